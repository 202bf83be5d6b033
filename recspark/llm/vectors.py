"""Operator 10: near-duplicate embeddings by sharded HNSW graphs.

Vectors are dealt to shards by a hash of their number; each shard builds one hierarchical
navigable small-world graph (layers of geometrically fewer nodes, links chosen for
diversity, inserted in batches).  Every vector queries every shard: a task reads a shard's graph
once and the queries stream past it, so a graph is copied only as often as tasks are needed.
A query whose beam is full of links gets a beam four times as wide until it is not.

The graphs answer, and an audit of bounded size sets their beam: ``AUDIT`` vectors of a shard get a
planted twin each, at a cosine between the threshold and 1, that is a node like any other.
Then these vectors are searched and also compared with the whole shard.  Recall is
measured for the links to twins and for the links to real vectors; while one is below
``RECALL``, the beam is doubled, in the end to the whole shard.  So an audit sees at least
``AUDIT`` links however rare they are in the table, and brute force answers nothing but the audit.
Found vectors count only if their cosine in double precision reaches the threshold.

Vectors that are equal in all components are one vector with a count from the start, so a
common vector is one query and one node.  A task returns, per query, the number of linked
vectors, and of the links of a batch only those that connect components (a spanning forest), so groups
of any size never become lists of pairs.  The components are united over all tasks.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component,
and rows with a null id, link with nothing and are kept; vectors of different lengths do
not link; repeated rows are vectors of their own; an empty table gives no rows; other columns
are ignored and may have any name.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import components, least_label

THRESHOLD = 0.95
SHARD_ROWS = 50_000
SHARDS = 8               # at least, so that small tables use several tasks too
SHARD_BYTES = 1 << 27    # of a shard's vectors, about
QUERY_ROWS = 1 << 20     # queries of one task, at most about
LINKS = 8                # of a node per upper layer; twice as many in the lowest
BUILD_BEAM = 32
BEAM = 48
RECALL = 0.98
AUDIT = 256              # vectors of a shard with a twin, at most a quarter of it


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no length over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Graph:
    """A hierarchical navigable small-world graph over unit vectors."""

    def __init__(self, x: np.ndarray, links: int = LINKS, build_beam: int = BUILD_BEAM, seed: int = 7):
        self.x, n = x.astype(np.float32), len(x)
        self.links = links
        draw = np.random.default_rng(seed).random(n)
        level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(links)).astype(int), 6)
        order = np.argsort(-level, kind="stable")          # the entry node has the highest level
        self.x, self.order, level = self.x[order], order, level[order]
        # layer l holds the nodes 0 .. sizes[l] - 1 (nodes are sorted by falling level)
        self.sizes = [int((level >= k).sum()) for k in range(int(level[0]) + 1)] if n else [0]
        self.near = [np.full((s, links * (2 if k == 0 else 1)), -1, np.int32) for k, s in enumerate(self.sizes)]
        rng = np.random.default_rng(seed + 1)
        for k in reversed(range(len(self.sizes))):
            size = self.sizes[k]
            todo = rng.permutation(size) if k == 0 else np.arange(size)
            if k == 0 and len(self.sizes) > 1:             # upper nodes first: they are the entries
                todo = np.concatenate([np.arange(self.sizes[1]), rng.permutation(np.arange(self.sizes[1], size))])
            done = 0
            while done < size:
                batch = todo[done:done + max(16, min(256, done))]
                self._insert(k, batch, todo[:done], build_beam)
                done += len(batch)

    def packed(self) -> tuple:
        """All but the vectors."""
        return self.links, self.order, self.sizes, self.near

    @classmethod
    def unpacked(cls, packed: tuple, x: np.ndarray) -> Graph:
        graph = cls.__new__(cls)
        graph.links, graph.order, graph.sizes, graph.near = packed
        graph.x = x[graph.order].astype(np.float32)
        return graph

    def _insert(self, layer: int, batch: np.ndarray, before: np.ndarray, beam: int) -> None:
        width = self.near[layer].shape[1]
        q = self.x[batch]
        among = q @ q.T
        np.fill_diagonal(among, -2)
        take = min(width, len(batch))
        mates = np.argpartition(-among, take - 1, axis=1)[:, :take]
        ids, sims = batch[mates], np.take_along_axis(among, mates, 1)
        if len(before):
            start = self._enter(q, layer) if layer + 1 < len(self.sizes) else np.full(len(batch), before[0])
            known = np.zeros(self.sizes[layer], bool)
            known[before] = True
            start = np.where(known[start], start, before[0])
            far_ids, far_sims = self._beam(q, layer, start, beam)
            ids, sims = np.concatenate([far_ids, ids], 1), np.concatenate([far_sims, sims], 1)
        sims = np.where((ids < 0) | (ids == batch[:, None]), -2, sims)
        order = np.argsort(-sims, axis=1)[:, :max(beam, width)]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        for node, i, s in zip(batch, ids, sims):
            good = s > -2
            mine = self._diverse(i[good], s[good], width)
            self.near[layer][node, :len(mine)] = mine
            for other in mine:
                row = self.near[layer][other]
                free = np.flatnonzero(row < 0)
                if node in row:
                    continue
                if len(free):
                    row[free[0]] = node
                else:                   # of the two neighbours most alike the farther one goes
                    v = self.x[np.append(row, node)]
                    alike = v @ v.T
                    np.fill_diagonal(alike, -2)
                    pair = np.array(divmod(int(alike.argmax()), len(v)))
                    gone = int(pair[(v[pair] @ self.x[other]).argmin()])
                    if gone < width:
                        row[gone] = node

    def _diverse(self, ids: np.ndarray, sims: np.ndarray, width: int) -> np.ndarray:
        """Candidates (nearest first) that are nearer to the node than to any chosen one; the
        remaining places go to the nearest others."""
        if len(ids) <= 1:
            return ids
        between = self.x[ids] @ self.x[ids].T
        chosen: list[int] = []
        for k in range(len(ids)):
            if not chosen or between[k, chosen].max() < sims[k]:
                chosen.append(k)
                if len(chosen) == width:
                    break
        if len(chosen) < width:
            left = [k for k in range(len(ids)) if k not in set(chosen)]
            chosen += left[:width - len(chosen)]
        return ids[chosen]

    def _enter(self, q: np.ndarray, layer: int) -> np.ndarray:
        """Greedy descent from the top to the layer above ``layer``."""
        at = np.zeros(len(q), np.int64)
        for k in range(len(self.sizes) - 1, layer, -1):
            ids, _ = self._beam(q, k, at, 1)
            at = ids[:, 0]
        return at

    def _beam(self, q: np.ndarray, layer: int, start: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of all queries in step: ids (-1: none) and similarities, best first."""
        near, n = self.near[layer], len(q)
        ids = np.full((n, beam), -1, np.int64)
        sims = np.full((n, beam), -2.0, np.float32)
        fresh = np.zeros((n, beam), bool)
        ids[:, 0], sims[:, 0], fresh[:, 0] = start, np.einsum("ij,ij->i", q, self.x[start]), True
        seen = np.zeros((n, len(near)), bool)
        seen[np.arange(n), start] = True
        live = np.arange(n)
        while len(live):
            pick = np.where(fresh[live], sims[live], -3).argmax(axis=1)
            at = ids[live, pick]
            fresh[live, pick] = False
            new = near[at].astype(np.int64)
            ok = (new >= 0) & ~seen[live[:, None], new]
            seen[live[:, None], np.where(ok, new, at[:, None])] = True
            s = np.where(ok, np.einsum("ij,ikj->ik", q[live], self.x[new]), -2).astype(np.float32)
            all_ids, all_sims = np.concatenate([ids[live], np.where(ok, new, -1)], 1), np.concatenate([sims[live], s], 1)
            all_fresh = np.concatenate([fresh[live], ok], 1)
            order = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[live], sims[live] = np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_sims, order, 1)
            fresh[live] = np.take_along_axis(all_fresh, order, 1)
            live = live[fresh[live].any(axis=1)]
        return ids, sims

    def search(self, q: np.ndarray, beam: int, enough: float) -> list[np.ndarray]:
        """Nodes at or above ``enough`` for every query; beams full of them are widened."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(q)
        q, todo = q.astype(np.float32), np.arange(len(q))
        while len(todo):
            if beam >= len(self.x):
                for k in range(0, len(todo), 512):
                    for i, row in zip(todo[k:k + 512], q[todo[k:k + 512]] @ self.x.T >= enough):
                        out[i] = self.order[np.flatnonzero(row)]
                return out
            wider = []
            step = max(16, min(512, 40_000 // beam))
            for k in range(0, len(todo), step):
                part = todo[k:k + step]
                ids, sims = self._beam(q[part], 0, self._enter(q[part], 0), beam)
                for i, row, s in zip(part, ids, sims):
                    if s[-1] >= enough:
                        wider.append(i)
                    else:
                        out[i] = self.order[row[s >= enough]]
            todo, beam = np.array(wider, int), beam * 4
        return out


def linked(graph: Graph, x: np.ndarray, q: np.ndarray, threshold: float, own: np.ndarray, beam: int) -> list[np.ndarray]:
    """Per query the shard's other vectors with cosine >= threshold, verified; ``own`` is the
    query's own place in the shard (-1: none).  Places from ``len(x)`` on are twins, left out."""
    out = []
    for k, c in enumerate(graph.search(q, beam, threshold - 1e-4)):
        c = c[(c < len(x)) & (c != own[k])]
        out.append(c[x[c] @ q[k] >= threshold])
    return out


def twins(x: np.ndarray, threshold: float, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Places of the audited vectors, and a vector near each of them."""
    rng = np.random.default_rng(seed)
    at = np.sort(rng.permutation(len(x))[:min(AUDIT, -(-len(x) // 4))])
    off = rng.normal(size=(len(at), x.shape[1]))
    off -= (off * x[at]).sum(axis=1, keepdims=True) * x[at]
    size = np.linalg.norm(off, axis=1, keepdims=True)
    off = np.where(size > 1e-9, off / np.maximum(size, 1e-9), 0)
    cos = threshold + (1 - threshold) * rng.uniform(0.02, 1, size=(len(at), 1))
    return at, _unit(cos * x[at] + np.sqrt(1 - cos * cos) * off)


def audited_beam(graph: Graph, x: np.ndarray, at: np.ndarray, twin: np.ndarray, threshold: float) -> int:
    """The narrowest of the beams ``BEAM``, twice that and so on that finds ``RECALL`` of the audited
    vectors' links to twins, and to other vectors."""
    every, place = np.concatenate([x, twin]), np.arange(len(x) + len(twin))
    truth = [np.flatnonzero((every @ x[k] >= threshold) & (place != k)) for k in at]
    beam = BEAM
    while beam < len(every):
        hit, want = np.zeros(2), np.zeros(2)
        for true, got in zip(truth, graph.search(x[at], beam, threshold - 1e-4)):
            found = np.isin(true, got)
            for side, part in enumerate((true < len(x), true >= len(x))):
                hit[side] += found[part].sum()
                want[side] += part.sum()
        if (hit >= RECALL * want).all():
            return beam
        beam *= 2
    return len(every)


def _build(threshold: float):
    """A shard's graph with its vectors, numbers, counts and beam, as one row."""
    def run(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("rep", kind="stable")
        x = _unit(np.stack(shard["v"].to_list()).astype(np.float64))
        at, twin = twins(x, threshold)
        graph = Graph(np.concatenate([x, twin]))
        beam = audited_beam(graph, x, at, twin, threshold)
        held = pickle.dumps((graph.packed(), x, twin, shard["rep"].to_numpy(), shard["copies"].to_numpy(), beam), protocol=5)
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "graph": [held]})
    return run


def _answers(shard: tuple, q_ids: np.ndarray, q: np.ndarray, threshold: float) -> pa.RecordBatch:
    """``(kind, id, value)``: 0 for a query's number of links, 1 for a link of the spanning forest."""
    graph, x, ids, count, beam = shard
    place = np.minimum(np.searchsorted(ids, q_ids), len(ids) - 1)      # ids ascend
    got = linked(graph, x, _unit(q), threshold, np.where(ids[place] == q_ids, place, -1), beam)
    root: dict[int, int] = {}

    def find(a: int) -> int:
        while (b := root.setdefault(a, a)) != a:
            root[a] = a = root.setdefault(b, b)
        return a

    rows = []
    for me, near in zip(q_ids.tolist(), got):
        if len(near):
            rows.append((0, me, int(count[near].sum())))
        for other in ids[near].tolist():
            a, b = find(me), find(other)
            if a != b:
                root[max(a, b)] = min(a, b)
                rows.append((1, me, other))
    cols = np.array(rows, np.int64).reshape(-1, 3).T
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1]), pa.array(cols[2])], ["kind", "id", "value"])


def _search(threshold: float):
    """Rows ``(graph, rep, v, dim, shard)``: queries stream past the graph that stands before them; a
    length that a shard lacks has no graph there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, of = None, None
        for batch in batches:
            held = batch.column(0)
            where = np.column_stack([batch.column(k).to_numpy() for k in (3, 4)])
            heads = np.flatnonzero(held.is_valid().to_numpy(zero_copy_only=False))
            edges = [-1, *heads.tolist(), batch.num_rows]
            for lo, hi in zip(edges, edges[1:]):
                if lo >= 0:
                    packed, x, twin, names, count, beam = pickle.loads(held[lo].as_py())
                    shard, of = (Graph.unpacked(packed, np.concatenate([x, twin])), x, names, count, beam), where[lo]
                mine = np.flatnonzero((where[lo + 1:hi] == of).all(axis=1)) + lo + 1 if shard else []
                if len(mine):
                    part = batch.take(pa.array(mine))
                    q = part.column(2).flatten().to_numpy(zero_copy_only=False)
                    yield _answers(shard, part.column(1).to_numpy(), q.reshape(len(mine), -1), threshold)
    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                 shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col(id_col).isNotNull() & F.coalesce(F.size(v) > 0, F.lit(False)) & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)
    # adding 0.0 makes the two zeros equal
    rows = materialize(vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                                      F.when(usable, F.transform(v, lambda x: x + F.lit(0.0))).alias("v")), "vectors")
    texts = rows.where(F.col("v").isNotNull())
    one = materialize(texts.groupBy("v").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"))
                      .withColumn("rep", F.monotonically_increasing_id()), "vectors-distinct")
    one = one.withColumn("dim", F.size("v"))
    n, numbers = one.agg(F.count(F.lit(1)), F.coalesce(F.sum("dim"), F.lit(0))).first()
    shards = max(SHARDS, -(-n // shard_rows), -(-8 * numbers // SHARD_BYTES))
    # a shard's queries are cut into blocks only as far as there are cores without a shard
    blocks = max(-(-2 * vectors.sparkSession.sparkContext.defaultParallelism // shards), -(-n // QUERY_ROWS))
    shard = F.pmod(F.xxhash64("rep"), F.lit(shards)).cast("int")
    block = F.pmod(F.hash("rep"), F.lit(blocks)).cast("int")
    # the stated queries (all rows, in blocks) go to every shard
    queries = one.select("dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), block.alias("block"),
                         F.lit(None).cast("binary").alias("graph"), "rep", "v")
    graphs = materialize(one.select("dim", shard.alias("shard"), "rep", "copies", "v").groupBy("dim", "shard").applyInPandas(
        _build(threshold), "dim int, shard int, graph binary"), "vectors-graphs")
    held = graphs.select("dim", "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "graph",
                         F.lit(-1).cast("long").alias("rep"), F.lit(None).cast("array<double>").alias("v"))
    met = held.union(queries).repartition(2 * shards * blocks, "dim", "shard", "block").sortWithinPartitions("dim", "shard", "block", "rep")
    found = materialize(met.select("graph", "rep", "v", "dim", "shard").mapInArrow(_search(threshold), "kind int, id long, value long"), "vectors-links")
    links = found.where("kind = 0").groupBy("id").agg(F.sum("value").alias("n"))
    joined = components(found.where("kind = 1").select("id", "value"), "id", "value", "vectors-components")
    least = least_label(joined, one.select(F.col("rep").alias("id"), F.col("low").alias("label")), "vectors-least")
    per = one.select("v", "rep", "low", "copies").join(links.withColumnRenamed("id", "rep"), "rep", "left").join(
        least.select(F.col("id").alias("rep"), "least"), "rep", "left").select(
        F.col("v").alias("v2"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "low").alias("component_id"))
    out = rows.join(per, F.col("v") == F.col("v2"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
