"""Operator 3: removal of repeated passages by bucket-pointer refinement.

Every byte of a 50-byte string that also starts in a document with a smaller id is
removed.  As in bucket-pointer refinement, suffixes fall into initial q-gram buckets, and a
bucket is refined by what stands at later offsets, the refined buckets being used again:

1. Buckets.  A 50-byte string belongs to the bucket of its smallest q-gram (by hash, the
   leftmost of equals), so equal strings lie at equal offsets in one bucket, and about one
   position in ``(50 - q + 2) / 2`` has to be shipped.  A run of neighbouring strings with one
   q-gram is one entry.
2. First refinement, by the whole context of a run: all runs with the context of a run in a
   document with a smaller id are removed as a whole; one run per context remains.
   Contexts met in a block are merged before they are shipped, so a passage that a third of
   all documents share is one entry per block and not one per document.
3. Second refinement, by the bucket of the half before and of the half after the q-gram:
   a shared 50-byte string covers one of them, so runs alone in both are done.
4. Third refinement, by whole strings, only for what is left, shipped and merged in the same
   way.

Buckets are hashes (40 bits of the q-gram beyond its partition and 64 of the context; 64 bits
of whole strings beyond theirs).  The shipped entries are packed per block and partition.  A
document longer than a block is read in overlapping parts.

Defined results: a null text is the empty text; strings are judged on the input, and the
earliest document keeps them; repeats inside one document stay, as do rows with a null id;
rows that repeat an id are judged each by its own text, none of them earlier than the other; an empty table gives no rows;
other columns are ignored and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import shuffle_partitions, slices
from .rolling import Rolling, mix, sliding_min

LENGTH = 50
Q = 12
SIDE = (LENGTH - Q) // 2          # a shared string goes this far beyond the q-gram on one side
BLOCK = 1_500_000                 # bytes; positions in a block have 24 bits
STRINGS = 400_000                 # whole strings that are shipped as one block
_LOW24 = np.uint64((1 << 24) - 1)
_TOP40 = ~_LOW24
_WHOLE = 1 << 7                   # flag of a run that is removed as a whole


def _planes(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of every number, byte by byte (which compresses better)."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unplane(raw: memoryview, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, n * width).reshape(width, n).T
    return out.reshape(-1).view("<u8")


#: Bytes of each column of shipped runs, and of shipped strings.
_WIDTHS = {"q": 5, "c": 8, "left": 2, "right": 2, "back": 1, "more": 1, "lo": 4, "doc": 4}
_STRING_WIDTHS = {"w": 8, "lo": 4, "doc": 4}


def _pack(ids: np.ndarray, keys: np.ndarray, cols: dict[str, np.ndarray], widths: dict[str, int] = _WIDTHS) -> bytes:
    """Entries of one block and partition: number of documents and entries, the documents'
    ids and the hashes of their texts, and the columns; ``doc`` is the place among the ids."""
    used, doc = np.unique(cols["doc"], return_inverse=True)
    step = np.diff(doc, prepend=0)            # entries are in document order
    head = np.array([len(used), len(doc)], "<u8").tobytes() + ids[used].astype("<i8").tobytes() + keys[used].astype("<i8").tobytes()
    return head + b"".join(_planes(step if k == "doc" else cols[k], w) for k, w in widths.items())


def _unpack(raw: bytes, widths: dict[str, int] = _WIDTHS) -> dict[str, np.ndarray]:
    view = memoryview(raw)
    docs, n = (int(x) for x in np.frombuffer(view[:16], "<u8"))
    ids, keys = np.frombuffer(view[16:16 + 16 * docs], "<i8").reshape(2, docs)
    at, out = 16 + 16 * docs, {}
    for k, w in widths.items():
        out[k] = _unplane(view[at:at + n * w], n, w)
        at += n * w
    place = np.cumsum(out["doc"].astype(np.int64))
    out["doc"], out["key"] = (ids[place], keys[place]) if n else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return out


def runs_of(parts: list[tuple[int, bytes, int]]) -> dict[str, np.ndarray]:
    """Entries of a block of ``(document's place, bytes, offset of these bytes in it)``: every
    maximal run of 50-byte strings with one smallest q-gram."""
    buf = np.frombuffer(b"".join(p[1] for p in parts) + bytes(LENGTH), np.uint8)
    length = np.array([len(p[1]) for p in parts], np.int64)
    start = np.cumsum(length) - length
    rolling = Rolling(buf)
    gram, side, whole = rolling.of(Q), rolling.of(Q + SIDE), rolling.of(LENGTH)
    key = (gram & _TOP40) | np.arange(len(gram), dtype=np.uint64)
    n = len(buf) - LENGTH
    anchor = (sliding_min(key, LENGTH - Q + 1)[:n] & _LOW24).astype(np.int64)
    part = np.repeat(np.arange(len(parts)), length)
    p = np.flatnonzero(np.arange(n) + LENGTH <= np.repeat(start + length, length))
    if not len(p):
        return {}
    anchor, part = anchor[p], part[p]
    first = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])))
    last = np.append(first[1:], len(p)) - 1
    lo, hi, a, part = p[first], p[last], anchor[first], part[first]
    odd = np.uint64(0x9E3779B97F4A7C15)
    shape = ((a - lo) * 64 + (hi - lo)).astype(np.uint64)
    code = mix(gram[a] + odd)
    context = mix((whole[lo] * odd + whole[hi]) * odd + shape)
    offset = np.array([x[2] for x in parts], np.int64) - start
    return {"doc": np.array([x[0] for x in parts], np.int64)[part], "lo": lo + offset[part], "more": hi - lo, "back": a - lo,
            "code": code, "c": context, "left": side[np.maximum(a - SIDE, 0)] & np.uint64(0xFFFF),
            "right": side[np.minimum(a, len(side) - 1)] & np.uint64(0xFFFF)}


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[tuple[int, int], bytes, int]]]:
    """Blocks of ``((id, hash of the text), bytes, offset)``; a document beyond a block comes in parts that
    overlap by one string less a byte."""
    block, held = [], 0
    for batch in slices(batches):
        for doc, text, key in zip(*(batch.column(k).to_pylist() for k in range(3))):
            raw = (text or "").encode()
            for at in range(0, max(1, len(raw) - LENGTH + 1), BLOCK):
                piece = raw[at:at + BLOCK + LENGTH - 1]
                if len(piece) < LENGTH:
                    continue
                if held and held + len(piece) > BLOCK + LENGTH:
                    yield block
                    block, held = [], 0
                block.append(((doc, key), piece, at))
                held += len(piece)
    if block:
        yield block


def _as_run(lo: np.ndarray, more: np.ndarray, flag: int) -> np.ndarray:
    return lo.astype(np.int64) << 8 | more.astype(np.int64) | flag


def _shipped(ids: np.ndarray, keys: np.ndarray, cols: dict[str, np.ndarray], same: np.ndarray, part: np.ndarray, n_parts: int,
             widths: dict[str, int]) -> pa.RecordBatch:
    """A block's entries, packed per partition.  Entries with equal ``same`` have one content:
    if an earlier document of the block has it, an entry is decided here (as a run that goes,
    packed under a negative partition)."""
    order = np.argsort(same, kind="stable")
    new = np.append(True, same[order][1:] != same[order][:-1])
    lead = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    done = np.zeros(len(order), bool)
    done[order] = ids[cols["doc"][lead]] < ids[cols["doc"][order]]
    out_part, out = [], []
    if done.any():
        out_part.append(-1 - int(ids[0]) % n_parts)
        run = _as_run(cols["lo"][done], cols["more"][done], _WHOLE)
        out.append(np.column_stack([ids[cols["doc"][done]], keys[cols["doc"][done]], run]).astype("<i8").tobytes())
    live = np.flatnonzero(~done)
    live = live[np.argsort(part[live], kind="stable")]
    cut = np.searchsorted(part[live], np.arange(n_parts + 1))
    for k in np.flatnonzero(np.diff(cut)):
        at = live[cut[k]:cut[k + 1]]
        out_part.append(int(k))
        out.append(_pack(ids, keys, {c: cols[c][at] for c in widths}, widths))
    return pa.RecordBatch.from_arrays([pa.array(out_part, pa.int32()), pa.array(out, pa.binary())], ["part", "entries"])


def _ship(n_parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            names = sorted({b[0] for b in block})
            place = {d: k for k, d in enumerate(names)}
            ids, keys = np.array(names, np.int64).reshape(-1, 2).T
            block.sort(key=lambda b: (b[0], b[2]))
            e = runs_of([(place[d], raw, at) for d, raw, at in block])
            if e:
                code = e.pop("code")
                e["q"] = code >> np.uint64(24)
                yield _shipped(ids, keys, e, mix(code ^ e["c"] * np.uint64(0xC2B2AE3D27D4EB4F)), (code % np.uint64(n_parts)).astype(np.int64), n_parts, _WIDTHS)
    return run


def _spread(group: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether an entry's group holds different documents."""
    _, at = np.unique(group, return_inverse=True)
    low, high = np.full(at.max() + 1, np.iinfo(np.int64).max), np.full(at.max() + 1, np.iinfo(np.int64).min)
    np.minimum.at(low, at, doc)
    np.maximum.at(high, at, doc)
    return (low < high)[at]


def refine(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents (ids, hashes of texts) and runs of one partition of buckets that are removed as a whole or must
    be looked at string by string."""
    got = [_unpack(x) for x in packed]
    e = {k: np.concatenate([g[k] for g in got]) for k in (*_WIDTHS, "key")}
    if not len(e["q"]):
        return (np.zeros(0, np.int64),) * 3
    order = np.lexsort((e["doc"], e["c"], e["q"]))
    e = {k: v[order] for k, v in e.items()}
    bucket = np.append(True, e["q"][1:] != e["q"][:-1])
    context = bucket | np.append(True, e["c"][1:] != e["c"][:-1])
    b, c = np.cumsum(bucket) - 1, np.cumsum(context) - 1
    earliest = e["doc"][np.flatnonzero(context)][c]
    whole = e["doc"] > earliest
    n_contexts = np.bincount(b[np.flatnonzero(context)])
    rest = np.flatnonzero(~whole & (n_contexts[b] > 1))
    lo, more = e["lo"].astype(np.int64), e["more"].astype(np.int64)
    if len(rest):
        doc, side = e["doc"][rest], b[rest].astype(np.int64) << 16
        left, right = _spread(side | e["left"][rest].astype(np.int64), doc), _spread(side | e["right"][rest].astype(np.int64), doc)
        # strings that reach SIDE bytes before the q-gram start at `edge` or earlier, those
        # that reach as far behind it start there or later
        hi, edge = lo[rest] + more[rest], lo[rest] + e["back"][rest].astype(np.int64) - SIDE
        hi = np.where(right, hi, np.minimum(hi, edge))
        lo[rest] = np.where(left, lo[rest], np.maximum(lo[rest], edge))
        more[rest] = hi - lo[rest]
        rest = rest[(left | right) & (hi >= lo[rest])]
    at = np.concatenate([np.flatnonzero(whole), rest])
    run = _as_run(lo[at], more[at], 0)
    run[:int(whole.sum())] |= _WHOLE
    return e["doc"][at], e["key"][at], run


def _decided(group: pd.DataFrame) -> pd.DataFrame:
    pairs = np.frombuffer(b"".join(group["entries"]), "<i8").reshape(-1, 3)
    return pd.DataFrame({"doc_id": pairs[:, 0], "key": pairs[:, 1], "run": pairs[:, 2]})


def _refine(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    if key[0] < 0:
        return _decided(group)
    doc, text, run = refine(list(group["entries"]))
    return pd.DataFrame({"doc_id": doc, "key": text, "run": run})


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed bytes of the texts, which are shuffled by id twice."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in slices(batches):
        raw = [press.compress((t or "").encode()) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(raw, pa.binary())], ["doc_id", "key", "raw"])


def _strings(n_parts: int):
    """Ships the whole strings of runs that are not decided."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()

        def shipped(held: list[tuple]) -> pa.RecordBatch:
            held.sort(key=lambda x: x[0])
            names = sorted({x[0] for x in held})
            at_name = {d: k for k, d in enumerate(names)}
            ids, keys = np.array(names, np.int64).reshape(-1, 2).T
            place = np.array([at_name[x[0]] for x in held])
            first, w, at = (np.concatenate([x[k] for x in held]) for k in (1, 2, 3))
            cols = {"w": w, "lo": at, "more": np.zeros(len(at), np.int64), "doc": np.repeat(place, [len(x[3]) for x in held])}
            return _shipped(ids, keys, cols, w, (first % np.uint64(n_parts)).astype(np.int64), n_parts, _STRING_WIDTHS)

        held, n = [], 0
        for batch in slices(batches):
            for doc, key, raw, mine in zip(*(batch.column(k).to_pylist() for k in range(4))):
                buf = np.frombuffer(press.decompress(raw), np.uint8)
                runs = np.unique(np.asarray(mine, np.int64))
                more = (runs & 127) + 1
                at = np.repeat(runs >> 8, more) + np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more)
                held.append(((doc, key), Rolling(buf).of(LENGTH)[at], Rolling(buf, second=True).of(LENGTH)[at], at))
                n += len(at)
                if n > STRINGS:
                    yield shipped(held)
                    held, n = [], 0
        if held:
            yield shipped(held)
    return run


def _late(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Strings of one partition that an earlier document has, as runs that go."""
    if key[0] < 0:
        return _decided(group)
    got = [_unpack(x, _STRING_WIDTHS) for x in group["entries"]]
    w, doc, text, at = (np.concatenate([g[k] for g in got]) for k in ("w", "doc", "key", "lo"))
    order = np.lexsort((doc, w))
    w, doc, text, at = w[order], doc[order], text[order], at[order].astype(np.int64)
    new = np.append(True, w[1:] != w[:-1])
    gone = doc > doc[np.flatnonzero(new)][np.cumsum(new) - 1]
    return pd.DataFrame({"doc_id": doc[gone], "key": text[gone], "run": _as_run(at[gone], 0 * at[gone], _WHOLE)})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdDecompressor()
    for batch in slices(batches):
        out: list[list] = [[], [], [], [], []]
        for doc, text, runs in zip(*(batch.column(k).to_pylist() for k in range(3))):
            buf = np.frombuffer(press.decompress(text), np.uint8)
            edge = np.zeros(len(buf) + 1, np.int64)
            if runs:
                run = np.asarray(runs, np.int64)
                np.add.at(edge, run >> 8, 1)
                np.add.at(edge, (run >> 8) + (run & 127) + LENGTH, -1)
            gone = np.cumsum(edge)[:-1] > 0
            spans = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
            kept = buf[~gone].tobytes()
            for col, x in zip(out, (doc, len(buf), int(gone.sum()), len(spans) // 2, hashlib.sha256(kept).hexdigest())):
                col.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                         ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _by_id(docs: DataFrame) -> DataFrame:
    squeezed = docs.select("doc_id", "text", "key").mapInArrow(_squeezed, "doc_id long, key long, raw binary")
    return squeezed.repartition(shuffle_partitions(docs.sparkSession), "doc_id", "key")


def removed_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, key, run)`` for documents with ``doc_id``, ``text`` and its hash ``key``: runs of
    strings to be removed, as ``first position << 8 | further strings``."""
    n = shuffle_partitions(docs.sparkSession)
    known = docs.where(F.col("doc_id").isNotNull())
    shipped = known.select("doc_id", "text", "key").mapInArrow(_ship(n), "part int, entries binary")
    runs = materialize(shipped.groupBy("part").applyInPandas(_refine, "doc_id long, key long, run long"), "passages")
    open_runs = runs.where(F.col("run").bitwiseAND(_WHOLE) == 0).groupBy("doc_id", "key").agg(F.collect_list("run").alias("runs"))
    strings = _by_id(known).join(open_runs, ["doc_id", "key"]).select("doc_id", "key", "raw", "runs").mapInArrow(_strings(n), "part int, entries binary")
    late = strings.groupBy("part").applyInPandas(_late, "doc_id long, key long, run long")
    whole = runs.where(F.col("run").bitwiseAND(_WHOLE) != 0)
    return whole.union(late).select("doc_id", "key", (F.col("run") - _WHOLE).alias("run"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("key"))
    runs = removed_runs(rows).groupBy("doc_id", "key").agg(F.collect_list("run").alias("runs"))
    return _by_id(rows).join(runs, ["doc_id", "key"], "left").select("doc_id", "raw", "runs").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
