"""Operator 8: near duplicates by improved consistent weighted sampling.

A text is the weighted set of its five-word shingles; a shingle's weight is its count in the
text times its inverse document frequency ``ln((1 + n) / (1 + df)) + 1`` over all ``n`` documents
with words.  Document frequencies are exact grouped counts of shingle hashes, of every shingle
however many there are: documents are written in blocks of about ``_BLOCK`` bytes, each one
compressed value, which all later steps read and exchange; a block
sends its distinct shingles to be counted and gets back the frequencies of those that lie in
several documents (all others lie in one), and its documents are sampled beside them.  No
table of shingles is held whole anywhere.  ``BANDS * ROWS`` consistent
samples of a text each choose a shingle together with its quantised weight by improved
consistent weighted sampling; two texts agree in a sample with the probability of their
weighted Jaccard similarity.  A sample draws from the shingles that a hash deals to it; what
stays empty is dealt again, and after ``DEALS`` deals draws from all shingles.  Texts that
agree in all rows of a band meet in a bucket.

A frequency counts every copy, so the shingles that a large group shares become light while
the edits of each copy stay heavy, and near copies of a large group have a low weighted
similarity.  So as many bands again come from samples in which every occurrence weighs one
(the shingle with the smallest hash of those dealt to a sample), and a pair of a bucket is
near if its exact weighted or its exact plain Jaccard similarity reaches the threshold.

No bucket is expanded into pairs, however large it is:

* texts with equal word sequences are one text from the start (grouped minimum);
* every bucket's members are verified against one of them, the one that lies in most
  buckets; the connected components of these links are taken;
* members of a bucket that are not in its largest component are compared with all its
  members, in blocks of about ``SIDE`` by ``SIDE`` texts (a matrix product of their shared
  shingles), pairs within one component excepted; a block returns only links that connect
  components.

So every pair of a bucket is verified unless it is connected already, and classes are the
connected components of all links.  Intermediate tables are written to the shared folder;
texts, frequencies and shingles go from there as soon as the next table is written.

Defined results: texts without a word (null and empty too) resemble nothing and are classes
of their own; a row with a null id has a null class and always stays; a document is an id with a text, so rows
that repeat both are one document and an id with several texts is several (each with the
smallest id of its own class); an empty table gives no rows; other columns are kept by `drop_near` and
may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize
from .common import components, least_label, shuffle_partitions, slices
from .rolling import mix

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 20, 5
DEALS = 8
SIDE = 256
TABLE = 1 << 20                # entries of the table of `inverse_frequencies`, at most
_KEY = np.uint64(24)           # a shingle is counted by its hash without these low bits
_HELD = 2_000_000              # shingles that a counting task holds at once
_PART = 1 << 25                # code points whose shingles are counted in one group, about
_BLOCK = 1 << 22               # bytes of text whose shingles are looked up together, about
_AT_ONCE = 1 << 16             # shingles that are sampled at once, about


_BASE = 0x9E3779B97F4A7C15
_BATCH = 400_000               # bytes of text that are hashed at once


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    one = np.ones(1, np.uint64)
    return tuple(np.concatenate([one, np.multiply.accumulate(np.full(n, b, np.uint64))]) for b in (_BASE, pow(_BASE, -1, 1 << 64)))


def word_hashes(raw: list[bytes]) -> list[np.ndarray]:
    """Hashes of the words (runs of bytes other than ASCII white space) of each text, by prefix
    sums of a polynomial over all bytes."""
    x = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    n = len(x)
    up, down = _powers(1 << max(19, (n - 1).bit_length()))
    inside = np.concatenate([[False], (x != 32) & ((x < 9) | (x > 13)), [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum((x.astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64)])
    h = mix((run[end] - run[start]) * down[start] + (end - start).astype(np.uint64))
    length = np.array([len(r) + 1 for r in raw])
    first = np.searchsorted(start, np.cumsum(length) - length)
    return np.split(h, first[1:])


def _shingles(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (ascending) and their counts, from word hashes."""
    k = min(WORDS, len(h))
    n = len(h) - k + 1
    s = h[:n].copy()
    for j in range(1, k):
        s = s * np.uint64(_BASE) + h[j:j + n]
    s = mix(s)
    s.sort()
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    return s[first], np.diff(np.append(first, n))


def hashed(text: list[str | bytes | None]) -> Iterator[np.ndarray]:
    """Word hashes of each text (bytes: its UTF-8), worked out in batches of bounded size."""
    held, size = [], 0
    for t in text:
        held.append(t.encode() if isinstance(t, str) else t or b"")
        size += len(held[-1])
        if size > _BATCH:
            yield from word_hashes(held)
            held, size = [], 0
    if held:
        yield from word_hashes(held)


def shingled(text: list[str | bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
    for h in hashed(text):
        yield _shingles(h) if len(h) else None


class Weights:
    """Inverse document frequencies: those of the shingles in the table, and the one of all others."""

    def __init__(self, n: int, floor: int, keys: np.ndarray, df: np.ndarray):
        order = np.argsort(keys)
        self.n, self.floor, self.keys = n, floor, keys[order]
        self.idf = (np.log((1 + n) / (1 + df[order])) + 1).astype(np.float32)
        self.rare = np.float32(np.log((1 + n) / (1 + floor)) + 1)

    def of(self, shingles: np.ndarray) -> np.ndarray:
        out = np.full(len(shingles), self.rare, np.float32)
        if len(self.keys):
            key = shingles >> _KEY
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[at] == key
            out[known] = self.idf[at[known]]
        return out


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending 40-bit keys as compressed byte planes of their steps, and their counts."""
    step = np.diff(keys, prepend=np.uint64(0))
    planes = [np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :w].T).tobytes() for x, w in ((step, 5), (counts, 5))]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(2, 5, -1)
    out = np.zeros((2, planes.shape[2], 8), np.uint8)
    out[:, :, :5] = planes.transpose(0, 2, 1)
    step, counts = out.reshape(2, -1).view("<u8")
    return np.cumsum(step, dtype=np.uint64), counts.astype(np.int64)


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys (ascending) with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts


_COUNTS = "docs long, total long, packed binary"
_ASKED = "part int, block long, docs long, packed binary"


def _count(parts: int):
    """Counts of the shingles of ``(block, text)`` or ``(block, packed)``, added up within a block as far as a task can hold
    them, per range of keys."""
    def shipped(held: list[np.ndarray], block: int) -> pa.RecordBatch:
        key = np.concatenate(held)
        keys, counts = _added(key, np.ones(len(key), np.int64))
        part = (keys * np.uint64(parts) >> np.uint64(40)).astype(np.int64)
        cut = np.searchsorted(part, np.arange(parts + 1))
        used = np.flatnonzero(np.diff(cut))
        packed = [_packed(keys[cut[k]:cut[k + 1]], counts[cut[k]:cut[k + 1]]) for k in used]
        n_docs = np.zeros(len(used), np.int64)
        n_docs[0] = len(held)
        blocks = np.full(len(used), block, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(blocks), pa.array(n_docs), pa.array(packed, pa.binary())],
                                          ["part", "block", "docs", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, now = [], 0, 0
        for block, text in (x for batch in batches for x in _texts(batch)):
            for got in shingled(text):
                if held and (block != now or n > _HELD):
                    yield shipped(held, now)
                    held, n = [], 0
                now = block
                if got:
                    # a document counts once for a key
                    key = got[0] >> _KEY
                    held.append(key[np.append(True, key[1:] != key[:-1])])
                    n += len(held[-1])
        if held:
            yield shipped(held, now)
    return run


def _asked(docs: DataFrame) -> DataFrame:
    """The distinct shingles of `blocks` or `packed_blocks`, packed, per block and range of keys."""
    column, each = ("packed", F.col("size")) if "packed" in docs.columns else ("text", F.char_length("text"))
    size = docs.agg(F.coalesce(F.sum(each), F.lit(0))).first()[0]
    parts = max(shuffle_partitions(docs.sparkSession), -(-size // _PART))
    return docs.select("block", column).mapInArrow(_count(parts), _ASKED)


def _add(group: pd.DataFrame) -> pd.DataFrame:
    """Document frequencies of one range of keys; those of 1 are only counted."""
    got = [_unpacked(raw) for raw in group["packed"]]
    keys, df = _added(*(np.concatenate([g[k] for g in got]) for k in (0, 1)))
    more = df > 1
    return pd.DataFrame({"docs": [int(group["docs"].sum())], "total": [int(df.sum())], "packed": [_packed(keys[more], df[more])]})


def _frequencies(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys that several documents hold and how many: in few copies of the arrays, as they are a task's largest."""
    keys, counts = [], []
    for r in raw:
        k, c = _unpacked(r)
        keys.append(k)
        counts.append(c.astype(np.int32))
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    del order
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    df = np.add.reduceat(counts, first, dtype=np.int64) if len(first) else counts.astype(np.int64)
    return keys[first[df > 1]], df[df > 1]


def _answer(group: pa.Table) -> pa.Table:
    """For every block that asks: the document frequencies over 1 of its shingles in one range of keys."""
    raw = group["packed"].to_pylist()
    keys, df = _frequencies(raw)
    out = []
    for r in raw:
        mine, _ = _unpacked(r)
        at = np.searchsorted(keys, mine)
        hit = at < len(keys)
        hit[hit] = keys[at[hit]] == mine[hit]
        out.append(_packed(mine[hit], df[at[hit]]) if hit.any() else None)
    return pa.table([group["block"], group["docs"], pa.array(out, pa.binary())], ["block", "docs", "packed"])


_ROW = pa.schema([("doc_id", pa.int64()), ("text", pa.binary()), ("raw", pa.string())])


def _closed(batches: list[pa.RecordBatch]) -> bytes:
    """Rows of ``(doc_id, text, raw)`` as one compressed value."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _ROW, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        for batch in batches:
            out.write_batch(pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(batch.columns, _ROW.types)], schema=_ROW))
    return sink.getvalue().to_pybytes()


def _opened(packed: pa.Scalar) -> Iterator[pa.RecordBatch]:
    """The rows of a block, a few at a time; texts are bytes."""
    with pa.ipc.open_stream(packed.as_buffer()) as rows:
        yield from rows


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str | bytes | None]]]:
    """Texts of one block after the other, a few at a time, of rows ``(block, text)`` or ``(block, packed)``."""
    if "packed" in batch.schema.names:
        for block, packed in zip(batch.column("block").to_pylist(), batch.column("packed")):
            for part in _opened(packed):
                yield block, part.column("text").to_pylist()
    else:
        for mine in slices([batch]):
            for block, text in groupby(zip(mine.column("block").to_pylist(), mine.column("text").to_pylist()), key=itemgetter(0)):
                yield block, [t for _, t in text]


def _numbered(batches: Iterator[pa.RecordBatch], per: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows ``(doc_id, text, raw)`` with the number of each row's block of about ``per`` bytes."""
    first, at = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        size = at + np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = int(size[-1]) if len(size) else at
        yield batch, first + size // per


def blocks(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, raw)`` with the number of its block, written once: neighbouring rows of about
    ``_BLOCK`` bytes of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in _numbered(batches, _BLOCK):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block, pa.int64())], ["doc_id", "text", "raw", "block"])

    return materialize(docs.select("doc_id", "text", "raw").mapInArrow(run, "doc_id long, text string, raw string, block long"), "near-documents")


def packed_blocks(docs: DataFrame) -> DataFrame:
    """The rows of `blocks`, each block as one row ``(block, size, packed)``: its bytes of text, and its
    rows compressed.  Written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None

        def row() -> pa.RecordBatch:
            size = sum(pc.sum(pc.binary_length(x.column(1))).as_py() or 0 for x in held)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([size], pa.int64()), pa.array([_closed(held)], pa.binary())],
                                              ["block", "size", "packed"])

        for batch, block in _numbered(slices(batches), _BLOCK):
            cut = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for a, b in zip(cut, cut[1:]):
                if held and block[a] != now:
                    yield row()
                    held = []
                held.append(batch.slice(a, b - a))
                now = int(block[a])
        if held:
            yield row()

    return materialize(docs.select("doc_id", "text", "raw").mapInArrow(run, "block long, size long, packed binary"), "near-documents")


def frequencies(docs: DataFrame) -> tuple[int, DataFrame]:
    """Number of documents with words, and ``(block, docs, packed)``: the exact document frequencies of a
    block's shingles that lie in several documents, null where none do.  The hashes' low bits are left out (40 bits
    stay): two shingles count as one with a chance of one in 2**40 for each pair."""
    got = materialize(_asked(docs).groupBy("part").applyInArrow(_answer, "block long, docs long, packed binary"), "near-answers")
    return got.agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0], got


def _answered(answers: DataFrame) -> DataFrame:
    return answers.where(F.col("packed").isNotNull()).select("block", F.col("packed").alias("answer"))


def block_weights(n: int, answers: list[bytes]) -> Weights:
    """Weights of a block's shingles from the answers to it."""
    got = [_unpacked(raw) for raw in answers]
    keys, df = (np.concatenate([g[k] for g in got]) if got else np.zeros(0, t) for k, t in ((0, np.uint64), (1, np.int64)))
    keys, first = np.unique(keys, return_index=True)        # a block that was read in two tasks asked twice
    return Weights(n, 1, keys, df[first])


def inverse_frequencies(docs: DataFrame) -> Weights:
    """A bounded table of inverse document frequencies over all documents with words, for use apart
    from `classes`, which looks up every shingle: frequencies above ``floor``, the total of all
    documents' distinct shingles over ``TABLE`` (at least 1), all others weighing alike.  The
    hashes' low bits are left out (40 bits stay), so a shingle outside the table takes the weight
    of one within it with a chance of at most ``TABLE / 2**40``, one in a million."""
    asked = _asked(docs.select("text", F.lit(0).cast("long").alias("block")))
    counted = materialize(asked.select("part", "docs", "packed").groupBy("part").applyInPandas(_add, _COUNTS), "near-frequencies")
    n, total = counted.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    floor = max(1, -(-total // TABLE))

    def above(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                keys, df = _unpacked(raw)
                keys, df = keys[df > floor], df[df > floor]
                if len(keys):
                    yield pa.RecordBatch.from_arrays([pa.array([_packed(keys, df)], pa.binary())], ["packed"])

    # frequencies above total / TABLE: at most TABLE shingles
    got = [_unpacked(r[0]) for r in counted.select("packed").mapInArrow(above, "packed binary").collect()]
    keys, df = (np.concatenate([g[k] for g in got]) if got else np.zeros(0, t) for k, t in ((0, np.uint64), (1, np.int64)))
    return Weights(n, floor, keys, df)


def _gamma2() -> np.ndarray:
    """Quantiles of the gamma(2, 1) distribution, whose distribution function is
    1 - exp(-x) (1 + x), by Newton steps."""
    p = (np.arange(1 << 16) + 0.5) / (1 << 16)
    x = np.sqrt(2 * p) + p
    for _ in range(60):
        x = np.maximum(x - (1 - np.exp(-x) * (1 + x) - p) / np.maximum(x * np.exp(-x), 1e-300), 1e-6)
    return x


class Sampler:
    """Improved consistent weighted sampling: for a shingle of weight w and draws r, c from
    gamma(2, 1) and b uniform, all fixed by (shingle, sample): t = floor(log w / r + b), and
    the shingle with the smallest log c - r (t - b) - r is chosen with its t."""

    def __init__(self, samples: int):
        q = _gamma2()
        self.n, self.r, self.log_c = samples, q.astype(np.float32), np.log(q).astype(np.float32)
        self.seeds = mix(np.arange(1, samples + DEALS + 1, dtype=np.uint64))

    def _draw(self, h: np.ndarray, log_w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value and t of every shingle from its 64 random bits."""
        b = (h & np.uint64(0xFFFFFFFF)).astype(np.float32) * np.float32(2.0 ** -32)
        r = self.r[(h >> np.uint64(48)).astype(np.int64)]
        t = np.floor(log_w / r + b)
        return self.log_c[(h >> np.uint64(32) & np.uint64(0xFFFF)).astype(np.int64)] - r * (t - b + np.float32(1)), t

    def _dealt(self, shingles: np.ndarray, seed: np.uint64) -> np.ndarray:
        h = mix(shingles ^ seed)
        return (h - h // np.uint64(self.n) * np.uint64(self.n)).view(np.int64)

    @staticmethod
    def _codes(shingles: np.ndarray, t: np.ndarray) -> np.ndarray:
        return mix(shingles + t.astype(np.int64).view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))

    def samples(self, shingles: np.ndarray, weights: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
        """A row of codes per document, one per sample for the chosen (shingle, t); ``doc`` (ascending)
        is the document of every shingle."""
        code, empty = np.zeros(docs * self.n, np.uint64), np.ones(docs * self.n, bool)
        log_w = np.log(weights).astype(np.float32)
        s, lw, of = shingles, log_w, doc
        for seed in self.seeds[self.n:]:
            to = of * self.n + self._dealt(s, seed)
            use = np.flatnonzero(empty[to])
            a, t = self._draw(mix(s[use] + seed), lw[use])
            # the smallest value of a sample, then the first shingle (a float's bits, made to sort like the float)
            bits = a.view(np.int32).astype(np.int64)
            bits = np.where(bits < 0, -(bits & 0x7FFFFFFF), bits)
            least = np.full(docs * self.n, np.iinfo(np.int64).max)
            np.minimum.at(least, to[use], (bits << 32) + np.arange(len(use)))
            place = np.flatnonzero(least != np.iinfo(np.int64).max)
            at = least[place] & 0xFFFFFFFF
            code[place] = self._codes(s[use[at]], t[at])
            empty[place] = False
            stay = empty.reshape(docs, self.n).any(axis=1)[of]
            if not stay.any():
                break
            s, lw, of = s[stay], lw[stay], of[stay]
        code, empty = code.reshape(docs, self.n), empty.reshape(docs, self.n)
        for d in np.flatnonzero(empty.any(axis=1)):
            lo, hi = np.searchsorted(doc, (d, d + 1))
            k = np.flatnonzero(empty[d])        # few shingles: many would have filled all samples
            a, t = self._draw(mix(shingles[lo:hi] ^ self.seeds[k][:, None]), log_w[lo:hi])
            at = a.argmin(axis=1)
            code[d, k] = self._codes(shingles[lo + at], t[np.arange(len(k)), at])
        return code

    def plains(self, shingles: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
        """A row of codes per document, every shingle weighing one: the smallest hash of those dealt to a sample."""
        code, empty = np.zeros(docs * self.n, np.uint64), np.ones(docs * self.n, bool)
        s, of = shingles, doc
        for seed in self.seeds[self.n:]:
            h = mix(s + seed)
            to = of * self.n + self._dealt(h, np.uint64(0))
            use = empty[to]
            to, h = to[use], h[use]
            least = np.full(docs * self.n, np.iinfo(np.uint64).max)
            np.minimum.at(least, to, h)
            code[to] = least[to]
            empty[to] = False
            stay = empty.reshape(docs, self.n).any(axis=1)[of]
            if not stay.any():
                break
            s, of = s[stay], of[stay]
        code, empty = code.reshape(docs, self.n), empty.reshape(docs, self.n)
        for d in np.flatnonzero(empty.any(axis=1)):
            mine = shingles[doc == d]
            k = np.flatnonzero(empty[d])
            code[d, k] = mix(mine ^ self.seeds[k][:, None]).min(axis=1)
        return code

    def sample(self, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return self.samples(shingles, weights, np.zeros(len(shingles), np.int64), 1)[0]

    def plain(self, shingles: np.ndarray) -> np.ndarray:
        return self.plains(shingles, np.zeros(len(shingles), np.int64), 1)[0]

    def bands(self, sets: list[tuple[np.ndarray, np.ndarray]], idf: Weights, bands: int) -> np.ndarray:
        """Keys of the weighted bands, then of the plain ones: a row per document of ``sets`` (shingles, counts)."""
        shingles, counts = (np.concatenate([x[k] for x in sets]) for k in (0, 1))
        doc = np.repeat(np.arange(len(sets)), [len(x[0]) for x in sets])
        code = np.concatenate([self.samples(shingles, counts * idf.of(shingles), doc, len(sets)),
                               self.plains(np.concatenate([shingles, _again(shingles, counts)]), np.concatenate([doc, np.repeat(doc, counts - 1)]), len(sets))],
                              axis=1).reshape(len(sets), 2 * bands, -1)
        key = code[:, :, 0].copy()
        for j in range(1, code.shape[2]):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + code[:, :, j])
        return key.view(np.int64)


@lru_cache(maxsize=1)
def _sampler(samples: int) -> Sampler:
    return Sampler(samples)


def signatures(docs: DataFrame, n: int, answers: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(doc_id, raw, block, x1, x2, bands)``: a hash of the text, its block, a 128-bit hash of the word
    sequence and the band keys; documents without words are left out."""

    def run(mine: pa.Table, answered: pa.Table) -> pa.Table:
        sampler, idf = _sampler(bands * rows), block_weights(n, answered["answer"].to_pylist())
        ids, raws, exact, keys, held, n_held = [], [], [], [], [], 0
        for batch in (part for packed in mine["packed"] for part in _opened(packed)):
            for doc, raw, h in zip(batch.column("doc_id").to_pylist(), batch.column("raw").to_pylist(), hashed(batch.column("text").to_pylist())):
                if len(h):
                    ids.append(doc)
                    raws.append(raw)
                    exact.append(hashlib.md5(h.tobytes()).digest())
                    held.append(_shingles(h))
                    n_held += len(held[-1][0])
                    if n_held > _AT_ONCE:
                        keys.append(sampler.bands(held, idf, bands).ravel())
                        held, n_held = [], 0
        if held:
            keys.append(sampler.bands(held, idf, bands).ravel())
        x = np.frombuffer(b"".join(exact), "<i8").reshape(-1, 2)
        flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * (2 * bands), pa.int32()), pa.array(flat, pa.int64()))
        block = np.full(len(ids), mine["block"][0].as_py() if len(mine) else 0)
        return pa.table([pa.array(ids, pa.int64()), pa.array(raws, pa.string()), pa.array(block, pa.int64()), pa.array(x[:, 0]), pa.array(x[:, 1]), lists],
                        ["doc_id", "raw", "block", "x1", "x2", "bands"])

    return docs.select("block", "packed").groupBy("block").cogroup(_answered(answers).groupBy("block")).applyInArrow(
        run, "doc_id long, raw string, block long, x1 long, x2 long, bands array<long>")


def _again(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Codes of the second and later occurrences of the shingles, with the bits by which the
    shingle's weight is found."""
    again = np.repeat(shingles, counts - 1)
    place = np.arange(len(again)) - np.repeat(np.cumsum(counts - 1) - (counts - 1), counts - 1) + 1
    low = (np.uint64(1) << _KEY) - np.uint64(1)
    return (again & ~low) | ((again + place.astype(np.uint64)) & low)


def as_set(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A multiset as an ascending set: the second and later occurrences of a shingle get codes
    of their own."""
    if (counts == 1).all():
        return shingles
    return np.sort(np.concatenate([shingles, _again(shingles, counts)]))


def _sets(docs: DataFrame, wanted: DataFrame, n: int, answers: DataFrame) -> DataFrame:
    """``(doc_id, s, w)``: the shingles of whole texts and their weights, packed, by the number of the
    text.  ``wanted`` (block, doc_id, x1, x2, rep) says which: the one with that word sequence
    (x1, x2) among a block's rows with a text's smallest id."""

    def run(mine: pa.Table, right: pa.Table) -> pa.Table:
        out = {}
        asked = right.filter(pc.is_valid(right["rep"]))
        reps = {(d, a, b): r for d, a, b, r in zip(*(asked[c].to_pylist() for c in ("doc_id", "x1", "x2", "rep")))}
        if reps:
            idf = block_weights(n, right["answer"].drop_null().to_pylist())
            ids = pc.unique(asked["doc_id"].combine_chunks())
            for batch in (part for packed in mine["packed"] for part in _opened(packed)):
                batch = batch.filter(pc.is_in(batch.column("doc_id"), value_set=ids))
                for doc, h in zip(batch.column("doc_id").to_pylist(), hashed(batch.column("text").to_pylist())):
                    if len(h):
                        rep = reps.get((doc, *np.frombuffer(hashlib.md5(h.tobytes()).digest(), "<i8").tolist()))
                        if rep is not None and rep not in out:
                            got = as_set(*_shingles(h))
                            out[rep] = got.tobytes(), idf.of(got).astype("<f4").tobytes()
        return pa.table([pa.array(out, pa.int64()), *(pa.array([v[k] for v in out.values()], pa.binary()) for k in (0, 1))], ["doc_id", "s", "w"])

    right = _answered(answers).unionByName(wanted.select("block", "doc_id", "x1", "x2", "rep"), allowMissingColumns=True)
    return docs.select("block", "packed").groupBy("block").cogroup(right.groupBy("block")).applyInArrow(run, "doc_id long, s binary, w binary")


def weighted_jaccard(a: np.ndarray, b: np.ndarray, wa: np.ndarray, wb: np.ndarray) -> float:
    """Sum of smaller weights over sum of larger weights of two sets of `as_set` and their weights."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = float(wa[b[at] == a].sum(dtype=np.float64))
    total = float(wa.sum(dtype=np.float64) + wb.sum(dtype=np.float64))
    return both / (total - both)


def plain_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Shared occurrences over all occurrences of two sets of `as_set`."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return both / (len(a) + len(b) - both)


def near(a: np.ndarray, b: np.ndarray, wa: np.ndarray, wb: np.ndarray, threshold: float) -> bool:
    return plain_jaccard(a, b) >= threshold or weighted_jaccard(a, b, wa, wb) >= threshold


def _verify(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``(a, b)`` of document ids that are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [near(*(np.frombuffer(batch.column(c)[k].as_py(), kind) for c, kind in ((2, "<u8"), (3, "<u8"), (4, "<f4"), (5, "<f4"))), threshold)
                    for k in range(len(batch))]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    j = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("s").alias("sa"), F.col("w").alias("wa")), "a")
    j = j.join(sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb"), F.col("w").alias("wb")), "b")
    return j.select("a", "b", "sa", "sb", "wa", "wb").mapInArrow(run, "a long, b long")


def connecting(ids: np.ndarray, component: np.ndarray, rows: np.ndarray, cols: np.ndarray, sets: list[np.ndarray],
               weights: list[np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """Links between texts at ``rows`` and at ``cols`` that connect different components."""
    used = np.unique(np.concatenate([rows, cols]))
    weight = np.zeros(len(ids))
    for k in used:
        weight[k] = weights[k].sum(dtype=np.float64)
    _, first, at = np.unique(np.concatenate([sets[k] for k in used]), return_index=True, return_inverse=True)
    seen = np.bincount(at) > 1
    column = np.cumsum(seen) - 1
    n, w = int(seen.sum()), np.concatenate([weights[k] for k in used])[first[seen]].astype(np.float64)
    start = dict(zip(used.tolist(), np.cumsum([0] + [len(sets[k]) for k in used])[:-1].tolist()))

    def dense(which: np.ndarray, lo: int, hi: int) -> np.ndarray:
        out = np.zeros((len(which), hi - lo))
        for i, k in enumerate(which):
            mine = at[start[k]:start[k] + len(sets[k])]
            c = column[mine[seen[mine]]]
            out[i, c[(c >= lo) & (c < hi)] - lo] = 1
        return out

    size = np.array([len(s) for s in sets])
    both, shared_n = np.zeros((len(rows), len(cols))), np.zeros((len(rows), len(cols)))
    for lo in range(0, n, 8192):          # bounded blocks of shared shingles
        hi = min(n, lo + 8192)
        r, c = dense(rows, lo, hi), dense(cols, lo, hi).T
        both += (r * w[lo:hi]) @ c
        shared_n += r @ c
    similar = both >= threshold * (weight[rows][:, None] + weight[cols][None, :] - both)
    similar |= shared_n >= threshold * (size[rows][:, None] + size[cols][None, :] - shared_n)
    similar &= component[rows][:, None] != component[cols][None, :]
    root = {int(c): int(c) for c in component}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    out = []
    for i, j in zip(*np.nonzero(similar)):
        a, b = find(int(component[rows[i]])), find(int(component[cols[j]]))
        if a != b:
            root[a] = b
            out.append((int(ids[rows[i]]), int(ids[cols[j]])))
    return out


def _block_links(met: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links that connect components, of members ``(bucket, doc, component)``."""
    size = met.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket").agg(
        F.max_by("component", F.struct("n", -F.col("component"))).alias("most"), F.max("n").alias("n_most"), F.sum("n").alias("n"))
    size = size.where(F.col("n") > F.col("n_most")).select(
        "bucket", "most", F.ceil((F.col("n") - F.col("n_most")) / SIDE).cast("int").alias("n_rows"), F.ceil(F.col("n") / SIDE).cast("int").alias("n_cols"))
    m = met.join(size, "bucket")
    row, col = F.pmod(F.xxhash64("doc"), F.col("n_rows")).cast("int"), F.pmod(F.hash("doc"), F.col("n_cols")).cast("int")
    is_row = F.col("component") != F.col("most")
    one = (F.col("n_rows") == 1) & (F.col("n_cols") == 1)
    # a bucket of one block needs its texts once: those to compare are marked
    cols = m.select("bucket", F.explode(F.sequence(F.lit(0), F.col("n_rows") - 1)).alias("i"), col.alias("j"), (one & is_row).alias("as_row"), F.lit(True).alias("as_col"), "doc", "component")
    rows = m.where(is_row & ~one).select("bucket", row.alias("i"), F.explode(F.sequence(F.lit(0), F.col("n_cols") - 1)).alias("j"),
                                         F.lit(True).alias("as_row"), F.lit(False).alias("as_col"), "doc", "component")
    placed = cols.union(rows).join(sets.withColumnRenamed("doc_id", "doc"), "doc")

    def links(block: pd.DataFrame) -> pd.DataFrame:
        got = connecting(block["doc"].to_numpy(), block["component"].to_numpy(), np.flatnonzero(block["as_row"]), np.flatnonzero(block["as_col"]),
                         [np.frombuffer(s, "<u8") for s in block["s"]], [np.frombuffer(w, "<f4") for w in block["w"]], threshold) if block["as_row"].any() else []
        return pd.DataFrame(got, columns=["a", "b"], dtype="int64")

    return placed.groupBy("bucket", "i", "j").applyInPandas(links, "a long, b long")


def _found(docs: DataFrame, threshold: float, bands: int, rows: int) -> DataFrame:
    """``(doc_id, raw, component, class_id)`` of every row with words: a number of its class, and the
    smallest id in it.  ``docs`` holds ``doc_id`` (not null), ``text`` and ``raw``."""
    docs = packed_blocks(docs)
    n, answers = frequencies(docs)
    sig = materialize(signatures(docs, n, answers, bands, rows), "near-signatures")
    # a number of its own for every text: ids may repeat
    first = sig.groupBy("x1", "x2").agg(F.min_by(F.struct("bands", "block"), "doc_id").alias("of"), F.min("doc_id").alias("low"))
    first = materialize(first.select("x1", "x2", "of.*", "low").withColumn("rep", F.monotonically_increasing_id()), "near-texts")
    member = sig.select("doc_id", "raw", "x1", "x2").join(first.select("x1", "x2", "rep", "low"), ["x1", "x2"]).select("doc_id", "raw", "rep", "low")

    # members of buckets that hold several texts, and how many such buckets a text is in
    placed = first.select("rep", F.posexplode("bands").alias("band", "key")).select(
        F.xxhash64("band", "key").alias("bucket"), F.col("rep").alias("doc"))
    several = placed.groupBy("bucket").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count(F.lit(1)).alias("n"),
                                           F.bit_xor(F.xxhash64("doc")).alias("x"), F.sum(F.hash("doc").cast("long")).alias("y")).where("low < high")
    # of buckets with the same members one is enough
    several = several.groupBy("low", "high", "n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket")
    met = materialize(placed.join(several, "bucket", "left_semi").distinct(), "near-buckets")
    degree = met.groupBy("doc").agg(F.count(F.lit(1)).alias("n"))
    wanted = degree.select(F.col("doc").alias("rep")).join(first.select("rep", F.col("low").alias("doc_id"), "block", "x1", "x2"), "rep")
    sets = materialize(_sets(docs, wanted, n, answers), "near-sets")
    discard(docs)
    discard(answers)
    lead = met.join(degree, "doc").groupBy("bucket").agg(F.max_by("doc", F.struct("n", -F.col("doc"))).alias("lead"))
    pairs = met.join(lead, "bucket").where(F.col("doc") != F.col("lead")).select(
        F.least("lead", "doc").alias("a"), F.greatest("lead", "doc").alias("b")).distinct()
    links = materialize(_verify(pairs, sets, threshold), "near-links")
    joined = components(links, "a", "b", "near-components")

    known = met.join(joined.withColumnRenamed("id", "doc"), "doc", "left").select("bucket", "doc", F.coalesce("component", "doc").alias("component"))
    more = materialize(_block_links(known, sets, threshold), "near-more")
    discard(sets)
    discard(met)
    joined = components(joined.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more), "a", "b", "near-components")
    least = least_label(joined, first.select(F.col("rep").alias("id"), F.col("low").alias("label")), "near-least")
    return member.join(least.withColumnRenamed("id", "rep"), "rep", "left").select(
        "doc_id", "raw", F.coalesce("component", "rep").alias("component"), F.coalesce("least", "low").alias("class_id"))


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                                                        F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("raw"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
            bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(doc_id, class_id)`` for every document with an id: the smallest id of its class."""
    docs = _identified(docs, id_col, text_col)
    found = _found(docs, threshold, bands, rows).groupBy("doc_id", "raw").agg(F.min("class_id").alias("class_id"))
    return docs.select("doc_id", "raw").distinct().join(found, ["doc_id", "raw"], "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
              bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One document of each class (that with the smallest id), with all columns; rows without an id
    or without words stay."""
    found = materialize(_found(_identified(docs, id_col, text_col), threshold, bands, rows), "near-found")
    lead = found.groupBy("component").agg(F.min(F.struct("doc_id", "raw")).alias("k")).select("k.doc_id", "k.raw", F.lit(True).alias("keep"))
    per = found.groupBy("doc_id", "raw").agg(F.count(F.lit(1)).alias("n"))
    per = materialize(per.join(lead, ["doc_id", "raw"], "left"), "near-kept")
    # the row as one column: its columns may have any name
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                        F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("raw"))
    named = whole.where(F.col("doc_id").isNotNull()).join(per, ["doc_id", "raw"], "left")
    out = whole.where(F.col("doc_id").isNull()).select("row").union(
        named.where(F.col("n").isNull() | (F.col("keep") & (F.col("n") == 1))).select("row"))
    if per.where("keep and n > 1").limit(1).count():      # rows that repeat id and text: one of them
        again = whole.join(per.where("keep and n > 1"), ["doc_id", "raw"])
        out = out.union(again.groupBy("doc_id", "raw").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")).select("row"))
    return out.select("row.*")
