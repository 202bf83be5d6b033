"""Operator 13: runs of repeated words, by difference-cover extensions on a harmonic grid.

A run is a stretch of words with smallest period q (words q apart are identical) that is at least
``max(12, 2 * q)`` words long and cannot be extended.  Any run with period q holds two neighbouring
points k*q and (k+1)*q of the grid of q with equal words, so the points of all grids (n * ln n pairs)
are compared first and the equal ones are extended forwards and backwards.

An extension of (i, j) compares single words up to the next offset at which both positions lie in
the cover (at most 30 words: every difference modulo 31 is that of two residues of the cover); most
pairs differ before.  Those that reach it are answered from the sampled suffixes alone: these are
sorted by doubling, their neighbours' common lengths are put into a sparse table, and a range minimum
is the rest of the extension.  The sorted samples are built once a document and direction, and only
if an extension gets so far.

The work runs in ``mapInArrow`` on the scan's own partitions: no shuffle, one document at a time.
A document takes about 60 bytes a word while it is worked on; grids of long documents are compared
in parts.

Defined results: a null or blank text has no words (no run, four nulls, both hashes of the empty
string); rows with a null id are taken without the planted change; repeated rows get a row each; an
empty table gives no rows; other columns are ignored and may have any name.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: A perfect difference set: every difference modulo MODULUS is that of two of its residues.
COVER, MODULUS = (1, 5, 11, 24, 25, 27), 31
#: Least length of a run, in words.
LEAST = 12
#: Grid pairs of documents of up to so many words are laid out once a worker.
LAID_OUT = 4096
#: Pairs extended at once.
PAIRS = 1 << 19
#: Bytes of text split into words at once.
PIECE = 1 << 20

_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_OUT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string")


@lru_cache(maxsize=1)
def _reach() -> np.ndarray:
    """[difference, residue] -> least offset that brings both positions into the cover."""
    out = np.full((MODULUS, MODULUS), MODULUS, np.int64)
    for d in range(MODULUS):
        for x in COVER:
            if (x + d) % MODULUS in COVER:
                out[d] = np.minimum(out[d], (x - np.arange(MODULUS)) % MODULUS)
    return out


class _Samples:
    """The suffixes of ``words`` that start in the cover: their order and a sparse table of the
    lengths that neighbours share.  ``words`` is padded with a number of its own."""

    def __init__(self, words: np.ndarray, n: int):
        index = np.full(MODULUS, -1, np.int64)
        index[list(COVER)] = np.arange(len(COVER))
        self.index = index
        blocks = -(-n // MODULUS)
        at = (np.arange(blocks)[:, None] * MODULUS + np.array(COVER)[None, :]).ravel()
        padded = np.full((blocks + 2) * MODULUS, -2, np.int32)
        padded[:len(words)] = words[:len(padded)]
        rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, MODULUS)[at])
        rank = np.unique(rows.view(f"V{rows.itemsize * MODULUS}").ravel(), return_inverse=True)[1].astype(np.int64)
        del rows
        ranks, m, step = [rank], len(at), len(COVER)
        while step < m and rank.max() < m - 1:   # samples `step` places on lie whole blocks further
            later = np.full(m, -1, np.int64)
            later[:m - step] = rank[step:]
            rank = np.unique(rank * (m + 1) + later + 1, return_inverse=True)[1]
            ranks.append(rank)
            step *= 2
        order = np.argsort(rank, kind="stable")
        self.place = np.empty(m, np.int64)
        self.place[order] = np.arange(m)
        a, b, shared = order[:-1].copy(), order[1:].copy(), np.zeros(max(m - 1, 0), np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            by = ranks[level]
            inside = np.flatnonzero((a < m) & (b < m))
            same = inside[by[a[inside]] == by[b[inside]]]
            a[same] += len(COVER) << level
            b[same] += len(COVER) << level
            shared[same] += MODULUS << level
        del ranks
        x, y = at[order[:-1]] + shared, at[order[1:]] + shared
        live, k = np.arange(len(shared)), 0
        while len(live):   # the block that differs, word by word
            live = live[(x[live] + k < len(padded)) & (y[live] + k < len(padded))]
            live = live[padded[x[live] + k] == padded[y[live] + k]]
            shared[live] += 1
            k += 1
        levels = [shared.astype(np.int32)]
        while len(shared) > 1 << len(levels):
            last, half = levels[-1], 1 << (len(levels) - 1)
            nxt = last.copy()
            nxt[:-half] = np.minimum(last[:-half], last[half:])
            levels.append(nxt)
        self.table = np.stack(levels)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words shared by the suffixes at cover positions i and j (not the same ones)."""
        a = self.place[i // MODULUS * len(COVER) + self.index[i % MODULUS]]
        b = self.place[j // MODULUS * len(COVER) + self.index[j % MODULUS]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        return np.minimum(self.table[level, low], self.table[level, high - (1 << level)]).astype(np.int64)


class Extensions:
    """Longest common extensions of positions i < j of one array of word numbers."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.words = np.concatenate([words.astype(np.int32), np.full(MODULUS + 1, -2, np.int32)])
        self.samples = None

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        w, out = self.words, np.zeros(len(i), np.int64)
        reach = _reach()[(j - i) % MODULUS, i % MODULUS]
        live, far = np.arange(len(i)), []
        for k in range(MODULUS):
            there = reach[live] == k
            if there.any():
                far.append(live[there])
                live = live[~there]
            if not len(live):
                break
            same = w[i[live] + k] == w[j[live] + k]
            out[live[~same]] = k
            live = live[same]
        if far:
            far = np.concatenate(far)
            far = far[j[far] + reach[far] <= self.n]
            if self.samples is None:
                self.samples = _Samples(self.words, self.n + 1)
            off = reach[far]
            out[far] = off + self.samples.common(i[far] + off, j[far] + off)
        return out


@lru_cache(maxsize=1)
def _laid_out() -> tuple[np.ndarray, np.ndarray]:
    """All grid pairs (i, i + q) below LAID_OUT, by their second point: a document of n words has
    the first ones."""
    i = np.concatenate([np.arange(0, LAID_OUT - q, q, dtype=np.int32) for q in range(1, LAID_OUT // 2 + 1)])
    q = np.concatenate([np.full(-(-(LAID_OUT - q) // q), q, np.int32) for q in range(1, LAID_OUT // 2 + 1)])
    order = np.argsort(i + q, kind="stable")
    return i[order], (i + q)[order]


def _grid(w: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid pairs (i, j) with equal words, in parts of about PAIRS."""
    n = len(w)
    if n <= LAID_OUT:
        i, j = _laid_out()
        m = int(np.searchsorted(j, n))
        i, j = i[:m], j[:m]
        same = np.flatnonzero((w[i] == w[j]) & (2 * (j - i) <= n))
        yield i[same].astype(np.int64), j[same].astype(np.int64)
        return
    parts, held, root = [], 0, int(n ** 0.5)

    def full(more: tuple[np.ndarray, np.ndarray]) -> bool:
        nonlocal held
        if len(more[0]):
            parts.append(more)
            held += len(more[0])
        return held >= PAIRS

    def flush() -> tuple[np.ndarray, np.ndarray]:
        nonlocal held, parts
        out = tuple(np.concatenate(x) for x in zip(*parts))
        parts, held = [], 0
        return out

    for q in range(1, root + 1):          # many points of a short period
        i = np.flatnonzero(w[:n - q:q] == w[q::q]) * q
        if full((i, i + q)):
            yield flush()
    for k in range(n // root + 1):        # point k of all long periods
        q = np.arange(root + 1, min(n // 2, (n - 1) // (k + 1)) + 1)
        q = q[w[k * q] == w[k * q + q]]
        if full((k * q, k * q + q)):
            yield flush()
    if parts:
        yield flush()


def find_runs(words: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start, then period.  ``words``: a number
    from 0 for each word, equal for equal words."""
    n = len(words)
    if n < LEAST:
        return np.zeros((0, 3), np.int64)
    forwards, backwards, found = Extensions(words), Extensions(words[::-1]), []
    for i, j in _grid(np.asarray(words)):
        for k in range(0, len(i), PAIRS):
            a, b = i[k:k + PAIRS], j[k:k + PAIRS]
            start, stop = a - backwards(n - b, n - a), b + forwards(a, b)
            ok = stop - start >= np.maximum(LEAST, 2 * (b - a))
            if ok.any():
                found.append(_least_period(np.stack([start[ok], stop[ok], (b - a)[ok]], 1)))
    if not found:
        return np.zeros((0, 3), np.int64)
    out = _least_period(np.concatenate(found))
    out[:, 1] -= out[:, 0]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _least_period(rows: np.ndarray) -> np.ndarray:
    """Of each stretch its least period: the others are multiples of it."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    return rows[first]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        out = self[word] = len(self)
        return out


def number_words(text: str) -> tuple[np.ndarray, list[bytes]]:
    """Number of each word, and the distinct words by number."""
    data, numbers, parts, at = text.encode(), _Numbers(), [], 0
    while at < len(data):
        cut = _BLANK.search(data, at + PIECE) if at + PIECE < len(data) else None
        stop = cut.start() if cut else len(data)
        parts.append(np.fromiter(map(numbers.__getitem__, data[at:stop].split()), np.int32))
        at = stop
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), list(numbers)


def planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """Where the words of a changed document come from (None: not changed)."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return np.concatenate([np.arange(a), a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))])


def drop_repeats(n: int, runs: np.ndarray) -> np.ndarray:
    """Whether each word stays: no run holds it after that run's first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:n]) == 0


def join_words(words: np.ndarray, names: list[bytes]) -> Iterator[bytes]:
    """The words joined by one space, in parts."""
    for k in range(0, len(words), PIECE):
        yield (b" " if k else b"") + b" ".join(map(names.__getitem__, words[k:k + PIECE].tolist()))


def _digest(doc_id: int | None, text: str) -> tuple:
    words, names = number_words(text)
    source = planted(len(words), doc_id)
    if source is not None:
        words = words[source]
    runs = find_runs(words)
    kept, listed = hashlib.sha256(), hashlib.sha256()
    for part in join_words(words[drop_repeats(len(words), runs)] if len(runs) else words, names):
        kept.update(part)
    for k in range(0, len(runs), PIECE):
        listed.update("".join(f"{s},{m},{q}\n" for s, m, q in runs[k:k + PIECE].tolist()).encode())
    if not len(runs):
        return doc_id, 0, None, None, None, None, listed.hexdigest(), kept.hexdigest()
    s, m, q = map(int, runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]])
    return doc_id, len(runs), s, m, q, 1000 * m // q, listed.hexdigest(), kept.hexdigest()


def _per_text(docs: DataFrame, work, schema: str, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [work(d, t.as_py() or "") for d, t in zip(batch.column(0).to_pylist(), batch.column(1))]
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(cols, kinds)], names)

    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64() if x.endswith(" long") else pa.string() for x in schema.split(", ")]
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: number of runs, the longest one, and hashes of all runs and of the
    words that are left, after the planted change."""
    return _per_text(docs, _digest, _OUT, id_col, text_col)


def collapse_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_runs, text`` with every run cut to its first period, words joined by one
    space (null if it was null is the empty text)."""
    def work(doc_id, text):
        words, names = number_words(text)
        runs = find_runs(words)
        return doc_id, len(runs), b"".join(join_words(words[drop_repeats(len(words), runs)], names)).decode()

    return _per_text(docs, work, "doc_id long, n_runs long, text string", id_col, text_col)
