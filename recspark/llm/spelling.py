"""Operator 12: grouping of spelling variants over a reduced alphabet.

Words are counted with DataFrame functions (combined before the shuffle), the vocabulary is written
once with an id per word.  Letters are hashed to SYMBOLS symbols.  Of every word the one-edit
neighbourhood of its reduced form is generated: all deletions and replacements, and the form itself
(an insertion is the deletion of the longer word, a replacement is generated towards the smaller
symbol, so that each pair comes from one of its sides and once only).  One edit leaves the first or
the second half of the original word as it is, so a neighbour is keyed by the reduced form *and* the
hash of the untouched original half; a word of the vocabulary lies under two keys.  Thus words that
share a reduced form are not paired with each other unless they also share a half, and a common
reduced form is no hot key.  Candidates are verified on the original strings by edit distance.

Forms are the near words of largest count; they are followed by pointer doubling (counts grow tenfold
each step, so a chain has at most log10 of the largest count steps).

A neighbourhood is made in parts of at most about a million keys, so words may be of any length.

Defined results: null and empty texts have no words; a null id deletes nothing; repeated rows count
each; an empty table gives no rows; other columns are ignored and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .rolling import mix

RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT, RATIO, TYPO_EVERY = 7, 2, 10, 31
#: Letters are hashed to so many symbols.
SYMBOLS = 10
#: Keys made at once.
KEYS = 1 << 20

_BASE, _HALF = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_WRAP = (1 << 64) - 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: counts of the distinct words, after the planted deletions."""
    runs = docs.select(F.col(id_col).cast("string").alias("d"), F.explode(
        F.regexp_extract_all(F.translate(F.col(text_col), _UPPER, _LOWER), F.lit(RUN), F.lit(0))).alias("w"))
    runs = runs.where(F.length("w") >= LEAST_LENGTH)
    h = F.crc32(F.concat_ws(":", "d", "w").cast("binary"))
    at = (F.col("h") % F.length("w")).cast("int")
    word = F.when(F.col("d").isNotNull() & (F.col("h") % TYPO_EVERY == 0),
                  F.concat(F.expr("left(w, cast(h % length(w) as int))"), F.substring("w", at + 2, F.length("w")))).otherwise(F.col("w"))
    return (runs.select("d", "w", h.alias("h")).select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Block:
    """Words of one length as numbers: reduced letters, and hashes of them and of the halves."""

    def __init__(self, some: list[str], n_symbols: int):
        self.n_symbols = n_symbols
        self.length = length = len(some[0])
        letters = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32).reshape(-1, length).astype(np.uint64)
        self.symbols = (mix(letters + np.uint64(1)) >> np.uint64(20)) % np.uint64(n_symbols)
        self.powers = _powers(_BASE, length + 1)
        terms = (self.symbols + np.uint64(1)) * self.powers[:length]
        zero = np.zeros((len(some), 1), np.uint64)
        self.before = np.concatenate([zero, np.cumsum(terms, 1, dtype=np.uint64)], 1)      # of the first i letters
        self.whole = self.before[:, -1]
        by = _powers(_HALF, length)
        letters += np.uint64(1)
        self.first = np.concatenate([zero, np.cumsum(letters * by, 1, dtype=np.uint64)], 1)
        self.last = np.concatenate([np.cumsum((letters * by[::-1])[:, ::-1], 1, dtype=np.uint64)[:, ::-1], zero], 1)

    def key(self, reduced: np.ndarray, half: np.ndarray, side: int) -> np.ndarray:
        return mix(mix(reduced.copy()) + mix(half ^ np.uint64(side * 0x5851F42D4C957F2D)))

    def own(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys under which the words themselves lie: by first half, by second half."""
        h = self.length // 2
        return self.key(self.whole, self.first[:, h], 0), self.key(self.whole, self.last[:, h], 1)

    def neighbours(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, key) of the generated neighbours, the words themselves included."""
        rows, n, c = np.arange(len(self.whole)), self.length, self.symbols
        for k in self.own():
            yield rows, k
        back, h = np.uint64(pow(_BASE, -1, 1 << 64)), (n - 1) // 2
        for i in range(n):                       # without letter i
            same = i + 1 < n and (i >= h or i + 1 < h)
            some = np.flatnonzero(c[:, i] != c[:, i + 1]) if same else rows
            reduced = self.before[some, i] + (self.whole[some] - self.before[some, i + 1]) * back
            yield some, self.key(reduced, self.first[some, h] if i >= h else self.last[some, h + 1], int(i < h))
        h = n // 2
        for i in range(n):                       # letter i by a smaller symbol
            half = self.first[:, h] if i >= h else self.last[:, h]
            for s in range(self.n_symbols - 1):
                some = np.flatnonzero(c[:, i] > s)
                reduced = self.whole[some] + (np.uint64(s) - c[some, i]) * self.powers[i]
                yield some, self.key(reduced, half[some], int(i < h))


def _blocks(batch: pa.RecordBatch, n_symbols: int) -> Iterator[tuple[np.ndarray, _Block]]:
    """The batch's words by length, in parts of bounded size, with their ids."""
    rows = sorted(zip(batch.column(1).to_pylist(), batch.column(0).to_pylist()), key=lambda r: len(r[0]))
    for length, some in groupby(rows, lambda r: len(r[0])):
        some, step = list(some), max(1, KEYS // (length * n_symbols))
        for k in range(0, len(some), step):
            yield np.array([i for _, i in some[k:k + step]], np.int64), _Block([w for w, _ in some[k:k + step]], n_symbols)


def _generated(n_symbols: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, block in _blocks(batch, n_symbols):
                held, size = [], 0
                for some, key in block.neighbours():
                    held.append((ids[some], key.view(np.int64)))
                    size += len(some)
                    if size >= KEYS:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], ["id", "key"])
                        held, size = [], 0
                if size:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], ["id", "key"])
    return run


def _own_keys(n_symbols: int):
    """The vocabulary under its two keys: the rows with the key and the side in place of the id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, block in _blocks(batch.set_column(0, "id", pa.array(range(batch.num_rows), pa.int64())), n_symbols):
                words_, counts = (batch.column(k).take(pa.array(at)) for k in (1, 2))
                for side, key in enumerate(block.own()):
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.full(len(at), side, np.int8)), words_, counts],
                                                     ["key", "side", "other", "other_n"])
    return run


def near_pairs(vocabulary: DataFrame, n_symbols: int = SYMBOLS) -> DataFrame:
    """``word, n, other, other_n``: every unordered pair of words at edit distance one, once.
    ``vocabulary``: ``id, word, n``, stable between reads."""
    made = vocabulary.select("id", "word").mapInArrow(_generated(n_symbols), "id long, key long")
    own = vocabulary.select("id", "word", "n").mapInArrow(_own_keys(n_symbols), "key long, side byte, other string, other_n long")
    found = made.join(own, "key").drop("key").join(vocabulary, "id")
    half = "cast(length(other) / 2 as int)"
    # a letter left out at the border of the halves is found by both: it counts by the first
    once = (F.length("word") == F.length("other")) | (F.col("side") == 0) | F.expr(f"left(word, {half}) != left(other, {half})")
    # two words of one reduced form find each other: it counts for the smaller word
    one = (F.col("word") < F.col("other")) | (_reduced("word", n_symbols) != _reduced("other", n_symbols))
    return found.where((F.levenshtein("word", "other", 1) == 1) & once & one).select("word", "n", "other", "other_n")


def _reduced(col: str, n_symbols: int):
    """The reduced form as text, by the table of the letters' symbols."""
    letters = _LOWER + _UPPER + "".join(map(chr, range(0xC0, 0x100)))
    codes = np.frombuffer(letters.encode("utf-32-le"), np.uint32).astype(np.uint64)
    symbols = (mix(codes + np.uint64(1)) >> np.uint64(20)) % np.uint64(n_symbols)
    return F.translate(F.col(col), letters, "".join(chr(48 + x) for x in symbols.tolist()))


def follow(links: DataFrame, name: str = "spelling-roots") -> DataFrame:
    """``word, root``: where the chains of ``word, form`` end, by pointer doubling.  The links
    must hold no cycle."""
    cur = materialize(links.select("word", F.col("form").alias("root")), name)
    while True:
        on = cur.select(F.col("word").alias("root"), F.col("root").alias("next"))
        nxt = materialize(cur.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), name)
        if not nxt.where("moved").limit(1).count():
            return cur
        cur = nxt.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_symbols: int = SYMBOLS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word."""
    vocabulary = materialize(words(docs, id_col, text_col).select(
        F.monotonically_increasing_id().alias("id"), "word", "n"), "spelling-words")
    near = near_pairs(vocabulary, n_symbols)
    both = near.select(F.explode(F.array(
        F.struct("word", "n", F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")).alias("best")),
        F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"),
                 F.struct((-F.col("n")).alias("less"), F.col("word").alias("form")).alias("best")))).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("best").alias("best"))
    known = materialize(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.less") >= RATIO * F.col("n"), F.col("best")).alias("best")), "spelling-forms")
    roots = follow(known.where(F.col("best").isNotNull()).select("word", F.col("best.form").alias("form")))
    return known.join(roots, "word", "left").select(
        "word", F.col("best.form").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near",
        (-F.col("best.less")).alias("form_n"))


_CRC = """list_reduce(list_prepend(4294967295::BIGINT, {bytes}),
  lambda c, b: xor(c >> 8, ({table})[1 + xor(c, b) % 256]))"""
_STEP = "lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
_BYTES = "flatten(list_transform(string_split({s}, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END))"

#: Pairs by masked letters and deleted letters, forms followed recursively.
OP12_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([k, 1, 1, 1, 1, 1, 1, 1, 1], {_STEP}) ORDER BY k) AS t FROM (SELECT unnest(range(256)) AS k)
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{RUN}')) AS w FROM documents
), counted AS (
  SELECT doc_id, w, count(*) AS k FROM runs WHERE length(w) >= {LEAST_LENGTH} GROUP BY ALL
), hashed AS (
  SELECT w, k, xor(4294967295, {_CRC.format(bytes=_BYTES.format(s="doc_id || ':' || w"), table="t")}) AS h FROM counted, crc
), vocabulary AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % {TYPO_EVERY} = 0 THEN left(w, (h % length(w))::INT) || substr(w, 2 + (h % length(w))::INT) ELSE w END AS word FROM hashed)
  WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(k) >= {LEAST_COUNT}
), spots AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary
), cut AS (
  SELECT DISTINCT word, n, left(word, i::INT - 1) || substr(word, i::INT + 1) AS rest FROM spots
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM
    (SELECT *, left(word, i::INT - 1) || '*' || substr(word, i::INT + 1) AS rest FROM spots) a JOIN
    (SELECT *, left(word, i::INT - 1) || '*' || substr(word, i::INT + 1) AS rest FROM spots) b ON a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT c.word, c.n, v.word, v.n FROM cut c JOIN vocabulary v ON c.rest = v.word
  UNION ALL SELECT v.word, v.n, c.word, c.n FROM cut c JOIN vocabulary v ON c.rest = v.word
), best AS (
  SELECT word, n, count(*) AS n_near, min({{'less': -other_n, 'form': other}}) AS b FROM near GROUP BY ALL
), known AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= {RATIO} * v.n THEN b END AS b
  FROM vocabulary v LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS root FROM known
  UNION ALL SELECT walk.word, k.b.form FROM walk JOIN known k ON walk.root = k.word WHERE k.b IS NOT NULL
), ends AS (
  SELECT walk.word, walk.root FROM walk JOIN known k ON walk.root = k.word WHERE k.b IS NULL
)
SELECT k.word, k.b.form AS form, e.root, k.n, k.n_near, -k.b.less AS form_n FROM known k JOIN ends e USING (word)
"""
