"""Operator 4: language identification by prediction by partial matching.

Per language a byte context tree of orders 0 to 3 is counted on a bounded sample of
labelled texts and then frozen.  A byte costs -log2 of its probability in the longest
context that the language has seen; a byte new to that context pays the escape probability
(distinct followers / (occurrences + distinct followers), method C, without exclusion) and is
coded in the next shorter context, in the end uniformly.  A text's code length is the exact
sum over all its bytes; the language with the shortest code is predicted.

Frozen trees are flat arrays: the longest known suffix of any three bytes is one array
lookup, and the cost of every (context, byte, language) another, so whole texts are scored
with array operations, in blocks of bounded size, on the scan's own partitions (no shuffle).

The sample: at most about ``PER_LANGUAGE`` texts of each language, chosen by a hash of the
id among the rows that are not held out.  The driver receives the sample's counts only
(four-byte strings of the sample), which this bounds.

Defined results: null text or a text without a letter is `und` with score 0, as is
everything when there is nothing to learn from; ties go to the first language by code point; a
row with a null id is held out; an empty table gives no rows; other columns are ignored and
may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import slices

PER_LANGUAGE = 400
ORDER = 3
FOLDS = 5
BLOCK = 2_000_000


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("text") != ""))
    # written, so that Spark knows its size (one row per language) and need not move the texts
    share = materialize(rows.groupBy("lang").agg(F.least(F.lit(1.0), per_language / F.count(F.lit(1))).alias("share")), "language-shares")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0
    return rows.join(share, "lang").where(place < F.col("share")).select("lang", "text")


def _codes(raw: list[bytes]) -> np.ndarray:
    """Four-byte strings (as numbers) that end at every byte of the texts; three zero bytes
    stand before each text."""
    x = np.frombuffer(b"\0\0\0" + b"\0\0\0".join(raw), np.uint8).astype(np.uint32)
    code = x[:-3] << 24 | x[1:-2] << 16 | x[2:-1] << 8 | x[3:]
    real = np.ones(len(code), bool)
    ends = np.cumsum([len(r) + 3 for r in raw])[:-1]
    for k in range(3):  # positions of the next text's leading zeros
        real[ends - 3 + k] = False
    return code[real]


def counts(rows: DataFrame) -> DataFrame:
    """``(lang, code, n)``: how often each four-byte string occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            by: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(lang, []).append(text.encode())
            for lang, raw in by.items():
                code, n = np.unique(_codes(raw), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code)), pa.array(code.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "code", "n"])

    return rows.mapInArrow(run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


class Trees:
    """Frozen context trees of all languages as flat arrays."""

    def __init__(self, langs: list[str], lang: np.ndarray, code: np.ndarray, n: np.ndarray):
        self.langs = langs
        digits = np.stack([code >> s & 255 for s in (24, 16, 8, 0)])
        known = np.unique(digits)
        self.symbol = np.zeros(256, np.int64)     # 0: a byte that no sample text holds
        known = known[known > 0]
        self.symbol[known] = np.arange(1, len(known) + 1)
        size = self.size = len(known) + 1
        d = self.symbol[digits]
        # contexts of each order that any language has seen, numbered in a row: the empty one is 0
        self.longest = np.zeros(size ** ORDER, np.int32)
        every, first, keys = [np.zeros(1, np.int64)], [0, 1], [np.zeros(len(code), np.int64)]
        for k in range(1, ORDER + 1):
            key = np.zeros(len(code), np.int64)
            for j in range(ORDER - k, ORDER):
                key = key * size + d[j]
            seen = np.unique(key)
            table = self.longest.reshape(-1, size ** k)
            table[:, seen] = np.arange(first[-1], first[-1] + len(seen))
            every.append(seen)
            keys.append(key)
            first.append(first[-1] + len(seen))
        total = first[-1]
        self.cost = np.empty((total * size, len(langs)), np.float32)
        for at in range(len(langs)):
            mine = lang == at
            prob = np.empty((total, size))
            for k in range(ORDER + 1):
                count = np.zeros((len(every[k]), size))
                np.add.at(count, (np.searchsorted(every[k], keys[k][mine]), d[ORDER][mine]), n[mine])
                if k == 0:
                    lower = np.full((1, size), 1 / 256)
                else:
                    up = every[k] % size ** (k - 1)
                    lower = prob[first[k - 1] + np.searchsorted(every[k - 1], up)]
                seen, kinds = count.sum(1, keepdims=True), (count > 0).sum(1, keepdims=True)
                whole = np.maximum(seen + kinds, 1)
                escape = np.where(seen > 0, kinds / whole, 1.0)
                prob[first[k]:first[k + 1]] = np.where(count > 0, count / whole, escape * lower)
            self.cost[:, at] = -np.log2(prob).reshape(-1)

    def code_lengths(self, raw: list[bytes]) -> np.ndarray:
        """Bits of every (non-empty) text in every language."""
        x = self.symbol[np.frombuffer(b"\0\0\0" + b"\0\0\0".join(raw), np.uint8)]
        at = (x[:-3] * self.size + x[1:-2]) * self.size + x[2:-1]
        cost = self.cost[self.longest[at].astype(np.int64) * self.size + x[3:]]
        length = np.array([len(r) for r in raw])
        start = np.concatenate([[0], np.cumsum(length + 3)[:-1]])
        cuts = np.stack([start, start + length], 1).reshape(-1)[:2 * len(raw) - 1]
        return np.add.reduceat(cost, cuts, axis=0, dtype=np.float64)[::2]


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Trees | None:
    got = counts(sample(docs, per_language, id_col, text_col, lang_col)).toPandas()
    if got.empty:
        return None
    langs = sorted(got["lang"].unique())
    return Trees(langs, got["lang"].map({x: k for k, x in enumerate(langs)}).to_numpy(), got["code"].to_numpy(), got["n"].to_numpy())


def predict(docs: DataFrame, trees: Trees | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; score is the posterior of the predicted
    language under equal priors."""
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    if trees is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    frozen = docs.sparkSession.sparkContext.broadcast(trees)

    def best(text: list[bytes]) -> list[tuple[str, float]]:
        if not text:
            return []
        bits = frozen.value.code_lengths(text)
        k = bits.argmin(axis=1)
        more = np.minimum(bits - bits.min(axis=1, keepdims=True), 1000.0)
        return [(frozen.value.langs[i], s) for i, s in zip(k, (1 / np.exp2(-more).sum(axis=1)).tolist())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out, block, held = [("und", 0.0)] * len(batch), [], 0
            where: list[int] = []
            for k, text in enumerate(batch.column(2).to_pylist()):
                if text and any(map(str.isalpha, text)):
                    where.append(k)
                    block.append(text.encode())
                    held += len(block[-1])
                if held >= BLOCK:
                    for i, x in zip(where, best(block)):
                        out[i] = x
                    where, block, held = [], [], 0
            for i, x in zip(where, best(block)):
                out[i] = x
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x[0] for x in out]), pa.array([x[1] for x in out], pa.float64())],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
