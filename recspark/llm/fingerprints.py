"""Operator 6: document fingerprints, bottom-k sketches of shingle hashes.

Native expressions.  A text's shingles are its runs of five words (all its words, if it
has fewer than five); the sketch is the ``k`` smallest distinct 64-bit shingle hashes in
ascending order.  Sketches of parts merge into the sketch of their union (`merge`,
`merge_groups`) and estimate resemblance, containment and the number of distinct shingles.

Everything about one text is computed inside its row, so sketching shuffles nothing.
Comparing each document with the next one by id needs one shuffle of the texts: rows go to
balanced ranges of the id order, and the first row of every range is also sent to the range
before it (the very first row to the last range), so that `lead` sees its neighbour.

Defined results: a null text is the empty text, whose fingerprint is the empty string; two
empty sketches resemble each other fully (1), an empty and a non-empty one not at all (0);
rows that repeat an id follow each other in the order of their text hash; null ids come first; a
table of one row is its own next document; an empty table gives no rows; other columns are
ignored and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions

K = 128
WORDS = 5
_SPACE = r"[\x20\x09-\x0D]+"
_CELLS = 4096


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once (a lambda variable is a value, while a
    column inside a lambda would be evaluated for every element)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Hashes of all word shingles in text order (repeats included); empty for no words."""
    ws = F.filter(F.split(F.coalesce(text, F.lit("")), _SPACE), lambda w: w != "")
    hashed = F.transform(ws, lambda w: F.xxhash64(w))

    def runs(h):
        last = F.greatest(F.size(h) - (words - 1), F.lit(1))
        every = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(h, i, words)))
        return F.when(F.size(h) == 0, F.array().cast("array<bigint>")).otherwise(every)

    return _bind(hashed, runs)


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, words))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sketched sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_groups(df: DataFrame, keys: list[str], sketch_col: str, k: int = K) -> DataFrame:
    """One merged sketch per group.  The k smallest hashes of a group are ranked with a
    group limit before and after the shuffle, so a hot group never meets in one task as a
    whole."""
    h = df.select(*keys, F.explode(sketch_col).alias("_h")).distinct()
    top = h.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("_h"))).where(F.col("_r") <= k)
    return top.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(sketch_col))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness: the share of the union's k smallest hashes that both hold."""
    def share(u):
        both = F.array_intersect(F.array_intersect(a, b), u)
        return F.when(F.size(u) == 0, F.lit(1.0)).otherwise(F.size(both) / F.size(u))
    return _bind(merge(a, b, k), share)


def distinct_count(s: Column, k: int = K) -> Column:
    """Distinct shingles: exact below k, else estimated from the k-th smallest hash."""
    place = (F.element_at(s, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise(F.lit(float(k - 1)) / place)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds too (1 for an empty a)."""
    both = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_count(a, k)))


def as_text(s: Column) -> Column:
    return F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, bucket, pos, real)``: rows in balanced id ranges, each range with a
    copy (``real`` false) of the row that follows its last one."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # a monotone cell of the id (cell 0: null), then cells joined to buckets of like row counts
    lo, hi = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    place = (F.col("doc_id").cast("double") - F.lit(float(lo or 0))) / F.lit(max(1.0, float(hi or 0) - float(lo or 0) + 1))
    cell = F.when(F.col("doc_id").isNull(), 0).otherwise(1 + F.least(F.floor(place * _CELLS), F.lit(_CELLS - 1))).cast("int")
    n = 4 * shuffle_partitions(docs.sparkSession)
    ids = rows.select("doc_id", cell.alias("cell"))
    per = ids.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
    run = F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))   # at most _CELLS + 1 rows
    all_n = F.sum("n").over(Window.partitionBy())
    per = per.withColumn("bucket", F.floor(F.coalesce(run, F.lit(0)) * n / all_n).cast("int"))
    firsts = per.groupBy("bucket").agg(F.min("cell").alias("cell"), F.min_by("first", "cell").alias("first"))
    by = Window.orderBy("bucket")
    last = F.max("bucket").over(Window.partitionBy())
    firsts = firsts.select("cell", "first", F.coalesce(F.lag("bucket").over(by), last).alias("prior"))
    cells = per.select("cell", "bucket").join(firsts, "cell", "left")
    rows = rows.withColumn("cell", cell).join(F.broadcast(cells), "cell")      # at most _CELLS + 1 rows
    # the first row of a bucket (its smallest id) goes to the bucket before as well
    leads = F.col("prior").isNotNull() & F.col("doc_id").eqNullSafe(F.col("first"))
    to = F.array(F.struct("bucket", F.lit(True).alias("real")))
    also = F.array(F.struct(F.col("prior").alias("bucket"), F.lit(False).alias("real")))
    rows = rows.withColumn("to", F.explode(F.when(leads, F.concat(to, also)).otherwise(to)))
    return rows.select("doc_id", "text", "to.bucket", "to.real", F.xxhash64("text").alias("tie"))


def fingerprint_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Each document's sketch, that of its edited text (the last half of its code points
    replaced by the start of the next document), and its likeness to both neighbours."""
    order = Window.partitionBy("bucket").orderBy(F.col("real").desc(), F.col("doc_id").asc_nulls_first(), "tie")
    rows = with_next(docs, id_col, text_col).withColumn("next_text", F.lead("text").over(order))
    rows = rows.withColumn("sk", sketch(F.col("text"), k))
    rows = rows.withColumn("next_sk", F.lead("sk").over(order)).where("real")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    rows = rows.withColumn("edited_sk", sketch(F.col("edited"), k))
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "sk", "edited_sk",
                       resemblance(F.col("sk"), F.col("edited_sk"), k).alias("near_edited"),
                       resemblance(F.col("sk"), F.col("next_sk"), k).alias("near_next"),
                       distinct_count(F.col("sk"), k).alias("distinct_shingles"),
                       containment(F.col("sk"), F.col("edited_sk"), k).alias("contained"))


def digest(docs: DataFrame) -> DataFrame:
    p = fingerprint_pairs(docs)
    return p.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("sk")).alias("fingerprint"),
                    as_text(F.col("edited_sk")).alias("edited_fingerprint"), "near_edited", "near_next", "distinct_shingles")
