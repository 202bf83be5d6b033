"""Operator 1: mix sources to target weights.

Native plan.  Every row gets a hash-random key (md5 of a seed and its id, uniform), rows
are sorted by that key within their source in ranges of the key space, the distributed
prefix sum of word counts runs over range totals and then inside one range, and each
source is cut at its exact budget; a source whose budget exceeds its size is repeated
(whole epochs and one partial epoch).

Only (id, source, size, key) is shuffled; the text is read once to count its words.  A hot
source is spread over as many key ranges as its row count asks for, and the result of the
prefix sums is one row per source (`cuts`), so the rows themselves are decided by comparing
their key with their source's cut.

Defined results: a null text has size 0, a null source is a source of its own (last in
order), an empty table gives no rows; rows that repeat an id share one key and split a cut
in proportion to their sizes; other input columns are ignored and may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import running, word_count

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = "mix-1"
#: Rows of one source that one key range holds on average.
ROWS_PER_RANGE = 4096


def _key(id_col):
    return F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       word_count(F.col(text_col)).alias("size"), _key(F.col(id_col)).alias("key"))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``(source, source_size, n_rows, weight, target)``: sources in code-point order (null
    last) take the weights in turn and share all words; a target stops at ``max_repeat``
    times its source's size and the excess goes to the others by weight.

    The shares that remain when no target is above its stop are ``weight * level`` for one
    common level, so the sources are ordered by the level at which they stop and the level
    is read off exact running totals over that order."""
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    by_source = by_source.withColumn("no_name", F.col("source").isNull())
    ordered = running(by_source, ["no_name", "source"], [], "mix-sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    s = materialize(ordered.withColumn("weight", weight).withColumn(
        "stop_at", F.col("source_size") * F.lit(float(max_repeat)) / F.col("weight")).drop("rank"), "mix-weights")
    total, all_weight = s.agg(F.sum("source_size"), F.sum("weight")).first()
    if total is None:
        return s.select("source", "source_size", "n_rows", "weight", F.lit(0.0).alias("target"))
    big = "decimal(38,0)"
    level = running(s, ["stop_at", "no_name", "source"], ["source_size", "weight"], "mix-levels")
    rest = F.lit(total).cast(big) - F.col("before_source_size").cast(big) * max_repeat
    rest_weight = F.lit(all_weight).cast(big) - F.col("before_weight").cast(big)
    free = rest * F.col("weight").cast("decimal(10,0)") <= F.col("source_size").cast(big) * max_repeat * rest_weight.cast("decimal(18,0)")
    first = level.where(free).agg(F.min_by(F.struct(rest.cast("double").alias("r"), rest_weight.cast("double").alias("w"),
                                                    F.col("rank").alias("k")), F.col("rank")).alias("x")).select("x.*").first()
    stopped = F.col("rank") < F.lit(first["k"])
    target = F.when(stopped, F.col("source_size") * F.lit(float(max_repeat))).otherwise(
        F.col("weight") * F.lit(first["r"]) / F.lit(first["w"]))
    return level.select("source", "source_size", "n_rows", "weight", target.alias("target"))


def cuts(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT,
         rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per source: its target, the whole epochs of its budget, and the place in
    key order where the last epoch is cut (``cut_key``, ``cut_words`` of that row's
    ``cut_size`` words; a null ``cut_key`` cuts before the first row)."""
    t = targets(rows, weights, max_repeat)
    budget = F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * max_repeat).cast("long")
    t = t.withColumn("budget", budget).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0).cast("long"))
    # integer division through doubles may be one off for very large sizes
    t = t.withColumn("epochs", F.col("epochs") - F.when(F.col("epochs") * F.col("source_size") > F.col("budget"), 1).otherwise(0))
    t = materialize(t.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
                    .withColumn("ranges", F.greatest(F.ceil(F.col("n_rows") / rows_per_range), F.lit(1)).cast("long"))
                    .withColumn("sid", F.xxhash64("source")), "mix-targets")
    head = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    keyed = rows.join(t.select(F.col("source").alias("s2"), "sid", "ranges", "rest"), F.col("source").eqNullSafe(F.col("s2"))).select(
        "source", "sid", "rest", "key", "size", F.shiftright(head * F.col("ranges"), 32).alias("range"))
    # rows with one key (one id) count as one
    keyed = keyed.groupBy("source", "rest", "range", "key").agg(F.sum("size").alias("size"))
    per_range = keyed.groupBy("source", "rest", "range").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    per_range = per_range.withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0)))
    # the one range of a source in which its budget ends
    at = per_range.where((F.col("offset") < F.col("rest")) & (F.col("rest") <= F.col("offset") + F.col("words"))).select(
        F.col("source").alias("s2"), F.col("range").alias("r2"), "offset")
    inside = keyed.join(at, F.col("source").eqNullSafe(F.col("s2")) & (F.col("range") == F.col("r2")))
    run = F.col("offset") + F.sum("size").over(Window.partitionBy("source", "range").orderBy("key"))
    cut = inside.withColumn("run", run).where((F.col("run") - F.col("size") < F.col("rest")) & (F.col("rest") <= F.col("run")))
    cut = cut.select(F.col("source").alias("s2"), F.col("key").alias("cut_key"), F.col("size").alias("cut_size"),
                     (F.col("rest") - F.col("run") + F.col("size")).alias("cut_words"))
    # written, so that Spark knows its size (one row per source) and broadcasts it only if it is small
    return materialize(t.join(cut, F.col("source").eqNullSafe(F.col("s2")), "left").select(
        "source", "source_size", "target", "epochs", "cut_key", "cut_size", "cut_words"), "mix-cuts")


def _last_epoch(size, key):
    """Words of a row that the partial epoch takes."""
    return (F.when(F.col("cut_key").isNull() | (key > F.col("cut_key")), F.lit(0))
            .when(key < F.col("cut_key"), size)
            .otherwise(F.floor(F.col("cut_words") * size / F.col("cut_size"))).cast("long"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target, taken``."""
    rows = materialize(sized(docs, id_col, text_col, source_col), "mix-rows")
    c = cuts(rows, weights, max_repeat).withColumnRenamed("source", "s2")
    taken = F.col("epochs") * F.col("size") + _last_epoch(F.col("size"), F.col("key"))
    return rows.join(c, F.col("source").eqNullSafe(F.col("s2"))).select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """The mix itself: each row of ``docs``, whole and with its own columns, once per epoch
    that takes any of its words (the document at the cut is kept whole); a row that the
    mix does not take goes."""
    rows = materialize(sized(docs, id_col, text_col, source_col), "mix-rows")
    c = cuts(rows, weights, max_repeat)
    c = c.select(F.col("source").alias("of"), F.struct(*[x for x in c.columns if x != "source"]).alias("cut"))
    # the row as one column: its columns may have any name
    whole = docs.select(F.struct(*[F.col(f"`{x}`") for x in docs.columns]).alias("row"), word_count(F.col(text_col)).alias("size"),
                        _key(F.col(id_col)).alias("key"), F.col(source_col).cast("string").alias("source"))
    last = (F.col("cut.cut_key").isNotNull() & (F.col("size") > 0) & (F.col("key") <= F.col("cut.cut_key"))).cast("int")
    copies = F.when(F.col("size") > 0, F.col("cut.epochs") + last).otherwise(F.col("cut.epochs")).cast("int")
    out = whole.join(c, F.col("source").eqNullSafe(F.col("of"))).select("row", copies.alias("copies")).where(F.col("copies") > 0)
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


OP1_SQL = """
WITH rows AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('mix-1:' || CAST(doc_id AS VARCHAR)) AS key FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source),
wt AS (SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM src),
lv AS (SELECT *, row_number() OVER o AS k,
         (SELECT sum(source_size) FROM wt) - 3 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS r,
         (SELECT sum(w) FROM wt) - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rw
       FROM wt WINDOW o AS (ORDER BY source_size * CAST(3 AS DOUBLE) / w, source IS NULL, source)),
f AS (SELECT k, r, rw FROM lv WHERE r * w <= 3 * source_size * rw ORDER BY k LIMIT 1),
tg AS (SELECT lv.source, source_size, CASE WHEN lv.k < f.k THEN CAST(3 * source_size AS DOUBLE)
         ELSE w * CAST(f.r AS DOUBLE) / CAST(f.rw AS DOUBLE) END AS target FROM lv, f),
bd AS (SELECT *, least(CAST(floor(target + 0.5) AS BIGINT), 3 * source_size) AS budget FROM tg),
ep AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM bd),
run AS (SELECT rows.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM rows)
SELECT doc_id, run.source, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM run JOIN ep ON run.source IS NOT DISTINCT FROM ep.source
"""
