"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

#: ASCII white space: the six characters that separate words in every operator here.
WORD = r"[^\x20\x09-\x0D]+"


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def word_count(text: Column) -> Column:
    """Number of maximal runs of non-white-space characters; null counts as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running(df: DataFrame, order: list[str], sums: list[str], name: str) -> DataFrame:
    """Global running totals without a one-task sort.

    Rows are range-partitioned on ``order`` and written once, totals are taken within
    each range, and the ranges' offsets (one row per range, at most the number of
    shuffle partitions) are added.  Adds ``rank`` (from 0) and ``before_<c>``, the exact
    sum of ``c`` over all earlier rows, for every ``c`` in ``sums``.  ``order`` must
    identify the row; equal rows get an arbitrary order."""
    n = shuffle_partitions(df.sparkSession)
    ranged = materialize(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), name)
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranges = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_sum_{c}") for c in sums])
    offsets = totals.select("_range", F.coalesce(F.sum("_n").over(ranges), F.lit(0)).alias("_off"),
                            *[F.coalesce(F.sum(f"_sum_{c}").over(ranges), F.lit(0)).alias(f"_off_{c}") for c in sums])
    out = ranged.withColumn("_pos", F.count(F.lit(1)).over(within))
    for c in sums:
        out = out.withColumn(f"_in_{c}", F.coalesce(F.sum(c).over(within), F.lit(0)))
    out = out.join(offsets, "_range")
    out = out.withColumn("rank", F.col("_off") + F.col("_pos"))
    for c in sums:
        out = out.withColumn(f"before_{c}", F.col(f"_off_{c}") + F.col(f"_in_{c}"))
    return out.select(*df.columns, "rank", *[f"before_{c}" for c in sums])


def components(edges: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """Connected components of an undirected edge list: ``(id, component)`` with the
    smallest id reachable; ids without an edge do not appear.

    Alternating large-star and small-star steps (Kiveris et al.), each one a grouped
    minimum (combined before the shuffle) joined back to the edges, so a hub is never
    gathered into one row.  Every round is written to the shared folder; the loop ends
    when the edge set, which is then a star per component, no longer changes."""
    cur = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    cur = materialize(cur, name)
    seen = None
    while True:
        state = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or tuple(state) == seen:
            return cur.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                cur.select("v", "v").distinct())
        seen = tuple(state)
        both = cur.union(cur.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        cur = materialize(small.union(low).where(F.col("u") != F.col("v")).distinct(), name)


#: Components with over 1 / HOT of the rows are joined by broadcast: at most so many.
HOT = 1024


def least_label(joined: DataFrame, labels: DataFrame, name: str = "labels") -> DataFrame:
    """``(id, component, least)``: the smallest label in the component of each id of ``joined`` (id,
    component); ``labels`` holds (id, label).  A component of any size is split: its rows
    meet its label by broadcast, which holds at most HOT rows."""
    x = materialize(joined.join(labels, "id"), name)
    total = x.count()
    per = x.groupBy("component").agg(F.min("label").alias("least"), F.count(F.lit(1)).alias("n"))
    hot = per.where(F.col("n") * HOT > total).select("component", F.col("least").alias("hot"))
    x = x.join(F.broadcast(hot), "component", "left")
    rest = x.where(F.col("hot").isNull()).join(per.where(F.col("n") * HOT <= total), "component")
    return x.where(F.col("hot").isNotNull()).select("id", "component", F.col("hot").alias("least")).union(rest.select("id", "component", "least"))


def slices(batches: Iterator, rows: int = 512) -> Iterator:
    """Arrow record batches in small parts, so that few texts are Python objects at once."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)
