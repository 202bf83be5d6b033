"""Operator 11: shards of near-equal bytes by longest-processing-time scheduling.

Rows that must stay together (here: of equal text) are a group.  Groups are ordered by size, the
largest first, with exact running totals over key ranges; each goes to the least-loaded shard through
a heap.  So that the heap stays small at every size of the input, a job of the heap is a group, or a
run of groups next to each other in the order that together hold at most about a ``1 / (JOBS * shards)``
of the bytes from there to the end of the order: the job number of a group is
``floor(JOBS * shards * ln(total / bytes from its start on))``.  A group larger than that is a job of
its own; towards the end the jobs are single small groups again, which level what is left.  There are
at most ``JOBS * shards * ln(total bytes)`` jobs (17,000 for eight shards of 100 TB), which is what the
driver sees; texts never move.

Rows of a shard are numbered by id over key ranges.

Defined results: a null text has no bytes and lies with the empty texts; repeated rows get a slot
each; an empty table gives no rows; a group larger than a shard's share has a shard (nearly) to itself;
other columns are ignored and may have any name.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import running

SHARDS = 8
#: Jobs of the heap for each shard in every e-fold of the bytes.
JOBS = 64
#: Groups with over this share of all rows are joined by broadcast: at most as many groups.
HOT_GROUPS = 1024


def schedule(jobs: list[tuple[int, int]], shards: int) -> dict[int, int]:
    """job -> shard: by size, the largest first, to the least-loaded shard (ties: the first)."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for size, job in sorted(((s, j) for j, s in jobs), key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        out[job] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def assign(rows: DataFrame, shards: int = SHARDS, jobs: int = JOBS) -> DataFrame:
    """Adds ``shard`` and ``slot``.  ``rows`` holds ``group`` and ``size`` (at least 1), with ``id``
    and the unique ``row`` to number them by, and must be stable between reads."""
    spark = rows.sparkSession
    groups = rows.groupBy("group").agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("n"))
    groups = running(groups.withColumn("less", -F.col("total")), ["less", "group"], ["total"], "sharding-groups")
    bytes_, n = groups.agg(F.sum("total"), F.sum("n")).first()
    if not n:
        return rows.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")})
    left = (F.lit(bytes_) - F.col("before_total")).cast("double")
    groups = materialize(groups.select("group", "total", "n", F.floor(
        F.lit(jobs * shards) * F.log(F.lit(float(bytes_)) / left)).alias("job")), "sharding-jobs")
    sizes = [(r.job, r.size) for r in groups.groupBy("job").agg(F.sum("total").alias("size")).collect()]
    assert len(sizes) <= jobs * shards * math.log(max(bytes_, 2)) + 2
    placed = spark.createDataFrame(list(schedule(sizes, shards).items()), "job long, shard int")
    groups = groups.join(F.broadcast(placed), "job").select("group", "n", "shard")
    hot = groups.where(F.col("n") * HOT_GROUPS > n)
    rows = rows.join(F.broadcast(hot.select("group", F.col("shard").alias("hot_shard"))), "group", "left")
    rest = rows.where(F.col("hot_shard").isNull()).join(
        groups.where(F.col("n") * HOT_GROUPS <= n).select("group", "shard"), "group").drop("hot_shard")
    rows = rows.where(F.col("hot_shard").isNotNull()).withColumnRenamed("hot_shard", "shard").unionByName(rest)
    rows = running(rows, ["shard", "id", "row"], [], "sharding-rows")
    first = rows.groupBy("shard").agg(F.min("rank").alias("first"))
    return rows.join(F.broadcast(first), "shard").withColumn("slot", F.col("rank") - F.col("first")).drop("rank", "first")


def shard_documents(docs: DataFrame, shards: int = SHARDS, jobs: int = JOBS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row; equal texts share a shard."""
    raw: Column = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = materialize(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), (F.length(raw) + F.lit(1)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.md5(raw).alias("group")), "sharding-texts")
    return assign(rows, shards, jobs).select(F.col("id").alias("doc_id"), "size", "text_crc32", "shard", "slot")


def digest(docs: DataFrame) -> DataFrame:
    return shard_documents(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), "slot",
                                        F.lit(None).cast("int").alias("grown_shard"))
