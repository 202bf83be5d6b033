"""Distributed row numbering, exact-size split and folds.

``row_number()`` over a window puts each partition group into one task, and a
window without ``partitionBy`` moves *all* rows into one task.  Both break when a
single key holds a large share of the rows.  The operators here bound the work per
task with an order-preserving *bucket* column:

1. ``counts``  = rows per (group, bucket)              — partial aggregation, tiny shuffle
2. ``offsets`` = running sum of counts before a bucket — window over the small counts table
3. join the offsets back on (group, bucket) and number rows inside (group, bucket).

The keys of step 3 are one struct column (equal structs may hold nulls), so the sort-merge
join and the window ask for the same partitioning: the data is exchanged once, with or
without a broadcast of the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import materialize


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


#: Rows that one task sorts or groups, about.
ROWS_A_TASK = 1_000_000
#: Rows that are exchanged at a time, about: a longer table goes through its exchange in several passes.
ROWS_A_PASS = 40_000_000


def tasks_for(df: DataFrame) -> int:
    """Shuffle partitions that hold about ``ROWS_A_TASK`` rows each, not fewer than the session's.
    Counts the rows: for plain table scans, where that reads the files' footers only."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_A_TASK))


def passes_for(df: DataFrame) -> int:
    """Passes of about ``ROWS_A_PASS`` rows each, by a count like that of ``tasks_for``."""
    return max(1, -(-df.count() // ROWS_A_PASS))


def _keys(partition_cols: Sequence[str], bucket_cols: Sequence[Column]) -> Column:
    return F.struct(*[F.col(c).alias(f"p{i}") for i, c in enumerate(partition_cols)],
                    *[b.alias(f"b{i}") for i, b in enumerate(bucket_cols)]).alias("__k")


def bucket_offsets(df: DataFrame, partition_cols: Sequence[str], bucket_cols: Sequence[Column],
                   groups: DataFrame | None = None, n_partitions: int | None = None) -> DataFrame:
    """``__o_k, __off``: the rows of a group before each of its buckets, with the columns of ``groups``
    (see :func:`bucketed_row_number`).  With ``groups`` they are written, so that the shuffles behind
    them are gone when the rows are exchanged."""
    x = df.select(_keys(partition_cols, bucket_cols))
    # exchanged before they are counted: a scan split of any size may hold as many groups as rows
    keyed = x if n_partitions is None else x.repartition(n_partitions, "__k")
    counts = keyed.groupBy("__k").agg(F.count(F.lit(1)).alias("__cnt"))
    w = Window.partitionBy(*[f"__k.p{i}" for i in range(len(partition_cols))]) \
        .orderBy(*[f"__k.b{i}" for i in range(len(bucket_cols))]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("__k").alias("__o_k"), F.coalesce(F.sum("__cnt").over(w), F.lit(0)).alias("__off"))
    if groups is None:
        return offsets
    (c,) = partition_cols
    offsets = offsets.join(groups.withColumnRenamed(c, "__g"), F.col("__o_k.p0") == F.col("__g"), "left").drop("__g")
    return materialize(offsets, "offsets", lean=True)


def bucketed_row_number(df: DataFrame, partition_cols: Sequence[str],
                        order_cols: Sequence[str | Column],
                        bucket_cols: Sequence[Column], out: str = "rn",
                        seen: Observation | None = None, groups: DataFrame | None = None,
                        n_partitions: int | None = None, columns: Sequence[Column] | None = None,
                        offsets: DataFrame | None = None, share: tuple[int, int] = (0, 1)) -> DataFrame:
    """``row_number() over (partition by P order by O)`` with bounded tasks.

    ``bucket_cols`` must be non-decreasing along ``order_cols`` inside each
    partition group (e.g. ``floor(seq / 4096)`` for ``order by seq``), so that the
    order of (bucket, order) equals the order of ``order_cols``.  Null keys are
    matched null-safely.  ``seen`` counts (as ``n``) the rows that enter the join.
    ``groups`` (of one partition column, a row each at most) joins its other columns to the
    rows of the group, through the offsets: without another exchange of the rows.
    ``n_partitions`` is that of the exchanges of rows and keys (the session's number if not given).
    ``columns`` are those of the result, computed from ``df`` after its exchange, ``order_cols`` from
    them: long values that follow from short ones are not moved.
    ``share`` (i, k) gives the i-th of k parts of the rows (from 0, by their group and bucket): passes
    over the same ``offsets`` (from :func:`bucket_offsets`) exchange a part at a time.
    """
    wide = groups is not None or offsets is not None
    if offsets is None:
        offsets = bucket_offsets(df, partition_cols, bucket_cols, groups, n_partitions)
    x = df.select("*", _keys(partition_cols, bucket_cols))
    i, k = share
    if k > 1:      # another hash than that of the exchange
        x, offsets = (t.filter(F.pmod(F.xxhash64(c), F.lit(k)) == i) for t, c in ((x, "__k"), (offsets, "__o_k")))
    if seen is not None:
        x = x.observe(seen, F.count(F.lit(1)).alias("n"))
    if n_partitions is not None:
        x = x.repartition(n_partitions, "__k")
    if columns is not None:
        x = x.select("__k", *columns)
    w2 = Window.partitionBy("__k").orderBy(*[_c(o) for o in order_cols])
    same = F.col("__k") == F.col("__o_k")
    if not wide:
        joined = x.join(offsets, on=same, how="inner").withColumn("__in", F.row_number().over(w2))
    else:                      # numbered first: the sort moves no columns of the groups, and the join needs no other
        joined = x.withColumn("__in", F.row_number().over(w2)).join(offsets, on=same, how="inner")
    return joined.withColumn(out, (F.col("__off") + F.col("__in")).cast("long")).drop("__off", "__in", "__k", "__o_k")


def range_row_number(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str],
                     out: str = "rn", n_partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by P order by O)`` that splits ANY hot key.

    ``order_cols`` (ascending) must make (P, O) a total order — end it with a unique
    key.  A range shuffle on (P, O) cuts the global order into contiguous ranges, so
    a key holding a third of the rows spans many partitions whatever its order values
    are; inside a partition rows are sorted and numbered with consecutive ids.  The
    table is written once (ids are then fixed), and only per (key, partition) counts
    and first ids — a small table — are windowed to get each key's running offset:
    rn = offset + id − first id + 1.  Costs one range shuffle + sort (like a window)
    plus one write of the input."""
    keys = [*partition_cols, *order_cols]
    n = n_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
           .withColumn("__pid", F.spark_partition_id())
           .withColumn("__id", F.monotonically_increasing_id()))
    x = materialize(x, "rangerank", lean=True)
    grp = [*partition_cols, "__pid"]
    firsts = x.groupBy(*grp).agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__cnt"))
    w = (Window.partitionBy(*partition_cols) if partition_cols else Window.partitionBy()) \
        .orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = firsts.select(*[F.col(k).alias(f"__o_{k}") for k in grp], "__first",
                         F.coalesce(F.sum("__cnt").over(w), F.lit(0)).alias("__off"))
    cond = [x[k].eqNullSafe(offs[f"__o_{k}"]) for k in grp]
    j = x.join(offs, on=cond, how="inner")
    return (j.withColumn(out, (F.col("__off") + F.col("__id") - F.col("__first") + 1).cast("long"))
             .drop("__pid", "__id", "__first", "__off", *[f"__o_{k}" for k in grp]))


def sample_hash(key: str | Column, seed: int) -> Column:
    """52-bit non-negative hash of ``seed:key`` from MD5 (hex digits 1-13).

    MD5 is chosen because every SQL engine has it, so the split is a pure function
    of (seed, key) that an independent engine can reproduce exactly; 52 bits keep
    the value exact in a double."""
    s = F.concat(F.lit(f"{seed}:"), _c(key).cast("string"))
    return F.conv(F.substring(F.md5(s), 1, 13), 16, 10).cast("long")


def exact_split(df: DataFrame, key: str, fraction: float = 0.70, seed: int = 19790324,
                flag: str = "in_sample", bucket_bits: int = 16,
                materialize_input: bool = True) -> DataFrame:
    """X1 + X2: mark exactly ``round(fraction·n)`` rows (half-even, like R) as sampled.

    Rows are ordered by (hash(seed,key), key); the first k are the sample.  The hash
    is uniform, so its top ``bucket_bits`` bits give equal-sized buckets.  Bucket
    counts (≤ 2**bucket_bits rows: a proven bound) locate the one bucket that the
    cut falls into; rows of lower buckets are in, higher buckets out, and only the
    cut bucket (~n / 2**bucket_bits rows) is sorted, to find its last sampled row: the flag
    compares every row with that one.  No full shuffle or sort, and no shuffle at all in the result.
    (Where rows equal in hash and key lie on both sides of the cut, it cannot tell them: the rows
    of the cut bucket are then numbered in the result.)  The input is read three times (counts, the
    cut, the result); it is written once to the checkpoint folder unless
    ``materialize_input=False`` (use that when ``df`` is already a plain table scan).
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    shift = 52 - bucket_bits
    x = df.withColumn("__h", sample_hash(key, seed)) \
          .withColumn("__bk", F.shiftrightunsigned(F.col("__h"), shift))
    if materialize_input:
        x = materialize(x, "split", lean=True)
    counts = x.groupBy("__bk").agg(F.count(F.lit(1)).alias("n")).collect()  # ≤ 2**bucket_bits rows
    n = sum(r["n"] for r in counts)
    k = int(round(fraction * n))  # Python round is half-even, as R's round
    cut, before = None, 0
    for r in sorted(counts, key=lambda r: r["__bk"]):
        if before + r["n"] >= k:
            cut = r["__bk"]
            break
        before += r["n"]
    if cut is None or k == 0:
        return x.withColumn(flag, F.lit(k > 0 and n > 0)).drop("__h", "__bk")
    need = k - before
    w = Window.partitionBy("__bk").orderBy("__h", key)
    ends = x.filter(F.col("__bk") == cut).select("__bk", "__h", key).withColumn("__rn", F.row_number().over(w)) \
            .filter(F.col("__rn").isin(need, need + 1)).orderBy("__rn").collect()   # the last row in, the first row out
    last = ends[0]
    if len(ends) == 1 or (ends[1]["__h"], ends[1][key]) != (last["__h"], last[key]):
        at = F.lit(last[key]).cast(x.schema[key].dataType)
        inside = (F.col("__h") < last["__h"]) | ((F.col("__h") == last["__h"]) & (F.col(key) <= at))
        return x.withColumn(flag, inside).drop("__h", "__bk")
    rest = x.filter(F.col("__bk") != cut).withColumn(flag, F.col("__bk") < F.lit(cut))
    at_cut = x.filter(F.col("__bk") == cut) \
              .withColumn(flag, F.row_number().over(w) <= F.lit(need))
    return rest.unionByName(at_cut).drop("__h", "__bk")


def modulo_folds(df: DataFrame, key: str, nfolds: int = 5, seed: int = 1,
                 out: str = "fold") -> DataFrame:
    """fold = (row index − 1) mod ``nfolds``, where the row index follows the
    (hash(seed,key), key) order — a seeded, engine-independent version of the
    reference's modulo assignment.  Uses the bucketed index (no single-partition
    window)."""
    h = sample_hash(key, seed)
    x = df.withColumn("__h", h)
    idx = bucketed_row_number(x, [], ["__h", key],
                              [F.shiftrightunsigned(F.col("__h"), 36)], out="__idx")
    return idx.withColumn(out, F.pmod(F.col("__idx") - 1, F.lit(nfolds)).cast("int")) \
              .drop("__h", "__idx")


class KeptRows:
    """X3 inside a build: as many rows leave its joins as enter them.

    The rows are counted as observed metrics of the one job that writes the result, with
    no extra pass.  A task that runs again after a lost executor may count its rows twice,
    and an empty table may have no metric, so a difference is counted anew before it is
    believed.  Serves one build and one write (of each of its passes)."""

    def __init__(self) -> None:
        self.before, self.after = Observation(), Observation()
        self.parts: list[KeptRows] = []

    def part(self) -> KeptRows:
        """The counter of one of the passes of the build, each written by its own job."""
        self.parts.append(KeptRows())
        return self.parts[-1]

    def leave(self, df: DataFrame) -> DataFrame:
        return df.observe(self.after, F.count(F.lit(1)).alias("n"))

    def check(self, source: DataFrame, written: DataFrame) -> int:
        """Number of rows, once the result is written; raises if ``written`` has lost or
        repeated rows of ``source``."""
        counts = [[x.get.get("n") for x in (p.before, p.after)] for p in self.parts or [self]]
        n, kept = (None if None in c else sum(c) for c in zip(*counts))
        if n is None or n != kept:
            n, kept = source.count(), written.count()
        if n != kept:
            raise AssertionError(f"{n} rows entered the joins, {kept} left them")
        return n


def check_invariants(checks: dict[str, Column], df: DataFrame) -> dict[str, object]:
    """Evaluate boolean/scalar aggregate checks in ONE pass and raise on failure.
    ``checks`` maps a name to an aggregate Column that must be true."""
    row = df.agg(*[c.alias(name) for name, c in checks.items()]).collect()[0]
    failed = [name for name in checks if row[name] is not True]
    if failed:
        raise AssertionError(f"invariant(s) failed: {failed}")
    return row.asDict()
