"""Exploration summaries.

Each graph of the reference becomes a DataFrame with the numbers behind the chart.

Scale notes
* ``summary`` is a partial/final hash aggregation: one small shuffle.
* ``num_com`` is ``n_distinct(commentID)``.  When the id is the table key
  (``id_is_key=True``, to be checked first by ``assert_unique_key``) it equals the row count,
  and Spark avoids the extra full-data exchange that a distinct aggregate needs.
* z-scores (W5) run on summary tables bounded by the fixed category lists, so a
  whole-table window over a few dozen rows is the simplest exact plan.
* quantiles (A19) are exact (type 7), by rank selection over counted values: running totals over
  key ranges of (group, value) give every value its ranks, and only the ≤2 values around each
  target rank are kept.  No group is ever collected into one task, ties are one row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.core import letters_only
from ..functions.timefn import TIME_OF_DAY, TIME_TO_POST, WEEKDAYS
from .features import COMMENT_POSITION
from ..session import materialize
from .indexing import bucketed_row_number

RECS, ID = "recommendations", "commentID"


def assert_unique_key(df: DataFrame, key: str = ID) -> None:
    """Invariant behind ``id_is_key``: the key is non-null and unique."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("nn"),
                 F.count_distinct(key).alias("nd")).collect()[0]
    if not (row["n"] == row["nn"] == row["nd"]):
        raise AssertionError(f"{key} is not a unique non-null key: {row}")


def summary(df: DataFrame, by: Sequence[str], id_is_key: bool = False,
            extra: Sequence[F.Column] = ()) -> DataFrame:
    """A8 shape: recs = Σ recommendations (0 when none), num_com = n_distinct(id),
    avg_recs = recs / num_com."""
    n = F.count(F.lit(1)) if id_is_key else F.count_distinct(ID)
    return (df.groupBy(*by)
              .agg(F.coalesce(F.sum(RECS), F.lit(0)).cast("long").alias("recs"),
                   n.cast("long").alias("num_com"), *extra)
              .withColumn("avg_recs", F.col("recs") / F.col("num_com")))


def zscore(df: DataFrame, c: str, out: str = "rescale") -> DataFrame:
    """R ``scale(x)`` with the sample standard deviation, over the whole table.
    Applied to summary tables whose size is bounded by fixed category lists (at most
    4×7, 4×8 or 16×5 rows), so the whole-table window is a few dozen rows."""
    w = Window.partitionBy()
    return df.withColumn(out, (F.col(c) - F.avg(c).over(w)) / F.stddev_samp(c).over(w))


def fixed_order(c: str, levels: Sequence[str], out: str) -> F.Column:
    """O4 for fixed level lists: 1-based position, null for values outside."""
    expr = None
    for i, v in enumerate(levels, start=1):
        expr = F.when(F.col(c) == v, F.lit(i)) if expr is None else expr.when(F.col(c) == v, F.lit(i))
    return expr.cast("long").alias(out)


# ------------------------------------------------------------------ graphs
def g01(trn: DataFrame) -> DataFrame:
    """A7 per comment + display order by (editorsSelection, −recs)."""
    t = trn.groupBy("articleID", "editorsSelection", ID) \
           .agg(F.coalesce(F.sum(RECS), F.lit(0)).cast("long").alias("recs"))
    t = materialize(t, "g01", lean=True)     # its shuffle is gone before the one of the numbering
    es_key = F.when(F.col("editorsSelection").isNull(), F.lit(2)) \
              .otherwise(F.col("editorsSelection").cast("int"))
    return bucketed_row_number(
        t, [], [F.col("editorsSelection").asc_nulls_last(), F.col("recs").desc(), F.col(ID).asc()],
        [es_key, -F.col("recs"), F.substring(ID, 1, 4)], out="plot_order")


def g02(trn: DataFrame, id_is_key: bool = False) -> DataFrame:
    """A8 + W4: number of editor-selection groups per article -> description."""
    t = summary(trn, ["articleID", "editorsSelection"], id_is_key)
    t = t.withColumn("maxord", F.count(F.lit(1)).over(Window.partitionBy("articleID")).cast("long"))
    return t.withColumn("descr", F.when(F.col("maxord") == 2, "The Article has Editor Selected Comments")
                                   .when(F.col("maxord") == 1,
                                         "The Article does not have Editor Selected Comments"))


def g03_points(trn: DataFrame, id_is_key: bool = False, xlim=(-100.0, 3000.0),
               ylim=(-100.0, 500.0)) -> DataFrame:
    """A9 + P16: per (article, editorsSelection) points inside the axis limits."""
    t = summary(trn, ["articleID", "editorsSelection"], id_is_key, [F.max("kwr").alias("kwr")])
    return t.filter(F.col("kwr").between(*xlim) & F.col("avg_recs").between(*ylim))


def _nrd(df: DataFrame, group: str, c: str) -> DataFrame:
    """MASS ``bandwidth.nrd``: 4·1.06·min(sd, IQR/1.34)·n^(−1/5), quartiles type 7."""
    q = exact_quantiles(df.select(group, c), [group], c, [0.25, 0.75])
    q = q.groupBy(group).agg((F.max(F.when(F.col("p") == 0.75, F.col("q")))
                              - F.max(F.when(F.col("p") == 0.25, F.col("q")))).alias("__iqr"))
    st = df.groupBy(group).agg(F.stddev_samp(c).alias("__sd"), F.count(F.lit(1)).alias("__n"))
    return ns_join(st, q, [group], "left").select(
        group, "__n",
        (F.lit(4 * 1.06) * F.least(F.col("__sd"), F.col("__iqr") / 1.34)
         * F.pow(F.col("__n").cast("double"), -0.2)).alias(f"h_{c}"))


def g03_density(trn: DataFrame, grid: int = 100, xlim=(-100.0, 3000.0),
                ylim=(-100.0, 500.0)) -> DataFrame:
    """2-D Gaussian kernel density (MASS ``kde2d`` form) of (kwr, avg_recs) on a
    grid×grid lattice over the axis limits, per editorsSelection.

    The kernel is separable, so each partition adds Φx(i)ᵀ·Φy(i) over its points in
    numpy (grid² work per point, no cross join of points × cells) and emits one
    partial grid; ``groupBy(cell).sum`` adds the partials.  Exact, and the output is
    grid² rows per group whatever the data size."""
    pts = g03_points(trn, xlim=xlim, ylim=ylim).select(
        F.col("editorsSelection").cast("string").alias("g"), F.col("kwr").cast("double").alias("x"),
        F.col("avg_recs").cast("double").alias("y"))
    # the point table (one row per article and group) is read five times below:
    # write it once to the checkpoint folder instead of re-deriving it from raw data
    pts = materialize(pts, "g03pts", lean=True)
    bw = ns_join(_nrd(pts, "g", "x"), _nrd(pts, "g", "y").drop("__n"), ["g"])
    flat = [r["g"] for r in bw.collect() if not ((r["h_x"] or 0) > 0 and (r["h_y"] or 0) > 0)]
    if flat:  # one row per group
        raise ValueError(f"no positive bandwidth for group(s) {flat}: the middle half of the values is equal")
    data = ns_join(pts, F.broadcast(bw), ["g"])  # one row per group: bounded
    gx = np.linspace(xlim[0], xlim[1], grid)
    gy = np.linspace(ylim[0], ylim[1], grid)
    schema = T.StructType([T.StructField("g", T.StringType()), T.StructField("ix", T.IntegerType()),
                           T.StructField("iy", T.IntegerType()), T.StructField("z", T.DoubleType())])

    def partial(batches):
        acc: dict[str, np.ndarray] = {}
        for b in batches:
            for g, sub in b.groupby("g", dropna=False):
                hx = sub["h_x"].iloc[0] / 4.0
                hy = sub["h_y"].iloc[0] / 4.0
                n = float(sub["__n"].iloc[0])
                ax = np.exp(-0.5 * ((gx[None, :] - sub["x"].to_numpy()[:, None]) / hx) ** 2) / np.sqrt(2 * np.pi)
                ay = np.exp(-0.5 * ((gy[None, :] - sub["y"].to_numpy()[:, None]) / hy) ** 2) / np.sqrt(2 * np.pi)
                z = ax.T @ ay / (n * hx * hy)
                key = "__null__" if pd.isna(g) else g
                acc[key] = acc.get(key, 0) + z
        for g, z in acc.items():
            ix, iy = np.meshgrid(np.arange(grid), np.arange(grid), indexing="ij")
            yield pd.DataFrame({"g": None if g == "__null__" else g, "ix": ix.ravel().astype("int32"),
                                "iy": iy.ravel().astype("int32"), "z": z.ravel()})

    parts = data.mapInPandas(partial, schema)
    out = parts.groupBy("g", "ix", "iy").agg(F.sum("z").alias("density"))
    return out.select(F.col("g").alias("editorsSelection"),
                      (F.lit(xlim[0]) + F.col("ix") * F.lit((xlim[1] - xlim[0]) / (grid - 1))).alias("kwr"),
                      (F.lit(ylim[0]) + F.col("iy") * F.lit((ylim[1] - ylim[0]) / (grid - 1))).alias("avg_recs"),
                      "density")


def g_topic(trn: DataFrame, by: str, id_is_key: bool = False) -> DataFrame:
    """A10/A11 -> letters only (F2, after grouping) -> drop null."""
    t = summary(trn, [by], id_is_key).withColumn(by, letters_only(by))
    return t.filter(F.col(by).isNotNull())


def g_keyword(trn: DataFrame, by: str, id_is_key: bool = False) -> DataFrame:
    """A12 of every non-null keyword (P15); the chart orders them by avg_recs."""
    return summary(trn.filter(F.col(by).isNotNull()), [by], id_is_key)


def g_top_keyword(trn: DataFrame, by: str, k: int = 10, id_is_key: bool = False) -> DataFrame:
    """O3: the first rows of A12 ordered by (−avg_recs, keyword)."""
    t = summary(trn, [by], id_is_key)
    return t.orderBy(F.col("avg_recs").desc(), F.col(by).asc_nulls_last()).limit(k)


def g_heat(trn: DataFrame, by: Sequence[str], z_on: str, id_is_key: bool = False,
           where: F.Column | None = None, orders: dict | None = None) -> DataFrame:
    """Summary -> z-score of ``z_on`` -> fixed level order."""
    src = trn.filter(where) if where is not None else trn
    t = zscore(summary(src, by, id_is_key), z_on)
    for c, (levels, out) in (orders or {}).items():
        t = t.withColumn(out, fixed_order(c, levels, out))
    return t


def read_filter() -> F.Column:
    """0 < readCL <= 16."""
    return (F.col("readCL") > 0) & (F.col("readCL") <= 16)


def g09(trn, id_is_key=False):
    return g_heat(trn, ["timeofday", "dow"], "avg_recs", id_is_key,
                  orders={"dow": (WEEKDAYS, "dow_ord"), "timeofday": (TIME_OF_DAY, "timeofday_ord")})


def g10(trn, id_is_key=False):
    return g_heat(trn, ["timeofday", "dow"], "recs", id_is_key,
                  orders={"dow": (WEEKDAYS, "dow_ord"), "timeofday": (TIME_OF_DAY, "timeofday_ord")})


def g11(trn):
    """P4 + projection behind the scatter plot."""
    return trn.filter(read_filter()).select("readCL", RECS, "com_cat")


def g12(trn, id_is_key=False):
    return summary(trn.filter(read_filter()), ["readCL", "com_cat"], id_is_key)


def g13(trn, id_is_key=False):
    return g_heat(trn, ["readCL", "com_cat"], "recs", id_is_key, where=read_filter())


def g14(trn, id_is_key=False):
    return g_heat(trn, ["timeofday", "time_to_post_cat"], "recs", id_is_key,
                  orders={"time_to_post_cat": (TIME_TO_POST, "ttp_ord"),
                          "timeofday": (TIME_OF_DAY, "timeofday_ord")})


def g15(trn, id_is_key=False):
    return g_heat(trn, ["timeofday", "time_to_post_cat"], "avg_recs", id_is_key,
                  orders={"time_to_post_cat": (TIME_TO_POST, "ttp_ord"),
                          "timeofday": (TIME_OF_DAY, "timeofday_ord")})


def g16(trn, id_is_key=False):
    """A16 + A19: box statistics of avg_recs per comment-position category."""
    box = boxplot_stats(summary(trn, ["com_pos_cat", "articleID"], id_is_key), ["com_pos_cat"], "avg_recs")
    return box.withColumn("pos_ord", fixed_order("com_pos_cat", COMMENT_POSITION, "pos_ord"))


def g16_outliers(trn, id_is_key=False):
    """The points that graph 16 draws outside the whiskers."""
    return boxplot_outliers(summary(trn, ["com_pos_cat", "articleID"], id_is_key), ["com_pos_cat"], "avg_recs")


# ------------------------------------------------------------------ quantiles / boxplot
def ns_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join on ``keys`` keeping one copy of the key columns (NULL
    groups are real groups in R's ``by=``)."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    if not keys:
        raise ValueError("ns_join needs at least one key")
    cond = [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys]
    j = left.join(r, on=cond, how=how)
    return j if how in ("left_semi", "left_anti") else j.drop(*[f"__r_{k}" for k in keys])


def value_ranks(df: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    """``group, v, n, before, total``: how often each value occurs in its group, the rows of the
    group below it and the rows of the group.  Null and NaN values are dropped (``na.rm``).

    Equal values are counted before the shuffle, so ties (however many) are one row.  The counts are
    cut into key ranges over (group, value) and written; a group of any size spans many ranges, and
    running totals are taken within a range, those of the ranges before it (one row per group and
    range) are added.  One plan for all sizes."""
    x = df.select(F.struct(*[F.col(c) for c in group_cols], F.lit(0).alias("one")).alias("group"),
                  F.col(value_col).cast("double").alias("v"))
    counts = x.where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("group", "v").agg(F.count(F.lit(1)).alias("n"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = materialize(counts.repartitionByRange(parts, "group", "v").withColumn("part", F.spark_partition_id()), "ranks", lean=True)
    sums = counts.groupBy("group", "part").agg(F.sum("n").alias("m"))
    whole = Window.partitionBy("group")
    offsets = sums.select("group", "part", F.sum("m").over(whole).alias("total"), F.coalesce(F.sum("m").over(
        whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"))
    within = Window.partitionBy("group", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    out = counts.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0))).join(offsets, ["group", "part"])
    return out.select("group", "v", "n", (F.col("off") + F.col("inside")).alias("before"), "total")


def _groups(df: DataFrame, group_cols: Sequence[str], *cols: str) -> DataFrame:
    return df.select(*[F.col("group")[c].alias(c) for c in group_cols], *cols)


def _quantiles(ranks: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``group, p, q`` (type 7) from ranks: at most two values a group and probability are kept."""
    h = [(F.col("total") - 1) * F.lit(float(p)) + 1 for p in probs]
    hits = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.floor(x).cast("long").alias("lo"), F.ceil(x).cast("long").alias("hi"), x.alias("h"))
                     for p, x in zip(probs, h)])
    holds = lambda k: (k > F.col("before")) & (k <= F.col("before") + F.col("n"))
    near = ranks.select("group", "v", "n", "before", F.explode(F.filter(hits, lambda t: holds(t["lo"]) | holds(t["hi"]))).alias("t"))
    ends = near.groupBy("group", F.col("t.p").alias("p")).agg(
        F.max(F.when(holds(F.col("t.lo")), F.col("v"))).alias("a"), F.max(F.when(holds(F.col("t.hi")), F.col("v"))).alias("b"),
        F.max(F.col("t.h") - F.col("t.lo")).alias("w"))
    return ends.select("group", "p", (F.col("a") + F.col("w") * (F.col("b") - F.col("a"))).alias("q"))


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str, probs: Sequence[float]) -> DataFrame:
    """R ``quantile(x, p, type=7)`` per group, exact and distributed (:func:`value_ranks`): group
    cols, p, q.  Null group values are groups; a group without a value does not appear."""
    return _groups(_quantiles(value_ranks(df, group_cols, value_col), probs), group_cols, "p", "q")


def _fenced(df: DataFrame, group_cols: Sequence[str], value_col: str) -> tuple[DataFrame, DataFrame]:
    """(hinges and fences per group, counted values with ``inside``)."""
    ranks = materialize(value_ranks(df, group_cols, value_col), "boxplot", lean=True)
    at = lambda p: F.max(F.when(F.col("p") == p, F.col("q")))
    box = _quantiles(ranks, [0.25, 0.5, 0.75]).groupBy("group").agg(at(0.25).alias("lower"), at(0.5).alias("middle"), at(0.75).alias("upper"))
    reach = 1.5 * (F.col("upper") - F.col("lower"))
    inside = (F.col("v") >= F.col("lower") - reach) & (F.col("v") <= F.col("upper") + reach)
    return box, ranks.join(box, "group").withColumn("inside", inside)


def boxplot_stats(df: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    """A19 (ggplot ``stat_boxplot``): lower/middle/upper hinges (type 7), whiskers = most extreme
    values within 1.5·IQR of the hinges, number of outliers, n (null and NaN values dropped)."""
    _, values = _fenced(df, group_cols, value_col)
    out = values.groupBy("group", "lower", "middle", "upper").agg(
        F.min(F.when(F.col("inside"), F.col("v"))).alias("ymin"), F.max(F.when(F.col("inside"), F.col("v"))).alias("ymax"),
        F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("n_outliers"), F.sum("n").alias("n"))
    return _groups(out, group_cols, "lower", "middle", "upper", "ymin", "ymax", "n_outliers", "n")


def boxplot_outliers(df: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    """The points drawn outside the whiskers, equal ones counted: group cols, value, n."""
    _, values = _fenced(df, group_cols, value_col)
    return _groups(values.where(~F.col("inside")).withColumnRenamed("v", value_col), group_cols, value_col, "n")
