"""Registered queries over the feature table: G1-G16, the wide feature join, the
exact split and the audit counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.core import round_half_even
from ..functions.timefn import TIME_OF_DAY, TIME_TO_POST, WEEKDAYS
from ..ml.prep import modelling_rows
from ..operators import eda, features
from ..operators.features import COMMENT_POSITION
from ..operators.indexing import exact_split
from ..sources import adapters
from . import oracle_sql as O
from .registry import register

R6 = lambda c: round_half_even(c, 6)


def _r6(x: str) -> str:
    return f"(round_even({x}, 6) + 0.0)"


def _sum_sql(by: str, extra: str = "", where: str = "") -> str:
    w = f" WHERE {where}" if where else ""
    return (f"SELECT {by}, CAST(coalesce(sum(recommendations), 0) AS BIGINT) AS recs, "
            f"count(DISTINCT commentID) AS num_com{extra}, "
            f"CAST(coalesce(sum(recommendations), 0) AS BIGINT) / count(DISTINCT commentID) AS avg_recs "
            f"FROM trn{w} GROUP BY {by}")


def _order_sql(c: str, levels: list[str], out: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} = {O.q(v)} THEN {i}" for i, v in enumerate(levels, 1)) + f" END AS {out}"


def _z_sql(inner: str, z_on: str, orders: str = "") -> str:
    return (f"SELECT *, {_r6(f'({z_on} - avg({z_on}) OVER ()) / stddev_samp({z_on}) OVER ()')} AS rescale"
            f"{orders} FROM ({inner})")


FEAT = O.features_cte()


def _trn(spark, sf):
    return features.training_comments(spark, sf)


def _z(df):
    return df.withColumn("rescale", R6("rescale"))


@register("g01", FEAT + """
SELECT articleID, editorsSelection, commentID, recs,
       row_number() OVER (ORDER BY editorsSelection ASC NULLS LAST, recs DESC, commentID ASC) AS plot_order
FROM (SELECT articleID, editorsSelection, commentID, CAST(coalesce(sum(recommendations), 0) AS BIGINT) AS recs
      FROM trn GROUP BY articleID, editorsSelection, commentID)
""", "G1 A7 O1 O4 W8")
def q_g01(spark, sf):
    return eda.g01(_trn(spark, sf))


@register("g02", FEAT + f"""
SELECT *, CASE WHEN maxord = 2 THEN 'The Article has Editor Selected Comments'
               WHEN maxord = 1 THEN 'The Article does not have Editor Selected Comments' END AS descr
FROM (SELECT *, count(*) OVER (PARTITION BY articleID) AS maxord FROM ({_sum_sql('articleID, editorsSelection')}))
""", "G2 A8 W4 P12 O2")
def q_g02(spark, sf):
    return eda.g02(_trn(spark, sf))


@register("g03_points", FEAT + f"""
SELECT * FROM ({_sum_sql('articleID, editorsSelection', ', max(kwr) AS kwr')})
WHERE kwr BETWEEN -100 AND 3000 AND avg_recs BETWEEN -100 AND 500
""", "G3 A9 P16")
def q_g03_points(spark, sf):
    return eda.g03_points(_trn(spark, sf))


@register("g03_density", FEAT + f"""
, p AS (SELECT CAST(editorsSelection AS VARCHAR) AS g, CAST(kwr AS DOUBLE) AS x, avg_recs AS y, row_number() OVER () AS id
        FROM ({_sum_sql('articleID, editorsSelection', ', max(kwr) AS kwr')})
        WHERE kwr BETWEEN -100 AND 3000 AND avg_recs BETWEEN -100 AND 500),
b AS (SELECT g, count(*) AS n,
             1.06 * least(stddev_samp(x), (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) / 1.34) * pow(count(*), -0.2) AS hx,
             1.06 * least(stddev_samp(y), (quantile_cont(y, 0.75) - quantile_cont(y, 0.25)) / 1.34) * pow(count(*), -0.2) AS hy
      FROM p GROUP BY g),
k AS (SELECT unnest(range(100)) AS i),
ax AS (SELECT id, p.g, i AS ix, exp(-0.5 * pow((-100 + i * (3100 / 99.0::DOUBLE) - x) / hx, 2)) / sqrt(2 * pi()) / hx / n AS u
       FROM p JOIN b ON p.g IS NOT DISTINCT FROM b.g, k),
ay AS (SELECT id, i AS iy, exp(-0.5 * pow((-100 + i * (600 / 99.0::DOUBLE) - y) / hy, 2)) / sqrt(2 * pi()) / hy AS v
       FROM p JOIN b ON p.g IS NOT DISTINCT FROM b.g, k),
z AS (SELECT g, ix, iy, sum(u * v) AS z FROM (SELECT * FROM ax WHERE u > 1e-30) ax JOIN (SELECT * FROM ay WHERE v > 1e-30) ay USING (id) GROUP BY ALL)
SELECT b.g AS editorsSelection, -100 + kx.i * (3100 / 99.0::DOUBLE) AS kwr, -100 + ky.i * (600 / 99.0::DOUBLE) AS avg_recs,
       round_even(coalesce(z, 0), 12) + 0.0 AS density
FROM b CROSS JOIN k kx CROSS JOIN k ky LEFT JOIN z ON z.g IS NOT DISTINCT FROM b.g AND ix = kx.i AND iy = ky.i
""", "G3 A20")
def q_g03_density(spark, sf):
    return eda.g03_density(_trn(spark, sf)).withColumn("density", round_half_even("density", 12))


@register("g04", FEAT + f"""
SELECT regexp_replace(topic, '[^A-Za-z]', '', 'g') AS topic, recs, num_com, avg_recs
FROM ({_sum_sql('topic')}) WHERE topic IS NOT NULL
""", "G4 A10 F2 P15")
def q_g04(spark, sf):
    return eda.g_topic(_trn(spark, sf), "topic")


@register("g05", FEAT + f"""
SELECT regexp_replace(specific, '[^A-Za-z]', '', 'g') AS specific, recs, num_com, avg_recs
FROM ({_sum_sql('specific')}) WHERE specific IS NOT NULL
""", "G5 A11 F2 P15")
def q_g05(spark, sf):
    return eda.g_topic(_trn(spark, sf), "specific")


for _i, _kw in ((6, "kw1"), (7, "kw2"), (8, "kw3")):
    def _mk(kw, graph):
        def fn(spark, sf):
            return graph(_trn(spark, sf), kw)
        return fn
    register(f"g{_i:02d}", FEAT + f"""
SELECT * FROM ({_sum_sql(_kw)}) WHERE {_kw} IS NOT NULL
""", f"G{_i} A12 P15")(_mk(_kw, eda.g_keyword))
    register(f"g{_i:02d}_top", FEAT + f"""
SELECT * FROM ({_sum_sql(_kw)}) ORDER BY avg_recs DESC, {_kw} ASC NULLS LAST LIMIT 10
""", "A12 O1 O3")(_mk(_kw, eda.g_top_keyword))


_TOD = _order_sql("timeofday", TIME_OF_DAY, "timeofday_ord")
_DOW = _order_sql("dow", WEEKDAYS, "dow_ord")
_TTP = _order_sql("time_to_post_cat", TIME_TO_POST, "ttp_ord")
_READ = "readCL > 0 AND readCL <= 16"


@register("g09", FEAT + _z_sql(_sum_sql("timeofday, dow"), "avg_recs", f", {_DOW}, {_TOD}"),
          "G9 A13 W5 O4")
def q_g09(spark, sf):
    return _z(eda.g09(_trn(spark, sf)))


@register("g10", FEAT + _z_sql(_sum_sql("timeofday, dow"), "recs", f", {_DOW}, {_TOD}"), "G10 A13 W5 O4")
def q_g10(spark, sf):
    return _z(eda.g10(_trn(spark, sf)))


@register("g11", FEAT + f"SELECT readCL, recommendations, com_cat FROM trn WHERE {_READ}", "G11 P4")
def q_g11(spark, sf):
    return eda.g11(_trn(spark, sf))


@register("g12", FEAT + _sum_sql("readCL, com_cat", where=_READ), "G12 A14 P4")
def q_g12(spark, sf):
    return eda.g12(_trn(spark, sf))


@register("g13", FEAT + _z_sql(_sum_sql("readCL, com_cat", where=_READ), "recs"), "G13 A14 W5")
def q_g13(spark, sf):
    return _z(eda.g13(_trn(spark, sf)))


@register("g14", FEAT + _z_sql(_sum_sql("timeofday, time_to_post_cat"), "recs", f", {_TTP}, {_TOD}"),
          "G14 A15 W5 O4")
def q_g14(spark, sf):
    return _z(eda.g14(_trn(spark, sf)))


@register("g15", FEAT + _z_sql(_sum_sql("timeofday, time_to_post_cat"), "avg_recs", f", {_TTP}, {_TOD}"),
          "G15 A15 W5 O4")
def q_g15(spark, sf):
    return _z(eda.g15(_trn(spark, sf)))


_BOX_SQL = FEAT + f"""
, s AS ({_sum_sql('com_pos_cat, articleID')}),
q AS (SELECT com_pos_cat, quantile_cont(avg_recs, 0.25) AS lower, quantile_cont(avg_recs, 0.5) AS middle,
             quantile_cont(avg_recs, 0.75) AS upper FROM s GROUP BY com_pos_cat),
f AS (SELECT *, lower - 1.5 * (upper - lower) AS lf, upper + 1.5 * (upper - lower) AS uf FROM q)
"""


@register("g16", _BOX_SQL + f"""
SELECT f.com_pos_cat, {_r6('f.lower')} AS lower, {_r6('f.middle')} AS middle, {_r6('f.upper')} AS upper,
       min(CASE WHEN s.avg_recs >= lf AND s.avg_recs <= uf THEN s.avg_recs END) AS ymin,
       max(CASE WHEN s.avg_recs >= lf AND s.avg_recs <= uf THEN s.avg_recs END) AS ymax,
       CAST(sum(CASE WHEN s.avg_recs >= lf AND s.avg_recs <= uf THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers,
       count(*) AS n, {_order_sql('f.com_pos_cat', COMMENT_POSITION, 'pos_ord')}
FROM f JOIN s ON f.com_pos_cat IS NOT DISTINCT FROM s.com_pos_cat
GROUP BY f.com_pos_cat, f.lower, f.middle, f.upper
""", "G16 A16 A19")
def q_g16(spark, sf):
    out = eda.g16(_trn(spark, sf))
    return out.select("com_pos_cat", R6("lower").alias("lower"), R6("middle").alias("middle"),
                      R6("upper").alias("upper"), "ymin", "ymax", "n_outliers", "n", "pos_ord")


@register("g16_outliers", _BOX_SQL + """
SELECT f.com_pos_cat, s.avg_recs, count(*) AS n FROM f JOIN s ON f.com_pos_cat IS NOT DISTINCT FROM s.com_pos_cat
WHERE s.avg_recs < lf OR s.avg_recs > uf GROUP BY ALL
""", "G16 A16 A19 (outlier points)")
def q_g16_outliers(spark, sf):
    return eda.g16_outliers(_trn(spark, sf))


# ------------------------------------------------------------------ feature table, split, audit
_FEATURE_COLS = ["commentID", "articleID", "type", "com_ord", "com_pos_cat", "com_cat", "readFR", "readCL",
                 "byline", "kw1", "kw2", "kw3", "timeofday", "wkdy", "dow", "topic", "specific", "snip_cat",
                 "time_to_post", "time_to_post_cat"]
# nullable integer features are reported as R numerics (double) in both engines
_NUMERIC_COLS = ["comment_length", "kwr1", "kwr2", "kwr3", "kwr", "minkwr"]


@register("feature_join", FEAT + "SELECT " + ", ".join(_FEATURE_COLS) + ", "
          + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _NUMERIC_COLS)
          + f", {_r6('com_sent')} AS com_sent, {_r6('snip_sent')} AS snip_sent FROM com_final2",
          "D-13 J2 J3 J4 J5 J6 J7 J8 J9 J10 P9 D-6..D-11 T4-T7")
def q_feature_join(spark, sf):
    c = features.feature_table(spark, sf)
    return c.select(*_FEATURE_COLS, *[F.col(x).cast("double").alias(x) for x in _NUMERIC_COLS],
                    R6("com_sent").alias("com_sent"), R6("snip_sent").alias("snip_sent"))


_SPLIT_SQL = f"""
WITH c AS (SELECT {O.comment_id()} AS commentID
           FROM lineitem WHERE l_orderkey % 10 < 7),
r AS (SELECT commentID, row_number() OVER (ORDER BY {O.sample_hash('commentID', 19790324)}, commentID) AS rn,
             count(*) OVER () AS n FROM c)
"""


def _split(spark, sf):
    c = adapters.comments(spark, sf, with_body=False).filter(F.col("type") == "trn").select("commentID")
    return exact_split(c, "commentID", 0.70, 19790324, flag="in_sample")


@register("split_train", _SPLIT_SQL + "SELECT commentID FROM r WHERE rn <= round_even(0.7::DOUBLE * n, 0)",
          "X1 X2 J11 (semi)")
def q_split_train(spark, sf):
    return _split(spark, sf).filter("in_sample").select("commentID")


@register("split_holdout", _SPLIT_SQL + "SELECT commentID FROM r WHERE rn > round_even(0.7::DOUBLE * n, 0)",
          "X1 X2 J11 (anti)")
def q_split_holdout(spark, sf):
    return _split(spark, sf).filter(~F.col("in_sample")).select("commentID")


@register("split_shares", _SPLIT_SQL + """
SELECT count(*) FILTER (WHERE rn <= round_even(0.7::DOUBLE * n, 0)) AS n_trn,
       count(*) FILTER (WHERE rn > round_even(0.7::DOUBLE * n, 0)) AS n_tst,
       round_even(count(*) FILTER (WHERE rn <= round_even(0.7::DOUBLE * n, 0)) / count(*), 2) + 0.0 AS share_trn
FROM r""", "X3")
def q_split_shares(spark, sf):
    s = _split(spark, sf)
    out = s.agg(F.count(F.when(F.col("in_sample"), 1)).alias("n_trn"),
                F.count(F.when(~F.col("in_sample"), 1)).alias("n_tst"),
                (F.bround(F.count(F.when(F.col("in_sample"), 1)) / F.count(F.lit(1)), 2) + 0.0).alias("share_trn"))
    return out


@register("audit_counts", FEAT + """
, fl AS (SELECT *, CASE WHEN __rn <= round_even(0.7::DOUBLE * __n, 0) THEN 'trn' ELSE 'tst' END AS split FROM trn_all)
SELECT split, count(*) AS n_rows, count(DISTINCT articleID) AS n_articles,
       count(*) FILTER (WHERE pubDate_dt IS NOT NULL) AS n_rows_matched,
       count(DISTINCT CASE WHEN pubDate_dt IS NOT NULL THEN articleID END) AS n_articles_matched
FROM fl GROUP BY split
""", "A17 P1 X3")
def q_audit_counts(spark, sf):
    c = features.feature_table(spark, sf).filter(F.col("type") == "trn")
    s = exact_split(c, "commentID", 0.70, 19790324, flag="__s", materialize_input=False)
    s = s.withColumn("split", F.when(F.col("__s"), "trn").otherwise("tst"))
    matched = F.col("pubDate_dt").isNotNull()
    return s.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("articleID").alias("n_articles"),
        F.count(F.when(matched, 1)).alias("n_rows_matched"),
        F.count_distinct(F.when(matched, F.col("articleID"))).alias("n_articles_matched"))


@register("model_rows", FEAT + f"""
SELECT commentID, recommendations, {_r6("ln(CASE WHEN recommendations = 0 THEN 1 ELSE recommendations END)")} AS log_rec
FROM trn WHERE byline IS NOT NULL
""", "P2 F14 M15 P10")
def q_model_rows(spark, sf):
    rows = modelling_rows(_trn(spark, sf))
    return rows.select("commentID", "recommendations", R6("log_rec").alias("log_rec"))
