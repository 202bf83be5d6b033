"""Property tests (hypothesis): each example is one batched Spark job."""

import re

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from recspark.functions.core import r_strsplit, trimws
from recspark.operators import eda
from recspark.operators.indexing import bucketed_row_number

SETTINGS = dict(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def r_strsplit_model(s, delims):
    """Pure-Python statement of R strsplit + trimws as used by text_to_columns."""
    if s is None:
        return None
    if s == "":
        return []
    parts = re.split("|".join(re.escape(d) for d in delims), s)
    if parts and parts[-1] == "":
        parts = parts[:-1]
    return [re.sub(r"^[ \t\r\n]+|[ \t\r\n]+$", "", p) for p in parts]


@settings(**SETTINGS)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab|, \t.", max_size=12)), min_size=1, max_size=40),
       st.sampled_from([["|"], ["|", ","], ["."], [", "]]))
def test_strsplit_matches_model(spark, strings, delims):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i int, s string")
    got = {r.i: r.p for r in df.select("i", F.transform(r_strsplit("s", delims), lambda p: trimws(p))
                                      .alias("p")).collect()}
    for i, s in enumerate(strings):
        assert got[i] == r_strsplit_model(s, delims), (s, delims)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-20, 20)), min_size=1, max_size=120),
       st.lists(st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]), min_size=1, max_size=4, unique=True))
def test_exact_quantiles_match_numpy(spark, rows, probs):
    df = spark.createDataFrame([(g, float(v)) for g, v in rows], "g int, v double")
    got = {(r.g, r.p): r.q for r in eda.exact_quantiles(df, ["g"], "v", probs).collect()}
    for g in {g for g, _ in rows}:
        vals = [float(v) for gg, v in rows if gg == g]
        for p in probs:
            assert abs(got[(g, p)] - float(np.quantile(vals, p))) < 1e-9


@settings(**SETTINGS)
@given(st.integers(1, 50), st.integers(1, 400))
def test_bucketed_row_number_any_width(spark, width, n):
    df = spark.range(n).select((F.col("id") % 5).alias("g"), ((F.col("id") * 37) % 101).alias("v"), "id")
    got = bucketed_row_number(df, ["g"], ["v", "id"], [F.floor(F.col("v") / width)], out="rn")
    ref = df.withColumn("rn2", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    assert got.join(ref, ["g", "v", "id"]).filter("rn != rn2").count() == 0
