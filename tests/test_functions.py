"""Boundary rows for the column helpers (FIXTURES.md §4)."""

import datetime as dt

from pyspark.sql import functions as F

from recspark.functions.core import r_bool, rint0, clamp0, r_strsplit, trimws, safe_log, is_in
from recspark.functions.text import sentiment_bucket, tokens, sentences
from recspark.functions.timefn import (parse_iso, time_of_day, time_to_post, time_to_post_category,
                                       weekday_name, weekend_flag, hour_of)
from recspark.functions.topics import topic_of
from recspark.operators.features import comment_position


def col1(spark, values, typ, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_rint_half_even_and_negative_zero(spark):
    out = col1(spark, [0.5, 1.5, 2.5, -0.4, -0.5, None], "double", rint0)
    assert out == [0.0, 2.0, 2.0, 0.0, 0.0, None]
    assert str(out[3]) == "0.0"  # not -0.0


def test_clamp_keeps_null(spark):
    assert col1(spark, [-3.0, 0.0, 2.0, None], "double", clamp0) == [0.0, 0.0, 2.0, None]


def test_editor_selection(spark):
    assert col1(spark, ["0", "1", "True", "False", "x", None], "string", r_bool) == \
        [False, True, True, False, None, None]


def test_r_strsplit(spark):
    out = col1(spark, ["a|b||", "|a", "", None, " a|\tb "], "string", lambda c: r_strsplit(c, ["|"]))
    assert out[0] == ["a", "b", ""]          # only ONE trailing empty piece dropped
    assert out[1] == ["", "a"]
    assert out[2] == []
    assert out[3] is None
    assert out[4] == [" a", "\tb "]


def test_trimws(spark):
    assert col1(spark, [" \t a b\r\n", None], "string", trimws) == ["a b", None]


def test_safe_log(spark):
    out = col1(spark, [0.0, 1.0, 10.0], "double", safe_log)
    assert out[0] == 0.0 and out[1] == 0.0 and abs(out[2] - 2.302585092994046) < 1e-12


def test_membership_never_null(spark):
    assert col1(spark, ["Sunday", "Monday", None], "string", lambda c: is_in(c, ["Sunday"])) == \
        [True, False, False]


def test_time_of_day_boundaries(spark):
    ts = [dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 1, 7, 59, 59), dt.datetime(2024, 1, 1, 8),
          dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 1, 18), dt.datetime(2024, 1, 1, 23, 59, 59), None]
    out = col1(spark, ts, "timestamp", lambda c: time_of_day(hour_of(c)))
    assert out == ["Late Night", "Late Night", "Morning", "Afternoon", "Evening", "Evening", None]


def test_weekday_and_weekend(spark):
    ts = [dt.datetime(2024, 1, 6, 10), dt.datetime(2024, 1, 8, 10)]  # Saturday, Monday
    assert col1(spark, ts, "timestamp", weekday_name) == ["Saturday", "Monday"]
    assert col1(spark, ["Saturday", "Monday", None], "string", weekend_flag) == ["Weekend", "Weekday", "Weekday"]
    assert col1(spark, ["Monday"], "string", lambda c: weekend_flag(c, reference_quirk=True)) == ["Weekend"]


def test_parse_iso(spark):
    out = col1(spark, ["2018-01-05T13:14:15Z", "2018-01-05 13:14:15", "", "nonsense", None], "string", parse_iso)
    assert out[0] == dt.datetime(2018, 1, 5, 13, 14, 15) and out[1] == out[0]
    assert out[2:] == [None, None, None]


def test_time_to_post_buckets(spark):
    pub = dt.datetime(2024, 1, 1, 0, 0, 0)
    minutes = [-5, 0, 14, 15, 30, 45, 60, 61, 120, 240, 720, 721, 0.5, 1.5]
    rows = [(pub + dt.timedelta(minutes=m), pub) for m in minutes] + [(pub, None)]
    df = spark.createDataFrame(rows, "a timestamp, p timestamp")
    df = df.withColumn("t", time_to_post("a", "p"))
    got = df.select("t", time_to_post_category("t").alias("c"),
                    time_to_post_category("t", "p", no_article_label=True).alias("c2")).collect()
    assert [r.t for r in got] == [0.0, 0.0, 14.0, 15.0, 30.0, 45.0, 60.0, 61.0, 120.0, 240.0, 720.0, 721.0,
                                  0.0, 2.0, None]
    assert [r.c for r in got][:12] == ["Within 15 minutes", "Within 15 minutes", "Within 15 minutes",
                                       "15 to 29 minutes", "30 to 44 minutes", "45 minutes to 1 Hour",
                                       "45 minutes to 1 Hour", "1 to 2 Hours", "1 to 2 Hours", "2 to 4 Hours",
                                       "4 to 12 Hours", ">12 Hours"]
    assert got[-1].c is None and got[-1].c2 == "No Article"


def test_sentiment_bucket_boundaries(spark):
    vals = [-0.5, -0.4999, -0.1, -0.0999, 0.0999, 0.1, 0.4999, 0.5, None]
    assert col1(spark, vals, "double", sentiment_bucket) == [
        "Very Negative", "Negative", "Negative", "Neutral", "Neutral", "Positive", "Positive",
        "Very Positive", None]


def test_comment_position_boundaries(spark):
    df = spark.createDataFrame([(v,) for v in [10, 11, 50, 51, 100, 101, 200, 201]], "com_ord long")
    assert [r[0] for r in df.select(comment_position("com_ord")).collect()] == [
        "Top 10", "11 to 50", "11 to 50", "51 to 100", "51 to 100", "101 to 200", "101 to 200", ">200"]


def test_topic_rules(spark):
    out = col1(spark, ["States (US)", "States US", "Facebook", "Music", "Donald Trump", "nothing", None],
               "string", topic_of)
    # "States (US)" is a regex group: it matches "States US" but not the literal text
    assert out[0] == "9. Other" and out[1] == "3. National"
    assert out[2] == "5. Science and Technology" and out[3] == "5. Entertainment"
    assert out[4] == "1. Politics" and out[5] == "9. Other" and out[6] == "9. Other"


def test_tokens_and_sentences(spark):
    out = col1(spark, ["Élan, the çà va; x1y. Second one!  ", "...", None], "string",
               lambda c: F.struct(tokens(c).alias("t"), sentences(c).alias("s")))
    assert out[0]["t"] == ["élan", "the", "çà", "va", "x", "y", "second", "one"]
    assert len(out[0]["s"]) == 2
    assert out[1]["t"] == [] and out[1]["s"] == []
    assert out[2]["t"] is None
