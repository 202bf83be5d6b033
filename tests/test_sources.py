"""Reference-shaped CSV inputs through the whole feature build."""

import csv

from pyspark.sql import functions as F

from recspark.operators import features
from recspark.sources.tables import (ARTICLE_CSV_SCHEMA, COMMENT_CSV_SCHEMA, read_delimited, write_scored,
                                     write_table)


def _write(path, header, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f, quoting=csv.QUOTE_MINIMAL)
        w.writerow(header)
        w.writerows(rows)


def test_reference_csv_to_features(spark, tmp_path):
    art_h = [f.name for f in ARTICLE_CSV_SCHEMA.fields]
    com_h = [f.name for f in COMMENT_CSV_SCHEMA.fields]
    _write(tmp_path / "train_articles.csv", art_h, [
        ["a1", "By X", "article", "H1", "['Donald Trump', 'Music', \"Women's Rights\"]", "2018-01-05T13:14:15Z",
         "A good day. Not bad, really!"],
        ["a2", "", "article", "H2", "['Music', 'Food']", "2018-01-06T07:00:00Z", "Plain text."]])
    _write(tmp_path / "test_articles.csv", art_h, [
        ["b1", "By Y", "article", "H3", "[]", "2018-02-01T20:00:00Z", ""]])
    _write(tmp_path / "train_comments.csv", com_h, [
        [1, "a1", 10, 1, 1515158055, 1515158955, "First line.\nSecond, \"quoted\" line.", "True", 5],
        [2, "a1", 11, 2, 1515158055, 1515161655, "Short", "0", 0],
        [3, "a2", 10, 1, 1515222000, 1515222000, "", "False", 3],
        [4, "zz", 12, 1, 1515222000, 1515222000, "orphan", "1", 1]])
    _write(tmp_path / "test_comments.csv", com_h, [
        [5, "b1", 13, 1, 1517515200, 1517516000, "Hello there", "", None]])
    art = read_delimited(spark, str(tmp_path / "train_articles.csv"), ARTICLE_CSV_SCHEMA, "trn") \
        .unionByName(read_delimited(spark, str(tmp_path / "test_articles.csv"), ARTICLE_CSV_SCHEMA, "tst"))
    com = read_delimited(spark, str(tmp_path / "train_comments.csv"), COMMENT_CSV_SCHEMA, "trn") \
        .unionByName(read_delimited(spark, str(tmp_path / "test_comments.csv"), COMMENT_CSV_SCHEMA, "tst"))
    assert {r.type: r["count"] for r in com.groupBy("type").count().collect()} == {"trn": 4, "tst": 1}   # A1
    body = com.filter("commentID = 1").collect()[0].commentBody
    assert body == 'First line.\nSecond, "quoted" line.'                                                  # multi-line
    ft = features.features_from_reference_inputs(art, com)
    rows = {r.commentID: r for r in ft.com_final.collect()}
    assert len(rows) == 5                                       # row count unchanged by the joins (X3)
    assert rows[1].editorsSelection is True and rows[2].editorsSelection is False
    assert rows[5].editorsSelection is None                     # D30: empty -> NA for the test source too
    assert rows[1].kw1 == "Music" and rows[1].topic == "1. Politics"   # 2 articles carry Music -> rank 1
    assert rows[1].time_to_post == 15.0 and rows[1].time_to_post_cat == "15 to 29 minutes"
    assert rows[4].pubDate_dt is None and rows[4].time_to_post_cat is None   # orphan comment (D2 default)
    assert rows[1].com_ord == 1 and rows[2].com_ord == 2
    assert rows[1].timeofday == "Afternoon" and rows[1].dow == "Friday"
    write_table(ft.com_final, str(tmp_path / "com_final"), partition_by=["type"])              # S3
    back = spark.read.parquet(str(tmp_path / "com_final")).filter("type = 'tst'")           # S4 + pruning
    assert back.count() == 1
    write_scored(back.select("commentID", F.lit(3.0).alias("pred_recs")), str(tmp_path / "sub"))  # S6
    sub = spark.read.option("header", True).csv(str(tmp_path / "sub")).collect()
    assert sub[0].commentID == "5" and sub[0].pred_recs == "3.0"


def test_written_table_is_built_once_per_session_and_source(spark):
    """Derived tables shared by many queries are written once per (application, source
    folder, name) and read back; another source folder gets its own table."""
    from recspark.operators import features
    calls = []

    def build(n):
        def make():
            calls.append(n)
            return spark.range(n).withColumnRenamed("id", "x")
        return make

    a1 = features.written_table(spark, "/src/a", "t_cache_test", build(3))
    a2 = features.written_table(spark, "/src/a", "t_cache_test", build(5))
    b1 = features.written_table(spark, "/src/b", "t_cache_test", build(5))
    assert calls == [3, 5]
    assert a1.count() == 3 and a2.count() == 3 and b1.count() == 5


def test_csv_columns_are_bound_by_header_name(spark, tmp_path):
    """Shuffled and extra columns, a missing label, and records that do not fit."""
    head = ["replyCount", "commentBody", "commentID", "newDesk", "articleID", "articleWordCount", "commentSequence",
            "approveDate", "createDate", "userID", "editorsSelection"]
    _write(tmp_path / "test_comments.csv", head, [
        [2, "two\nlines", 7, "OpEd", "a1", 900, 1, 1515158955, 1515158055, "10.0", "False"],
        ["NA", "x", 8, "", "a1", "many", 2, 1515158955, 1515158055, 11, "1"],
        [3, "y", 9, "Sports"]])
    df = read_delimited(spark, str(tmp_path / "test_comments.csv"), COMMENT_CSV_SCHEMA, "tst", bad_row="bad")
    rows = {r.commentID: r for r in df.collect()}
    assert rows[7].commentBody == "two\nlines" and rows[7].articleID == "a1" and rows[7].userID == 10
    assert rows[7].replyCount == 2 and rows[7].newDesk == "OpEd" and rows[7].articleWordCount == 900
    assert rows[7].recommendations is None and rows[7].type == "tst"
    assert [rows[k].bad for k in (7, 8, 9)] == [False, True, True]
    assert rows[8].replyCount is None and rows[8].articleWordCount is None
    assert df.filter("bad").count() == 2

    art_head = ["snippet", "abstract", "articleID", "keywords", "byline", "pubDate"]
    _write(tmp_path / "articles.csv", art_head, [["Plain.", "long abstract", "a1", "['Music']", "By X", "2018-01-05T13:14:15Z"]])
    art = read_delimited(spark, str(tmp_path / "articles.csv"), ARTICLE_CSV_SCHEMA, "tst")
    assert art.first().byline == "By X" and art.first().snippet == "Plain."
    ft = features.features_from_reference_inputs(art, df.drop("bad"))
    from recspark.ml.prep import feature_columns
    assert {"replyCount", "newDesk", "articleWordCount"} <= set(feature_columns(ft.com_final))
    assert ft.com_final.count() == 3
    got = ft.com_final.filter("commentID = 7").first()
    assert got.replyCount == 2 and got.byline == "By X" and got.kw1 == "Music"
    assert "abstract" in ft.art.columns
