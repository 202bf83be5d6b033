"""Driver tables in the roles of the reference (FIXTURES.md §3).

article  <- orders     articleID=o_orderkey, pubDate=o_orderdate, byline=o_orderpriority,
                       snippet = documents.text with doc_id = o_orderkey (left)
comment  <- lineitem   articleID=l_orderkey, commentSequence=l_linenumber, userID=l_suppkey,
                       approveDate=l_shipdate, editorsSelection=(l_returnflag='R'),
                       recommendations=l_quantity, commentID = key of all columns,
                       commentBody = conversations.text with (conv_id, turn) =
                       (l_orderkey, l_linenumber) (left)
keyword  <- (order, p_name) pairs through lineitem.l_partkey
type     <- 'trn' when articleID % 10 < 7 else 'tst'

All columns are derived by Spark from the given tables; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

TRAIN_TAG, TEST_TAG = "trn", "tst"


def split_tag(key: str) -> F.Column:
    return F.when(F.pmod(F.col(key), F.lit(10)) < 7, F.lit(TRAIN_TAG)).otherwise(F.lit(TEST_TAG))


def comment_id() -> F.Column:
    """The comment key is built from ALL line-item columns (the four key columns are
    not unique at every scale).  Numbers are written as integers (quantity, cents,
    percent) and the date as yyyyMMdd, so any engine can rebuild the same text; it is
    never passed through double (D26).  Over the columns of :func:`comment_parts`."""
    parts = [*[F.col(c) for c in ("articleID", "partID", "userID", "commentSequence", "recommendations", "cents", "discount", "tax",
                                  "flag", "status")], F.date_format("shipdate", "yyyyMMdd")]
    return F.concat_ws("-", *[x.cast("string") for x in parts])


def articles(spark: SparkSession, sf_dir: str, with_snippet: bool = False) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    art = o.select(F.col("o_orderkey").alias("articleID"),
                   F.col("o_orderdate").cast("timestamp").alias("pubDate_dt"),
                   F.col("o_orderpriority").alias("byline"),
                   split_tag("o_orderkey").alias("type"))
    if with_snippet:
        art = art.join(article_snippets(spark, sf_dir), on="articleID", how="left")
    return art


def article_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(articleID, snippet): the text of an article lives in ``documents``."""
    return read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("articleID"),
                                                         F.col("text").alias("snippet"))


def comment_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(articleID, commentSequence, commentBody) from ``conversations``."""
    return read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("articleID"), F.col("turn").alias("commentSequence"),
        F.col("text").alias("commentBody"))


def comment_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What :func:`comment_columns` are computed from: whole numbers and short values, to be
    moved instead of the comments themselves, whose ids are long texts of all of them."""
    percent = lambda c: F.round(F.col(c) * 100).cast("long")
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("articleID"), F.col("l_partkey").alias("partID"), F.col("l_suppkey").alias("userID"),
        F.col("l_linenumber").cast("long").alias("commentSequence"), F.col("l_quantity").cast("long").alias("recommendations"),
        percent("l_extendedprice").alias("cents"), percent("l_discount").alias("discount"), percent("l_tax").alias("tax"),
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), F.col("l_shipdate").alias("shipdate"))


def comment_columns() -> list[F.Column]:
    """The columns of a comment, over :func:`comment_parts`."""
    return [comment_id().alias("commentID"), F.col("articleID"), F.col("commentSequence"), F.col("userID"),
            F.col("shipdate").cast("timestamp").alias("approveDate_ts"), (F.col("flag") == "R").alias("editorsSelection"),
            F.col("recommendations"), split_tag("articleID").alias("type")]


def comments(spark: SparkSession, sf_dir: str, with_body: bool = False) -> DataFrame:
    com = comment_parts(spark, sf_dir).select(*comment_columns())
    if with_body:
        com = com.join(comment_bodies(spark, sf_dir), on=["articleID", "commentSequence"], how="left")
    return com


def keyword_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(articleID, new): the part names of an order's line items."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return li.join(p, li.l_partkey == p.p_partkey, "inner") \
             .select(F.col("l_orderkey").alias("articleID"), F.col("p_name").alias("new"))


def part_keyword_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyword-list text column in the reference's ``['a', 'b']`` format, built row
    by row from a part's name tokens, brand and type (input of T2)."""
    p = read_table(spark, sf_dir, "part")
    items = F.concat(F.split(F.col("p_name"), " "), F.array(F.col("p_brand"), F.col("p_type")))
    text = F.concat(F.lit("['"), F.array_join(items, "', '"), F.lit("']"))
    return p.select(F.col("p_partkey").alias("articleID"), text.alias("keywords"))


def learning_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label + features for the model operators, from ``events``:
    label = rint(value) (a count-like target), features hour(ts), `$.k` of props,
    event_type, user_id; key = event_id."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("commentID"),
        (F.rint("value") + F.lit(0.0)).alias("recommendations"),
        F.hour(F.col("ts").cast("timestamp")).cast("double").alias("hr"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.col("event_type"),
        F.col("user_id").cast("string").alias("user"),
        F.dayofweek(F.col("ts").cast("timestamp")).cast("double").alias("dow_num"),
    )
