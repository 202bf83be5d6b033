"""Keyword list parsing, ranking and per-article keyword features (T2, U3, A2-A4,
J1, W1, W2, U4, D-1 … D-5).

Scale notes
* The distinct (article, keyword) pairs are written once to the checkpoint folder:
  they feed the frequency table and the join back, and Spark re-derived the
  pair join for each branch otherwise.
* The keyword frequency ``N`` is a partial/final aggregation (one small shuffle).
* The global ``dense_rank`` over (N desc, keyword) must not be a window without
  ``partitionBy`` (that is a single-partition exchange).  It is computed on the
  *distinct keyword* table with :func:`bucketed_row_number`, bucket =
  (−N, first two characters), which is order-preserving.  Inside the distinct table
  every keyword occurs once, so row_number == dense_rank.
* Per-article outputs (top-3, topic, score, specific) come from ONE
  ``groupBy(articleID)`` plus a top-3 window whose ``rn <= 3`` filter Spark plans as
  a partial ``WindowGroupLimit`` before the exchange (a hot article ships ≤3 rows per
  map task).
* D6 fix: a keyword repeated within one article is counted once per article
  (duplicates would otherwise duplicate the article in J4 and fill kw1..kw3 with the
  same keyword).  ``N`` counts articles per keyword.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.core import col, trimws
from ..functions.topics import DEFAULT_TOPIC, TOPIC_RULES, topic_of
from ..session import materialize
from .indexing import bucketed_row_number


def parse_keyword_list(c: str | Column, glue_quoted: bool = True) -> Column:
    """``['a', 'b', "c's"]`` -> array<string>.

    Steps as in the reference: drop ``[`` and ``]``, turn ``',`` into ``|``, drop
    ``'``, split on ``|``, trim.  D4: an element in double quotes is not separated
    from the next one by ``',`` and so stays glued to it (``glue_quoted=True``
    keeps that); ``False`` also splits on ``",``.  Empty list / empty string -> [].
    """
    x = F.regexp_replace(F.regexp_replace(col(c), r"\[", ""), r"\]", "")
    x = F.regexp_replace(x, "',", "|")
    if not glue_quoted:
        x = F.regexp_replace(x, '",', "|")
        x = F.regexp_replace(x, '"', "")
    x = F.regexp_replace(x, "'", "")
    parts = F.transform(F.split(x, r"\|", -1), lambda p: trimws(p))
    # R strsplit drops a single trailing empty piece and maps "" to no pieces
    parts = F.when(F.get(parts, F.size(parts) - 1) == "", F.slice(parts, 1, F.size(parts) - 1)) \
             .otherwise(parts)
    return F.when(x == "", F.array().cast("array<string>")).otherwise(parts)


def explode_keywords(articles: DataFrame, id_col: str = "articleID",
                     list_col: str = "keywords") -> DataFrame:
    """U3 + P5: (articleID, keyword list text) -> (articleID, new) pairs; null and
    empty keywords removed."""
    return (articles.select(id_col, F.explode(parse_keyword_list(list_col)).alias("new"))
                    .filter(F.col("new").isNotNull() & (F.col("new") != "")))


def rank_keywords(pairs: DataFrame, id_col: str = "articleID", kw_col: str = "new",
                  prefix_chars: int = 2, n_partitions: int | None = None) -> DataFrame:
    """D-1: (articleID, new) pairs -> (articleID, new, N, keyword_rank, topic).

    N = number of articles carrying the keyword (A2, J1); keyword_rank = dense rank
    by (N desc, keyword asc) (W1); topic = T8 rule of the keyword.  With ``n_partitions`` the
    pairs are exchanged to so many tasks before the distinct ones are taken (nearly all are: a
    task that takes them before the exchange holds a whole scan split)."""
    some = pairs.select(id_col, kw_col).filter(F.col(kw_col).isNotNull())
    if n_partitions is not None:
        some = some.repartition(n_partitions, id_col, kw_col)
    distinct_pairs = materialize(some.distinct(), "kwpairs")
    freq = distinct_pairs.groupBy(kw_col).agg(F.count(F.lit(1)).alias("N"))
    ranked = bucketed_row_number(
        freq, [], [F.col("N").desc(), F.col(kw_col).asc()],
        [(-F.col("N")), F.substring(F.col(kw_col), 1, prefix_chars)], out="keyword_rank")
    ranked = ranked.withColumn("topic", topic_of(kw_col))
    # the ranked keyword table is small (one row per keyword); re-deriving the pair
    # table from the written distinct pairs for each per-article output is cheap
    return distinct_pairs.join(ranked, on=kw_col, how="inner") \
                         .select(id_col, kw_col, "N", "keyword_rank", "topic")


def keyword_ordinals(ranked: DataFrame, id_col: str = "articleID",
                     bucket_width: int = 4096, n_partitions: int | None = None) -> DataFrame:
    """ord2 = position of a keyword inside its article by (N desc, rank asc) ==
    rank asc.  Bucketed by rank so a huge article is numbered by many tasks."""
    return bucketed_row_number(ranked, [id_col], ["keyword_rank"],
                               [F.floor(F.col("keyword_rank") / bucket_width)], out="ord2", n_partitions=n_partitions)


def article_keyword_features(ranked: DataFrame, id_col: str = "articleID",
                             kw_col: str = "new", top: int = 3) -> DataFrame:
    """D-2 … D-5 per article: kw1..kwK, kwr1..kwrK (U4), topic = least topic label
    (A3), kwr = ΣN, minkwr = min rank (A4), specific = keyword of the best rank (D-5).

    Plan: every aggregate has a fixed-width buffer so Spark uses hash aggregation
    (string min/max/min_by would force a sort-based aggregate over all pairs):
    the topic label is aggregated as its order-preserving code among the fixed labels;
    the top-K keywords come from the ``rn <= K`` window (partial WindowGroupLimit) and
    are gathered with a list of at most K entries per article; the keyword of the best
    rank is kw1."""
    labels = topic_labels()
    code = F.lit(None).cast("int")
    for i, lab in enumerate(labels):
        code = F.when(F.col("topic") == lab, F.lit(i)).otherwise(code)
    decode = None
    for i, lab in enumerate(labels):
        decode = F.when(F.col("__tc") == i, F.lit(lab)) if decode is None else \
            decode.when(F.col("__tc") == i, F.lit(lab))
    per_article = ranked.groupBy(id_col).agg(
        F.min(code).alias("__tc"), F.sum("N").alias("kwr"), F.min("keyword_rank").alias("minkwr")) \
        .withColumn("topic", decode).drop("__tc")
    w = Window.partitionBy(id_col).orderBy("keyword_rank")
    top_rows = ranked.select(id_col, kw_col, "keyword_rank") \
                     .withColumn("__ord", F.row_number().over(w)) \
                     .filter(F.col("__ord") <= top)
    lists = top_rows.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("__ord", "keyword_rank", kw_col))).alias("__top"))
    pick = [F.get(F.col("__top"), i)[kw_col].alias(f"kw{i + 1}") for i in range(top)] + \
           [F.get(F.col("__top"), i)["keyword_rank"].alias(f"kwr{i + 1}") for i in range(top)]
    wide = lists.select(id_col, *pick).withColumn("specific", F.col("kw1"))
    return per_article.join(wide, on=id_col, how="inner")


def topic_labels() -> list[str]:
    """All topic labels (rules + default) in string order, for code/decode."""
    return sorted({lab for lab, _ in TOPIC_RULES} | {DEFAULT_TOPIC})
