"""Article and comment features and the final wide table (D-6 … D-13, J2-J10, X1-X3).

Plan shape at scale
* article keyword features: one aggregation per article (see ``keywords``)
* article table ⟕ keyword features: one join on articleID
* comment order: bucketed row number (hot articles are split by sequence bucket)
* comments ⟕ article features (D7: by articleID and type): the features travel with the
  bucket offsets, one row per (article, bucket), so the comments are exchanged and sorted
  once for their order and for this join.  It also carries ``pubDate_dt`` for time-to-post.
  The exchange moves the parts of a comment, not its id (a text of all of them), and a long
  table goes through it in passes, each written before the next: its disk is that of a pass.
* text features: row-local projections on the table that holds the text (spread over
  the cluster when the scan has too few partitions); only keys + scores are joined.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.core import ladder, r_bool
from ..functions.timefn import (epoch_seconds_ts, hour_of, parse_iso, time_of_day, time_to_post,
                                time_to_post_category, weekday_name, weekend_flag)
from ..session import ensure_checkpoint_dir, materialize, scratch, write_lean
from ..sources import adapters
from ..sources.tables import spread
from .indexing import KeptRows, bucket_offsets, bucketed_row_number, exact_split, passes_for, range_row_number, tasks_for
from .keywords import article_keyword_features, explode_keywords, rank_keywords
from .textops import add_length, add_readability, add_sentiment

# ---- fixed values: comment-position buckets -----------------------------------------
COMMENT_POSITION = ["Top 10", "11 to 50", "51 to 100", "101 to 200", ">200"]
# --------------------------------------------------------------------------------------

ARTICLE_FEATURES = ["type", "articleID", "byline", "kw1", "kw2", "kw3", "kwr1", "kwr2", "kwr3",
                    "timeofday", "wkdy", "dow", "topic", "specific", "kwr", "minkwr",
                    "snip_sent", "snip_cat", "pubDate_dt"]


#: Names of computed columns; input columns of these names are dropped.
ADDED = ["hr", "time_to_post", "time_to_post_cat", "com_sent", "com_cat", "comment_length", "readFR", "readCL"]


def time_features(df: DataFrame, ts_col: str = "pubDate_dt") -> DataFrame:
    """D-6 + D-7: hr, timeofday, dow, wkdy."""
    return (df.withColumn("hr", hour_of(ts_col))
              .withColumn("timeofday", time_of_day("hr"))
              .withColumn("dow", weekday_name(ts_col))
              .withColumn("wkdy", weekend_flag("dow")))


def comment_position(c: str = "com_ord") -> F.Column:
    x = F.col(c)
    return ladder([(x <= 10, COMMENT_POSITION[0]), ((x > 10) & (x <= 50), COMMENT_POSITION[1]),
                   ((x > 50) & (x <= 100), COMMENT_POSITION[2]),
                   ((x > 100) & (x <= 200), COMMENT_POSITION[3]), (x > 200, COMMENT_POSITION[4])])


def order_bucket(seq: str, width: int = 4096) -> F.Column:
    return F.floor(F.col(seq) / width)


def comment_order(com: DataFrame, group: str = "articleID", seq: str = "commentSequence",
                  tiebreak: str = "commentID", bucket_width: int = 4096,
                  strategy: str = "bucket", kept: KeptRows | None = None,
                  articles: DataFrame | None = None, n_partitions: int | None = None,
                  columns: Sequence[F.Column] | None = None, offsets: DataFrame | None = None,
                  share: tuple[int, int] = (0, 1)) -> DataFrame:
    """D-9: com_ord = row number by (sequence, id) inside the article + its bucket.
    ``strategy="bucket"`` splits hot articles by sequence bucket (one hash shuffle);
    ``"range"`` splits any hot article, even one whose sequence never changes (range
    shuffle + one write).  ``kept`` counts the comments that enter; ``articles`` (one row per
    article) joins its columns on the way (bucket strategy).  ``columns`` are those of a comment, if
    ``com`` holds the parts that they are computed from, ``share`` a part of the rows with their
    ``offsets`` (bucket strategy; see :func:`bucketed_row_number`)."""
    if strategy == "range":
        if kept is not None or articles is not None or columns is not None or offsets is not None or share != (0, 1):
            raise ValueError("the range strategy writes the comments on its way: count, join and compute them there")
        out = range_row_number(com, [group], [seq, tiebreak], out="com_ord")
    else:
        out = bucketed_row_number(com, [group], [seq, tiebreak],
                                  [order_bucket(seq, bucket_width)], out="com_ord",
                                  seen=kept and kept.before, groups=articles, n_partitions=n_partitions,
                                  columns=columns, offsets=offsets, share=share)
    return out.withColumn("com_pos_cat", comment_position("com_ord"))


def distinct_posters(com: DataFrame, group: str = "articleID", user: str = "userID") -> DataFrame:
    """D-8 / A6: distinct users per article (computed, not joined: D13)."""
    return com.groupBy(group).agg(F.count_distinct(user).alias("num_posts"))


def text_scores(texts: DataFrame, keys: list[str], text_col: str, sent_col: str, cat_col: str,
                readability: bool = False, sentiment_kwargs: dict | None = None) -> DataFrame:
    """T3-T7 on the table that holds the text; only keys + scores are joined back
    (J6, J8, J9 — the reference joins them on a row surrogate, here on the key).  The other measures
    are taken before the sentiment join, which then moves no text."""
    t = spread(texts)
    out = [*keys, sent_col, cat_col]
    if readability:
        t = add_length(add_readability(t, text_col), text_col)
        out += ["comment_length", "readFR", "readCL"]
    return add_sentiment(t, text_col, sent_col, cat_col, **(sentiment_kwargs or {})).select(*out)


def article_features(art: DataFrame, pairs: DataFrame, snippets: DataFrame,
                     sentiment_kwargs: dict | None = None, n_partitions: int | None = None) -> DataFrame:
    """Article table + time + keyword features + snippet sentiment."""
    kw = article_keyword_features(rank_keywords(pairs, n_partitions=n_partitions))
    snip = text_scores(snippets, ["articleID"], "snippet", "snip_sent", "snip_cat",
                       sentiment_kwargs=sentiment_kwargs)
    a = time_features(art)
    return a.join(snip, on="articleID", how="left").join(kw, on="articleID", how="left")


def comment_features(com: DataFrame, art_feat: DataFrame, bodies: DataFrame,
                     no_article_label: bool = False, sentiment_kwargs: dict | None = None,
                     body_keys: tuple[str, ...] = ("articleID", "commentSequence"),
                     kept: KeptRows | None = None, n_partitions: int | None = None,
                     columns: Sequence[F.Column] | None = None) -> DataFrame:
    """Comment features joined with the reduced article features (D-13).  ``kept`` counts the
    comments that enter and leave the joins (X3); ``columns`` as in :func:`comment_order`."""
    return comment_passes(com, art_feat, bodies, no_article_label, sentiment_kwargs, body_keys, kept, n_partitions, columns)[0]


def comment_passes(com: DataFrame, art_feat: DataFrame, bodies: DataFrame, no_article_label: bool = False,
                   sentiment_kwargs: dict | None = None, body_keys: tuple[str, ...] = ("articleID", "commentSequence"),
                   kept: KeptRows | None = None, n_partitions: int | None = None,
                   columns: Sequence[F.Column] | None = None, passes: int = 1) -> list[DataFrame]:
    """The comment features in ``passes`` parts of the comments: written one by one, each exchanges
    its own comments and article features only."""
    body = text_scores(bodies, list(body_keys), "commentBody", "com_sent", "com_cat",
                       readability=True, sentiment_kwargs=sentiment_kwargs)
    if passes > 1:                                           # scored once
        body = materialize(body, "bodies", lean=True)
    # an article's rows (one per type, usually one) as one: a comment takes those of its type
    red = art_feat.select("articleID", F.struct(*[c for c in ARTICLE_FEATURES if c != "articleID"]).alias("__a"))
    red = red.groupBy("articleID").agg(F.collect_list("__a").alias("__arts"))
    offsets = bucket_offsets(com, ["articleID"], [order_bucket("commentSequence")], red, n_partitions)
    if n_partitions is not None:
        n_partitions = max(int(com.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_partitions // passes))
    return [_comment_pass(com, offsets, body, no_article_label, body_keys, kept.part() if kept and passes > 1 else kept,
                          n_partitions, columns, (i, passes)) for i in range(passes)]


def _comment_pass(com: DataFrame, offsets: DataFrame, body: DataFrame, no_article_label: bool, body_keys: tuple[str, ...],
                  kept: KeptRows | None, n_partitions: int | None, columns: Sequence[F.Column] | None,
                  share: tuple[int, int]) -> DataFrame:
    c = comment_order(com, kept=kept, n_partitions=n_partitions, columns=columns, offsets=offsets, share=share)
    c = c.withColumn("__arts", F.filter("__arts", lambda a: a["type"] == F.col("type")))
    added = [a for a in ARTICLE_FEATURES if a not in ("articleID", "type")]
    c = c.select("*", F.explode_outer("__arts").alias("__a")).select(
        *[x for x in c.columns if x != "__arts"], *[F.col("__a")[a].alias(a) for a in added])
    c = c.join(body, on=list(body_keys), how="left")
    c = c.withColumn("time_to_post", time_to_post("approveDate_ts", "pubDate_dt"))
    c = c.withColumn("time_to_post_cat",
                     time_to_post_category("time_to_post", "pubDate_dt", no_article_label))
    return c if kept is None else kept.leave(c)


@dataclass
class FeatureTables:
    art: DataFrame
    passes: list[DataFrame]      # the comments in parts, to be written one by one

    @property
    def com_final(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.passes)


def build_features(spark: SparkSession, sf_dir: str, no_article_label: bool = False,
                   sentiment_kwargs: dict | None = None, kept: KeptRows | None = None) -> FeatureTables:
    com = adapters.comment_parts(spark, sf_dir)
    n = tasks_for(com)
    art = article_features(adapters.articles(spark, sf_dir), adapters.keyword_pairs(spark, sf_dir),
                           adapters.article_snippets(spark, sf_dir), sentiment_kwargs, n)
    return FeatureTables(art, comment_passes(com, art, adapters.comment_bodies(spark, sf_dir), no_article_label, sentiment_kwargs,
                                             kept=kept, n_partitions=n, columns=adapters.comment_columns(), passes=passes_for(com)))


def features_from_reference_inputs(art_raw: DataFrame, com_raw: DataFrame, no_article_label: bool = False,
                                   sentiment_kwargs: dict | None = None, kept: KeptRows | None = None) -> FeatureTables:
    """The same feature build from inputs in the reference's own shape (S1/S2 output):
    articles (articleID, keywords text, pubDate ISO text, snippet, byline, type) and
    comments (commentID, articleID, userID, commentSequence, approveDate epoch seconds,
    commentBody, editorsSelection text, recommendations, type).  Every other column of
    the inputs is kept, so that models may use it (``ml.prep.feature_columns`` excludes by
    name); an input column named like a computed one gives way to it.  D30: the
    editor-selection text is normalised for both sources."""
    computed = [c for c in ARTICLE_FEATURES if c not in ("type", "articleID", "byline", "pubDate_dt")]
    art = art_raw.drop(*computed, *ADDED).withColumn("pubDate_dt", parse_iso("pubDate")).drop("pubDate", "keywords", "snippet")
    pairs = explode_keywords(art_raw, "articleID", "keywords")
    snippets = art_raw.select("articleID", "snippet")
    com = (com_raw.withColumn("approveDate_ts", epoch_seconds_ts("approveDate"))
                  .withColumn("editorsSelection", r_bool("editorsSelection"))
                  .drop("commentBody", "byline", "pubDate_dt", "com_ord", "com_pos_cat", *computed, *ADDED))
    bodies = com_raw.select("commentID", "commentBody")
    art_feat = article_features(art, pairs, snippets, sentiment_kwargs)
    return FeatureTables(art_feat, [comment_features(com, art_feat, bodies, no_article_label, sentiment_kwargs,
                                                     body_keys=("commentID",), kept=kept)])


def train_split(com_final: DataFrame, fraction: float = 0.70, seed: int = 19790324,
                key: str = "commentID", materialize_input: bool = True) -> tuple[DataFrame, DataFrame]:
    """P3 + X1 + X2: training comments split exactly into (trn, tst) by a seeded hash."""
    trn_all = com_final.filter(F.col("type") == "trn")
    flagged = exact_split(trn_all, key, fraction, seed, flag="__s", materialize_input=materialize_input)
    return (flagged.filter(F.col("__s")).drop("__s"),
            flagged.filter(~F.col("__s")).drop("__s"))


_WRITTEN: dict[tuple[str, str, str], str] = {}
_TRAINING: dict[tuple[str, str], DataFrame] = {}


def written_table(spark: SparkSession, sf_dir: str, name: str, build, check=None) -> DataFrame:
    """Build a derived table once per application and source folder, write it to the
    checkpoint folder and read it back afterwards (the reference saves its feature
    tables the same way and every later step reads them).  ``check`` is called with the
    written table before anything reads it.  ``build`` gives the table or a list of its parts, which
    are written one by one; its own intermediates are removed."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/recspark-{name}-{uuid.uuid4().hex}"
        with scratch():
            parts = build()
            for i, df in enumerate(parts if isinstance(parts, list) else [parts]):
                write_lean(df, path, "append" if i else "overwrite")
        if check is not None:
            check(spark.read.parquet(path))
        _WRITTEN[key] = path
    return spark.read.parquet(_WRITTEN[key])


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``com_final`` of the driver tables, written once (S3/S4); raises if a join has lost or
    repeated a comment (X3)."""
    kept = KeptRows()
    return written_table(spark, sf_dir, "com_final", lambda: build_features(spark, sf_dir, kept=kept).passes,
                         lambda written: kept.check(adapters.comments(spark, sf_dir), written))


def training_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exploration input: the 70 % training split with a matched article (P1).  Rows of the feature
    table are told by the cut of their hash, found once per application and source folder: no second copy."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINING:
        _TRAINING[key], _ = train_split(feature_table(spark, sf_dir), materialize_input=False)
    return _TRAINING[key].filter(F.col("pubDate_dt").isNotNull())
