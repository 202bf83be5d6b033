"""Text operators on DataFrames (T1 lives in ``text_to_columns``):
sentiment + bucket (T3-T5, A5), readability (T6), comment length (T7).

Readability and length are row-local projections (``functions/text.py``).  Sentiment is a join:
every token of a text (its row, sentence, clause and position) meets a lexicon *table* of polar
words and valence shifters, broadcast where its size allows; only the tokens found there are
shuffled, by row.  Shifters act through a window of token positions inside the clause.  The lexicon
may have any number of entries, and nothing of it is in the plan or on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.core import rint0
from ..functions.text import char_length, coleman_liau, flesch_kincaid, readability_counts, sentences, sentiment_bucket, tokens
from ..session import materialize

# ---- fixed values: a small TEST lexicon drawn from frequent words of the driver's
# documents (the reference's lexicon belongs to a third-party package and is not
# reproduced; callers pass their own).  Invented polarities. --------------------------
TEST_LEXICON: dict[str, float] = {
    "with": 1.0, "for": 0.5, "this": 0.75, "that": -0.5, "from": -0.75, "was": -1.0,
    "on": 0.25, "avec": 1.0, "pour": 0.5, "sur": -0.5, "mit": 1.0, "für": 0.5,
    "auf": -0.5, "con": 1.0, "para": 0.5, "por": -0.5,
}
TEST_NEGATORS = ["not", "no", "never", "pas", "ne", "nicht", "kein", "nunca"]
TEST_AMPLIFIERS = ["is", "est", "ist", "es", "very"]
TEST_DEAMPLIFIERS = ["it", "un", "ein", "una", "barely"]
# -------------------------------------------------------------------------------------


#: Roles of a lexicon's words; a word may have several.
ROLES = ("polar", "negator", "amplifier", "deamplifier")


def lexicon_table(entries: DataFrame) -> DataFrame:
    """One row a word: ``token, polarity, neg, amp, deamp``.

    ``entries`` holds ``word``, ``polarity`` and, optionally, ``role`` (of ROLES; null or absent:
    polar).  Words are lower-cased; the polarities of a repeated word are added up."""
    role = F.coalesce(F.lower("role"), F.lit(ROLES[0])) if "role" in entries.columns else F.lit(ROLES[0])
    x = entries.select(F.lower(F.trim("word")).alias("token"), F.col("polarity").cast("double").alias("p"), role.alias("role"))
    is_ = lambda r: F.max(F.when(F.col("role") == r, 1).otherwise(0))
    return x.where(F.col("token").isNotNull()).groupBy("token").agg(
        F.coalesce(F.sum(F.when(F.col("role") == ROLES[0], F.col("p"))), F.lit(0.0)).alias("polarity"),
        is_(ROLES[1]).alias("neg"), is_(ROLES[2]).alias("amp"), is_(ROLES[3]).alias("deamp"))


def lexicon_of(spark: SparkSession, lexicon: Mapping[str, float] = TEST_LEXICON, negators: Sequence[str] = TEST_NEGATORS,
               amplifiers: Sequence[str] = TEST_AMPLIFIERS, deamplifiers: Sequence[str] = TEST_DEAMPLIFIERS) -> DataFrame:
    """A lexicon table from lists in the program, written: rows from the driver have no size that Spark knows, and
    the join would exchange all tokens of all texts before it finds the table small."""
    rows = [(w, float(v), ROLES[0]) for w, v in lexicon.items()]
    rows += [(w, 0.0, r) for r, ws in zip(ROLES[1:], (negators, amplifiers, deamplifiers)) for w in ws]
    return materialize(lexicon_table(spark.createDataFrame(rows, "word string, polarity double, role string")), "lexicon")


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A lexicon from a Parquet table or a CSV file with a header (``word, polarity[, role]``)."""
    raw = spark.read.option("header", True).csv(path) if path.lower().endswith((".csv", ".csv.gz")) else spark.read.parquet(path)
    return materialize(lexicon_table(raw), "lexicon")


def sentiment_scores(texts: DataFrame, row: str, text_col: str, lexicon: DataFrame, before: int = 5, after: int = 2,
                     amp_weight: float = 0.8) -> DataFrame:
    """T4 + A5: ``row, score`` of every text with a token of the lexicon; ``row`` is unique and stable.

    The score is the sum over sentences of (sum over polar tokens of
    ``polarity * (-1)^neg * max(0, 1 + amp_weight * (amp * (-1)^neg - deamp))``) / sqrt(words), the
    shifters counted in the token window [i - before, i + after] of the same comma clause without the
    token itself.  Sums are taken in the order of the text."""
    said = texts.select(row, F.posexplode(sentences(text_col)).alias("s", "sentence"))
    said = said.select(row, "s", F.transform(F.split("sentence", ",", -1), tokens).alias("clauses"))
    said = said.withColumn("words", F.aggregate("clauses", F.lit(0), lambda a, c: a + F.size(c)))
    said = said.select(row, "s", "words", F.posexplode("clauses").alias("c", "clause"))
    said = said.select(row, "s", "words", "c", F.posexplode("clause").alias("i", "token"))
    hits = said.join(lexicon, "token").repartition(row)
    near = Window.partitionBy(row, "s", "c").orderBy("i").rangeBetween(-before, after)
    others = {x: F.sum(x).over(near) - F.col(x) for x in ("neg", "amp", "deamp")}
    sign = F.when(F.pmod(F.col("neg"), F.lit(2)) == 1, F.lit(-1.0)).otherwise(F.lit(1.0))
    part = F.col("polarity") * sign * F.greatest(F.lit(0.0), F.lit(1.0) + F.lit(amp_weight) * (F.col("amp") * sign - F.col("deamp")))
    parts = hits.withColumns(others).where(F.col("polarity") != 0).select(row, F.struct("s", "c", "i", "words", part.alias("x")).alias("t"))
    sums = parts.groupBy(row).agg(F.array_sort(F.collect_list("t")).alias("ts"))   # polar tokens of one text
    start = F.struct(F.lit(-1).alias("s"), F.lit(-1).alias("c"), F.lit(1).alias("words"), F.lit(0.0).alias("clause"),
                     F.lit(0.0).alias("sentence"), F.lit(0.0).alias("text"))

    def done(a):
        return (a["sentence"] + a["clause"]) / F.sqrt(a["words"].cast("double"))

    def step(a, t):
        same = a["s"] == t["s"]
        goes_on = same & (a["c"] == t["c"])
        return F.struct(t["s"].alias("s"), t["c"].alias("c"), t["words"].alias("words"),
                        F.when(goes_on, a["clause"] + t["x"]).otherwise(t["x"]).alias("clause"),
                        F.when(goes_on, a["sentence"]).when(same, a["sentence"] + a["clause"]).otherwise(0.0).alias("sentence"),
                        F.when(same, a["text"]).otherwise(a["text"] + done(a)).alias("text"))

    return sums.select(row, F.aggregate("ts", start, step, lambda a: a["text"] + done(a)).alias("score"))


def add_sentiment(df: DataFrame, text_col: str, score_col: str, cat_col: str, lexicon: DataFrame | Mapping[str, float] = TEST_LEXICON,
                  negators: Sequence[str] = TEST_NEGATORS, amplifiers: Sequence[str] = TEST_AMPLIFIERS,
                  deamplifiers: Sequence[str] = TEST_DEAMPLIFIERS, before: int = 5, after: int = 2, amp_weight: float = 0.8,
                  digits: int | None = None) -> DataFrame:
    """T4/T5: text score and its 5-class bucket.  ``lexicon`` is a table (:func:`lexicon_table`) or a
    mapping with the three lists of shifters.  A null text has a null score, one without a word of
    the lexicon 0 (``sum(na.rm=TRUE)`` of nothing).  The rows are written once (their numbers must not
    change between the two readings).  The bucket is taken from the unrounded score; ``digits``
    optionally rounds (half-even) the reported score."""
    if not isinstance(lexicon, DataFrame):
        if not lexicon:
            raise ValueError("lexicon must not be empty")
        lexicon = lexicon_of(df.sparkSession, lexicon, negators, amplifiers, deamplifiers)
    rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "texts")
    scores = sentiment_scores(rows, "__row", text_col, lexicon, before, after, amp_weight).withColumnRenamed("score", "__score")
    # whether there is a text is told before the join, which need not move it then
    out = rows.withColumn("__said", F.col(text_col).isNotNull()).join(scores, "__row", "left").drop("__row")
    out = out.withColumn(score_col, F.when(F.col("__said"), F.coalesce("__score", F.lit(0.0)))).drop("__score", "__said")
    out = out.withColumn(cat_col, sentiment_bucket(score_col))
    if digits is not None:
        out = out.withColumn(score_col, F.bround(F.col(score_col), digits) + F.lit(0.0))
    return out


def add_readability(df: DataFrame, text_col: str, fk_col: str = "readFR",
                    cl_col: str = "readCL") -> DataFrame:
    """Flesch–Kincaid and Coleman–Liau grades, rounded half-even (D12: the
    reference stores Flesch–Kincaid under the name ``readFR``; kept)."""
    return (df.withColumn("__toks", tokens(text_col))
              .withColumn("__rc", readability_counts(text_col, F.col("__toks")))
              .withColumn(fk_col, rint0(flesch_kincaid(F.col("__rc"))))
              .withColumn(cl_col, rint0(coleman_liau(F.col("__rc"))))
              .drop("__rc", "__toks"))


def add_length(df: DataFrame, text_col: str, out: str = "comment_length") -> DataFrame:
    return df.withColumn(out, char_length(text_col))
