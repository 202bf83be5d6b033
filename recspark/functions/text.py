"""Text measures computed inside the row.

Design: a text is one row; its sentences / clauses / tokens are arrays built with
``split`` and measured with higher-order functions (``transform`` / ``filter`` /
``aggregate``): readability costs no shuffle.  The sentiment operator (``operators.textops``)
explodes the same arrays.  The same definitions are written in DuckDB list functions for the
oracle (``plans/oracle_sql.py``).

Definitions (parameters in brackets):

* sentence  = piece of the text between runs of ``[.!?]``; kept if it has a token
* clause    = piece of a sentence between commas
* token     = lower-cased maximal run of letters (``\\p{L}``)
* syllables = vowel groups of a token, at least 1 (a documented deviation from the
  dictionary-based count of the original library)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import col, ladder

SENTENCE_RX = r"[.!?]+"
TOKEN_RX = r"[^\p{L}]+"
NONLETTER_RX = r"[^\p{L}]"
VOWEL_GROUP_RX = r"[aeiouyáàâäéèêëíìîïóòôöúùûüý]+"


def tokens(c: str | Column) -> Column:
    """Lower-cased letter runs of a string (empty pieces removed)."""
    return F.filter(F.split(F.lower(col(c)), TOKEN_RX, -1), lambda t: t != F.lit(""))


LETTER_RX = r"\p{L}"


def sentences(c: str | Column) -> Column:
    """Sentence pieces that contain at least one token (= at least one letter;
    one regex find instead of tokenizing the piece)."""
    return F.filter(F.split(col(c), SENTENCE_RX, -1), lambda s: s.rlike(LETTER_RX))


def clause_tokens(sentence: Column) -> Column:
    """array<array<string>>: token arrays of the comma clauses of one sentence."""
    return F.transform(F.split(sentence, ",", -1), lambda cl: tokens(cl))


def char_length(c: str | Column) -> Column:
    """Length in code points."""
    return F.length(col(c)).cast("long")


# ---------------------------------------------------------------- readability
def readability_counts(c: str | Column, toks: Column | None = None) -> Column:
    """struct(words, sentences, letters, syllables) of a text.  Pass ``toks`` (the
    column holding ``tokens(c)``) to tokenize only once."""
    toks = tokens(c) if toks is None else toks
    syl = F.aggregate(
        F.transform(toks, lambda t: F.greatest(F.lit(1), F.regexp_count(t, F.lit(VOWEL_GROUP_RX)))),
        F.lit(0).cast("long"), lambda a, b: a + b)
    return F.struct(
        F.size(toks).cast("long").alias("words"),
        F.size(sentences(c)).cast("long").alias("sentences"),
        F.length(F.regexp_replace(col(c), NONLETTER_RX, "")).cast("long").alias("letters"),
        syl.alias("syllables"),
    )


def flesch_kincaid(counts: Column) -> Column:
    """Flesch–Kincaid grade = 0.39·W/S + 11.8·Syl/W − 15.59 (null without words)."""
    w, s, syl = counts["words"].cast("double"), counts["sentences"].cast("double"), \
        counts["syllables"].cast("double")
    return F.when(counts["words"] > 0,
                  F.lit(0.39) * (w / s) + F.lit(11.8) * (syl / w) - F.lit(15.59))


def coleman_liau(counts: Column) -> Column:
    """Coleman–Liau grade = 5.88·L/W − 29.6·S/W − 15.8 (null without words)."""
    w, s, l_ = counts["words"].cast("double"), counts["sentences"].cast("double"), \
        counts["letters"].cast("double")
    return F.when(counts["words"] > 0,
                  F.lit(5.88) * (l_ / w) - F.lit(29.6) * (s / w) - F.lit(15.8))


# ---------------------------------------------------------------- sentiment (T4, T5)
SENTIMENT_CLASSES = ["Very Negative", "Negative", "Neutral", "Positive", "Very Positive"]


def sentiment_bucket(c: str | Column) -> Column:
    """T5: <=-.5 / (-.5,-.1] / (-.1,.1) / [.1,.5) / >=.5; null stays null."""
    x = col(c)
    return ladder([(x <= -0.5, SENTIMENT_CLASSES[0]),
                   ((x > -0.5) & (x <= -0.1), SENTIMENT_CLASSES[1]),
                   ((x > -0.1) & (x < 0.1), SENTIMENT_CLASSES[2]),
                   ((x >= 0.1) & (x < 0.5), SENTIMENT_CLASSES[3]),
                   (x >= 0.5, SENTIMENT_CLASSES[4])])
