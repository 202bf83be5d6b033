"""Corpus pipeline: quality classifier, line dedup, near-duplicate removal, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept;
its result is written as Parquet to the shared folder and read again as the next stage's
``docs``.  All stages but the last return the columns of ``documents``; the last returns the
packed pieces.

Rows the stages cannot judge stay: a null text or source has a defined result in every
operator (see there).  After line dedup ``n_chars`` is that of the text that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm import lines, mixing, near_dup, packing, quality
from recspark.llm.queries import vocabulary
from recspark.session import materialize

#: No stage's rows can be told in SQL: the first is a fitted model.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.reject(docs, labels, F.col("source"), F.col("lang"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = lines.drop_boilerplate(docs, F.col("source"))
    if "n_chars" in docs.columns:
        left = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("_line_dropped") > 0, left).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality", keep_quality), ("lines", drop_lines), ("near_duplicates", drop_near_duplicates), ("mix", mix_sources), ("pack", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
