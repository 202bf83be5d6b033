"""Registered queries of the training-data operators: name -> (Spark query, DuckDB SQL or None)."""

from __future__ import annotations

import importlib.util
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (fingerprints, language, lines, mixing, near_dup, packing, quality, runs, sharding, spelling, suffix_dedup, token_counts,
               vectors)


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's vocabulary file: the folder in PUBLIC_TOKENIZERS, else the
    installed package of that name, else /opt/tokenizers."""
    base = os.environ.get("PUBLIC_TOKENIZERS")
    if base:
        return os.path.join(base, name)
    if importlib.util.find_spec("public_tokenizers"):
        import public_tokenizers
        return public_tokenizers.path(name)
    return os.path.join("/opt/tokenizers", name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language.predict(docs, language.learn(docs))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.drop_boilerplate(_table(spark, sf_dir, "documents"), F.col("source"))
    return out.select("doc_id", "source", F.col("_line_total").alias("n_lines"), F.col("_line_dropped").alias("n_dropped"),
                      F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digest(_table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))
    return out.select("doc_id", "source", "lang", F.col("_q_evidence").alias("evidence"), F.col("_q_prior").alias("prior"),
                      F.col("_q_quality").alias("quality"), (F.col("_q_quality") >= quality.CUT).alias("kept"))


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(_table(spark, sf_dir, "documents")).withColumn("kept", F.col("doc_id") == F.col("class_id"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.digest(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(_table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_mixing, op2_packing, op3_suffix_dedup, op4_language_id, op5_line_dedup, op6_fingerprints,
                                   op7_quality, op8_near_dup, op9_token_counts, op10_near_vectors, op11_sharding, op12_spelling, op13_runs)}
SQL = {"op1_mixing": mixing.OP1_SQL, "op5_line_dedup": lines.OP5_SQL, "op12_spelling": spelling.OP12_SQL}


def with_pipeline() -> dict:
    """All queries of this package, the corpus pipeline among them."""
    import corpus_pipeline
    return {**QUERIES, "pipeline": corpus_pipeline.run}
