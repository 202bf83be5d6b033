"""Model persistence and the model registry.

Spark ML models use their own writers; the Poisson boosting and MLP models are saved
as their Spark ML trees plus a one-row JSON table of their numbers — all through
Spark's file system layer, so paths can be any shared store.  The registry is a
Parquet table (model_name, algo, path, params, cv_mae).
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml.regression import (DecisionTreeRegressionModel, LinearRegressionModel,
                                   RandomForestRegressionModel)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.core import clamp0, rint0
from .learners import PRED, AtBudget, PoissonGBTModel, PoissonMLPModel, StackModel
from .linear import LinearModel

_SPARK_MODELS = {"LinearRegressionModel": LinearRegressionModel,
                 "RandomForestRegressionModel": RandomForestRegressionModel}


def save_model(spark: SparkSession, model, path: str) -> str:
    kind = type(model).__name__
    if kind in _SPARK_MODELS:
        model.write().overwrite().save(f"{path}/model")
        meta = {"kind": kind}
    elif isinstance(model, PoissonGBTModel):
        for i, (tm, _, _, _) in enumerate(model.trees):
            tm.write().overwrite().save(f"{path}/tree_{i}")
        meta = {"kind": "PoissonGBTModel", "f0": model.f0,
                "trees": [{"idx": idx, "leaves": [[k, v] for k, v in leaves.items()], "lr": lr}
                          for _, idx, leaves, lr in model.trees]}
    elif isinstance(model, PoissonMLPModel):
        meta = {"kind": "PoissonMLPModel", "activation": model.activation,
                "mean": model.mean.tolist(), "std": model.std.tolist(), "width": model.width,
                "weights": [w.tolist() for w in model.weights]}
    elif isinstance(model, StackModel):
        for i, m in enumerate(model.models.values()):
            save_model(spark, m, f"{path}/base_{i}")
        meta = {"kind": kind, "names": list(model.models), "coef": model.coef}
    elif isinstance(model, AtBudget):
        save_model(spark, model.model, f"{path}/inner")
        meta = {"kind": kind, "nbins_cats": model.nbins_cats}
    elif isinstance(model, LinearModel):
        meta = {"kind": "LinearModel", "coef": model.coef.tolist(), "n_numbers": model.n_numbers, "width": model.width,
                "alpha": model.alpha, "lambda": model.lam}
    else:
        raise TypeError(f"cannot save {kind}")
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
         .write.mode("overwrite").json(f"{path}/meta")
    return path


def load_model(spark: SparkSession, path: str):
    meta = json.loads(spark.read.json(f"{path}/meta").collect()[0]["meta"])
    kind = meta["kind"]
    if kind in _SPARK_MODELS:
        return _SPARK_MODELS[kind].load(f"{path}/model")
    if kind == "PoissonGBTModel":
        m = PoissonGBTModel(meta["f0"])
        for i, t in enumerate(meta["trees"]):
            tm = DecisionTreeRegressionModel.load(f"{path}/tree_{i}")
            m.trees.append((tm, t["idx"], {float(k): float(v) for k, v in t["leaves"]}, t["lr"]))
        return m
    if kind == "PoissonMLPModel":
        return PoissonMLPModel([np.array(w) for w in meta["weights"]], np.array(meta["mean"]),
                               np.array(meta["std"]), meta["activation"], meta.get("width", 0))
    if kind == "StackModel":
        return StackModel({n: load_model(spark, f"{path}/base_{i}") for i, n in enumerate(meta["names"])}, meta["coef"])
    if kind == "AtBudget":
        return AtBudget(load_model(spark, f"{path}/inner"), meta["nbins_cats"])
    if kind == "LinearModel":
        return LinearModel(np.array(meta["coef"]), meta["n_numbers"], meta["width"], meta["alpha"], meta["lambda"])
    raise TypeError(kind)


def write_registry(spark: SparkSession, rows: list[tuple[str, str, str, dict, float]], path: str) -> DataFrame:
    """(model_name, algo, path, params, cv_mae) as a Parquet table."""
    df = spark.createDataFrame([(n, a, p, json.dumps(prm, sort_keys=True, default=str), float(m))
                                for n, a, p, prm, m in rows],
                               "model_name string, algo string, path string, params string, cv_mae double")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def chain(df: DataFrame, models: dict[str, object]) -> DataFrame:
    """Predictions of all models as columns of the same rows: one narrow pass, no join."""
    for name, m in models.items():
        df = m.transform(df).withColumnRenamed(PRED, name)
    return df


def score_with(spark: SparkSession, df: DataFrame, registry: DataFrame, names: list[str]) -> DataFrame:
    """S7 + S8: load the named models through the registry table and score ``df``."""
    paths = {r.model_name: r.path for r in registry.filter(F.col("model_name").isin(*names)).collect()}
    if missing := [n for n in names if n not in paths]:
        raise KeyError(f"not in the registry: {missing}")
    return chain(df, {n: load_model(spark, paths[n]) for n in names})


def submission(pred: DataFrame, id_col: str = "commentID", clamp: bool = True) -> DataFrame:
    """Id + round(prediction), clamped at 0; the id stays integral/text."""
    p = rint0(PRED)
    return pred.select(F.col(id_col), (clamp0(p) if clamp else p).alias("pred_recs"))
