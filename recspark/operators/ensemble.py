"""Prediction error and ensembles.

E2 scale note: the reference re-scans all predictions once per trial (10,000 passes).
Here one pass serves up to ``TRIALS_A_PASS`` trials: every task multiplies its prediction
blocks (m×7) with the weight matrix (7×T) in numpy, and emits one partial (trial, Σ|err|, n)
per trial; ``groupBy(trial).sum`` adds the partials.  No trial × row pairs are ever
materialised as Spark rows.  The scan's partitions are first drawn together to a few for each
core, so the partials number cores × trials whatever the data; more trials take more passes,
each with a matrix of bounded size.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.core import clamp0, rint0
from ..session import materialize
from ..sources.tables import spread
from .indexing import sample_hash

# ---- fixed values: model order and the two hand-set weight vectors of the reference --
MODELS = ["pred_nn2", "pred_ml2", "pred_rf2", "pred_gbm2", "pred_glm2", "pred_rf3", "pred_gbm3"]
WEIGHTS_A = [1, 1, 3, 2, 0, 1, 2]   # divided by 10
WEIGHTS_B = [1, 1, 7, 1, 0, 0, 3]   # divided by 13
CLAMPED = ["pred_ml2", "pred_glm2"]  # D23: only these two are clamped at 0 in the ensemble
# ---------------------------------------------------------------------------------------


def mae(df: DataFrame, pred: str, label: str, rounded: bool = True, divide_by_all: bool = True,
        alias: str = "mae") -> DataFrame:
    """Mean absolute error of (rounded) predictions.
    ``divide_by_all`` = Σ|err| (na.rm) / all rows (002/003); else the mean over
    non-null errors (005)."""
    p = rint0(pred) if rounded else F.col(pred)
    err = F.abs(p - F.col(label))
    agg = F.sum(err) / F.count(F.lit(1)) if divide_by_all else F.avg(err)
    return df.agg(agg.alias(alias))


def mae_by_model(df: DataFrame, models: Sequence[str], label: str) -> DataFrame:
    """A18 for several prediction columns in one pass (unpivot + partial aggregation)."""
    long = df.unpivot([label], list(models), "model", "pred")
    err = F.abs(rint0("pred") - F.col(label))
    return long.groupBy("model").agg((F.sum(err) / F.count(F.lit(1))).alias("mae"))


def mean_of_two(df: DataFrame, a: str, b: str, out: str = "pred_recs") -> DataFrame:
    """Both submissions are rounded and clamped first, then averaged and rounded."""
    ra, rb = clamp0(rint0(a)), clamp0(rint0(b))
    return df.withColumn(out, rint0((ra + rb) / 2))


def weighted(df: DataFrame, weights: Sequence[float], models: Sequence[str] = MODELS,
             clamp: Sequence[str] = CLAMPED, out: str = "final_pred") -> DataFrame:
    """round(Σ w_j·pred_j / Σ w_j), with the listed models clamped at 0 first."""
    if len(weights) != len(models) or sum(weights) <= 0:
        raise ValueError("need one weight per model and a positive sum")
    cols = {m: (clamp0(m) if m in clamp else F.col(m)) for m in models}
    num = None
    for w, m in zip(weights, models):
        term = F.lit(float(w)) * cols[m]
        num = term if num is None else num + term
    return df.withColumn(out, rint0(num / F.lit(float(sum(weights)))))


#: Trials whose weights are shipped with one pass over the predictions (7 weights: 7 MB).
TRIALS_A_PASS = 100_000


def weight_trials(spark: SparkSession, n_trials: int = 10_000, n_models: int = 7,
                  seed: int = 2018, max_weight: int = 10) -> DataFrame:
    """F19 + D21: trial weights ``round(U(0, max_weight))`` (half-even), one hash
    stream per (trial, model) so any engine can regenerate them; trials whose
    weights sum to 0 are rejected."""
    t = spark.range(1, n_trials + 1).withColumnRenamed("id", "trial")
    ws = []
    for j in range(1, n_models + 1):
        u = sample_hash(F.concat(F.col("trial").cast("string"), F.lit(f":{j}")), seed) / F.lit(float(2 ** 52))
        ws.append(rint0(F.lit(float(max_weight)) * u).alias(f"w{j}"))
    t = t.select("trial", *ws)
    tot = sum((F.col(f"w{j}") for j in range(2, n_models + 1)), F.col("w1"))
    return t.withColumn("tot", tot).filter(F.col("tot") > 0)


def search_weights(preds: DataFrame, weights: DataFrame, label: str,
                   models: Sequence[str] = MODELS, clamp: Sequence[str] = CLAMPED,
                   trial_chunk: int = 512, trials_a_pass: int = TRIALS_A_PASS) -> DataFrame:
    """MAE (mean over non-null errors) of the rounded weighted mean for every
    trial, of any number: about ``trials_a_pass`` of them are shipped with the tasks of one
    pass over the predictions; further passes write their sums to the shared folder."""
    x = spread(preds.select(*[(clamp0(m) if m in clamp else F.col(m)).cast("double").alias(m)
                              for m in models], F.col(label).cast("double").alias("__y")))
    spark = preds.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    x = x.coalesce(tasks)
    passes = -(-weights.count() // trials_a_pass)
    if passes <= 1:
        return weights.join(_errors(x, weights, models, trial_chunk), "trial")
    res = None
    for k in range(passes):
        mine = weights.where(F.pmod(F.xxhash64("trial"), F.lit(passes)) == k)
        errors = materialize(_errors(x, mine, models, trial_chunk), "trials")
        res = errors if res is None else res.union(errors)
    return weights.join(res, "trial")


#: Rows that meet a chunk of trials at once: with 512 trials 1 MB of errors, which a core's cache holds.
ROWS_A_BLOCK = 256
#: Predictions below this size give numbers for every trial (no sum of seven times ten overflows).
_PLAIN = 1e290


def add_errors(P: np.ndarray, y: np.ndarray, W: np.ndarray, tot: np.ndarray, chunk: int, sae: np.ndarray, cnt: np.ndarray) -> None:
    """Adds the absolute errors of some rows, and the number of those that are numbers, to every trial's."""
    if not len(P):
        return
    plain = bool(np.abs(P).max() < _PLAIN and np.abs(y).max() < _PLAIN)     # no null, NaN or infinity among them
    for s in range(0, len(W), chunk):
        e = slice(s, s + chunk)
        err = P @ W[e].T
        err /= tot[e]
        np.rint(err, out=err)
        err -= y[:, None]
        np.abs(err, out=err)
        if plain:
            cnt[e] += len(P)
        else:
            ok = ~np.isnan(err)
            cnt[e] += ok.sum(axis=0)
            err[~ok] = 0.0
        sae[e] += err.sum(axis=0)


def _errors(x: DataFrame, weights: DataFrame, models: Sequence[str], trial_chunk: int) -> DataFrame:
    """``(trial, mae)`` of the trials of one pass."""
    names = [f"w{j}" for j in range(1, len(models) + 1)]
    wpd = weights.select("trial", *names).toPandas()
    trials = wpd["trial"].to_numpy(dtype=np.int64)
    W = wpd[names].to_numpy(dtype=np.float64)  # T×7
    tot = W.sum(axis=1)
    schema = T.StructType([T.StructField("trial", T.LongType()), T.StructField("sae", T.DoubleType()),
                           T.StructField("n", T.LongType())])

    def block(batches):
        sae = np.zeros(len(trials))
        cnt = np.zeros(len(trials), dtype=np.int64)
        for b in batches:
            rows, ys = b[list(models)].to_numpy(dtype=np.float64), b["__y"].to_numpy(dtype=np.float64)
            for r in range(0, len(rows), ROWS_A_BLOCK):
                add_errors(rows[r:r + ROWS_A_BLOCK], ys[r:r + ROWS_A_BLOCK], W, tot, trial_chunk, sae, cnt)
        yield pd.DataFrame({"trial": trials, "sae": sae, "n": cnt})

    part = x.mapInPandas(block, schema)
    return part.groupBy("trial").agg((F.sum("sae") / F.sum("n")).alias("mae"))


def best_trials(results: DataFrame) -> DataFrame:
    """The trials whose MAE equals the minimum (ties kept)."""
    m = results.agg(F.min("mae").alias("__min"))
    return results.join(F.broadcast(m), F.col("mae") == F.col("__min")).drop("__min")


# ------------------------------------------------------------------ adapter predictions
def pseudo_predictions(events: DataFrame) -> DataFrame:
    """Seven integer-valued prediction columns as arithmetic functions of
    (event_id, value), label = round(value) (FIXTURES §3)."""
    v, k = F.col("value"), F.col("event_id")
    return events.select(
        k.alias("commentID"),
        rint0(v).alias("recommendations"),
        rint0(v * F.lit(0.9)).alias("pred_nn2"),
        (rint0(v) - 3 + F.pmod(k, F.lit(7))).cast("double").alias("pred_ml2"),
        rint0(v * F.lit(1.1)).alias("pred_rf2"),
        (rint0(v) + F.pmod(k, F.lit(3)) - 1).cast("double").alias("pred_gbm2"),
        (rint0(v / 2) - 5).alias("pred_glm2"),
        rint0(F.sqrt(v) * 5).alias("pred_rf3"),
        (rint0(v) + F.pmod(k * 7, F.lit(5)) - 2).cast("double").alias("pred_gbm3"),
    )
