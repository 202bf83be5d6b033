"""Local explanation of single predictions (L1-L4, A21), LIME-style.

L1 explainer: per numeric feature the quartile bin edges (``approxQuantile``, one
   pass) and per categorical feature the frequencies of ALL levels, a table of cumulative
   count intervals that stays distributed.
L2 explain: for each case, ``n_permutations`` perturbed rows are generated inside
   the case row (``explode(sequence)`` — bounded by the parameter, no join): every
   feature draws a bin (numeric, then a uniform value inside it) or a level
   (categorical) by its training frequency — a hashed training-row number, joined to the
   level whose interval holds it by equality on interval blocks; row 0 is the case itself.  The model
   scores all rows in one ``transform``.  Each row is then coded 1/0 per feature
   ("same bin/level as the case"), weighted by the kernel
   sqrt(exp(−d²/width²)) with d = share of differing features, and ONE weighted ridge
   regression per case runs in ``groupBy(case).applyInPandas`` (many cases in
   parallel; a group has exactly n_permutations rows).  The ``n_features`` largest
   |coefficients| are kept and refitted.
L3 roll-up: intercept + Σ weights vs the model prediction per case (A21).
The number of permutations, bins and the ridge penalty are library defaults in the
reference (not stated there): parameters here.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize


@dataclass
class Explainer:
    numeric: dict[str, list[float]]          # bin edges incl. min and max
    categorical: dict[str, Levels]


@dataclass
class Levels:
    table: DataFrame    # (block, lo, hi, level): the level takes the training rows lo <= k < hi
    rows: int           # training rows
    step: int           # rows of a block; block = floor(k / step)


def level_intervals(train: DataFrame, c: str, groups: int = 1024) -> Levels:
    """All levels of ``c`` (null too) with their cumulative counts.

    The running sum is taken inside hashed groups of levels and over the groups' totals (one
    row a group, ``groups`` at most), so no task sees all levels.  Every interval is repeated
    for the blocks it reaches; with as many blocks as levels the table has at most two rows
    a level."""
    group = F.pmod(F.xxhash64("level"), F.lit(groups))
    counts = train.groupBy(F.col(c).cast("string").alias("level")).agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts.withColumn("g", group), "levels")
    size = counts.agg(F.count(F.lit(1)).alias("levels"), F.sum("n").alias("rows")).first()
    rows = int(size["rows"] or 0)
    step = max(1, -(-rows // max(1, size["levels"])))
    offsets = counts.groupBy("g").agg(F.sum("n").alias("m")).select(
        "g", F.coalesce(F.sum("m").over(Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("g").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    table = counts.withColumn("in", inside).join(offsets, "g").withColumn("lo", F.col("off") + F.col("in"))
    table = table.withColumn("hi", F.col("lo") + F.col("n")).withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("lo") / step), F.floor((F.col("hi") - 1) / step))))
    return Levels(materialize(table.select("block", "lo", "hi", "level"), "levels"), rows, step)


def build_explainer(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                    n_bins: int = 4, rel_error: float = 1e-3) -> Explainer:
    """L1."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    edges = train.approxQuantile(list(numeric), probs, rel_error) if numeric else []
    num = {c: sorted(set(e)) if len(set(e)) > 1 else [e[0], e[0] + 1.0] for c, e in zip(numeric, edges)}
    return Explainer(num, {c: level_intervals(train, c) for c in categorical})


def _bin_of(c: str, edges: list[float]) -> F.Column:
    """Index of the bin of value ``c`` (edges[i] < x ≤ edges[i+1]; first bin closed)."""
    inner = edges[1:-1]
    return F.size(F.filter(F.array(*[F.lit(float(e)) for e in inner]), lambda e: e < F.col(c))) \
        if inner else F.lit(0)


def perturb(cases: DataFrame, ex: Explainer, case_col: str, n_permutations: int = 5000,
            seed: int = 7) -> DataFrame:
    """Rows (case_col, perm, features...) with perm 0 = the case itself."""
    x = cases.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_permutations - 1))).alias("perm"))
    for i, (c, edges) in enumerate(ex.numeric.items()):
        nb = len(edges) - 1
        b = F.floor(F.rand(seed + 31 * i) * nb).cast("int")  # equal-frequency (quantile) bins
        lo = F.element_at(F.array(*[F.lit(float(e)) for e in edges[:-1]]), b + 1)
        hi = F.element_at(F.array(*[F.lit(float(e)) for e in edges[1:]]), b + 1)
        val = lo + (hi - lo) * F.rand(seed + 31 * i + 1)
        x = x.withColumn(c, F.when(F.col("perm") == 0, F.col(c).cast("double")).otherwise(val))
    for i, (c, levels) in enumerate(ex.categorical.items()):
        if not levels.rows:
            x = x.withColumn(c, F.when(F.col("perm") == 0, F.col(c).cast("string")))
            continue
        # drawn by hashing, so that a task that runs again draws the same
        k = F.pmod(F.xxhash64(F.lit(seed + 7919 + 31 * i), F.col(case_col), F.col("perm")), F.lit(levels.rows))
        x = x.withColumn("__k", k).withColumn("__block", F.floor(F.col("__k") / levels.step))
        t = levels.table.select(*[F.col(n).alias(f"__t_{n}") for n in levels.table.columns])
        x = x.join(t, (F.col("__block") == F.col("__t_block")) & (F.col("__k") >= F.col("__t_lo")) & (F.col("__k") < F.col("__t_hi")))
        x = x.withColumn(c, F.when(F.col("perm") == 0, F.col(c).cast("string")).otherwise(F.col("__t_level"))).drop(
            "__k", "__block", *t.columns)
    return x


def explain(cases: DataFrame, ex: Explainer, score: callable, case_col: str, n_features: int = 20,
            kernel_width: float = 0.5, n_permutations: int = 5000, ridge: float = 1e-3,
            seed: int = 7) -> DataFrame:
    """L2: one row per (case, selected feature) with feature_weight, model_intercept,
    model_prediction (local model at the case), prediction (black-box model), r2.
    ``score(df) -> df`` must add a ``prediction`` column."""
    feats = [*ex.numeric, *ex.categorical]
    pert = perturb(cases, ex, case_col, n_permutations, seed)
    scored = score(pert)
    # bin index (numeric) or level (categorical) of every row; the case is perm 0 of
    # its own group, so the same/different coding happens inside the group
    coded = scored.select(case_col, "perm", "prediction",
                          *[_bin_of(c, e).cast("string").alias(f"__s_{c}") for c, e in ex.numeric.items()],
                          *[F.col(c).cast("string").alias(f"__s_{c}") for c in ex.categorical])
    schema = T.StructType([T.StructField(case_col, cases.schema[case_col].dataType),
                           T.StructField("feature", T.StringType()),
                           T.StructField("feature_weight", T.DoubleType()),
                           T.StructField("model_intercept", T.DoubleType()),
                           T.StructField("model_prediction", T.DoubleType()),
                           T.StructField("prediction", T.DoubleType()),
                           T.StructField("model_r2", T.DoubleType())])
    k = min(n_features, len(feats))

    def fit_case(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("perm")
        codes = pdf[[f"__s_{c}" for c in feats]].astype(object)
        X = (codes == codes.iloc[0]).to_numpy(dtype=float)
        y = pdf["prediction"].to_numpy(dtype=float)
        d = 1.0 - X.mean(axis=1)                       # share of features differing from the case
        w = np.sqrt(np.exp(-(d ** 2) / kernel_width ** 2))

        def wridge(cols):
            Xs = np.column_stack([np.ones(len(y)), X[:, cols]])
            W = w[:, None]
            A = Xs.T @ (Xs * W) + ridge * np.diag([0.0] + [1.0] * len(cols))
            beta = np.linalg.solve(A, Xs.T @ (w * y))
            fitted = Xs @ beta
            ybar = np.average(y, weights=w)
            ss_tot = np.sum(w * (y - ybar) ** 2)
            r2 = 1 - np.sum(w * (y - fitted) ** 2) / ss_tot if ss_tot > 0 else 0.0
            return beta, r2

        beta_all, _ = wridge(list(range(len(feats))))
        sel = sorted(np.argsort(-np.abs(beta_all[1:]))[:k].tolist())
        beta, r2 = wridge(sel)
        case_x = np.concatenate([[1.0], X[0, sel]])
        return pd.DataFrame({case_col: pdf[case_col].iloc[0], "feature": [feats[i] for i in sel],
                             "feature_weight": beta[1:], "model_intercept": beta[0],
                             "model_prediction": float(case_x @ beta), "prediction": float(y[0]),
                             "model_r2": r2})

    return coded.groupBy(case_col).applyInPandas(fit_case, schema)


def rollup(expl: DataFrame, case_col: str) -> DataFrame:
    """Per case max(intercept), Σ feature weights, max(prediction)."""
    return expl.groupBy(case_col).agg(F.max("model_intercept").alias("intercept"),
                                      F.sum("feature_weight").alias("sum_weights"),
                                      F.max("model_prediction").alias("model_prediction"),
                                      F.max("prediction").alias("prediction"))
