"""Registered model queries (rows-only: iterative / randomised learners have no SQL
oracle).  Input: ``events`` as a learning table (label = round(value)), split exactly
70/30 into train / holdout by key; events with ``event_id % 10 >= 7`` play the
submission set.  Budgets are small so that the queries finish quickly (not those of
AutoML: its candidates are the operator's own); the full grids of the reference are the
constants in ``recspark.ml.search``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.core import clamp0, rint0
from ..ml import explain as X
from ..ml import learners as L
from ..ml import registry as RG
from ..ml import search as S
from ..ml import linear
from ..ml.prep import PREPARED, feature_columns, fit_prep, max_bins_for
from ..operators import ensemble as E
from ..operators.indexing import exact_split
from ..session import ensure_checkpoint_dir
from ..sources import adapters
from ..sources.tables import write_scored
from .registry import register

KEY = "commentID"
RF_QUERY_GRID = {"ntrees": [10, 20], "max_depth": [5, 8], "min_rows": [5, 10], "sample_rate": [.975, 1],
                 "nbins": [10, 20], "mtries": [-1, 2]}


_PREPARED: dict = {}


def _data(spark, sf):
    """(prep, train, holdout, submission) — prepared once per session and source
    folder and written to the checkpoint folder (every learner reads them many times)."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _PREPARED:
        _PREPARED[key] = _prepare(spark, sf)
    prep, paths = _PREPARED[key]
    return (prep, *[spark.read.parquet(p) for p in paths])


def _prepare(spark, sf):
    lf = adapters.learning_frame(spark, sf)
    labelled = lf.filter(F.pmod(F.col(KEY), F.lit(10)) < 7)
    sub = lf.filter(F.pmod(F.col(KEY), F.lit(10)) >= 7).drop("recommendations")
    s = exact_split(labelled, KEY, 0.70, 19790324, flag="__s")
    feats = feature_columns(lf)
    prep = fit_prep(s.filter("__s"), feats)
    cols = [KEY, "recommendations", *PREPARED]
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/recspark-ml-{uuid.uuid4().hex}"
    parts = {"trn": prep.transform(s.filter("__s")).select(*cols),
             "tst": prep.transform(s.filter(~F.col("__s"))).select(*cols),
             "sub": prep.transform(sub).select(KEY, *PREPARED)}
    for name, df in parts.items():
        df.write.mode("overwrite").parquet(f"{base}/{name}")
    return prep, [f"{base}/{n}" for n in parts]


def _nf(prep):
    return len(prep.feature_names())


@register("ml_glm_search", None, "M2 M9 M11 M12 O5 X4")
def q_ml_glm_search(spark, sf):
    """All 11 alphas of the grid, each with its whole path of 100 lambdas."""
    _, trn, _, _ = _data(spark, sf)
    return S.glm_search(spark, S.with_folds(trn, KEY), KEY)[0]


_LS_SQL = """
WITH e AS (
  SELECT round_even(value, 0) AS y, CAST(hour(CAST(ts AS TIMESTAMP)) AS DOUBLE) AS hr,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, CAST(dayofweek(CAST(ts AS TIMESTAMP)) + 1 AS DOUBLE) AS dow_num
  FROM events WHERE event_id % 10 < 7
), f AS (SELECT y, hr - avg(hr) OVER () AS a, coalesce(k - avg(k) OVER (), 0) AS b, dow_num - avg(dow_num) OVER () AS c FROM e WHERE y IS NOT NULL),
m AS (SELECT sum(a*a) AS aa, sum(a*b) AS ab, sum(a*c) AS ac, sum(b*b) AS bb, sum(b*c) AS bc, sum(c*c) AS cc,
             sum(a*y) AS ay, sum(b*y) AS by_, sum(c*y) AS cy FROM f),
d AS (SELECT *, aa*(bb*cc - bc*bc) - ab*(ab*cc - bc*ac) + ac*(ab*bc - bb*ac) AS det FROM m),
r AS (SELECT 'hr' AS term, (ay*(bb*cc - bc*bc) - ab*(by_*cc - bc*cy) + ac*(by_*bc - bb*cy)) / det AS x FROM d
      UNION ALL SELECT 'k', (aa*(by_*cc - bc*cy) - ay*(ab*cc - bc*ac) + ac*(ab*cy - by_*ac)) / det FROM d
      UNION ALL SELECT 'dow_num', (aa*(bb*cy - by_*bc) - ab*(ab*cy - by_*ac) + ay*(ab*bc - bb*ac)) / det FROM d)
SELECT term, round_even(x, 6) + 0.0 AS coefficient FROM r
"""


@register("ml_glm_unpenalised", _LS_SQL, "M2 (lambda 0: least squares)")
def q_ml_glm_unpenalised(spark, sf):
    """The solver without a penalty on all labelled rows against the closed form."""
    lf = adapters.learning_frame(spark, sf).filter(F.pmod(F.col(KEY), F.lit(10)) < 7)
    prep = fit_prep(lf, ["hr", "k", "dow_num"])
    m = linear.fit(prep.transform(lf), 1.0, 0.0)
    rows = [(n, float(b)) for n, b in zip(prep.numeric, m.coef[1:])]
    return spark.createDataFrame(rows, "term string, coefficient double").withColumn(
        "coefficient", F.bround("coefficient", 6) + F.lit(0.0))


@register("ml_rf_search", None, "M5 M6 M9 M11 O5")
def q_ml_rf_search(spark, sf):
    prep, trn, _, _ = _data(spark, sf)
    board, _ = S.grid_search(spark, S.with_folds(trn, KEY), S.ALGOS["rf"], RF_QUERY_GRID, _nf(prep), KEY,
                             max_models=2, seed=1, fixed={"max_bins": max_bins_for(prep)})
    return board


@register("ml_cv_oof", None, "M11 J12 D25")
def q_ml_cv_oof(spark, sf):
    prep, trn, _, _ = _data(spark, sf)
    r = S.cross_validate(S.with_folds(trn, KEY), S.ALGOS["rf"],
                         {"ntrees": 10, "max_depth": 6, "max_bins": max_bins_for(prep)}, _nf(prep), KEY, refit=False)
    return r.oof


@register("ml_poisson_gbt", None, "M3 M4 M10 M12 M14")
def q_ml_poisson_gbt(spark, sf):
    prep, trn, tst, _ = _data(spark, sf)
    # early stopping watches a validation part of the training rows
    v = trn.withColumn("__valid", F.pmod(F.xxhash64(KEY), F.lit(10)) == 0)
    m = L.PoissonGBT(ntrees=15, max_depth=4, learn_rate=0.3, learn_rate_annealing=0.95, sample_rate=0.9,
                     col_sample_rate_per_tree=0.8, max_bins=max_bins_for(prep), checkpoint_every=5).fit(
        v, _nf(prep), valid_col="__valid")
    pred = m.transform(tst)
    return pred.select(KEY, "recommendations", "prediction", clamp0(rint0("prediction")).alias("pred_recs"))


@register("ml_mlp", None, "M7")
def q_ml_mlp(spark, sf):
    prep, trn, tst, _ = _data(spark, sf)
    m = L.PoissonMLP(hidden=(16, 16), activation="Tanh", epochs=4, batches_per_epoch=2, rate=0.01,
                     momentum_start=0.5, momentum_stable=0.9, momentum_ramp=1e4, l2=1e-5).fit(trn, _nf(prep))
    return m.transform(tst).select(KEY, "recommendations", "prediction")


def _automl(spark, sf):
    """All of the operator's own candidates with their own parameters; GLM is left out as in the reference."""
    prep, trn, _, sub = _data(spark, sf)
    found = S.automl(spark, S.with_folds(trn, KEY), _nf(prep), KEY, exclude=("glm",), fixed={"max_bins": max_bins_for(prep)})
    return found, sub


@register("ml_automl", None, "M8 M13 O5")
def q_ml_automl(spark, sf):
    return _automl(spark, sf)[0].leaderboard


@register("ml_automl_leader", None, "M8 M13 M14 S7 (the leader, refitted, saved, loaded, scores the submission set)")
def q_ml_automl_leader(spark, sf):
    found, sub = _automl(spark, sf)
    path = RG.save_model(spark, found.model, f"{ensure_checkpoint_dir(spark).rstrip('/')}/leader-{uuid.uuid4().hex}")
    return RG.submission(RG.load_model(spark, path).transform(sub))


@register("ml_importance", None, "M16")
def q_ml_importance(spark, sf):
    prep, trn, _, _ = _data(spark, sf)
    m = L.random_forest(ntrees=10, max_depth=6, max_bins=max_bins_for(prep)).fit(trn)
    return spark.createDataFrame(S.importance(m, prep.feature_names()), "feature string, importance double")


def _explain(spark, sf):
    prep, trn, _, _ = _data(spark, sf)
    m = L.random_forest(ntrees=10, max_depth=6, max_bins=max_bins_for(prep)).fit(trn)
    lf = adapters.learning_frame(spark, sf)
    raw_train = lf.filter(F.pmod(F.col(KEY), F.lit(10)) < 7)
    ex = X.build_explainer(raw_train, prep.numeric, prep.categorical)
    # The rows to explain are picked by key — here the three largest labels
    cases = raw_train.orderBy(F.col("recommendations").desc(), F.col(KEY)).limit(3) \
                     .select(KEY, *prep.numeric, *prep.categorical)
    return X.explain(cases, ex, lambda d: m.transform(prep.transform(d)), KEY,
                     n_features=20, kernel_width=0.5)


@register("ml_lime", None, "L1 L2 L4 P14")
def q_ml_lime(spark, sf):
    return _explain(spark, sf)


@register("ml_lime_rollup", None, "L3 A21")
def q_ml_lime_rollup(spark, sf):
    return X.rollup(_explain(spark, sf), KEY)


@register("ml_submission", None, "M14 S6 E0 S7 S8")
def q_ml_submission(spark, sf):
    """Cross-validate and fit two models, save them, write the registry with their errors,
    find and reload them through it, score the submission set in one chain,
    average (E0) and return the scored rows (also written as a header CSV)."""
    prep, trn, _, sub = _data(spark, sf)
    mb = max_bins_for(prep)
    folds = S.with_folds(trn, KEY)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models-{uuid.uuid4().hex}"
    entries = []
    for name, algo, params in (("rf2", "rf", {"ntrees": 10, "max_depth": 6, "max_bins": mb}),
                               ("gbm2", "gbm", {"ntrees": 5, "max_depth": 3, "learn_rate": 0.3, "max_bins": mb})):
        fitted = S.cross_validate(folds, S.ALGOS[algo], params, _nf(prep), KEY)
        RG.save_model(spark, fitted.model, f"{base}/{name}")
        entries.append((name, algo, f"{base}/{name}", params, fitted.cv_mae))
    registry = RG.write_registry(spark, entries, f"{base}/registry")
    scored = RG.score_with(spark, sub, registry, ["rf2", "gbm2"])
    out = E.mean_of_two(scored, "gbm2", "rf2").select(KEY, "pred_recs")
    write_scored(out, f"{base}/submission_ens")
    return spark.read.schema("commentID long, pred_recs double").option("header", True) \
                .csv(f"{base}/submission_ens")


@register("ml_ensemble_models", None, "E1 E2 A18 (real model predictions)")
def q_ml_ensemble_models(spark, sf):
    """Weighted-ensemble search over real holdout predictions of three learners."""
    prep, trn, tst, _ = _data(spark, sf)
    mb = max_bins_for(prep)
    models = {"pred_rf2": L.random_forest(ntrees=10, max_depth=6, max_bins=mb).fit(trn),
              "pred_glm2": S.ALGOS["glm"].fit(trn, {"alpha": 0.5}, _nf(prep)),
              "pred_gbm2": L.PoissonGBT(ntrees=5, max_depth=3, learn_rate=0.3, max_bins=mb).fit(trn, _nf(prep))}
    preds = RG.chain(tst, models).select(KEY, "recommendations", *models)
    names = list(models)
    w = E.weight_trials(spark, 10_000, n_models=len(names), seed=3)
    return E.best_trials(E.search_weights(preds, w, "recommendations", models=names, clamp=["pred_glm2"]))


@register("ml_stack", None, "M11 M13")
def q_ml_stack(spark, sf):
    """Stacked ensemble: out-of-fold predictions of base learners (joined by key) feed
    a linear metalearner; returns its coefficients and cross-validated MAE.  (The
    boosted learner joins the stacks inside ``ml_automl``.)"""
    prep, trn, _, _ = _data(spark, sf)
    mb = max_bins_for(prep)
    d = S.with_folds(trn, KEY)
    base = {"rf": ("rf", {"ntrees": 10, "max_depth": 6, "max_bins": mb}),
            "rf_deep": ("rf", {"ntrees": 10, "max_depth": 12, "mtries": 1, "max_bins": mb}),
            "glm": ("glm", {"alpha": 0.5})}
    oofs = {n: S.cross_validate(d, S.ALGOS[a], p, _nf(prep), KEY, refit=False).oof for n, (a, p) in base.items()}
    meta, cv_mae, _ = S.stack(oofs, KEY)
    rows = [(n, float(c), float(cv_mae)) for n, c in zip(oofs, meta.coefficients.toArray())]
    rows.append(("intercept", float(meta.intercept), float(cv_mae)))
    return spark.createDataFrame(rows, "input string, coefficient double, cv_mae double")
