"""Registered queries: MAE, two-model mean, weighted ensembles, weight search, folds,
log target, clamp.  Input: ``events`` with seven arithmetic pseudo-predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.core import clamp0, rint0, round_half_even, safe_log
from ..operators import ensemble as E
from ..operators.indexing import modulo_folds
from ..sources.tables import read_table
from . import oracle_sql as O
from .registry import register

N_TRIALS = 10_000
SEED = 2018

_PRED_SQL = """
p AS (SELECT event_id AS commentID, round_even(value, 0) + 0.0 AS recommendations,
             round_even(value * 0.9::DOUBLE, 0) + 0.0 AS pred_nn2,
             CAST(round_even(value, 0) + 0.0 - 3 + (event_id % 7) AS DOUBLE) AS pred_ml2,
             round_even(value * 1.1::DOUBLE, 0) + 0.0 AS pred_rf2,
             CAST(round_even(value, 0) + 0.0 + (event_id % 3) - 1 AS DOUBLE) AS pred_gbm2,
             round_even(value / 2, 0) + 0.0 - 5 AS pred_glm2,
             round_even(sqrt(value) * 5, 0) + 0.0 AS pred_rf3,
             CAST(round_even(value, 0) + 0.0 + ((event_id * 7) % 5) - 2 AS DOUBLE) AS pred_gbm3
      FROM events)"""


def _clamp(x: str) -> str:
    return f"(CASE WHEN {x} < 0 THEN 0 ELSE {x} END)"


def _preds(spark, sf):
    return E.pseudo_predictions(read_table(spark, sf, "events"))


@register("mae_rounded", "WITH " + _PRED_SQL.strip() + """
SELECT model, sum(abs(round_even(pred, 0) + 0.0 - recommendations)) / count(*) AS mae
FROM (UNPIVOT p ON pred_nn2, pred_ml2, pred_rf2, pred_gbm2, pred_glm2, pred_rf3, pred_gbm3
      INTO NAME model VALUE pred) GROUP BY model
""", "A18 F13 F15 M12")
def q_mae_rounded(spark, sf):
    return E.mae_by_model(_preds(spark, sf), E.MODELS, "recommendations")


@register("ensemble_mean", "WITH " + _PRED_SQL.strip() + f"""
SELECT commentID, round_even(({_clamp('round_even(pred_gbm2, 0)')} + {_clamp('round_even(pred_rf2, 0)')}) / 2, 0) + 0.0
       AS pred_recs FROM p
""", "E0 P13 M14")
def q_ensemble_mean(spark, sf):
    return E.mean_of_two(_preds(spark, sf), "pred_gbm2", "pred_rf2").select("commentID", "pred_recs")


def _weighted_sql(w: list[int], name: str) -> str:
    terms = " + ".join(f"{float(wi)!r}::DOUBLE * {_clamp(m) if m in E.CLAMPED else m}"
                       for wi, m in zip(w, E.MODELS))
    return f"round_even(({terms}) / {float(sum(w))!r}::DOUBLE, 0) + 0.0 AS {name}"


@register("ensemble_weighted", "WITH " + _PRED_SQL.strip() + f"""
SELECT commentID, {_weighted_sql(E.WEIGHTS_A, 'final_a')}, {_weighted_sql(E.WEIGHTS_B, 'final_b')} FROM p
""", "E1 P13 P18")
def q_ensemble_weighted(spark, sf):
    d = E.weighted(_preds(spark, sf), E.WEIGHTS_A, out="final_a")
    d = E.weighted(d, E.WEIGHTS_B, out="final_b")
    return d.select("commentID", "final_a", "final_b")


@register("ensemble_weighted_mae", "WITH " + _PRED_SQL.strip() + f""",
f AS (SELECT recommendations, {_weighted_sql(E.WEIGHTS_A, 'final_a')}, {_weighted_sql(E.WEIGHTS_B, 'final_b')} FROM p)
SELECT avg(abs(final_a - recommendations)) AS mae_a, avg(abs(final_b - recommendations)) AS mae_b FROM f
""", "E1 A18 F22")
def q_ensemble_weighted_mae(spark, sf):
    d = E.weighted(_preds(spark, sf), E.WEIGHTS_A, out="final_a")
    d = E.weighted(d, E.WEIGHTS_B, out="final_b")
    return d.agg(F.avg(F.abs(F.col("final_a") - F.col("recommendations"))).alias("mae_a"),
                 F.avg(F.abs(F.col("final_b") - F.col("recommendations"))).alias("mae_b"))


def _trials_sql(n: int = N_TRIALS, seed: int = SEED) -> str:
    ws = ", ".join(
        f"round_even(10.0::DOUBLE * ({O.sample_hash(f'CAST(trial AS VARCHAR) || {O.q(f":{j}")}', seed)}"
        f" / 4503599627370496.0::DOUBLE), 0) + 0.0 AS w{j}" for j in range(1, 8))
    return (f"w0 AS (SELECT trial, {ws} FROM (SELECT range AS trial FROM range(1, {n + 1}))),\n"
            f"w AS (SELECT *, w1 + w2 + w3 + w4 + w5 + w6 + w7 AS tot FROM w0 WHERE w1 + w2 + w3 + w4 + w5 + w6 + w7 > 0)")


_SEARCH_SQL = "WITH " + _PRED_SQL.strip() + ",\n" + _trials_sql() + f""",
r AS (SELECT w.trial, w.w1, w.w2, w.w3, w.w4, w.w5, w.w6, w.w7, w.tot,
             sum(abs(round_even((w.w1 * p.pred_nn2 + w.w2 * {_clamp('p.pred_ml2')} + w.w3 * p.pred_rf2
                                 + w.w4 * p.pred_gbm2 + w.w5 * {_clamp('p.pred_glm2')} + w.w6 * p.pred_rf3
                                 + w.w7 * p.pred_gbm3) / w.tot, 0) - p.recommendations))
             / count(*) AS mae
      FROM w CROSS JOIN p GROUP BY ALL)
"""


def _search(spark, sf):
    w = E.weight_trials(spark, N_TRIALS, seed=SEED)
    return E.search_weights(_preds(spark, sf), w, "recommendations")


@register("ensemble_search", _SEARCH_SQL + "SELECT * FROM r", "E2 F19 F20 J13 U2")
def q_ensemble_search(spark, sf):
    return _search(spark, sf)


@register("ensemble_search_best", _SEARCH_SQL + "SELECT * FROM r WHERE mae = (SELECT min(mae) FROM r)",
          "E2 P7 F22")
def q_ensemble_search_best(spark, sf):
    return E.best_trials(_search(spark, sf))


@register("modulo_folds", f"""
SELECT event_id, CAST((row_number() OVER (ORDER BY {O.sample_hash('event_id', 1)}, event_id) - 1) % 5 AS INTEGER)
       AS fold FROM events
""", "X4 F20 W8")
def q_modulo_folds(spark, sf):
    e = read_table(spark, sf, "events").select("event_id")
    return modulo_folds(e, "event_id", 5, seed=1)


@register("log_target", """
SELECT event_id, round_even(ln(CASE WHEN y = 0 THEN 1 ELSE y END), 6) + 0.0 AS log_rec
FROM (SELECT event_id, round_even(value, 0) + 0.0 AS y FROM events)
""", "F14 M15")
def q_log_target(spark, sf):
    e = read_table(spark, sf, "events")
    return e.select("event_id", round_half_even(safe_log(rint0("value")), 6).alias("log_rec"))


@register("clamp_round", """
SELECT event_id, CASE WHEN r < 0 THEN 0 ELSE r END AS pred_recs
FROM (SELECT event_id, round_even(value - 50, 0) + 0.0 AS r FROM events)
""", "P13 F13 M14")
def q_clamp_round(spark, sf):
    e = read_table(spark, sf, "events")
    return e.select("event_id", clamp0(rint0(F.col("value") - 50)).alias("pred_recs"))
