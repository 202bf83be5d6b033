"""Modelling job: grid search + CV per algorithm, holdout MAE, saved models and
registry, scored submission, ensemble-weight search.

    python scripts/model_job.py --features /path/out --out /path/models [--grids small|reference]

``--features`` is the folder written by ``feature_job.py`` (``trn``, ``tst``,
``com_final``).  ``--grids reference`` uses the reference's full grids (sampled by
random discrete search with ``--max-models``); ``small`` uses a tiny grid per algorithm.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from recspark.ml import registry as RG  # noqa: E402
from recspark.ml import search as S  # noqa: E402
from recspark.ml.prep import PREPARED, feature_columns, fit_prep, max_bins_for, modelling_rows  # noqa: E402
from recspark.operators import ensemble as E  # noqa: E402
from recspark.session import DEFAULT_CONF, ensure_checkpoint_dir, materialize  # noqa: E402
from recspark.sources.tables import write_scored, write_table  # noqa: E402

KEY, LABEL = "commentID", "recommendations"
SMALL = {"glm": {"alpha": [0, 0.5, 1]},
         "rf": {"ntrees": [10, 20], "max_depth": [5, 8], "min_rows": [5, 10]},
         "gbm": {"ntrees": [5, 10], "max_depth": [3, 4], "learn_rate": [0.1, 0.3]}}
REFERENCE = {"glm": S.GLM_GRID, "rf": S.RF_GRID_2, "gbm": S.GBM_GRID_2}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--features", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--grids", choices=["small", "reference"], default="small")
    ap.add_argument("--max-models", type=int, default=2)
    ap.add_argument("--max-runtime-secs", type=float, default=S.MAX_RUNTIME_SECS)
    ap.add_argument("--trials", type=int, default=10_000)
    args = ap.parse_args()
    builder = SparkSession.builder.appName("recspark-models")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)

    trn = modelling_rows(spark.read.parquet(f"{args.features}/trn"))           # P2 + log target
    tst = modelling_rows(spark.read.parquet(f"{args.features}/tst"))
    sub = spark.read.parquet(f"{args.features}/com_final").filter(F.col("type") == "tst")
    feats = [c for c in feature_columns(trn) if c in sub.columns]
    prep = fit_prep(trn, feats)
    nf, mb = len(prep.feature_names()), max_bins_for(prep)
    cols = [KEY, LABEL, *PREPARED]
    T = S.with_folds(prep.transform(trn).select(*cols), KEY)
    V = materialize(prep.transform(tst).select(*cols), "holdout")
    U = materialize(prep.transform(sub).select(KEY, *PREPARED), "submission")

    grids = SMALL if args.grids == "small" else REFERENCE
    fixed = {"rf": {"max_bins": mb}, "gbm": {"max_bins": mb}}
    registry_rows, models = [], {}
    for algo in ("glm", "rf", "gbm"):
        if algo == "glm":   # the whole grid costs two passes
            board, results = S.glm_search(spark, T, KEY, grids[algo])
        else:
            board, results = S.grid_search(spark, T, S.ALGOS[algo], grids[algo], nf, KEY,
                                           max_models=args.max_models, max_runtime_secs=args.max_runtime_secs,
                                           fixed=fixed[algo])
        best = min(results, key=lambda r: r.cv_mae)
        write_table(board, f"{args.out}/leaderboard_{algo}")
        model = best.model or S.ALGOS[algo].fit(T, best.params, nf)
        pred = model.transform(V)
        mae = E.mae(pred, "prediction", LABEL).collect()[0][0]              # rounded predictions
        print(f"{algo}: cv_mae={best.cv_mae:.4f} holdout_mae={mae:.4f} params={best.params}")
        path = RG.save_model(spark, model, f"{args.out}/{algo}")
        registry_rows.append((algo, algo, path, best.params, best.cv_mae))
        models[f"pred_{algo}"] = model
        write_scored(RG.submission(model.transform(U)), f"{args.out}/submission_{algo}")
    RG.write_registry(spark, registry_rows, f"{args.out}/registry")

    names = list(models)
    holdout = RG.chain(V, models).select(KEY, LABEL, *names)   # all predictions on the same rows, no join
    w = E.weight_trials(spark, args.trials, n_models=len(names))
    best = E.best_trials(E.search_weights(holdout, w, LABEL, models=names, clamp=["pred_glm"]))
    write_table(best, f"{args.out}/ensemble_best")
    top = spark.read.parquet(f"{args.out}/ensemble_best").orderBy("trial").take(5)  # ties are all kept
    print(f"best ensemble trials written to {args.out}/ensemble_best; first:", [tuple(r) for r in top])
    spark.stop()


if __name__ == "__main__":
    main()
