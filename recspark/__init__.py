"""recspark — article/comment feature engineering, exploration summaries and
recommendation-count models as Spark DataFrame programs.

Sub-packages:

* ``sources``   — table readers/writers, the driver-table adapter, model registry
* ``functions`` — Column-level helpers (rounding, null-safe buckets, time, text, topics)
* ``operators`` — DataFrame -> DataFrame operators (text_to_columns, keyword ranking,
  features, sentiment, readability, distributed row index / split / folds, EDA, ensembles)
* ``ml``        — Spark ML estimators and search (GLM, RF, Poisson boosting, MLP,
  cross-validation, stacking, LIME-style explanation)
* ``plans``     — the registered queries and their DuckDB oracle SQL
"""

__version__ = "0.1.0"
