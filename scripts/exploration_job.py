"""Exploration job: the data behind the 16 graphs, from the written training split.

    python scripts/exploration_job.py --trn /path/out/trn --out /path/graphs

Reads the ``trn`` table written by ``feature_job.py``, keeps comments with a matched
article (P1) and writes one Parquet table per graph (g01 … g16, g03 as points and
density).
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from recspark.operators import eda  # noqa: E402
from recspark.session import DEFAULT_CONF, ensure_checkpoint_dir  # noqa: E402
from recspark.sources.tables import write_table  # noqa: E402

GRAPHS = {
    "g01": eda.g01, "g02": eda.g02, "g03_points": eda.g03_points, "g03_density": eda.g03_density,
    "g04": lambda t: eda.g_topic(t, "topic"), "g05": lambda t: eda.g_topic(t, "specific"),
    "g06": lambda t: eda.g_top_keyword(t, "kw1"), "g07": lambda t: eda.g_top_keyword(t, "kw2"),
    "g08": lambda t: eda.g_top_keyword(t, "kw3"), "g09": eda.g09, "g10": eda.g10, "g11": eda.g11,
    "g12": eda.g12, "g13": eda.g13, "g14": eda.g14, "g15": eda.g15, "g16": eda.g16,
}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--trn", required=True, help="training split written by feature_job.py")
    ap.add_argument("--out", required=True)
    args = ap.parse_args()
    builder = SparkSession.builder.appName("recspark-exploration")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    trn = spark.read.parquet(args.trn).filter(F.col("pubDate_dt").isNotNull())
    for name, graph in GRAPHS.items():
        write_table(graph(trn), f"{args.out}/{name}")
        print(name, spark.read.parquet(f"{args.out}/{name}").count())
    spark.stop()


if __name__ == "__main__":
    main()
