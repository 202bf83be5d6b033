"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Flow (as the reference does with its saved tables): build the feature table once and
write it as Parquet (partitioned by ``type``), split the training part exactly and
write it, then run the exploration summaries from the written table.  Text,
keyword, order and ensemble operators run on the raw driver tables.  Every query is
executed completely with the ``noop`` sink (no collect to the driver).  One untimed
run of the feature build on the smallest tables warms up the JVM (JIT, codegen
caches) first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from recspark.operators import eda, features  # noqa: E402
from recspark.plans import REGISTRY  # noqa: E402
from recspark.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=2 * cpus, driver_memory="16g")
    scratch = tempfile.mkdtemp(prefix="recspark-bench-")
    times: dict[str, float] = {}

    def run(name, make):
        t0 = time.time()
        make()
        times[name] = round(time.time() - t0, 3)

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):  # JVM warm-up, not timed
        features.build_features(spark, warm).com_final.write.format("noop").mode("overwrite").save()
    else:
        spark.range(10).count()

    feat_path, trn_path = f"{scratch}/com_final", f"{scratch}/trn"
    run("features", lambda: features.build_features(spark, sf_dir).com_final
        .write.mode("overwrite").partitionBy("type").parquet(feat_path))

    def split():
        com = spark.read.parquet(feat_path)
        trn, _ = features.train_split(com, materialize_input=False)  # already a table scan
        trn.write.mode("overwrite").parquet(trn_path)
    run("split", split)

    def trn():
        return spark.read.parquet(trn_path).filter(F.col("pubDate_dt").isNotNull())

    graphs = {
        "g01": lambda: eda.g01(trn()), "g02": lambda: eda.g02(trn()),
        "g03_points": lambda: eda.g03_points(trn()), "g03_density": lambda: eda.g03_density(trn()),
        "g04": lambda: eda.g_topic(trn(), "topic"), "g05": lambda: eda.g_topic(trn(), "specific"),
        "g06": lambda: eda.g_top_keyword(trn(), "kw1"), "g09": lambda: eda.g09(trn()),
        "g12": lambda: eda.g12(trn()), "g14": lambda: eda.g14(trn()), "g16": lambda: eda.g16(trn()),
    }
    for name, mk in graphs.items():
        run(name, lambda mk=mk: noop(mk()))

    for name in ["keyword_rank", "keyword_top3", "comment_order", "sentiment_documents",
                 "readability_documents", "topic_rules_documents", "text_to_columns_next",
                 "ensemble_search", "modulo_folds", "ml_poisson_gbt"]:
        run(name, lambda name=name: noop(REGISTRY[name].fn(spark, sf_dir)))

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
