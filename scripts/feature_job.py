"""Feature job: build and write the feature tables and the exact train/holdout split.

    python scripts/feature_job.py --sf-dir /root/testdata/sf0.01 --out /path/out
    python scripts/feature_job.py --csv-dir /path/with/reference/csvs --out /path/out

The CSV layout is the reference's: ``train_articles.csv``, ``test_articles.csv``,
``train_comments.csv``, ``test_comments.csv``.  Outputs (Parquet): ``art``, ``com_final``
(partitioned by ``type``), ``trn`` and ``tst`` (the 70/30 split of the training comments).
On a cluster, run it with spark-submit; ``spark.checkpoint.dir`` must name a shared folder.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from recspark.operators import features  # noqa: E402
from recspark.operators.indexing import KeptRows  # noqa: E402
from recspark.operators.textops import read_lexicon  # noqa: E402
from recspark.session import DEFAULT_CONF, ensure_checkpoint_dir  # noqa: E402
from recspark.sources import adapters  # noqa: E402
from recspark.sources.tables import (ARTICLE_CSV_SCHEMA, COMMENT_CSV_SCHEMA, read_delimited,  # noqa: E402
                                     write_table)


def main() -> None:
    ap = argparse.ArgumentParser()
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf-dir", help="folder with the driver Parquet tables")
    src.add_argument("--csv-dir", help="folder with the four reference-format CSV files")
    ap.add_argument("--out", required=True)
    ap.add_argument("--lexicon", help="sentiment lexicon: Parquet table or CSV file with word, polarity and optionally role "
                                      "(polar, negator, amplifier, deamplifier); the small test lexicon if absent")
    ap.add_argument("--fraction", type=float, default=0.70)
    ap.add_argument("--seed", type=int, default=19790324)
    args = ap.parse_args()

    builder = SparkSession.builder.appName("recspark-features")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)

    sentiment = {"lexicon": read_lexicon(spark, args.lexicon)} if args.lexicon else None
    kept = KeptRows()
    if args.sf_dir:
        com_raw = adapters.comments(spark, args.sf_dir)
        ft = features.build_features(spark, args.sf_dir, sentiment_kwargs=sentiment, kept=kept)
    else:
        def both(kind, schema):
            """Both files, ingested once to Parquet; records that do not fit are counted and reported."""
            for part, tag in (("train", "trn"), ("test", "tst")):
                write_table(read_delimited(spark, f"{args.csv_dir}/{part}_{kind}.csv", schema, tag, bad_row="_bad"),
                            f"{args.out}/raw_{kind}_{tag}")
            raw = [spark.read.parquet(f"{args.out}/raw_{kind}_{tag}") for tag in ("trn", "tst")]
            both_raw = raw[0].unionByName(raw[1], allowMissingColumns=True)
            print(f"{kind}: bad_rows={both_raw.filter('_bad').count()} of {both_raw.count()}")
            return both_raw.drop("_bad")
        com_raw = both("comments", COMMENT_CSV_SCHEMA)
        ft = features.features_from_reference_inputs(both("articles", ARTICLE_CSV_SCHEMA), com_raw, sentiment_kwargs=sentiment,
                                                     kept=kept)

    write_table(ft.art, f"{args.out}/art")
    write_table(ft.com_final, f"{args.out}/com_final", partition_by=["type"])
    com = spark.read.parquet(f"{args.out}/com_final")
    kept.check(com_raw, com)  # X3: the joins neither lose nor repeat a comment
    trn, tst = features.train_split(com, args.fraction, args.seed, materialize_input=False)
    write_table(trn, f"{args.out}/trn")
    write_table(tst, f"{args.out}/tst")
    n_trn, n_tst = spark.read.parquet(f"{args.out}/trn").count(), spark.read.parquet(f"{args.out}/tst").count()
    # The split shares, as the reference checks them
    share = round(n_trn / max(n_trn + n_tst, 1), 2)
    print(f"trn={n_trn} tst={n_tst} share={share}")
    if n_trn + n_tst and share != round(args.fraction, 2):
        raise SystemExit(f"split share {share} != {args.fraction}")
    spark.stop()


if __name__ == "__main__":
    main()
