"""The feature build on little disk: what goes when, what is moved, and the same rows in any number of passes."""

import time

import pytest
from pyspark.sql import functions as F

from recspark import session
from recspark.operators import features, indexing
from recspark.operators.indexing import KeptRows, exact_split, sample_hash
from recspark.sources import adapters

from .conftest import SF_SMALL


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle")}


def _written(spark, name):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{session.ensure_checkpoint_dir(spark)}/recspark-{name}-*")
    return len(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path))


def test_shuffles_and_intermediates_of_a_written_table_go(spark):
    own, before = spark.conf.get(session.SHUFFLES_GO, None), _shuffle_files(spark)

    def build():
        inner = session.materialize(spark.range(2000).repartition(3, "id").groupBy("id").count(), "disktest")
        return [inner.filter(F.col("id") % 2 == i).repartition(4, "count", "id") for i in (0, 1)]

    got = features.written_table(spark, "/src/disk", "t_disk_test", build)
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before and _written(spark, "disktest") == 0
    assert got.count() == 2000 and got.agg(F.sum("id")).first()[0] == 1999 * 1000
    assert spark.conf.get(session.SHUFFLES_GO, None) == own


def test_release_of_shuffles_is_undone_by_the_last_of_several_writes(spark):
    own = spark.conf.get(session.SHUFFLES_GO, None)
    with session.release_shuffles(spark):
        with pytest.raises(ValueError), session.release_shuffles(spark):
            raise ValueError
        assert spark.conf.get(session.SHUFFLES_GO) == "true"
    assert spark.conf.get(session.SHUFFLES_GO, None) == own


def test_passes_give_the_rows_of_one_pass(spark, tmp_path, monkeypatch):
    one = features.build_features(spark, SF_SMALL)
    assert len(one.passes) == 1
    n = adapters.comments(spark, SF_SMALL).count()
    monkeypatch.setattr(indexing, "ROWS_A_PASS", n // 4 + 1)
    kept = KeptRows()
    many = features.build_features(spark, SF_SMALL, kept=kept)
    assert len(many.passes) == 4
    sizes = []
    for i, part in enumerate(many.passes):
        part.write.parquet(f"{tmp_path}/{i}")
        sizes.append(spark.read.parquet(f"{tmp_path}/{i}").count())
    assert min(sizes) > n // 8 and sum(sizes) == n
    got = spark.read.parquet(*[f"{tmp_path}/{i}" for i in range(4)])
    assert kept.check(adapters.comments(spark, SF_SMALL), got) == n
    want = one.com_final
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_exchange_moves_the_parts_of_a_comment(spark):
    x = features.comment_order(adapters.comment_parts(spark, SF_SMALL), n_partitions=5, columns=adapters.comment_columns())
    plan = x._jdf.queryExecution().executedPlan().toString()
    rows = plan.split("Window [row_number()")[0] if "Window [row_number()" in plan else plan
    top, *below = plan.split("REPARTITION_BY_NUM")
    assert below and "concat_ws" in top and not any("concat_ws" in b for b in below), rows
    want = features.comment_order(adapters.comments(spark, SF_SMALL))
    assert x.select(*want.columns).exceptAll(want).count() == 0 and x.count() == want.count()


def test_training_rows_are_told_without_a_copy_or_a_shuffle(spark):
    trn = features.training_comments(spark, SF_SMALL)
    assert _written(spark, "trn") == 0
    plan = trn._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Scan parquet") == 1, plan
    all_trn = features.feature_table(spark, SF_SMALL).filter("type = 'trn'")
    ids = [r.commentID for r in all_trn.orderBy(sample_hash("commentID", 19790324), "commentID").select("commentID").collect()]
    matched = {r.commentID for r in all_trn.filter("pubDate_dt is not null").select("commentID").collect()}
    want = sorted(set(ids[:round(0.7 * len(ids))]) & matched)
    assert sorted(r.commentID for r in trn.select("commentID").collect()) == want


@pytest.mark.parametrize("copies", [1, 2, 30])
def test_exact_split_counts_with_equal_keys(spark, copies):
    df = spark.range(60).select(F.when(F.col("id") < 60 - copies, F.col("id").cast("string")).otherwise("same").alias("k"), "id")
    for fraction in (0.0, 0.25, 0.5, 0.7, 1.0):
        got = exact_split(df, "k", fraction, seed=3, bucket_bits=3)
        assert got.count() == 60 and got.filter("in_sample").count() == round(60 * fraction)
        keys = {r.k for r in got.filter("in_sample").collect()} & {r.k for r in got.filter("not in_sample").collect()}
        assert keys <= {"same"}


def test_g01_numbers_written_rows(spark):
    """The grouping's shuffle has gone when the numbering exchanges the rows."""
    from recspark.operators import eda
    trn = spark.createDataFrame([(1, True, "a", 3), (1, None, "b", None), (2, False, "c", 5), (2, False, "c", 2)],
                                "articleID long, editorsSelection boolean, commentID string, recommendations long")
    before = _shuffle_files(spark)
    got = eda.g01(trn)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "sum(recommendations" not in plan, plan
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert [(r.commentID, r.recs) for r in got.orderBy("plot_order").collect()] == [("c", 7), ("a", 3), ("b", 0)]


def test_tokens_meet_a_small_lexicon_before_any_exchange(spark):
    """Only the tokens found in the lexicon are exchanged: it is broadcast from the start, whatever the limit's size."""
    from recspark.operators.textops import add_sentiment
    df = spark.createDataFrame([(i, "plain words with this and that, not for") for i in range(20)], "id int, t string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    try:
        plan = add_sentiment(df, "t", "s", "c")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin [token" in plan and "SortMergeJoin [token" not in plan, plan
    assert "hashpartitioning(token" not in plan, plan


def test_sentiment_join_moves_no_text_that_nobody_reads(spark):
    from recspark.operators.textops import add_sentiment
    df = spark.createDataFrame([(0, "this and that"), (1, None), (2, "")], "id int, t string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = add_sentiment(df, "t", "s", "c").select("id", "s", "c")
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows = {r.id: (r.s, r.c is None) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [b for a, b in zip(plan.splitlines(), plan.splitlines()[1:]) if "Exchange hashpartitioning(__row" in a and "__said" in b]
    assert moved and not any("[t#" in b or " t#" in b for b in moved), plan
    assert rows[1] == (None, True) and rows[2] == (0.0, False) and rows[0][0] != 0
