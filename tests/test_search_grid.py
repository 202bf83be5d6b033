"""The grid sampler draws evenly from grids of any size, and keys may repeat in summaries."""

from recspark.ml.search import random_discrete
from recspark.operators import eda


def test_sampler_is_even_on_a_large_grid():
    grid = {c: list(range(20)) for c in "abcdef"}          # 64 million points
    got = random_discrete(grid, 400)
    assert len({tuple(p.items()) for p in got}) == 400
    for c in grid:
        assert {p[c] for p in got} == set(grid[c])
        assert abs(sum(p[c] for p in got) / 400 - 9.5) < 1.5


def test_summary_counts_distinct_ids(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 5), ("a", 2, 1)], "g string, commentID long, recommendations long")
    assert eda.summary(df, ["g"]).first().num_com == 2
