import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.operators import explore, ranking, splits


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one value; groups of very different size."""
    rng = np.random.default_rng(0)
    rows = []
    for i in range(6000):
        v = 5.0 if i % 3 == 0 else float(np.round(rng.lognormal(3, 2), 2))
        rows.append((i, "big" if i % 10 else "small", None if i % 97 == 0 else v))
    return spark.createDataFrame(rows, "id long, g string, v double").cache(), rows


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.95, 1.0])
def test_quantiles(skewed, q):
    df, rows = skewed
    values = [v for _, _, v in rows if v is not None]
    assert ranking.exact_quantiles(df, "v", [q]).first()[0] == pytest.approx(np.quantile(values, q))


def test_grouped_quantiles(skewed):
    df, rows = skewed
    for few in (False, True):
        found = ranking.exact_quantiles(df, "v", [0.5, 0.9], ["g"], few).collect()
        got = {r["g"]: (r["q0"], r["q1"]) for r in found}
        for g in ("big", "small"):
            values = [v for _, h, v in rows if h == g and v is not None]
            assert got[g] == pytest.approx(tuple(np.quantile(values, [0.5, 0.9])))


def test_running_sums_wherever_the_cuts_fall(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"), (F.col("id") % 4).alias("n"))
    for slices in (2, 8, 256):
        rows = ranking.running_sums(df, [], "v", ["n"], slices=slices).orderBy("v").collect()
        total = 0
        for r in rows:
            assert r["n_before"] == total and r["n_total"] == 1500
            total += r["n"]


def test_row_rank(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 3)
    rows = ranking.row_rank(df, ["g"], "id").collect()
    assert all(r["rank"] == r["id"] // 3 for r in rows)


def test_histogram(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 2.5, 10)], "x double")
    rows = explore.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r["n"] for r in rows] == list(np.histogram([0, 1, 2, 2.5, 10], 5)[0])
    same = explore.histogram(df.where("x = 1"), "x", 4).orderBy("bin").collect()
    assert sum(r["n"] for r in same) == 1 and same[0]["bin_start"] == 0.5


def test_samples(spark):
    df = spark.range(5000)
    a, b = (sorted(r["id"] for r in splits.sample_rows(df.repartition(n), 700).collect()) for n in (1, 7))
    assert a == b and len(set(a)) == 700
    assert splits.sample_rows(df, 9000).count() == 5000
    assert a != sorted(r["id"] for r in splits.sample_rows(df, 700, seed=1).collect())


def test_stratified_and_shuffled(spark):
    df = spark.range(1000).withColumn("s", F.when(F.col("id") < 700, "a").otherwise("b"))
    n = {(r["s"], r["split"]): r["count"] for r in splits.stratified_splits(df, "s").groupBy("s", "split").count().collect()}
    assert n == {("a", "test"): 105, ("a", "val"): 105, ("a", "train"): 490,
                 ("b", "test"): 45, ("b", "val"): 45, ("b", "train"): 210}
    train, test = splits.shuffled_split(df, "id")
    assert (train.count(), test.count()) == (800, 200) and train.join(test, "id").isEmpty()


def test_spread_sample(spark):
    df = spark.range(0, 1001)
    got = sorted(r["id"] for r in splits.spread_sample(df, 30).collect())
    assert got == [c * 100 + i for c in range(10) for i in range(3)]


def test_temporal_splits(spark):
    days = ["2023-12-31", "2024-06-01", "2025-01-01", "2026-01-01", "1979-01-01", "bad", None]
    df = spark.createDataFrame(list(enumerate(days)), "id int, last_donation_date string")
    train, val, test = splits.temporal_splits(df)
    assert [[r["id"] for r in x.collect()] for x in (train, val, test)] == [[0], [1], [2]]
