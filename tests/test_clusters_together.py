"""K-means fits that share their reads, against Lloyd's steps in one process."""

import numpy as np
import pytest

from tallyspark.operators import clusters


def plain(x, centres):
    for _ in range(100):
        near = ((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[near == k].mean(axis=0) if (near == k).any() else c for k, c in enumerate(centres)])
        if ((new - centres) ** 2).sum(axis=1).max() <= 1e-8:
            break
        centres = new
    return centres, ((x[:, None] - centres) ** 2).sum(axis=2).min(axis=1).sum()


def test_fits_together_equal_separate_fits(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.4, (60, 3)) for c in ((0, 0, 0), (5, 0, 0), (0, 6, 0), (3, 3, 3))])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id int, features array<double>").repartition(3)
    chosen = clusters.spread_starts(df, 12)
    assert len(np.unique(chosen, axis=0)) == 12
    starts = {k: chosen[:k] for k in (1, 4, 12)}
    fitted = clusters.lloyd_together(df, starts)
    for k, (centres, cost) in fitted.items():
        want, least = plain(x, starts[k])
        assert np.abs(centres - want).max() < 1e-6 and cost == pytest.approx(least)
    rows = clusters.nearest_centre(df, fitted[4][0]).collect()
    assert all(r["cluster"] == ((x[r["id"]] - fitted[4][0]) ** 2).sum(axis=1).argmin() for r in rows)
    table = {r["k"]: r for r in clusters.elbow(df, (2, 4, 8), seeds=(1, 2)).collect()}
    assert table[2]["inertia"] > table[4]["inertia"] > table[8]["inertia"]
    assert clusters.best_k(spark.createDataFrame(list(table.values()))).first()["k"] == 4


def test_rows_that_are_all_equal(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(20)], "id int, features array<double>")
    starts = clusters.spread_starts(df, 5)
    assert len(starts) == 1
    assert clusters.lloyd_together(df, {"one": starts})["one"][1] == pytest.approx(0)


def test_mini_batches_come_near_lloyd(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.4, (150, 2)) for c in ((0, 0), (5, 0), (0, 6), (4, 4))])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id int, features array<double>")
    start = {k: x[rng.choice(len(x), k, replace=False)] for k in (1, 4)}
    start[4] = clusters.spread_starts(df, 4)
    found = clusters.mini_batches_together(df, start, batch_rows=100, max_batches=30)
    for k, (centres, cost, batches) in found.items():
        assert 10 < batches <= 30
        assert cost == pytest.approx(((x[:, None] - centres) ** 2).sum(axis=2).min(axis=1).sum())
        assert cost <= 1.05 * plain(x, start[k])[1]
