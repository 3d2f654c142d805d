import math

import pytest

from tallyspark.operators import clusters
from tallyspark.sources.upsert import merge_into, table_by_key, upsert

SCHEMA = "a int, b string, kept string, changed int, at int"


def files(path):
    return {p.parent.name: p.name for p in path.glob("key_folder=*/*.parquet")}


def test_merge_reads_and_rewrites_touched_folders_only(spark, tmp_path):
    old = spark.createDataFrame([(n, "x", f"old {n}", n, 0) for n in range(200)] + [(None, "x", "n", 1, 0)], SCHEMA)
    new = spark.createDataFrame([(3, "x", "new", 30, 1), (3, "x", "newer", 31, 2), (500, "x", None, None, 1), (None, "x", "n", 2, 1)], SCHEMA)
    path, args = tmp_path / "table", (["a", "b"], ["changed"], "at")
    merge_into(str(path), old, *args, folders=32)
    before = files(path)
    read = merge_into(str(path), new, *args, folders=32)
    after = files(path)
    assert 1 <= len(read) <= 2
    assert {f for f in before if before[f] != after[f]} <= {f"key_folder={n}" for n in [*read, 32]}
    schema = old.drop("at").schema
    want = upsert(upsert(None, old, *args), new, *args)
    found = table_by_key(spark, str(path), schema)
    assert found.columns == want.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect())) and found.count() == 203
    plan = table_by_key(spark, str(path), schema, read)._jdf.queryExecution().toString()
    assert "PartitionFilters: [key_folder" in plan or "PartitionFilters: [isnotnull(key_folder" in plan
    # Keyed rows again, and none at all: nothing changes.
    merge_into(str(path), new.where("a is not null"), *args, folders=32)
    assert merge_into(str(path), new.limit(0), *args, folders=32) == []
    assert sorted(map(str, table_by_key(spark, str(path), schema).collect())) == sorted(map(str, want.collect()))
    assert table_by_key(spark, str(tmp_path / "none"), schema) is None


POINTS = [(n, [float(n % 7), float(n % 5) / 2, n / 9], "one" if n % 3 else "two") for n in range(30)]


def plain(points, asked):
    values = []
    for i, x, c in asked:
        sums = {}
        for _, y, o in points:
            total, n = sums.get(o, (0.0, 0))
            sums[o] = total + math.dist(x, y), n + 1
        if sums[c][1] == 1:
            values.append(0.0)
            continue
        a = sums[c][0] / (sums[c][1] - 1)
        b = min(t / n for o, (t, n) in sums.items() if o != c)
        values.append((b - a) / max(a, b))
    return sum(values) / len(values)


def test_euclidean_silhouette_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(clusters, "SILHOUETTE_BLOCK", 4)
    points = [*POINTS, (30, [9.0, 9.0, 9.0], "alone"), (31, [1.0, 2.0, 3.0], "two"), (32, [1.0, 2.0, 3.0], "two")]
    odd = [(40, None, "one"), (41, [0.0, 0.0, 0.0], None)]
    rows = spark.createDataFrame([*points, *odd], "id long, features array<double>, label string")
    every = clusters.euclidean_silhouette(rows, "features", "label").first()[0]
    assert every == pytest.approx(plain(points, points), abs=1e-9)
    some = clusters.euclidean_silhouette(rows, "features", "label", rows.where("id % 5 = 0")).first()[0]
    assert some == pytest.approx(plain(points, [p for p in points if p[0] % 5 == 0]), abs=1e-9)
    for none in (rows.limit(0), rows.where("label = 'one'")):
        assert clusters.euclidean_silhouette(none, "features", "label").first()[0] is None
