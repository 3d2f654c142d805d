"""K-means segments, their quality and their profiles."""

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import PARTIES, mean
from ..session import cut_lineage, discard, shared_dir
from .explore import top_n, top_n_per_group
from .features import most_frequent
from .side_by_side import side_by_side
from .splits import sample_rows

# --- Fixed values: candidate numbers of clusters. ---
ELBOW_K = [50, 100, 150, 200, 300, 500]
# --- End of fixed values. ---


def as_array(df, features):
    """``features`` as an array of doubles, whether it is a vector or an array."""
    if df.schema[features].dataType.typeName() == "array":
        return F.transform(F.col(features), lambda x: x.cast("double"))
    return vector_to_array(features)


def as_vector(df, features):
    if df.schema[features].dataType.typeName() == "array":
        return array_to_vector(F.transform(F.col(features), lambda x: x.cast("double")))
    return F.col(features)


def fit_kmeans(df: DataFrame, k, features="features", seeds=(42, 43, 44), max_iter=100):
    """The fit of lowest cost over the seeds (Lloyd's steps over all rows, k-means|| start)."""

    def fit(seed):
        return KMeans(k=k, featuresCol=features, predictionCol="cluster", seed=seed, maxIter=max_iter).fit(df)

    return min(side_by_side(df.sparkSession, fit, seeds), key=lambda m: m.summary.trainingCost)


def assign_clusters(model, *splits):
    """(id, cluster) of each split."""
    return [model.transform(df).select("id", "cluster") for df in splits]


def with_clusters(df: DataFrame, assignments: DataFrame) -> DataFrame:
    return df.join(assignments, "id", "left")


def centroids(df: DataFrame, features, cluster) -> DataFrame:
    """Mean vector and size of each cluster (vectors are added up inside the JVM)."""
    rows = df.select(F.col(cluster).alias("cluster"), as_vector(df, features).alias("_v"))
    means = rows.groupBy("cluster").agg(
        Summarizer.mean(F.col("_v")).alias("_m"), F.count("*").alias("size")
    )
    return means.select("cluster", vector_to_array("_m").alias("centroid"), "size")


def _square(x):
    return F.aggregate(F.transform(x, lambda v: v * v), F.lit(0.0), lambda s, v: s + v)


def _squared(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def distances_to_centroid(df: DataFrame, features, cluster) -> DataFrame:
    """(cluster, squared distance) of every row to its own centroid.

    Spark broadcasts the centroids if they are few; hot clusters of a shuffled join are split.
    """
    rows = df.select(F.col(cluster).alias("cluster"), as_array(df, features).alias("_x"))
    return rows.join(centroids(df, features, cluster), "cluster").select("cluster", _squared("_x", "centroid").alias("d2"))


def cluster_quality(df: DataFrame, features, cluster) -> DataFrame:
    """Inertia and the least, greatest, mean and deviation of the cluster sizes."""
    inertia = distances_to_centroid(df, features, cluster).agg(F.sum("d2")).scalar()
    sizes = df.groupBy(cluster).agg(F.count("*").alias("size"))
    return sizes.agg(
        F.min("size").alias("min_size"),
        F.max("size").alias("max_size"),
        F.avg("size").alias("mean_size"),
        F.stddev_pop("size").alias("std_size"),
    ).withColumn("inertia", inertia)


def davies_bouldin(df: DataFrame, features, cluster) -> DataFrame:
    """Mean over clusters of the worst (spread + spread) / distance to another cluster.

    Each centroid looks at the list of all k centroids, which is one small row.
    """
    spread = distances_to_centroid(df, features, cluster).groupBy("cluster").agg(
        F.avg(F.sqrt("d2")).alias("s")
    )
    middle = centroids(df, features, cluster).join(spread, "cluster").select("cluster", "centroid", "s")
    others = middle.agg(F.collect_list(F.struct("cluster", "centroid", "s"))).scalar()

    def ratio(o):
        distance = F.sqrt(_squared(o["centroid"], F.col("centroid")))
        return F.when(o["cluster"] != F.col("cluster"), (o["s"] + F.col("s")) / distance)

    worst = F.array_max(F.transform(F.col("_all"), ratio))
    return middle.withColumn("_all", others).agg(F.avg(worst).alias("davies_bouldin"))


def silhouette(df: DataFrame, features, cluster):
    """Mean silhouette of all rows under squared Euclidean distance.

    The mean squared distance of a row to a cluster follows from the cluster's size, mean vector and
    mean square, so the work is linear in the rows: each looks at one entry per cluster. Rows of
    clusters of one count zero.
    """
    rows = df.select(F.col(cluster).alias("cluster"), as_array(df, features).alias("_x")).withColumn("_q", _square("_x"))
    spread = rows.groupBy("cluster").agg(F.avg("_q").alias("q"))
    every = centroids(df, features, cluster).join(spread, "cluster").agg(
        F.collect_list(F.struct("cluster", "centroid", "size", "q"))
    ).scalar()

    def to_cluster(c):
        inner = F.aggregate(F.zip_with(c["centroid"], F.col("_x"), lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
        return F.greatest(F.col("_q") + c["q"] - 2 * inner, F.lit(0.0))

    own = F.filter("_all", lambda c: c["cluster"] == F.col("cluster"))[0]
    others = F.transform(F.filter("_all", lambda c: c["cluster"] != F.col("cluster")), to_cluster)
    inner, outer = to_cluster(own) * own["size"] / (own["size"] - 1), F.array_min(others)
    scored = rows.withColumn("_all", every).select(
        F.when(own["size"] > 1, inner).alias("a"), outer.alias("b"), own["size"].alias("size")
    )
    value = F.when(F.col("size") > 1, (F.col("b") - F.col("a")) / F.greatest("a", "b", F.lit(1e-300))).otherwise(0.0)
    return scored.agg(F.avg(value).alias("silhouette"))


def sampled_silhouette(df: DataFrame, features, cluster, max_rows, key="id", seed=42):
    """Mean Euclidean silhouette of ``max_rows`` sampled rows.

    The sample goes to every task as one matrix (its size is bounded by
    ``max_rows``); each task measures its own rows against it. ``silhouette``
    scores all rows.
    """
    rows = df.select(
        F.col(key).alias("id"), F.col(cluster).alias("cluster"), as_array(df, features).alias("x")
    )
    sample = sample_rows(rows, max_rows, "id", seed)
    local = sample.toPandas()
    points = np.array(local["x"].tolist(), dtype=float)
    labels, codes = np.unique(local["cluster"].to_numpy(), return_inverse=True)
    shared = df.sparkSession.sparkContext.broadcast((points, codes, np.bincount(codes), labels))

    def score(batches):
        xs, cs, sizes, names = shared.value
        norms = (xs * xs).sum(axis=1)
        one_hot = np.eye(len(sizes))[cs]
        for pdf in batches:
            if not len(pdf):
                continue
            a = np.array(pdf["x"].tolist(), dtype=float)
            own = np.searchsorted(names, pdf["cluster"].to_numpy())
            d2 = (a * a).sum(axis=1)[:, None] + norms - 2 * a @ xs.T
            sums = np.sqrt(np.maximum(d2, 0)) @ one_hot
            line = np.arange(len(a))
            rest = sizes[own] - 1
            inner = sums[line, own] / np.maximum(rest, 1)
            means = sums / sizes
            means[line, own] = np.inf
            outer = means.min(axis=1)
            value = np.where(rest > 0, (outer - inner) / np.maximum(np.maximum(inner, outer), 1e-300), 0.0)
            yield pd.DataFrame({"s": value})

    return sample.mapInPandas(score, "s double").agg(F.avg("s").alias("silhouette"))


# Rows of a cluster, and of a sample, that are measured against each other at once.
SILHOUETTE_BLOCK = 4096


def euclidean_silhouette(df: DataFrame, features, cluster, sample: DataFrame = None, key="id"):
    """Mean Euclidean silhouette of the rows of ``sample`` (rows of ``df``; all of them if None), measured against all of ``df``.

    Clusters and sample are cut into blocks by a hash of the key, so a hot cluster is many blocks. A pair
    of blocks hands on one sum of distances per sampled row. The work is sampled rows x all rows: give a
    sample of bounded size where ``df`` is large. Rows of clusters of one count zero; null features or
    clusters and their rows are left out; one cluster alone, or an empty sample, gives null.
    """

    def points(rows):
        picked = rows.select(F.col(key).alias("id"), F.col(cluster).alias("cluster"), as_array(rows, features).alias("x"))
        return picked.where(F.col("cluster").isNotNull() & F.col("x").isNotNull())

    base = points(df)
    asked = base if sample is None else points(sample)
    sizes = base.groupBy("cluster").agg(F.count("*").alias("n"))
    cut = sizes.withColumn("blocks", F.ceil(F.col("n") / SILHOUETTE_BLOCK))
    parts = F.ceil(asked.agg(F.count("*").alias("n")).scalar() / SILHOUETTE_BLOCK)

    def salted(n):
        return F.pmod(F.xxhash64(F.lit(11), "id"), n)

    def upto(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(n, F.lit(1)) - 1))

    cells = cut.select(F.col("cluster").alias("other"), upto(F.col("blocks")).alias("block"))
    every = cells.agg(F.collect_list(F.struct("other", "block"))).scalar()
    left = asked.withColumn("part", salted(F.greatest(parts, F.lit(1)))).withColumn("_cell", F.explode(every))
    left = left.select("id", "x", "part", "_cell.other", "_cell.block")
    right = base.join(cut, "cluster").select(F.col("cluster").alias("other"), F.col("x").alias("y"), salted(F.col("blocks")).alias("block"))
    right = right.withColumn("part", upto(parts))

    def sums(queries, rows):
        if not len(queries) or not len(rows):
            return pd.DataFrame({"id": [], "other": [], "total": []})
        x, y = (np.array(part.tolist(), dtype=float) for part in (queries["x"], rows["y"]))
        d2 = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * x @ y.T
        total = np.sqrt(np.maximum(d2, 0)).sum(axis=1)
        return pd.DataFrame({"id": queries["id"], "other": rows["other"].iloc[0], "total": total})

    types = {c: t for c, t in base.dtypes}
    keys = ["other", "block", "part"]
    far = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        sums, f"id {types['id']}, other {types['cluster']}, total double"
    )
    far = far.groupBy("id", "other").agg(F.sum("total").alias("total")).join(
        sizes.select(F.col("cluster").alias("other"), "n"), "other"
    )
    own = F.col("other") == F.col("cluster")
    scored = far.join(asked.select("id", "cluster"), "id").groupBy("id").agg(
        F.max(F.when(own, F.col("n"))).alias("size"),
        F.max(F.when(own & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
    )
    value = F.when(F.col("size") == 1, 0.0).when(
        F.col("b").isNotNull(), (F.col("b") - F.col("a")) / F.greatest("a", "b", F.lit(1e-300))
    )
    return scored.agg(F.avg(value).alias("silhouette"))


# Rows among which the starts of ``lloyd_together`` are chosen; they are at the driver.
START_ROWS = 5000


def spread_starts(df: DataFrame, most, features="features", seed=42, key="id"):
    """``most`` starting centres, each drawn by its squared distance to those before; the first k serve for k clusters.

    They are drawn among the first ``START_ROWS`` rows in the order of a hash.
    """
    order = F.xxhash64(F.lit(seed), key)
    rows = df.select(as_array(df, features).alias("x"), order.alias("o")).orderBy("o").limit(START_ROWS).collect()
    x, rng = np.array([r["x"] for r in rows], dtype=float), np.random.default_rng(seed)
    chosen, left = [int(rng.integers(len(x)))], np.full(len(x), np.inf)
    while len(chosen) < min(most, len(x)):
        left = np.minimum(left, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
        if not left.sum() > 0:
            break
        chosen.append(int(rng.choice(len(x), p=left / left.sum())))
    return x[chosen]


def _nearest(x, centres):
    """(number, squared distance) of the nearest centre of each row."""
    d2 = (x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1) - 2 * x @ centres.T
    near = d2.argmin(axis=1)
    return near, np.maximum(d2[np.arange(len(x)), near], 0)


def _sums(rows, centres):
    """{name: per cluster the rows, their squared distances and their vectors, added up inside the tasks} for some sets of centres.

    One row per set and task is shuffled.
    """
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    def add_up(batches):
        total = {n: np.zeros((len(c), c.shape[1] + 2)) for n, c in shared.value.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for n, c in shared.value.items():
                near, d2 = _nearest(x, c)
                weights = [None, d2, *x.T]
                total[n] += np.stack([np.bincount(near, w, len(c)) for w in weights], axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())], names=["n", "sums"]
        )

    def meet(table):
        added = sum(np.frombuffer(v.as_py()) for v in table.column("sums"))
        return pa.Table.from_arrays([table.column("n")[:1], pa.array([added.tobytes()], pa.binary())], names=["n", "sums"])

    answers = rows.select("x").mapInArrow(add_up, "n int, sums binary").groupBy("n").applyInArrow(meet, "n int, sums binary")
    return {r["n"]: np.frombuffer(r["sums"]).reshape(len(centres[r["n"]]), -1) for r in answers.collect()}


def lloyd_together(df: DataFrame, starts, features="features", max_iter=100, tolerance=1e-4):
    """{name: (centres, cost)} of Lloyd's steps from each of ``starts`` ({name: centres}), to whose rows all of them share the reads.

    A start rests when no centre moves by more than ``tolerance``; a cluster without rows
    keeps its centre. ``cost`` is that of the centres returned.
    """
    rows = df.select(as_array(df, features).alias("x"))
    centres = {n: np.array(c, dtype=float) for n, c in enumerate(starts.values())}
    moving, cost = set(centres), {}
    for _ in range(max_iter):
        if not moving:
            break
        for n, sums in _sums(rows, {n: centres[n] for n in moving}).items():
            cost[n] = float(sums[:, 1].sum())
            new = np.where(sums[:, :1] > 0, sums[:, 2:] / np.maximum(sums[:, :1], 1), centres[n])
            if not ((new - centres[n]) ** 2).sum(axis=1).max() > tolerance**2:
                moving.discard(n)
            else:
                centres[n] = new
    for n, sums in (_sums(rows, {n: centres[n] for n in moving}) if moving else {}).items():
        cost[n] = float(sums[:, 1].sum())
    return {name: (centres[n], cost[n]) for n, name in enumerate(starts)}


# --- Fixed values: rows of a mini-batch, batches without a gain before a fit rests. ---
BATCH_ROWS = 10_000
PATIENCE = 10
# --- End of fixed values. ---


def mini_batches_together(
    df: DataFrame, starts, features="features", key="id", batch_rows=BATCH_ROWS, max_batches=300, patience=PATIENCE, gain=1e-4
):
    """{name: (centres, cost, batches read)} of mini-batch steps from each of ``starts``; all of them share the batches.

    The rows are dealt into batches by a hash of the key, each a folder of its own, so a step reads one batch
    only; the folders are stored once and removed at the end. After the last batch the first one follows. A centre moves
    towards the mean of its rows by their share of all rows it has had. A start rests when the smoothed cost of the
    batches has not fallen by the share ``gain`` for ``patience`` of them. More than ``max_batches`` batches are not stored: a fit sees a
    sample of so many rows at most. ``cost`` is that of all rows, read once more.
    """
    spark, rows = df.sparkSession, df.select(F.col(key).alias("id"), as_array(df, features).alias("x"))
    n_rows = rows.count()
    parts = max(1, -(-n_rows // batch_rows))
    path = f"{shared_dir(spark)}/batches-{uuid.uuid4().hex}"
    dealt = rows.select("x", F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(parts)).cast("int").alias("batch"))
    dealt.where(F.col("batch") < max_batches).repartition("batch").write.partitionBy("batch").parquet(path)
    stored_batches = spark.read.schema("x array<double>, batch int").parquet(path)
    centres = {n: np.array(c, dtype=float) for n, c in enumerate(starts.values())}
    had = {n: np.zeros(len(c)) for n, c in centres.items()}
    smooth, best, idle, read, moving = {}, {}, dict.fromkeys(centres, 0), dict.fromkeys(centres, 0), set(centres)
    weight = min(1.0, 2.0 * batch_rows / (n_rows + 1))
    for step in range(max_batches):
        if not moving:
            break
        batch = stored_batches.where(F.col("batch") == step % min(parts, max_batches))
        for n, sums in _sums(batch, {n: centres[n] for n in moving}).items():
            read[n] += 1
            count = sums[:, 0]
            if not count.sum():
                continue
            had[n] += count
            mean = sums[:, 2:] / np.maximum(count, 1)[:, None]
            centres[n] = centres[n] + (count / np.maximum(had[n], 1))[:, None] * (mean - centres[n])
            now = float(sums[:, 1].sum() / count.sum())
            smooth[n] = now if n not in smooth else smooth[n] * (1 - weight) + now * weight
            idle[n] = 0 if smooth[n] < best.get(n, np.inf) * (1 - gain) else idle[n] + 1
            best[n] = min(smooth[n], best.get(n, np.inf))
            if idle[n] >= patience:
                moving.discard(n)
    discard(spark, path)
    whole = _sums(rows, centres)
    return {name: (centres[n], float(whole[n][:, 1].sum()) if n in whole else 0.0, read[n]) for n, name in enumerate(starts)}


def nearest_centre(df: DataFrame, centres, features="features", out="cluster") -> DataFrame:
    """``df`` with the number of the nearest of some centres; a tie goes to the lowest."""
    shared = df.sparkSession.sparkContext.broadcast(np.asarray(centres))

    @F.arrow_udf("int")
    def near(x: pa.Array) -> pa.Array:
        rows = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), shared.value.shape[1])
        return pa.array(_nearest(rows, shared.value)[0], pa.int32())

    return df.withColumn(out, near(as_array(df, features)))


def elbow(df: DataFrame, k_values=tuple(ELBOW_K), features="features", seeds=(42, 43, 44), score=silhouette):
    """Inertia, silhouette and Davies-Bouldin index for each number of clusters, of the best of the seeds.

    ``score`` measures labelled rows; ``euclidean_silhouette`` of a sample goes there, too. The fits of all numbers and seeds go over the rows together.
    """
    rows, k_values = cut_lineage(df), list(k_values)
    starts = {}
    for seed in seeds:
        chosen = spread_starts(rows, max(k_values), features, seed)
        starts.update({(k, seed): chosen[:k] for k in k_values})
    fitted = lloyd_together(rows, starts, features)

    def row(k):
        centres, cost = min((fitted[k, seed] for seed in seeds), key=lambda f: f[1])
        labelled = cut_lineage(nearest_centre(rows, centres, features))
        return (
            k,
            cost,
            score(labelled, features, "cluster").first()[0],
            davies_bouldin(labelled, features, "cluster").first()[0],
        )

    table = side_by_side(df.sparkSession, row, k_values)
    schema = "k int, inertia double, silhouette_score double, davies_bouldin_index double"
    return df.sparkSession.createDataFrame(table, schema)


def best_k(elbow_rows: DataFrame) -> DataFrame:
    """The row with the highest silhouette; the smallest k on a tie."""
    return elbow_rows.orderBy(F.desc_nulls_last("silhouette_score"), "k").limit(1)


def value_ranks(df: DataFrame, c, n, cluster="cluster") -> DataFrame:
    """The ``n`` most frequent values per cluster, counted before they are ranked."""
    counts = df.where(F.col(c).isNotNull() & F.col(cluster).isNotNull()).groupBy(cluster, c).agg(
        F.count("*").alias("n")
    )
    return top_n_per_group(counts, n, cluster, "n", c)


def _value_map(df, c, n, cluster, name):
    """The ranked values and their counts as one map per cluster (n entries at most)."""
    ranked = value_ranks(df, c, n, cluster)
    return ranked.groupBy(cluster).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(c), F.col("n")))).alias(name)
    )


def cluster_means(df: DataFrame, cluster="cluster") -> DataFrame:
    """Size and means of behaviour, party shares and party amounts per cluster."""
    behaviour = ["total_donations", "total_amount", "avg_donation_amount", "recency_days",
                 "unique_committees"]
    named = {c: c if c.startswith("avg_") else f"avg_{c}" for c in behaviour}
    return df.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(
        F.count("*").alias("size"),
        *[mean(c).alias(name) for c, name in named.items()],
        mean("dem_pct").alias("avg_dem_pct"),
        mean("rep_pct").alias("avg_rep_pct"),
        *[mean(f"{p.lower()}_amount").alias(f"avg_{p.lower()}_amount") for p in PARTIES],
    )


def cluster_modes(df: DataFrame, cluster="cluster") -> DataFrame:
    """Most frequent employer, occupation, party and state per cluster, UNKNOWN if all are null."""
    names = {"employer": "avg_employer", "occupation": "avg_occupation",
             "primary_party": "dominant_party", "state": "dominant_state"}
    out = df.where(F.col(cluster).isNotNull()).select(cluster).distinct()
    for c, name in names.items():
        mode = most_frequent(df.where(F.col(cluster).isNotNull()), cluster, c)
        out = out.join(mode.withColumnRenamed(c, name), cluster, "left").withColumn(
            name, F.coalesce(name, F.lit("UNKNOWN"))
        )
    return out


def cluster_profile(df: DataFrame, cluster="cluster") -> DataFrame:
    """One nested row per cluster: demographics, behaviour, parties and places."""
    flat = cluster_means(df, cluster).join(cluster_modes(df, cluster), cluster)
    for c, n, name in (
        ("occupation", 5, "top_occupations"),
        ("state", 10, "top_states"),
        ("primary_party", len(PARTIES), "primary_party_distribution"),
    ):
        flat = flat.join(_value_map(df, c, n, cluster, name), cluster, "left")
    return flat.select(
        F.col(cluster).alias("cluster_id"),
        "size",
        F.struct("avg_employer", "avg_occupation", "top_occupations").alias("demographics"),
        F.struct(
            "avg_total_donations", "avg_total_amount", "avg_donation_amount", "avg_recency_days",
            "avg_unique_committees",
        ).alias("donation_behavior"),
        F.struct(
            "primary_party_distribution", "dominant_party", "avg_dem_pct", "avg_rep_pct",
            *[f"avg_{p.lower()}_amount" for p in PARTIES],
        ).alias("party_affiliation"),
        F.struct("top_states", "dominant_state").alias("geographic"),
    )


def profile_summary(df: DataFrame, cluster="cluster") -> DataFrame:
    """One flat row per cluster, as the summary file has it."""
    flat = cluster_means(df, cluster).join(cluster_modes(df, cluster), cluster)
    return flat.select(
        F.col(cluster).alias("cluster"), "size", "dominant_party",
        F.col("avg_total_donations").alias("avg_donations"),
        F.col("avg_total_amount").alias("avg_amount"),
        F.left("avg_occupation", F.lit(20)).alias("top_occupation"),
        F.col("dominant_state").alias("top_state"),
    )


def dominant_party_counts(summary: DataFrame) -> DataFrame:
    """Clusters per dominant party and their share, with the overall mean size."""
    overall = summary.agg(
        F.struct(F.count("*").alias("clusters"), F.avg("size").alias("mean_size")).alias("o")
    ).scalar()
    counts = summary.groupBy("dominant_party").agg(F.count("*").alias("n"))
    return counts.withColumn("_o", overall).select(
        "dominant_party", "n", (F.col("n") / F.col("_o.clusters")).alias("share"),
        F.col("_o.mean_size").alias("mean_size"),
    )


def interesting_clusters(summary: DataFrame, n=10) -> DataFrame:
    """The largest clusters, those of the highest and those of the most frequent gifts."""
    lists = [("largest", "size"), ("highest_average", "avg_amount"), ("most_frequent", "avg_donations")]
    out = None
    for name, by in lists:
        rows = top_n(summary, n, by, "cluster").select(
            F.lit(name).alias("list"), "cluster", F.col(by).cast("double").alias("value"),
            "dominant_party",
        )
        out = rows if out is None else out.unionByName(rows)
    return out
