"""Registered queries on samples, features, metrics, clusters, neighbours and models."""

import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..functions.scalars import PARTIES
from ..operators import clusters, evaluate, features, knn, likelihood, models, splits, totals
from ..operators import explore as ex
from ..operators.side_by_side import side_by_side
from ..session import cut_lineage, discard, shared_dir, union_all
from ..sources import sinks
from .catalog import query
from .ledger import AS_OF, CUTOFF

TRAIN_UNTIL, VAL_YEAR, TEST_YEAR = 1999, 2000, 2001


# --- Samples and splits -----------------------------------------------------


def numbered_totals(g, rows=None):
    """Donor totals with a whole-number id, as the sampled table has one."""
    number = F.substr(F.col("cmte_id"), F.lit(2), F.lit(8)).cast("long")
    return (g.totals if rows is None else rows).withColumn("id", F.col("contributor_id") * 1000000 + number)


@query
def modelling_cohort(g):
    return splits.modelling_cohort(g.donors, 3).select("id", "primary_party", "total_amount")


@query
def temporal_splits(g):
    parts = splits.temporal_splits(g.donors, TRAIN_UNTIL, VAL_YEAR, TEST_YEAR)
    named = zip(("train", "val", "test"), parts)
    return union_all([p.select(F.lit(n).alias("split"), "id", "last_donation_year") for n, p in named])


@query
def sampled_donors(g):
    return splits.sample_rows(splits.modelling_cohort(g.donors), 500).select("id", "primary_party")


@query
def sampled_donors_facts(g):
    """Size of the sample, its different ids, and how many of them the cohort has."""
    cohort = splits.modelling_cohort(g.donors)
    sample = splits.sample_rows(cohort, 500).select("id")
    known = sample.join(cohort.select("id"), "id", "left_semi")
    return sample.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids")).withColumn(
        "members", known.agg(F.count("*")).scalar()
    )


@query
def spread_sample_pairs(g):
    return splits.spread_sample(numbered_totals(g), 5000).select("id", "total_donations")


@query
def stratified_split_counts(g):
    rows = splits.stratified_splits(splits.modelling_cohort(g.donors), "primary_party")
    return rows.groupBy("primary_party", "split").agg(F.count("*").alias("n"))


@query
def shuffled_split_counts(g):
    train, test = splits.shuffled_split(g.donors, "id")
    return train.agg(F.count("*").alias("train"), F.count_distinct("id").alias("ids")).withColumn(
        "test", test.agg(F.count("*")).scalar()
    )


# --- Features ---------------------------------------------------------------


@query
def temporal_features(g):
    rows = features.temporal_features(g.donors.drop("recency_days"), "2001-12-31")
    return rows.select(
        "id", "donor_tenure_days", "donation_frequency", "first_donation_year",
        "last_donation_year", "first_donation_month", "recency_days",
    )


@query
def behavioral_features(g):
    rows = features.behavioral_features(ex.giving(g.donors))
    return rows.select(
        "id", "party_diversity", "party_loyalty", "is_repeat_donor", "is_frequent_donor",
        "recent_activity_ratio",
    )


@query
def demographic_features(g):
    rows = features.demographic_features(features.geographic_features(g.donors), top_n=40)
    return rows.select("id", "state", "zip_prefix", "employer_grouped", "occupation_grouped")


@query
def feature_medians(g):
    _, numeric = features.feature_columns()
    rows = features.extract_features(g.donors)
    return features.column_medians(rows, numeric)


@query
def imputed_features(g):
    """Features of the last years' donors, filled with the medians of the others."""
    rows = cut_lineage(splits.with_valid_year(g.donors))
    train, rest = rows.where("last_donation_year <= 2000"), rows.where("last_donation_year > 2000")
    _, numeric = features.feature_columns()
    return features.feature_frame(rest, train).select("id", *features.CATEGORICAL, *numeric)


@query
def zip_demographics(g):
    return features.zip_demographics(g.donors)


@query
def new_donor_features(g):
    key = F.col("s_suppkey")
    newcomers = g.table("supplier").select(
        key.alias("newcomer"),
        F.lpad((key * 13 % 1200 * 83).cast("string"), 5, "0").alias("zip_code"),
        F.when(key % 4 != 0, "SA").alias("state"),
    )
    return features.new_donor_features(newcomers, g.donors).drop("zip_code", "state")


# --- Repeat-gift likelihood -------------------------------------------------


def _summary(g):
    return totals.committee_summary(g.committees, g.links, g.candidates)


def _training(g, sample_size=None):
    rows = totals.donor_totals(
        g.contributions, g.committees, g.links, g.candidates, AS_OF, likelihood.history_and_first_gift(CUTOFF)
    )
    return likelihood.training_frame(
        g.contributions, numbered_totals(g, rows), _summary(g), g.donors, g.committees, CUTOFF, sample_size
    )


@query
def label_pairs(g):
    return likelihood.label_pairs(g.totals, CUTOFF).select(
        "contributor_id", "cmte_id", "donated_after_cutoff"
    )


@query
def point_in_time_features(g):
    return likelihood.point_in_time_features(g.contributions, CUTOFF)


@query
def features_of_repeat_pairs(g):
    pairs = likelihood.label_pairs(g.totals, CUTOFF).where("donated_after_cutoff = 1")
    return likelihood.point_in_time_features(g.contributions, CUTOFF, pairs)


@query
def first_gift_after(g):
    return likelihood.first_gift_after(g.contributions, CUTOFF)


@query
def first_gift_after_by_window(g):
    return likelihood.first_gift_after_by_window(g.contributions, CUTOFF)


@query
def likelihood_training_frame(g):
    return _training(g)


@query
def likelihood_sampled_frame(g):
    return _training(g, 2000).select("contributor_id", "cmte_id", "donated_after_cutoff", "target_amount")


@query
def likelihood_model_frame(g):
    rows = cut_lineage(_training(g))
    train = rows.where(F.col("contributor_id") % 5 != 0)
    test = rows.where(F.col("contributor_id") % 5 == 0)
    return likelihood.model_frame(test, train, top_n=50).select(
        *likelihood.PAIR, *likelihood.MODEL_COLUMNS
    )


# --- Metrics ----------------------------------------------------------------


def predicted_donors(g):
    """Donors with a stand-in prediction, right for two donors of three."""
    guess = F.element_at(
        F.array(*[F.lit(p) for p in PARTIES[:5]]), (F.col("id") * 7 % 5 + 1).cast("int")
    )
    rows = g.donors.where(F.col("primary_party").isNotNull())
    amounts = {
        f"pred_{p.lower()}_amount": F.col(f"{p.lower()}_amount").cast("double")
        * (0.8 + F.col("id") % 5 / 10.0) + F.col("id") % 11
        for p in PARTIES
    }
    hit = F.when(F.col("id") % 3 != 0, F.col("primary_party")).otherwise(guess)
    return rows.withColumn("predicted", hit).withColumns(amounts)


def scored_lines(g):
    """Transactions with a class and three scores: unique, tied and clustered near 0."""
    li = g.table("lineitem")
    return li.select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_extendedprice") / 105000.0).alias("score"),
        F.col("l_discount").alias("tied_score"),
        (F.col("l_tax") * F.col("l_tax") * 100).alias("low_score"),
        "l_linestatus",
        "l_quantity",
    )


@query
def class_metrics(g):
    return evaluate.class_metrics(predicted_donors(g), "primary_party", "predicted")


@query
def weighted_metrics(g):
    return evaluate.weighted_metrics(predicted_donors(g), "primary_party", "predicted")


@query
def confusion_matrix(g):
    return evaluate.confusion_matrix(predicted_donors(g), "primary_party", "predicted", PARTIES)


@query
def simplified_party_metrics(g):
    return evaluate.simplified_party_metrics(predicted_donors(g), "primary_party", "predicted")


@query
def quality_label_metrics(g):
    return evaluate.class_metrics(g.table("labels"), "quality", "toxic")


@query
def party_class_weights(g):
    rows = g.donors.where(F.col("primary_party").isNotNull())
    return models.class_weights(rows, "primary_party")


def _roc_auc(g):
    rows = scored_lines(g)
    return evaluate.roc_auc(rows, "label", "score").select(F.lit("score").alias("name"), "auc", "support").unionByName(
        evaluate.roc_auc(rows, "label", "tied_score").select(
            F.lit("tied_score").alias("name"), "auc", "support"
        )
    )


query(_roc_auc, "roc_auc", digits=8)


def _one_vs_rest_auc(g):
    rows = predicted_donors(g)
    return evaluate.one_vs_rest_auc(
        rows, "primary_party", {p: f"pred_{p.lower()}_amount" for p in PARTIES}
    )


query(_one_vs_rest_auc, "one_vs_rest_auc", digits=8)


@query
def roc_curve(g):
    return evaluate.roc_curve(scored_lines(g), "label", "low_score")


@query
def roc_curve_unique_scores(g):
    return evaluate.roc_curve(scored_lines(g), "label", "score")


@query
def calibration(g):
    return evaluate.calibration(scored_lines(g), "label", "low_score")


@query
def score_histogram_by_class(g):
    return ex.histogram(scored_lines(g), "score", 30, by="label")


@query
def residual_histogram(g):
    rows = predicted_donors(g).withColumn(
        "residual", F.col("pred_dem_amount") - F.col("dem_amount").cast("double")
    )
    return ex.histogram(rows, "residual", 50)


@query
def amount_percentiles(g):
    from ..operators.ranking import exact_quantiles

    return exact_quantiles(scored_lines(g), "score", [0.05, 0.5, 0.95], ["label"], few_groups=True)


@query
def regression_metrics_by_party(g):
    return evaluate.regression_metrics(predicted_donors(g), "lib_amount", "pred_lib_amount", ["primary_party"])


@query
def party_amount_metrics(g):
    return evaluate.party_amount_metrics(predicted_donors(g))


def _two_models(g):
    """The stand-in predictions and a model that always answers DEM and no amount."""
    rows = predicted_donors(g)
    always = rows.withColumn("predicted", F.lit("DEM")).withColumns(
        {f"pred_{p.lower()}_amount": F.lit(0.0) for p in PARTIES}
    )
    return {"Supervised": rows, "Always DEM": always}


@query
def model_comparison(g):
    return evaluate.compare_models(_two_models(g))


@query
def amount_comparison(g):
    return evaluate.compare_amounts(_two_models(g))


@query
def other_group_amounts(g):
    return evaluate.other_group_amounts(g.donors).select("id", "other_group")


# --- Clusters ---------------------------------------------------------------


def clustered_donors(g):
    """Donors with a fixed label in the place of a fitted cluster."""
    labels = g.identities.where(F.col("id") % 83 != 0).select(
        "id", (F.col("id") * F.col("id") % 12).alias("cluster")
    )
    return clusters.with_clusters(g.donors, labels)


@query
def cluster_means(g):
    return clusters.cluster_means(clustered_donors(g))


@query
def cluster_modes(g):
    return clusters.cluster_modes(clustered_donors(g))


@query
def cluster_top_occupations(g):
    return clusters.value_ranks(clustered_donors(g), "occupation", 5)


@query
def cluster_top_states(g):
    return clusters.value_ranks(clustered_donors(g), "state", 10)


@query
def cluster_party_distribution(g):
    return clusters.value_ranks(clustered_donors(g), "primary_party", 6).drop("rank")


@query
def cluster_profile(g):
    return clusters.cluster_profile(clustered_donors(g))


@query
def cluster_profile_lists(g):
    """The ranked lists inside the nested profiles, one row per entry."""
    profile = clusters.cluster_profile(clustered_donors(g))
    out = None
    for name, column in (
        ("occupation", "demographics.top_occupations"),
        ("state", "geographic.top_states"),
        ("party", "party_affiliation.primary_party_distribution"),
    ):
        rows = profile.select("cluster_id", "size", F.lit(name).alias("list"), F.explode(column).alias("value", "n"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def cluster_summary(g):
    return clusters.profile_summary(clustered_donors(g))


@query
def dominant_party_counts(g):
    return clusters.dominant_party_counts(clusters.profile_summary(clustered_donors(g)))


@query
def interesting_clusters(g):
    return clusters.interesting_clusters(clusters.profile_summary(clustered_donors(g)), 5)


@query
def cluster_quality(g):
    return clusters.cluster_quality(g.table("embeddings"), "embedding", "label")


def _davies_bouldin(g):
    return clusters.davies_bouldin(g.table("embeddings"), "embedding", "label")


query(_davies_bouldin, "davies_bouldin", digits=6)


def _silhouette(g):
    return clusters.silhouette(g.table("embeddings"), "embedding", "label")


query(_silhouette, "silhouette", digits=6)


def _euclidean_silhouette(g):
    """Every twentieth vector against all vectors."""
    rows = g.table("embeddings")
    return clusters.euclidean_silhouette(rows, "embedding", "label", rows.where("vec_id % 20 = 0"), "vec_id")


query(_euclidean_silhouette, "euclidean_silhouette", digits=6)


def vectors(g):
    to_double = F.transform("embedding", lambda x: x.cast("double"))
    return g.table("embeddings").select(
        F.col("vec_id").alias("id"), "label", array_to_vector(to_double).alias("features")
    )


@query
def kmeans_clusters(g):
    rows = vectors(g)
    model = clusters.fit_kmeans(rows, 10)
    return clusters.assign_clusters(model, rows)[0]


@query
def kmeans_facts(g):
    """Rows, and those that another centre than their cluster's is nearer to."""
    rows = vectors(g)
    model = clusters.fit_kmeans(rows, 10)
    centres = [F.array(*[F.lit(float(v)) for v in c]) for c in model.clusterCenters()]
    x = vector_to_array("features")

    def square(c):
        return F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)

    far = F.array(*[square(c) for c in centres])
    marked = model.transform(rows).withColumn("_d", far)
    own = F.element_at("_d", F.col("cluster") + 1)
    return marked.agg(
        F.count("*").alias("rows"), F.count_if(own > F.array_min("_d") + 1e-9).alias("misplaced"), F.lit(len(centres)).alias("centres")
    )


@query
def mini_batch_facts(g):
    """Rows, and whether mini-batches come within 5 % of the cost of Lloyd's steps from the same start."""
    rows = g.table("embeddings")
    start = {10: clusters.spread_starts(rows, 10, "embedding", key="vec_id")}
    cost = clusters.mini_batches_together(rows, start, "embedding", "vec_id")[10][1]
    least = clusters.lloyd_together(rows, start, "embedding")[10][1]
    return rows.agg(F.count("*").alias("rows"), F.lit(int(cost <= 1.05 * least)).cast("long").alias("near_lloyd"))


@query
def fitted_segments(g):
    """Donors segmented by K-means on the clustering features, from splits to profiles."""
    (train, *others), _ = features.prepare(*_model_splits(g), features.CLUSTERING)
    model = clusters.fit_kmeans(train, 8)
    assigned = union_all([
        a.withColumn("split", F.lit(name))
        for name, a in zip(("train", "val", "test"), clusters.assign_clusters(model, train, *others))
    ])
    assigned = cut_lineage(assigned)
    segments = clusters.with_clusters(g.donors, assigned.drop("split"))
    profiled = clusters.cluster_profile(segments).agg(F.sum("size")).scalar()
    counts = assigned.where("cluster between 0 and 7").groupBy("split").agg(F.count("*").alias("n"))
    return counts.withColumn("profiled", profiled)


@query
def kmeans_elbow(g):
    return clusters.elbow(vectors(g))


# --- Neighbours -------------------------------------------------------------


def _exact_knn(g):
    e = g.table("embeddings")
    return knn.exact_knn(e, e, 20, "vec_id", "embedding")


def _cluster_knn(g):
    e = g.table("embeddings")
    return knn.knn_within_clusters(e, e, "label", 5, "vec_id", "embedding", exclude_self=True)


query(_exact_knn, "exact_knn", digits=8)
query(_cluster_knn, "knn_within_clusters", digits=8)


@query
def approximate_knn(g):
    e = g.table("embeddings")
    return knn.approximate_knn(e, e, 20, 1, "vec_id", "embedding")


@query
def approximate_knn_rows(g):
    """Neighbours and their different ids per query."""
    e = g.table("embeddings")
    found = knn.approximate_knn(e, e, 20, 1, "vec_id", "embedding")
    return found.groupBy("query_id").agg(F.count("*").alias("n"), F.count_distinct("neighbor_id").alias("ids"))


@query
def approximate_knn_recall(g):
    e = g.table("embeddings")
    truth = knn.exact_knn(e, e, 10, "vec_id", "embedding")
    return knn.recall(knn.approximate_knn(e, e, 10, 8, "vec_id", "embedding"), truth)


@query
def neighbor_votes(g):
    e = g.table("embeddings")
    found = knn.exact_knn(e, e, 15, key="vec_id", features="embedding", exclude_self=True)
    facts = e.withColumn("amount", F.col("vec_id") * 3 % 101 * 1.0)
    return knn.neighbor_votes(found, facts, "vec_id", "label", ["amount"])


# --- Models -----------------------------------------------------------------


def _model_splits(g):
    """Stratified splits of the cohort (nearly all stand-in donors give in the last year)."""
    rows = cut_lineage(splits.stratified_splits(splits.modelling_cohort(g.donors), "primary_party"))
    return [rows.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")]


@query
def party_model_comparison(g):
    """Logistic regression, forest, boosting and SVM at their defaults, on all features and on demographics only."""

    def of(kind):
        (train, val, _), _ = features.prepare(*_model_splits(g), kind)
        return models.party_classifiers(train, val, models.default_party_classifiers(train.count()))[1]

    kinds = {"full": features.FULL, "demo": features.DEMOGRAPHIC}
    tables = dict(zip(kinds, side_by_side(g.spark, lambda name: of(kinds[name]), kinds)))
    return union_all([t.withColumn("features", F.lit(name)) for name, t in tables.items()])


@query
def kernel_svm_metrics(g):
    """The SVM alone, and the share of the kernel that its landmarks leave unexplained."""
    (train, val, _), _ = features.prepare(*_model_splits(g))
    fitted, metrics = models.party_classifiers(train, val, {"Support Vector Machine": models.KernelSvm()})
    return metrics.withColumn("unexplained", F.lit(fitted["Support Vector Machine"].unexplained))


@query
def amount_model_comparison(g):
    """Ridge, forest and boosting for each party at their defaults, with stage-one probabilities as features."""
    (train, val, _), _ = features.prepare(*_model_splits(g))
    stage1, _ = models.party_classifiers(train, val, {"Logistic Regression": models.logistic(train.count())})
    party = stage1["Logistic Regression"]
    rows = [
        models.with_party_probabilities(df, party).select(
            F.col("stage2_features").alias("features"), *[F.col(c).cast("double").alias(c) for c in features.PARTY_AMOUNTS]
        )
        for df in (train, val)
    ]
    return models.all_amount_models(*rows)[1]


@query
def saved_party_models(g):
    """Each classifier saved, loaded and used again: rows of val, and those whose prediction or probability differs."""
    (train, val, _), _ = features.prepare(*_model_splits(g))
    made = {
        "Logistic Regression": models.logistic(train.count()), "Random Forest": models.forest_classifier(trees=20),
        "Gradient Boosting": models.boosted_classifier(trees=5), "Support Vector Machine": models.KernelSvm(size=64),
    }
    fitted, metrics = models.party_classifiers(train, val, made)
    held = cut_lineage(val)
    folder, tables = f"{shared_dir(g.spark)}/models-{uuid.uuid4().hex}", []
    for number, (name, model) in enumerate(fitted.items()):
        path = f"{folder}/{number}"
        sinks.save_model(PipelineModel(stages=[model]), metrics.where(F.col("model_name") == name), path, name=name)
        again, saved, facts = sinks.load_model(g.spark, path)
        both = again.transform(held).select("id", F.col("prediction").alias("p2"), vector_to_array("probability").alias("a2"))
        both = model.transform(held).select("id", "prediction", vector_to_array("probability").alias("a")).join(both, "id")
        apart = F.exists(F.zip_with("a", "a2", lambda x, y: ~x.eqNullSafe(y)), lambda x: x)
        tables.append(both.agg(F.count("*").alias("rows"), F.count_if((F.col("prediction") != F.col("p2")) | apart).alias("differing")).select(
            F.lit(facts["name"]).alias("model_name"), "rows", "differing", F.lit(saved.count()).alias("metric_rows"),
        ))
    out = cut_lineage(union_all(tables))
    discard(g.spark, folder)
    return out


def _likelihood_sets(g):
    rows = cut_lineage(_training(g))
    train, test = splits.shuffled_split(rows, ["contributor_id", "cmte_id"])
    encoded = [cut_lineage(likelihood.model_frame(df, train)) for df in (train, test)]
    scaler = models.likelihood_scaler(train.count()).fit(encoded[0])
    return train, scaler, [scaler.transform(df) for df in encoded]


@query
def forest_stages(g):
    _, _, (train, test) = _likelihood_sets(g)
    return models.forest_stages(train, cut_lineage(test))


@query
def likelihood_importance(g):
    _, _, (train, _) = _likelihood_sets(g)
    rows = cut_lineage(models.balanced(train, "donated_after_cutoff"))
    forest = models.likelihood_forest().fit(rows)
    return models.importance_frame(g.spark, forest, likelihood.MODEL_COLUMNS)


@query
def scored_pairs(g):
    """All labelled pairs and as many without any history."""
    raw, scaler, (train, _) = _likelihood_sets(g)
    forest, boosted = models.likelihood_models(train)
    known = likelihood.label_pairs(g.totals, CUTOFF).select(*likelihood.PAIR)
    unknown = known.select((F.col("contributor_id") + 10**9).alias("contributor_id"), "cmte_id")
    return models.score_pairs(
        known.unionByName(unknown), g.contributions, _summary(g), g.donors, g.committees, CUTOFF,
        raw, scaler, forest, boosted,
    )
