"""Metrics as aggregations of predicted rows."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import simplify_party
from ..session import union_all
from .ranking import running_sums

# --- Fixed values. ---
SIMPLE_PARTIES = ["DEM", "REP", "OTHER"]
OTHER_PARTIES = ["LIB", "GRE", "IND", "OTHER"]
CALIBRATION_EDGES = [i * 0.1 for i in range(11)]
# --- End of fixed values. ---


def pair_counts(df: DataFrame, truth, predicted) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def confusion_matrix(df: DataFrame, truth, predicted, labels) -> DataFrame:
    """One row per true label, one column per predicted one, in the given order."""
    counts = pair_counts(df, truth, predicted).groupBy("truth").pivot("predicted", labels).agg(F.sum("n"))
    spine = df.sparkSession.createDataFrame([(x,) for x in labels], "truth string")
    names = [str(x) for x in labels]
    return spine.join(counts, "truth", "left").fillna(0, subset=names)


def _ratio(a, b):
    """a / b, 0 when b is 0."""
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def class_metrics(df: DataFrame, truth, predicted) -> DataFrame:
    """Precision, recall, F1 and support of every label in truth or prediction."""
    counts = pair_counts(df, truth, predicted)
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)
    real = counts.select(F.col("truth").alias("label"), hit.alias("tp"), F.col("n").alias("support"),
                         F.lit(0).cast("bigint").alias("called"))
    said = counts.select(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("tp"),
                         F.lit(0).cast("bigint").alias("support"), F.col("n").alias("called"))
    sums = real.unionByName(said).groupBy("label").agg(
        *[F.sum(c).alias(c) for c in ("tp", "support", "called")]
    )
    precision, recall = _ratio(F.col("tp"), F.col("called")), _ratio(F.col("tp"), F.col("support"))
    both = precision + recall
    return sums.select(
        "label",
        precision.alias("precision"),
        recall.alias("recall"),
        F.when(both > 0, 2 * precision * recall / both).otherwise(0.0).alias("f1"),
        "support",
        "tp",
    )


def weighted_metrics(df: DataFrame, truth, predicted) -> DataFrame:
    """Accuracy and the support-weighted precision, recall and F1, in one row."""
    per_class = class_metrics(df, truth, predicted)
    total = F.sum("support")
    return per_class.agg(
        (F.sum("tp") / total).alias("accuracy"),
        *[
            (F.sum(F.col(m) * F.col("support")) / total).alias(f"{m}_weighted")
            for m in ("precision", "recall", "f1")
        ],
    )


def simplified_party_metrics(df: DataFrame, truth, predicted) -> DataFrame:
    """Class metrics after all but DEM and REP are counted as OTHER."""
    three = df.select(simplify_party(truth).alias("t"), simplify_party(predicted).alias("p"))
    spine = df.sparkSession.createDataFrame([(x,) for x in SIMPLE_PARTIES], "label string")
    metrics = class_metrics(three, "t", "p").drop("tp")
    return spine.join(metrics, "label", "left").fillna(0, ["precision", "recall", "f1", "support"])


def _score_counts(df, label, score, by=()):
    """Positives and negatives per distinct score: what all rank metrics need."""
    positive = F.col(label) == 1
    return df.where(F.col(score).isNotNull()).groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )


def roc_auc(df: DataFrame, label, score, by=()) -> DataFrame:
    """Exact area under the ROC curve; tied scores count half.

    Null when a group has one class only. ``by`` is a column of few values, such
    as the class.
    """
    counts = _score_counts(df, label, score, by)
    ranked = running_sums(counts, by, "score", ["pos", "neg"], few_groups=True)
    area = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    return ranked.groupBy(*by).agg(
        (area / F.nullif(pairs, F.lit(0.0))).alias("auc"), F.max("pos_total").alias("support")
    )


def one_vs_rest_auc(df: DataFrame, truth, scores) -> DataFrame:
    """AUC of every class against the rest and, by ``weighted``, their weighted mean.

    ``scores`` maps each class to the column with its score.
    """
    entries = F.explode(
        F.array(*[
            F.struct(F.lit(k).alias("class"), F.col(c).cast("double").alias("score"),
                     (F.col(truth) == k).cast("int").alias("is_class"))
            for k, c in scores.items()
        ])
    )
    long = df.select(entries.alias("e")).select("e.*")
    per_class = roc_auc(long, "is_class", "score", ["class"])
    weighted = per_class.agg(
        F.lit("weighted").alias("class"),
        (F.sum(F.col("auc") * F.col("support")) / F.sum("support")).alias("auc"),
        F.sum("support").alias("support"),
    )
    return per_class.unionByName(weighted)


def roc_curve(df: DataFrame, label, score) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score; a row is called at score >= threshold."""
    ranked = running_sums(_score_counts(df, label, score), (), "score", ["pos", "neg"])
    return ranked.select(
        F.col("score").alias("threshold"),
        ((F.col("neg_total") - F.col("neg_before")) / F.col("neg_total")).alias("fpr"),
        ((F.col("pos_total") - F.col("pos_before")) / F.col("pos_total")).alias("tpr"),
    )


def regression_metrics(df: DataFrame, truth, predicted, by=()) -> DataFrame:
    """MAE, RMSE, R2 and MAPE per group, over all rows and over positive targets.

    ``mape`` is over targets that are not 0 (infinite when there is none) and
    ``mape_positive`` over positive ones. A group without a positive target has
    nulls in all but its count and ``mape``.
    """
    y, p = F.col(truth).cast("double"), F.col(predicted).cast("double")

    def block(test, suffix):
        def only(c):
            return c if test is None else F.when(test, c)

        n = F.count(only(y))
        squares = F.sum(only((y - p) * (y - p)))
        spread = F.var_pop(only(y)) * n
        r2 = F.when(spread > 0, 1 - squares / spread).otherwise(F.when(squares == 0, 1.0).otherwise(0.0))
        return [
            F.avg(only(F.abs(y - p))).alias(f"mae{suffix}"),
            F.sqrt(squares / F.nullif(n, F.lit(0))).alias(f"rmse{suffix}"),
            r2.alias(f"r2{suffix}"),
        ]

    # The divisor is null where the row is not counted, as the branch may still be evaluated.
    share = F.abs((y - p) / F.nullif(y, F.lit(0.0)))
    out = df.groupBy(*by).agg(
        F.count(y).alias("n"),
        F.count_if(y > 0).alias("n_positive"),
        *block(None, ""),
        *block(y > 0, "_nonzero"),
        F.coalesce(F.avg(F.when(y != 0, share)) * 100, F.lit(float("inf"))).alias("mape"),
        (F.avg(F.when(y > 0, share)) * 100).alias("mape_positive"),
    )
    always = {*by, "n", "n_positive", "mape"}
    return out.select(
        *[c if c in always else F.when(F.col("n_positive") > 0, F.col(c)).alias(c) for c in out.columns]
    )


def other_group_amounts(df: DataFrame, prefix="", suffix="_amount", out="other_group") -> DataFrame:
    """Adds the sum of the amounts of all parties but DEM and REP."""
    parts = [F.col(f"{prefix}{p.lower()}{suffix}") for p in OTHER_PARTIES]
    return df.withColumn(out, reduce(lambda a, b: a + b, parts))


def calibration(df: DataFrame, label, score) -> DataFrame:
    """Mean score, actual rate and count in ten bins of the score.

    An empty bin shows its middle, 0 and 0.
    """
    x = F.col(score).cast("double")
    place = reduce(
        lambda a, b: a + b, [(x >= F.lit(edge)).cast("int") for edge in CALIBRATION_EDGES[1:10]]
    )
    sums = df.where(x.isNotNull()).groupBy(place.alias("bin")).agg(
        F.avg(x).alias("s"), F.avg(F.col(label).cast("double")).alias("r"), F.count("*").alias("c")
    )
    bins = df.sparkSession.createDataFrame(
        [(i, (CALIBRATION_EDGES[i] + CALIBRATION_EDGES[i + 1]) / 2) for i in range(10)],
        "bin int, middle double",
    )
    return bins.join(sums, "bin", "left").select(
        "bin",
        F.coalesce("s", "middle").alias("mean_score"),
        F.coalesce("r", F.lit(0.0)).alias("actual_rate"),
        F.coalesce("c", F.lit(0)).alias("n"),
    )


def best_model(metrics: DataFrame, by, highest=True) -> DataFrame:
    """The row with the best value; ties go to the first model name."""
    order = F.desc_nulls_last(by) if highest else F.asc_nulls_last(by)
    return metrics.orderBy(order, "model_name").limit(1)


def party_amount_metrics(df: DataFrame, predicted_prefix="pred_") -> DataFrame:
    """Regression metrics for DEM, REP and the rolled-up OTHER amounts, one row each."""
    rows = other_group_amounts(df, out="_true_other")
    rows = other_group_amounts(rows, predicted_prefix, out="_pred_other")
    entries = [
        ("DEM", "dem_amount", f"{predicted_prefix}dem_amount"),
        ("REP", "rep_amount", f"{predicted_prefix}rep_amount"),
        ("OTHER", "_true_other", "_pred_other"),
    ]
    long = F.explode(
        F.array(*[
            F.struct(F.lit(k).alias("party"), F.col(t).cast("double").alias("t"),
                     F.col(p).cast("double").alias("p"))
            for k, t, p in entries
        ])
    )
    return regression_metrics(rows.select(long.alias("e")).select("e.*"), "t", "p", ["party"])


def compare_models(predictions, truth="primary_party", predicted="predicted") -> DataFrame:
    """One row per model: accuracy and weighted metrics over DEM, REP and OTHER.

    ``predictions`` maps the model's name to its predicted rows.
    """
    tables = []
    for name, df in predictions.items():
        three = df.select(simplify_party(truth).alias("t"), simplify_party(predicted).alias("p"))
        tables.append(weighted_metrics(three, "t", "p").select(F.lit(name).alias("model_name"), "*"))
    return union_all(tables)


def compare_amounts(predictions, predicted_prefix="pred_") -> DataFrame:
    """One row per model and party with the regression metrics of the amounts."""
    return union_all([
        party_amount_metrics(df, predicted_prefix).select(F.lit(name).alias("model_name"), "*")
        for name, df in predictions.items()
    ])
