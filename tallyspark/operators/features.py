"""Donor features, fitted on the training rows and applied to any others."""

import math
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    ElementwiseProduct,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (
    PARTIES,
    clean_category,
    date_diff,
    fill_unknown,
    mean,
    recency_days,
    zip_prefix,
)
from ..session import cut_lineage
from .explore import top_n_per_group
from .ranking import column_medians

# --- Fixed values: the feature columns, in order, and the entropy offset. ---
CATEGORICAL = ["state", "zip_prefix", "employer_grouped", "occupation_grouped"]
HISTORY = [
    "total_donations", "total_amount", "avg_donation_amount", "donations_last_2years",
    "amount_last_2years", "recency_days", "donor_tenure_days", "donation_frequency",
    "unique_committees", "party_diversity", "party_loyalty", "is_repeat_donor",
    "is_frequent_donor", "recent_activity_ratio", "first_donation_year", "last_donation_year",
    "first_donation_month",
]
ENTROPY_EPSILON = 1e-10
# --- End of fixed values. ---
PARTY_COUNTS = [f"{p.lower()}_donations" for p in PARTIES]
PARTY_AMOUNTS = [f"{p.lower()}_amount" for p in PARTIES]


def feature_columns(include_history=True, include_party_amounts=False):
    """(categorical, numeric) column names of a feature set."""
    numeric = HISTORY + PARTY_COUNTS if include_history else []
    return CATEGORICAL, numeric + (PARTY_AMOUNTS if include_party_amounts else [])


def temporal_features(df: DataFrame, as_of=None) -> DataFrame:
    first = F.col("first_donation_date").try_cast("date")
    last = F.col("last_donation_date").try_cast("date")
    tenure = date_diff(last, first)
    frequency = F.col("total_donations") / (tenure / 365.25 + 1)
    new = {
        "donor_tenure_days": F.coalesce(tenure, F.lit(0)),
        "donation_frequency": F.coalesce(frequency, F.lit(0.0)),
        "first_donation_year": F.year(first),
        "last_donation_year": F.year(last),
        "first_donation_month": F.month(first),
    }
    if "recency_days" not in df.columns:
        new["recency_days"] = recency_days(last, as_of)
    return df.withColumns(new)


def behavioral_features(df: DataFrame) -> DataFrame:
    """Party diversity (entropy in bits), loyalty, repeat flags, recent share.

    A party whose net amount is negative has no logarithm and adds nothing.
    """
    amounts = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in PARTY_AMOUNTS]
    total = sum(amounts[1:], amounts[0])
    df = df.withColumn("_total", F.when(total == 0, 1.0).otherwise(total))
    bits = F.lit(0.0)
    for amount in amounts:
        share = amount / F.col("_total") + ENTROPY_EPSILON
        bits = bits + F.coalesce(F.when(share > 0, share * F.log2(share)), F.lit(0.0))
    df = df.withColumn("party_diversity", -bits).drop("_total")
    n, total_amount = F.col("total_donations"), F.col("total_amount").cast("double")
    return df.withColumns(
        {
            "party_loyalty": 1 - F.col("party_diversity") / math.log2(len(PARTIES)),
            "is_repeat_donor": (n > 1).cast("int"),
            "is_frequent_donor": (n >= 5).cast("int"),
            "recent_activity_ratio": F.col("amount_last_2years").cast("double")
            / F.nullif(total_amount + 1, F.lit(0.0)),
        }
    )


def geographic_features(df: DataFrame) -> DataFrame:
    return df.withColumns({"zip_prefix": zip_prefix("zip_code"), "state": fill_unknown("state")})


def top_categories(df: DataFrame, columns, n=100) -> DataFrame:
    """The ``n`` most frequent values of each column, as rows (column, value).

    Ties go to the first in alphabetical order. All columns are counted in one
    pass, and ``n`` rows per column and task are ranked.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    )
    counts = (
        df.select(pairs.alias("p")).select("p.*").where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count("*").alias("n"))
    )
    return top_n_per_group(counts, n, "column", "n", "value").select("column", "value")


def group_rare(df: DataFrame, c, top: DataFrame, out) -> DataFrame:
    """``out`` is ``c`` where it is one of the ``top`` values, else OTHER.

    ``top`` comes from ``top_categories``, so the broadcast side has at most its
    ``n`` rows.
    """
    values = top.where(F.col("column") == c)
    kept = F.broadcast(values.select(F.col("value").alias(c), F.lit(True).alias("_kept")))
    grouped = F.when(F.col("_kept"), F.col(c)).otherwise("OTHER")
    joined = df.join(kept, c, "left").withColumn(out, grouped)
    return joined.drop("_kept")


def clean_demographics(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"employer": clean_category("employer"), "occupation": clean_category("occupation")}
    )


def demographic_features(df: DataFrame, fit_on=None, top_n=100) -> DataFrame:
    """Employer and occupation with all but the ``top_n`` values of ``fit_on`` as OTHER."""
    df = clean_demographics(df)
    source = df if fit_on is None else clean_demographics(fit_on)
    top = top_categories(source, ["employer", "occupation"], top_n)
    for c in ("employer", "occupation"):
        df = group_rare(df, c, top, f"{c}_grouped")
    return df


def impute_medians(df: DataFrame, medians: DataFrame, columns) -> DataFrame:
    """Null numbers become the median of their column; ``columns`` become doubles."""
    table = medians.agg(F.map_from_entries(F.collect_list(F.struct("feature", "median"))))
    with_medians = df.withColumn("_m", table.scalar())
    return with_medians.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.col("_m")[c]) for c in columns}
    ).drop("_m")


def extract_features(df, fit_on=None, include_history=True, top_n=100, as_of=None) -> DataFrame:
    """All feature columns, without imputation."""
    out = demographic_features(geographic_features(df), fit_on, top_n)
    return behavioral_features(temporal_features(out, as_of)) if include_history else out


@dataclass
class FeatureSet:
    """What a set is made of; ``scope`` is where categories and medians come from."""

    include_history: bool = True
    include_party_amounts: bool = False
    scope: str = "train"
    top_n: int = 100


FULL = FeatureSet()
DEMOGRAPHIC = FeatureSet(include_history=False)
CLUSTERING = FeatureSet(include_party_amounts=True)


def feature_frame(df, train, kind: FeatureSet = FULL) -> DataFrame:
    """Imputed feature columns of ``df``; top values and medians are those of ``train``.

    With ``scope='per_split'`` they are those of ``df`` itself.
    """
    source = train if kind.scope == "train" else df
    _, numeric = feature_columns(kind.include_history, kind.include_party_amounts)
    out = extract_features(df, source, kind.include_history, kind.top_n)
    if not numeric:
        return out
    fitted = extract_features(source, source, kind.include_history, kind.top_n)
    return impute_medians(out, column_medians(fitted, numeric), numeric)


def encoder(kind: FeatureSet, n_train) -> Pipeline:
    """One-hot categories and standardised numbers as one vector ``features``.

    A category not seen in training gives zeros. Numbers are divided by the
    population deviation: MLlib divides by the sample one, so its result is
    multiplied by sqrt(n / (n - 1)).
    """
    categorical, numeric = feature_columns(kind.include_history, kind.include_party_amounts)
    stages = [
        StringIndexer(
            inputCols=categorical, outputCols=[f"{c}_ix" for c in categorical],
            handleInvalid="keep", stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(
            inputCols=[f"{c}_ix" for c in categorical], outputCols=[f"{c}_hot" for c in categorical]
        ),
    ]
    parts = [f"{c}_hot" for c in categorical]
    if numeric:
        grow = math.sqrt(n_train / (n_train - 1)) if n_train > 1 else 1.0
        stages += [
            VectorAssembler(inputCols=numeric, outputCol="_numbers"),
            StandardScaler(inputCol="_numbers", outputCol="_sample_scaled", withMean=True, withStd=True),
            ElementwiseProduct(
                inputCol="_sample_scaled", outputCol="_scaled", scalingVec=[grow] * len(numeric)
            ),
        ]
        parts.append("_scaled")
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=parts, outputCol="features")])


def prepare(train, val, test, kind: FeatureSet = FULL):
    """(train, val, test) with a ``features`` vector, and the encoder fitted on train.

    The feature rows are written out once: the encoder and every model fitted on
    them read them many times.
    """
    train = cut_lineage(train)
    frames = [cut_lineage(feature_frame(df, train, kind)) for df in (train, val, test)]
    model = encoder(kind, train.count()).fit(frames[0])
    return [model.transform(f) for f in frames], model


def zip_demographics(donors: DataFrame) -> DataFrame:
    """Per three-digit zip: mean gift, mean count, party shares, most frequent party."""
    rows = donors.where(F.col("zip_code").isNotNull()).withColumn("zip3", F.left("zip_code", F.lit(3)))
    means = rows.groupBy("zip3").agg(
        mean("avg_donation_amount").alias("avg_donation"),
        mean("total_donations").alias("avg_donations_count"),
        mean("dem_pct").alias("dem_pct"),
        mean("rep_pct").alias("rep_pct"),
    )
    return means.join(most_frequent(rows, "zip3", "primary_party"), "zip3", "left")


def most_frequent(df: DataFrame, group, c) -> DataFrame:
    """The most frequent value of ``c`` per group; ties go to the lowest value.

    Counted per group and value first, so no value list is ever held in one row.
    """
    counts = df.where(F.col(c).isNotNull()).groupBy(group, c).agg(F.count("*").alias("_n"))
    best = counts.groupBy(group).agg(F.min(F.struct(-F.col("_n"), F.col(c).alias("v"))).alias("_b"))
    return best.select(group, F.col("_b.v").alias(c))


def new_donor_features(newcomers: DataFrame, donors: DataFrame) -> DataFrame:
    """Cold-start rows (zip_code, state) with the statistics of their zip area.

    An area without donors takes 0 gifts, even party shares and DEM.
    """
    stats = zip_demographics(donors)
    rows = newcomers.withColumn("zip3", F.left("zip_code", F.lit(3)))
    zero, half = F.lit(0.0), F.lit(0.5)
    joined = rows.join(stats.withColumn("_known", F.lit(True)), "zip3", "left")
    known = F.col("_known")
    return joined.select(
        *newcomers.columns,
        fill_unknown("state").alias("state_known"),
        fill_unknown("zip3").alias("zip_prefix"),
        F.lit("UNKNOWN").alias("employer_grouped"),
        F.lit("UNKNOWN").alias("occupation_grouped"),
        F.when(known, F.col("avg_donation")).otherwise(zero).alias("avg_donation_amount"),
        F.when(known, F.col("avg_donations_count")).otherwise(zero).alias("total_donations"),
        F.when(known, F.col("dem_pct")).otherwise(half).alias("dem_pct"),
        F.when(known, F.col("rep_pct")).otherwise(half).alias("rep_pct"),
        F.when(known, F.coalesce("primary_party", F.lit("DEM"))).otherwise("DEM").alias("primary_party"),
    )
