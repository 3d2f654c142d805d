"""Samples and splits that are reproducible and never rank a whole table in one task."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import PARTIES
from .ranking import row_rank

# --- Fixed values: years a date counts as valid in. ---
FIRST_VALID_YEAR, LAST_VALID_YEAR = 1980, 2030


def hash_order(key, seed):
    """A pseudo-random but reproducible order of the rows."""
    keys = [key] if isinstance(key, str) else key
    return F.xxhash64(F.lit(seed), *keys)


def shuffled_rank(df: DataFrame, key, seed, by=(), at_most=None) -> DataFrame:
    """1-based ``rank`` of every row in hash order within its group, and ``rank_of``.

    The hash is uniform, so its top bits cut each group into 4096 even slices
    that are numbered apart from each other; a hot group is just more rows in
    each slice. With ``at_most`` the slices beyond that rank are dropped before
    any row is shuffled.
    """
    by = list(by)
    rows = df.withColumn("_h", hash_order(key, seed)).withColumn(
        "_slice", F.shiftright("_h", 52)
    )
    counts = rows.groupBy(*by, "_slice").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(*by)
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *by,
        "_slice",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(whole).alias("rank_of"),
    )
    if not by:
        offsets = F.broadcast(offsets)  # 4096 rows
    placed = rows.join(offsets, [*by, "_slice"])
    if at_most is not None:
        placed = placed.where(F.col("_offset") < at_most)
    inside = Window.partitionBy(*by, "_slice").orderBy("_h", *([key] if isinstance(key, str) else key))
    placed = placed.withColumn("rank", F.col("_offset") + F.row_number().over(inside))
    if at_most is not None:
        placed = placed.where(F.col("rank") <= at_most)
    return placed.select(*df.columns, "rank", "rank_of")


def sample_rows(df: DataFrame, n, key="id", seed=42) -> DataFrame:
    """``n`` random rows, or all of them when there are fewer."""
    return shuffled_rank(df, key, seed, at_most=n).drop("rank", "rank_of")


def spread_sample(df: DataFrame, n, id_col="id", chunks=10) -> DataFrame:
    """The ``n // chunks`` lowest ids of each of ``chunks`` equal ranges of ids."""
    span = df.agg(F.struct(F.min(id_col).alias("lo"), F.max(id_col).alias("hi")).alias("s")).scalar()
    width = F.greatest(F.col("_span.hi") - F.col("_span.lo"), F.lit(1))
    steps = (F.col(id_col) - F.col("_span.lo")) * chunks + (chunks - 1)
    chunk = F.least(F.floor(steps / width), F.lit(chunks - 1))
    ranked = row_rank(
        df.withColumn("_span", span).withColumn("_chunk", chunk).drop("_span"), ["_chunk"], id_col,
        few_groups=True,
    )
    return ranked.where(F.col("rank") < n // chunks).select(*df.columns)


def modelling_cohort(donors, min_donations=1) -> DataFrame:
    """Donors the models are trained on."""
    return donors.where(
        (F.col("total_donations") >= min_donations)
        & F.col("primary_party").isin(PARTIES)
        & (F.col("total_amount") > 0)
    )


def with_valid_year(df: DataFrame) -> DataFrame:
    """Rows with a last gift in a valid year, and that year."""
    year = F.year(F.col("last_donation_date").try_cast("date"))
    return df.withColumn("last_donation_year", year).where(
        F.col("last_donation_year").between(FIRST_VALID_YEAR, LAST_VALID_YEAR)
    )


def temporal_splits(df: DataFrame, train_until=2023, val_year=2024, test_year=2025):
    """(train, val, test) by the year of the last gift."""
    rows = with_valid_year(df)
    year = F.col("last_donation_year")
    return rows.where(year <= train_until), rows.where(year == val_year), rows.where(year == test_year)


def stratified_splits(df, stratum, key="id", test_size=0.15, val_size=0.15, seed=42) -> DataFrame:
    """Adds ``split``: each stratum gives its share to test, then to val, the rest to train."""
    ranked = shuffled_rank(df, key, seed, by=[stratum])
    n_test = F.round(F.col("rank_of") * test_size)
    n_val = F.round(F.col("rank_of") * val_size)
    split = (
        F.when(F.col("rank") <= n_test, "test")
        .when(F.col("rank") <= n_test + n_val, "val")
        .otherwise("train")
    )
    return ranked.withColumn("split", split).drop("rank", "rank_of")


def shuffled_split(df: DataFrame, key, train_share=0.8, seed=42):
    """(train, test): the first share of the rows in shuffled order, and the rest."""
    ranked = shuffled_rank(df, key, seed)
    cut = F.floor(F.col("rank_of") * train_share)
    drop = ("rank", "rank_of")
    return ranked.where(F.col("rank") <= cut).drop(*drop), ranked.where(F.col("rank") > cut).drop(*drop)
