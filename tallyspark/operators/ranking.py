"""Ranks, running sums and exact quantiles without a single-task window.

A window over a whole table, or over one hot group, runs in one task. Here the
ordered values are first cut into slices at approximate quantiles; the slices
are windowed apart from each other and shifted by the sums of the slices before
them. The cuts only balance the work: the result is exact wherever they fall.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A power of two.
SLICES = 256


def _sliced(df: DataFrame, by, value, sums, few_groups, slices=SLICES):
    """``df`` with its slice number, and per slice the sums before it and in the group.

    Without groups, or with ``few_groups``, the cuts and the slice sums are small
    by construction (``slices`` numbers per group) and are broadcast, so that no
    row is shuffled by its group alone.
    """
    small = F.broadcast if few_groups or not by else (lambda x: x)
    by = list(by)
    fractions = [i / slices for i in range(1, slices)]
    cuts = F.percentile_approx(value, fractions, 10 * slices).alias("_cuts")
    # Naming the summed columns here keeps them in this branch of the plan, so that
    # it reads the same shuffle as the others instead of computing ``df`` again.
    counted = df.where(sum(F.col(c) for c in sums) > 0)
    if by:
        cut = df.join(small(counted.groupBy(*by).agg(cuts)), by)
    else:
        cut = df.withColumn("_cuts", counted.agg(cuts).scalar())
    # The number of cuts below the value, by halving steps.
    steps = F.array(*[F.lit(slices >> i) for i in range(1, slices.bit_length())])
    place = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get("_cuts", at + step - 1) < F.col(value), at + step).otherwise(at),
    )
    sliced = cut.withColumn("_slice", place).drop("_cuts")
    # At most ``slices`` rows per group reach these two windows.
    whole = Window.partitionBy(*by)
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = sliced.groupBy(*by, "_slice").agg(*[F.sum(c).alias(c) for c in sums])
    offsets = per_slice.select(
        *by,
        "_slice",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}_offset") for c in sums],
        *[F.col(c).alias(f"_{c}_inside") for c in sums],
        *[F.sum(c).over(whole).alias(f"{c}_total") for c in sums],
    )
    return sliced, small(offsets)


def _shifted(sliced, offsets, by, value, sums):
    """Running sums inside the slices of ``offsets``, shifted by those before."""
    inside = (
        Window.partitionBy(*by, "_slice").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    out = sliced.join(offsets, [*by, "_slice"])
    for c in sums:
        out = out.withColumn(
            f"{c}_before", F.col(f"_{c}_offset") + F.coalesce(F.sum(c).over(inside), F.lit(0))
        )
    return out.drop("_slice", *[f"_{c}_{x}" for c in sums for x in ("offset", "inside")])


def running_sums(df: DataFrame, by, value, sums, few_groups=False, slices=SLICES) -> DataFrame:
    """Add ``<c>_before`` and ``<c>_total`` for every column c of ``sums``.

    ``df`` has one row per group and ``value`` (pre-aggregated, so a hot value is
    one row) and no null among them. ``_before`` adds the rows of lower value in
    the group and ``_total`` all its rows. Nothing in ``sums`` is negative. Set
    ``few_groups`` when the groups are a small fixed set (columns, classes).
    """
    by = list(by)
    sliced, offsets = _sliced(df, by, value, sums, few_groups, slices)
    return _shifted(sliced, offsets, by, value, sums)


def exact_quantiles(df: DataFrame, value, probabilities, by=(), few_groups=False) -> DataFrame:
    """Interpolated quantiles per group: one double column ``q<i>`` per probability.

    Nulls are left out. The position is p * (n - 1) and the result lies between
    the two values around it. Only the slices that hold such a value are sorted.
    """
    by = list(by)
    rows = df.where(F.col(value).isNotNull())
    counts = rows.groupBy(*by, F.col(value).cast("double").alias("_v")).agg(
        F.count("*").alias("_n")
    )

    def position(p):
        return F.lit(float(p)) * (F.col("_n_total") - 1)

    indices = [f(position(p)) for p in probabilities for f in (F.floor, F.ceil)]
    sliced, offsets = _sliced(counts, by, "_v", ["_n"], few_groups)
    end = F.col("__n_offset") + F.col("__n_inside")
    held = [(F.col("__n_offset") <= i) & (i < end) for i in indices]
    holding = offsets.where(reduce(lambda a, b: a | b, held))
    if few_groups or not by:
        holding = F.broadcast(holding)
    ranked = _shifted(sliced, holding, by, "_v", ["_n"])
    after = F.col("_n_before") + F.col("_n")
    picked = ranked.groupBy(*by).agg(
        F.max("_n_total").alias("_n_total"),
        *[F.min(F.when(after > i, F.col("_v"))).alias(f"_at{k}") for k, i in enumerate(indices)],
    )
    out = []
    for k, p in enumerate(probabilities):
        lo, hi = F.col(f"_at{2 * k}"), F.col(f"_at{2 * k + 1}")
        part = position(p) - F.floor(position(p))
        out.append((lo + (hi - lo) * part).alias(f"q{k}"))
    return picked.select(*by, *out)


def exact_median(df: DataFrame, value, by=(), name="median", few_groups=False) -> DataFrame:
    return exact_quantiles(df, value, [0.5], by, few_groups).withColumnRenamed("q0", name)


def column_medians(df: DataFrame, columns) -> DataFrame:
    """Exact median of each column, as rows (feature, median), in one pass over ``df``."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in columns])
    )
    long = df.select(pairs.alias("p")).select("p.feature", "p.v")
    return exact_median(long, "v", ["feature"], few_groups=True)


def row_rank(df: DataFrame, by, value, name="rank", few_groups=False) -> DataFrame:
    """0-based rank of each row by ``value``, which is unique within its group.

    ``<name>_of`` is the number of rows in the group.
    """
    ranked = running_sums(df.withColumn("_one", F.lit(1)), by, value, ["_one"], few_groups)
    return ranked.withColumnRenamed("_one_before", name).withColumnRenamed(
        "_one_total", f"{name}_of"
    ).drop("_one")
