"""Donor by committee totals and the candidate views built on them."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import (
    as_date,
    date_diff,
    from_cents,
    has_flag,
    to_cents,
    within_years,
)
from ..session import broadcast_if_small


def committee_summary(committees, links, candidates) -> DataFrame:
    """One row per committee: its greatest candidate party and whether it has a candidate."""
    ca = candidates.select("cand_id", F.col("cand_pty_affiliation").alias("cand_party"))
    linked = links.select("cmte_id", "cand_id").join(ca, "cand_id")
    per_cmte = linked.groupBy("cmte_id").agg(
        F.max("cand_party").alias("cand_party"), F.max("cand_id").alias("_any")
    )
    return (
        committees.select(
            "cmte_id",
            F.col("cmte_pty_affiliation").alias("cmte_party"),
            F.col("cmte_tp").alias("cmte_type"),
            F.col("cmte_st").alias("cmte_state"),
        )
        .join(per_cmte, "cmte_id", "left")
        .withColumn("has_candidate", has_flag("_any"))
        .drop("_any")
    )


def committee_candidate(links, candidates) -> DataFrame:
    """The candidate shown for a committee: the linked one with the greatest id."""
    ca = candidates.select(
        "cand_id", "cand_name", F.col("cand_pty_affiliation").alias("cand_party"),
        "cand_office", F.col("cand_office_st").alias("cand_state"),
    )
    named = links.select("cmte_id", "cand_id").join(ca, "cand_id")
    best = named.groupBy("cmte_id").agg(F.max(F.struct(*ca.columns)).alias("_c"))
    return best.select("cmte_id", "_c.*")


def average_gap(span, n):
    """Days between gifts: the span over one less than their number, 0 for a single one."""
    return F.when(n > 1, span / (n - 1)).otherwise(F.lit(0.0))


def donor_totals(contributions, committees, links, candidates, as_of, more=None) -> DataFrame:
    """One row per donor and committee with its amounts, dates, activity and trend.

    ``more`` ({name: aggregate of transaction columns}) is added up in the same grouping; ``_copy`` then numbers the rows
    of a pair, of which there are several if its committee is listed more than once.

    ``amount_trend`` is the least-squares slope of the amount over the days (null
    when all gifts fall on one day). The committee and candidate columns are
    joined after the aggregation.
    """
    day, cents = F.col("transaction_dt"), F.col("_cents")
    # Plain columns for the aggregation. Days from a fixed day near the data keep the
    # sums behind the slope small.
    rows = contributions.select(
        "contributor_id", "cmte_id", "transaction_dt", "transaction_pgi",
        to_cents("transaction_amt").alias("_cents"), *(["transaction_amt", "sub_id"] if more else []),
    )
    tests = {
        "last_1year": within_years(day, as_of, 1),
        "last_2years": within_years(day, as_of, 2),
        "primary": F.col("transaction_pgi") == "P",
        "general": F.col("transaction_pgi") == "G",
    }
    rows = rows.select(
        "contributor_id", "cmte_id", "transaction_dt", "_cents",
        (cents / 100.0).alias("_amount"),
        F.datediff(day, F.lit("2000-01-01").cast("date")).cast("double").alias("_day"),
        *[F.when(test, 1).otherwise(0).alias(f"_n_{name}") for name, test in tests.items()],
        *[F.when(test, cents).otherwise(0).alias(f"_cents_{name}") for name, test in tests.items()],
        *(["transaction_amt", "sub_id", "transaction_pgi"] if more else []),
    )
    sums = rows.groupBy("contributor_id", "cmte_id").agg(
        F.count("*").alias("total_donations"),
        F.sum("_cents").alias("_sum"),
        F.count("_cents").alias("_count"),
        F.min("_cents").alias("_min"),
        F.max("_cents").alias("_max"),
        F.stddev_pop("_amount").alias("stddev_amount"),
        F.min("transaction_dt").alias("first_donation_date"),
        F.max("transaction_dt").alias("last_donation_date"),
        F.regr_slope("_amount", "_day").alias("amount_trend"),
        *[F.sum(f"_n_{name}").alias(f"donations_{name}") for name in tests],
        *[F.sum(f"_cents_{name}").alias(f"_sum_{name}") for name in tests],
        *[value.alias(name) for name, value in (more or {}).items()],
    ).where(F.col("cmte_id").isNotNull())
    plain = ["contributor_id", "cmte_id", "total_donations", "stddev_amount", "first_donation_date",
             "last_donation_date", "amount_trend", *[f"donations_{name}" for name in tests]]
    sums = sums.select(
        *plain,
        from_cents("_sum").alias("total_amount"),
        (F.col("_sum") / 100.0 / F.nullif(F.col("_count"), F.lit(0))).alias("avg_amount"),
        from_cents("_min").alias("min_amount"),
        from_cents("_max").alias("max_amount"),
        *[from_cents(f"_sum_{name}").alias(f"amount_{name}") for name in tests],
        *(more or {}),
    )
    span = date_diff("last_donation_date", "first_donation_date")
    sums = sums.withColumns(
        {
            "days_since_first": F.datediff(as_date(as_of), "first_donation_date"),
            "days_since_last": F.datediff(as_date(as_of), "last_donation_date"),
            "donation_span_days": span,
            "avg_days_between_donations": average_gap(span, F.col("total_donations")),
            "is_recurring": (F.col("total_donations") > 1).cast("int"),
        }
    )
    cm = committees.select(
        "cmte_id",
        F.col("cmte_nm").alias("cmte_name"),
        F.col("cmte_tp").alias("cmte_type"),
        F.col("cmte_pty_affiliation").alias("cmte_party"),
        F.col("cmte_st").alias("cmte_state"),
    )
    dims = cm.join(committee_candidate(links, candidates), "cmte_id", "left")
    if more:
        dims = dims.withColumn("_copy", F.row_number().over(Window.partitionBy("cmte_id").orderBy("cmte_name")))
    return sums.join(broadcast_if_small(dims, committees), "cmte_id", "left")


CANDIDATE_COLUMNS = [
    "contributor_id", "cmte_id", "cmte_name", "cand_id", "cand_name", "cand_party", "cand_office",
    "cand_state", "total_donations", "total_amount", "avg_amount", "first_donation_date",
    "last_donation_date", "days_since_last", "donations_last_2years", "amount_last_2years",
    "is_recurring",
]


def donor_candidate_totals(totals: DataFrame) -> DataFrame:
    """The rows of ``totals`` whose committee is linked to a candidate."""
    return totals.where(F.col("cand_id").isNotNull()).select(*CANDIDATE_COLUMNS)


def donor_candidate_summary(totals: DataFrame) -> DataFrame:
    """Per donor and candidate over all of the candidate's committees.

    A pair of donor and committee is one row of ``totals``, so counting rows
    counts committees.
    """
    return (
        totals.where(F.col("cand_id").isNotNull())
        .groupBy("contributor_id", "cand_id")
        .agg(
            F.max("cand_name").alias("cand_name"),
            F.max("cand_party").alias("cand_party"),
            F.max("cand_office").alias("cand_office"),
            F.max("cand_state").alias("cand_state"),
            F.count("cmte_id").alias("committees_donated_to"),
            F.sum("total_donations").alias("total_donations"),
            F.sum("total_amount").alias("total_amount"),
            F.avg("avg_amount").alias("avg_amount"),
            F.min("first_donation_date").alias("first_donation_date"),
            F.max("last_donation_date").alias("last_donation_date"),
            F.min("days_since_last").alias("days_since_last"),
            F.sum("donations_last_2years").alias("donations_last_2years"),
            F.sum("amount_last_2years").alias("amount_last_2years"),
            F.max("is_recurring").alias("is_recurring"),
        )
    )
