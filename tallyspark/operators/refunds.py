"""Gifts of one year met by refunds of a later year."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import date_diff, from_cents, half_even, mean, refund_pct, to_cents
from ..session import one_row
from .ranking import column_medians, exact_quantiles


def donations_only(contributions):
    return contributions.where((F.col("transaction_amt") > 0) & F.col("transaction_dt").isNotNull())


def refunds_only(contributions):
    return contributions.where((F.col("transaction_amt") < 0) & F.col("transaction_dt").isNotNull())


def yearly_donations(contributions) -> DataFrame:
    return donations_only(contributions).groupBy(
        "contributor_id", "cmte_id", F.year("transaction_dt").alias("donation_year")
    ).agg(
        F.count("*").alias("donation_count"),
        F.sum("transaction_amt").alias("total_donated"),
        F.min("transaction_dt").alias("first_donation"),
        F.max("transaction_dt").alias("last_donation"),
    )


def yearly_refunds(contributions) -> DataFrame:
    return refunds_only(contributions).groupBy(
        "contributor_id", "cmte_id", F.year("transaction_dt").alias("refund_year")
    ).agg(
        F.count("*").alias("refund_count"),
        F.sum(F.abs("transaction_amt")).alias("total_refunded"),
        F.min("transaction_dt").alias("first_refund"),
        F.max("transaction_dt").alias("last_refund"),
    )


def match_years(donations: DataFrame, refunds: DataFrame, year_gap=1) -> DataFrame:
    """Join of yearly gifts and yearly refunds ``year_gap`` years later."""
    r = refunds.withColumn("donation_year", F.col("refund_year") - year_gap)
    matched = donations.join(r, ["contributor_id", "cmte_id", "donation_year"])
    return matched.withColumn("refund_pct", refund_pct("total_refunded", "total_donated"))


def cross_year_refunds(contributions, year_gap=1) -> DataFrame:
    """Gifts of year X with refunds of year X + ``year_gap``, per donor and committee.

    A refund is filed under the year its gift would have, so gifts and refunds
    meet in one grouping: one scan and one map-side combined shuffle give what
    two groupings and a join would.
    """
    day, cents = F.col("transaction_dt"), F.col("_cents")
    gift, refund = cents > 0, cents < 0
    # Plain columns for the aggregation: each is null where its row does not count.
    rows = contributions.select(
        "contributor_id", "cmte_id", "transaction_dt",
        F.when(day.isNotNull(), to_cents("transaction_amt")).alias("_cents"),
    ).select(
        "contributor_id",
        "cmte_id",
        F.when(refund, F.year(day) - year_gap).otherwise(F.year(day)).alias("donation_year"),
        F.when(gift, cents).alias("_given"),
        F.when(gift, day).alias("_given_on"),
        F.when(refund, -cents).alias("_back"),
        F.when(refund, day).alias("_back_on"),
    )
    grouped = rows.groupBy("contributor_id", "cmte_id", "donation_year").agg(
        F.count("_given").alias("donation_count"),
        F.sum("_given").alias("_donated"),
        F.min("_given_on").alias("first_donation"),
        F.max("_given_on").alias("last_donation"),
        F.count("_back").alias("refund_count"),
        F.sum("_back").alias("_refunded"),
        F.min("_back_on").alias("first_refund"),
        F.max("_back_on").alias("last_refund"),
    )
    matched = grouped.where(
        (F.col("donation_count") > 0)
        & (F.col("refund_count") > 0)
        & F.col("contributor_id").isNotNull()
        & F.col("cmte_id").isNotNull()
    )
    return matched.select(
        "contributor_id",
        "cmte_id",
        "donation_year",
        (F.col("donation_year") + year_gap).alias("refund_year"),
        "donation_count",
        from_cents("_donated").alias("total_donated"),
        "first_donation",
        "last_donation",
        "refund_count",
        from_cents("_refunded").alias("total_refunded"),
        "first_refund",
        "last_refund",
        refund_pct("_refunded", "_donated").alias("refund_pct"),
    )


def largest_refunds(patterns: DataFrame, n) -> DataFrame:
    """The ``n`` patterns with the most refunded, or all of them when ``n`` is None."""
    if n is None:
        return patterns
    return patterns.orderBy(
        F.desc("total_refunded"), "contributor_id", "cmte_id", "donation_year"
    ).limit(n)


def enrich(patterns: DataFrame, donors, committees) -> DataFrame:
    """All patterns with the details of donor and committee; ``largest_refunds`` picks some beforehand."""
    d = donors.select(
        F.col("id").alias("contributor_id"), "first_name", "last_name", "city", "state", "zip_code",
        "employer", "occupation", "primary_party",
        F.col("total_donations").alias("lifetime_donations"),
        F.col("total_amount").alias("lifetime_amount"),
    )
    c = committees.select(
        "cmte_id", F.col("cmte_nm").alias("committee_name"),
        F.col("cmte_pty_affiliation").alias("committee_party"),
        F.col("cmte_tp").alias("committee_type"), F.col("cmte_st").alias("committee_state"),
    )
    return patterns.join(d, "contributor_id", "left").join(c, "cmte_id", "left")


def refund_summary(patterns: DataFrame, contributions) -> DataFrame:
    """One row of 17 metrics.

    ``patterns`` is read several times: write it to a table (or cut its lineage)
    before when it comes from a large ledger. Full refunds are those of at least 100 percent, so they include the excess
    ones. The medians are exact.
    """
    pct = F.col("refund_pct")
    stats = patterns.agg(
        F.count("*").alias("total_patterns"),
        F.count_distinct("contributor_id").alias("unique_contributors"),
        F.count_distinct("cmte_id").alias("unique_committees"),
        F.sum("total_donated").alias("total_donated"),
        F.sum("total_refunded").alias("total_refunded"),
        mean("total_donated").alias("avg_donated"),
        mean("total_refunded").alias("avg_refunded"),
        F.avg("refund_pct").alias("avg_refund_pct"),
        F.count_if(pct >= 100).alias("full_refunds"),
        F.count_if((pct > 0) & (pct < 100)).alias("partial_refunds"),
        F.count_if(pct > 100).alias("excess_refunds"),
        F.min("donation_year").alias("min_donation_year"),
        F.max("donation_year").alias("max_donation_year"),
    )
    positive = contributions.where(F.col("transaction_amt") > 0).agg(
        F.count("*").alias("n"), F.sum("transaction_amt").alias("s")
    )
    medians = column_medians(patterns, ["total_donated", "total_refunded"])

    def median(c):
        return F.max(F.when(F.col("feature") == c, F.col("median")))

    both = medians.agg(
        median("total_donated").alias("median_donated"), median("total_refunded").alias("median_refunded")
    )
    return (
        stats.withColumns({"_m": one_row(both), "_p": one_row(positive)})
        .select(
            *stats.columns,
            "_m.*",
            F.col("_p.n").alias("total_contribution_count"),
            F.coalesce("_p.s", F.lit(0)).alias("total_contribution_amount"),
        )
    )


def refunds_by_year(patterns: DataFrame) -> DataFrame:
    return patterns.where(F.col("donation_year").isNotNull()).groupBy("donation_year").agg(
        F.count_distinct("contributor_id").alias("unique_contributors"),
        F.count_distinct("cmte_id").alias("unique_committees"),
        half_even(F.sum("total_donated")).alias("total_donated"),
        half_even(mean("total_donated")).alias("avg_donated"),
        half_even(F.sum("total_refunded")).alias("total_refunded"),
        half_even(mean("total_refunded")).alias("avg_refunded"),
        half_even(F.avg("refund_pct")).alias("avg_refund_pct"),
    )


def refunds_by_state(enriched: DataFrame) -> DataFrame:
    return (
        enriched.where(F.col("state").isNotNull())
        .groupBy("state")
        .agg(
            F.count_distinct("contributor_id").alias("unique_contributors"),
            half_even(F.sum("total_donated")).alias("total_donated"),
            half_even(F.sum("total_refunded")).alias("total_refunded"),
            half_even(F.avg("refund_pct")).alias("avg_refund_pct"),
        )
        .orderBy(F.desc("total_refunded"), "state")
    )


def refunds_by_party(enriched: DataFrame) -> DataFrame:
    return (
        enriched.where(F.col("committee_party").isNotNull())
        .groupBy("committee_party")
        .agg(
            F.count_distinct("contributor_id").alias("unique_contributors"),
            F.count_distinct("cmte_id").alias("unique_committees"),
            half_even(F.sum("total_donated")).alias("total_donated"),
            half_even(F.sum("total_refunded")).alias("total_refunded"),
            half_even(F.avg("refund_pct")).alias("avg_refund_pct"),
        )
        .orderBy(F.desc("total_refunded"), "committee_party")
    )


def with_timing(patterns: DataFrame) -> DataFrame:
    """Days from the last gift of the year to the first refund."""
    return patterns.withColumn("days_to_refund", date_diff("first_refund", "last_donation"))


def merge_timing(enriched: DataFrame, patterns: DataFrame) -> DataFrame:
    """The enriched rows with the days of their own pattern."""
    keys = ["contributor_id", "cmte_id", "donation_year"]
    return enriched.join(with_timing(patterns).select(*keys, "days_to_refund"), keys, "left")


def refund_timing(patterns: DataFrame) -> DataFrame:
    timed = with_timing(patterns)
    days = F.col("days_to_refund")
    median = exact_quantiles(timed, "days_to_refund", [0.5])
    return timed.agg(
        F.avg(days).alias("avg_days_to_refund"),
        F.min(days).alias("min_days_to_refund"),
        F.max(days).alias("max_days_to_refund"),
        *[F.count_if(days <= d).alias(f"refunds_within_{d}_days") for d in (30, 90, 180, 365)],
    ).withColumn("median_days_to_refund", median.scalar())


def refund_report(summary: DataFrame, timing: DataFrame) -> DataFrame:
    """Summary and timing in one row, with refunds as a share of all contributions."""
    share = F.col("total_refunded").cast("double") / F.col("total_contribution_amount").cast("double")
    row = summary.withColumn("refunds_pct_of_total", share * 100)
    return row.withColumn("_t", one_row(timing)).select(*row.columns, "_t.*")
