"""Roll-ups of donors, transactions and committees.

Donor roll-ups take rows with a positive total, as ``giving`` selects them.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import (
    JUNK_EMPLOYERS,
    JUNK_OCCUPATIONS,
    PARTIES,
    SEGMENTS,
    committee_type_label,
    date_diff,
    donor_segment,
    donor_type,
    election_cycle,
    frequency_category,
    log10_clip,
    mean,
    party_group,
    party_label,
)
from ..session import one_row
from .ranking import exact_quantiles


def giving(donors):
    return donors.where(F.col("total_amount") > 0)


def top_n(df: DataFrame, n, by, tie) -> DataFrame:
    """The ``n`` rows with the greatest ``by``; ties go to the lowest ``tie``."""
    return df.orderBy(F.desc(by), F.asc(tie)).limit(n)


def top_n_per_group(df: DataFrame, n, group, by, tie) -> DataFrame:
    """The ``n`` best rows of each group, numbered by ``rank``.

    Spark keeps ``n`` rows per group and task before it shuffles.
    """
    order = Window.partitionBy(group).orderBy(F.desc(by), F.asc(tie))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def summary_statistics(donors) -> DataFrame:
    return giving(donors).agg(
        F.count("*").alias("total_contributors"),
        F.sum("total_amount").alias("total_donated"),
        mean("total_amount").alias("avg_total_per_contributor"),
        F.sum("total_donations").alias("total_transactions"),
        mean("total_donations").alias("avg_donations_per_contributor"),
        mean("avg_donation_amount").alias("avg_donation_amount"),
    )


def distribution_points(donors) -> DataFrame:
    """Donation count, log amount and party group of every giving donor."""
    return giving(donors).select(
        "id",
        "total_donations",
        log10_clip("total_amount").alias("log_amount"),
        party_group("primary_party").alias("party_group"),
    )


def histogram(df: DataFrame, value, bins, by=None) -> DataFrame:
    """Equal-width bins over [min, max] of ``value``, the last one closed.

    Empty bins are listed with 0. With ``by`` every group has bins over its own
    range. When all values are equal the range is half a unit to both sides.
    """
    x = F.col(value).cast("double")
    rows = df.where(x.isNotNull())
    lo, hi = F.min(x), F.max(x)
    limits = (
        F.when(lo == hi, lo - 0.5).otherwise(lo).alias("lo"),
        F.when(lo == hi, hi + 0.5).otherwise(hi).alias("hi"),
    )
    keys = [by] if by else []
    spine = F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    if by:
        rows = rows.where(F.col(by).isNotNull())
        ranges = rows.groupBy(by).agg(*limits)
        placed = rows.join(ranges, by)
    else:
        ranges = rows.agg(*limits)
        placed = rows.withColumn("_r", one_row(ranges)).select("*", "_r.*")
    place = F.floor((x - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    counts = placed.groupBy(*keys, F.least(place, F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count("*").alias("n")
    )
    width = (F.col("hi") - F.col("lo")) / bins
    return (
        ranges.select(*keys, "lo", "hi", spine)
        .join(counts, [*keys, "bin"], "left")
        .select(
            *keys,
            "bin",
            (F.col("lo") + width * F.col("bin")).alias("bin_start"),
            (F.col("lo") + width * (F.col("bin") + 1)).alias("bin_end"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def mean_and_median(df: DataFrame, value) -> DataFrame:
    median = exact_quantiles(df, value, [0.5]).select("q0").scalar()
    return df.agg(mean(value).alias("mean")).withColumn("median", median)


def one_time_vs_repeat(donors) -> DataFrame:
    n = F.col("total_donations")
    return giving(donors).agg(
        F.count_if(n == 1).alias("one_time"),
        F.count_if(n > 1).alias("repeat"),
        (F.count_if(n == 1) / F.count("*")).alias("one_time_share"),
        (F.count_if(n > 1) / F.count("*")).alias("repeat_share"),
    )


def _by_last_year(donors, first, last):
    year = F.year("last_donation_date")
    return (
        giving(donors)
        .where(year.between(first, last))
        .groupBy(year.alias("year"))
        .agg(
            F.count("*").alias("num_donors"),
            F.sum("total_amount").alias("total_donated"),
            mean("total_amount").alias("avg_donation"),
        )
    )


def year_over_year(yearly: DataFrame, value, name="yoy_growth") -> DataFrame:
    """Percent change from the row before; the first row has 0.

    The unpartitioned window sees one row per year only.
    """
    before = F.lag(F.col(value).cast("double")).over(Window.orderBy("year"))
    change = (F.col(value).cast("double") / before - 1) * 100
    return yearly.withColumn(name, F.coalesce(change, F.lit(0.0)))


def annual_trends(donors, first=2010, last=2025) -> DataFrame:
    return year_over_year(_by_last_year(donors, first, last), "total_donated")


def election_cycle_summary(donors, first=2010, last=2024) -> DataFrame:
    """Mean over the years of each cycle (years weigh the same)."""
    yearly = _by_last_year(donors, first, last).withColumn("cycle", election_cycle("year"))
    return (
        yearly.where(F.col("cycle") != "Off-Year")
        .groupBy("cycle")
        .agg(*[F.avg(c).alias(c) for c in ("total_donated", "num_donors", "avg_donation")])
    )


def _placeholder_free(c, junk):
    return F.col(c).isNotNull() & (F.col(c) != "") & ~F.col(c).isin(junk)


def _top_by(donors, c, junk, n):
    groups = (
        giving(donors)
        .where(_placeholder_free(c, junk))
        .groupBy(c)
        .agg(
            F.count("*").alias("num_donors"),
            F.sum("total_amount").alias("total_donated"),
            mean("total_amount").alias("avg_donation"),
        )
    )
    return top_n(groups, n, "total_donated", c)


def top_occupations(donors, n=15) -> DataFrame:
    return _top_by(donors, "occupation", JUNK_OCCUPATIONS, n)


def top_employers(donors, n=15) -> DataFrame:
    return _top_by(donors, "employer", JUNK_EMPLOYERS, n)


def reranked(top: DataFrame, key, n=15) -> DataFrame:
    """The same few rows numbered by average gift and by donor count."""
    by_avg = Window.orderBy(F.desc("avg_donation"), F.asc(key))
    by_count = Window.orderBy(F.desc("num_donors"), F.asc(key))
    return top.select(
        key,
        F.row_number().over(by_avg).alias("rank_by_avg"),
        F.row_number().over(by_count).alias("rank_by_count"),
    ).where((F.col("rank_by_avg") <= n) | (F.col("rank_by_count") <= n))


def donor_segments(donors) -> DataFrame:
    return (
        giving(donors)
        .groupBy(donor_segment("total_amount").alias("donor_segment"), "primary_party")
        .agg(
            F.count("*").alias("num_donors"),
            F.sum("total_amount").alias("total_donated"),
            mean("total_amount").alias("avg_donation"),
        )
    )


def segment_totals(segments: DataFrame) -> DataFrame:
    """Totals of each segment; its average is the plain mean over party rows."""
    return segments.groupBy("donor_segment").agg(
        F.sum("num_donors").alias("num_donors"),
        F.sum("total_donated").alias("total_donated"),
        F.avg("avg_donation").alias("avg_donation"),
    )


def segment_party_pivot(segments: DataFrame) -> DataFrame:
    """Donors by segment and party, every segment and party listed."""
    sums = (
        segments.where(F.col("primary_party").isNotNull())
        .groupBy("donor_segment")
        .pivot("primary_party", PARTIES)
        .agg(F.sum("num_donors"))
    )
    spine = sums.sparkSession.createDataFrame([(s,) for s in SEGMENTS], "donor_segment string")
    return spine.join(sums, "donor_segment", "left").fillna(0, subset=PARTIES)


def party_by_state(donors, min_total=1e6) -> DataFrame:
    """Amounts by state and party with shares and lean, states over ``min_total``."""
    rows = giving(donors).where((F.length("state") == 2) & F.col("primary_party").isNotNull())
    sums = rows.groupBy("state").pivot("primary_party", PARTIES).agg(F.sum("total_amount"))
    doubles = sums.select(
        "state", *[F.coalesce(F.col(p).cast("double"), F.lit(0.0)).alias(p) for p in PARTIES]
    )
    total = sum((F.col(p) for p in PARTIES[1:]), F.col(PARTIES[0]))
    return (
        doubles.withColumn("total", total)
        .withColumn("dem_pct", F.col("DEM") / F.col("total") * 100)
        .withColumn("rep_pct", F.col("REP") / F.col("total") * 100)
        .withColumn("lean", F.col("dem_pct") - F.col("rep_pct"))
        .where(F.col("total") > min_total)
        .orderBy("lean", "state")
    )


def most_partisan_states(by_state: DataFrame, n=10) -> DataFrame:
    """The ``n`` states with the highest DEM share and the ``n`` of lowest lean."""
    dem = top_n(by_state, n, "dem_pct", "state").select(F.lit("DEM").alias("list"), "state", "dem_pct", "lean")
    rep = by_state.orderBy("lean", "state").limit(n).select(
        F.lit("REP").alias("list"), "state", "dem_pct", "lean"
    )
    return dem.unionByName(rep)


def transactions_by_year(contributions, first=1980, last=2025, min_donations=100) -> DataFrame:
    amount = F.col("transaction_amt")
    year = F.year("transaction_dt")
    sums = (
        contributions.where(year.between(first, last))
        .groupBy(year.alias("year"))
        .agg(
            F.count_if(amount > 0).alias("num_donations"),
            F.count_if(amount < 0).alias("num_refunds"),
            F.sum(F.when(amount > 0, amount).otherwise(0)).alias("total_donations"),
            F.sum(F.when(amount < 0, -amount).otherwise(0)).alias("total_refunds"),
        )
        .where(F.col("num_donations") > min_donations)
    )

    def rate(part, rest):
        p, r = F.col(part).cast("double"), F.col(rest).cast("double")
        return p / (p + r) * 100

    return sums.withColumn("refund_rate", rate("num_refunds", "num_donations")).withColumn(
        "refund_amount_rate", rate("total_refunds", "total_donations")
    )


def donor_tenure(donors) -> DataFrame:
    """Type and tenure in days of every giving donor with both dates."""
    return (
        giving(donors)
        .where(F.col("first_donation_date").isNotNull() & F.col("last_donation_date").isNotNull())
        .select(
            "id", "total_donations", "total_amount", "primary_party",
            date_diff("last_donation_date", "first_donation_date").alias("donor_tenure_days"),
            donor_type("total_donations").alias("donor_type"),
        )
    )


def donor_retention(donors) -> DataFrame:
    return donor_tenure(donors).groupBy("donor_type").agg(
        F.count("*").alias("num_donors"),
        mean("total_amount").alias("mean_lifetime_value"),
        F.sum("total_amount").alias("total_donated"),
        mean("donor_tenure_days").alias("mean_tenure_days"),
    )


def frequency_segmentation(donors) -> DataFrame:
    return (
        giving(donors)
        .groupBy(frequency_category("total_donations").alias("frequency_category"))
        .agg(F.count("*").alias("num_donors"), mean("total_amount").alias("avg_total_amount"))
    )


def geographic_top(donors, by="total_donated", n=20) -> DataFrame:
    states = (
        giving(donors)
        .where(F.col("state").isNotNull() & (F.col("state") != ""))
        .groupBy("state")
        .agg(F.count("*").alias("num_donors"), F.sum("total_amount").alias("total_donated"))
    )
    return top_n(states, n, by, "state")


def committee_year_facts(contributions, committees, first=1980, last=2030) -> DataFrame:
    """Sum, count and average per committee and year.

    Transactions are added up before the committee is joined, so a committee
    with very many of them is combined map-side.
    """
    amount, year = F.col("transaction_amt"), F.year("transaction_dt")
    sums = (
        contributions.where((amount > 0) & year.between(first, last))
        .groupBy("cmte_id", year.alias("year"))
        .agg(
            F.sum(amount).alias("total_raised"),
            F.count("*").alias("num_contributions"),
            mean(amount).alias("avg_contribution"),
        )
        .where(F.col("total_raised") > 0)
    )
    cm = committees.select("cmte_id", "cmte_nm", "cmte_tp", "cmte_pty_affiliation")
    return sums.join(cm, "cmte_id").withColumn("party_label", party_label("cmte_pty_affiliation"))


def top_committees(facts: DataFrame, n=15) -> DataFrame:
    sums = (
        facts.where(F.col("cmte_nm").isNotNull())
        .groupBy("cmte_id", "cmte_nm", "party_label")
        .agg(F.sum("total_raised").alias("total_raised"))
    )
    return top_n(sums, n, "total_raised", "cmte_id")


def party_by_year(facts: DataFrame) -> DataFrame:
    return facts.groupBy("year", "party_label").agg(F.sum("total_raised").alias("total_raised"))


def party_mean_contribution(facts: DataFrame) -> DataFrame:
    """Plain mean over committee-years of their average contribution."""
    return facts.groupBy("party_label").agg(F.avg("avg_contribution").alias("avg_contribution"))


def top_committee_types(facts: DataFrame, n=8) -> DataFrame:
    sums = facts.groupBy(committee_type_label("cmte_tp").alias("cmte_type_label")).agg(
        F.sum("total_raised").alias("total_raised")
    )
    return top_n(sums, n, "total_raised", "cmte_type_label")


def value_counts(df: DataFrame, c) -> DataFrame:
    """Rows per value and their share; null is not counted."""
    counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)
