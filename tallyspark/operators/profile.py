"""Party attribution and the donor profile."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (
    PARTIES,
    from_cents,
    half_up_quotient,
    party_bucket,
    pct_share,
    primary_party,
    recency_days,
    to_cents,
    within_years,
)
from ..session import broadcast_if_small


def attribute_parties(contributions, committees, links, candidates) -> DataFrame:
    """Every transaction with its committee, link and candidate.

    A committee with several links repeats the transaction, as a chain of left
    joins does. Use ``committee_party_mix`` to aggregate without that growth.
    """
    cm = committees.select("cmte_id", "cmte_nm", F.col("cmte_pty_affiliation").alias("cmte_party"))
    known = cm.select("cmte_id")
    ln = links.join(known, "cmte_id", "left_semi").select("cmte_id", "cand_id")
    ca = candidates.select("cand_id", "cand_name", F.col("cand_pty_affiliation").alias("cand_party"))
    return (
        contributions.join(cm, "cmte_id", "left")
        .join(ln.join(ca, "cand_id", "left"), "cmte_id", "left")
        .withColumn("party", party_bucket("cand_party", "cmte_party"))
    )


def committee_party_mix(committees, links, candidates, link_mode="reference") -> DataFrame:
    """One row per committee: into how many joined rows a transaction turns, by party.

    ``reference`` counts one row per link, so a committee linked to three
    candidates weighs three. ``dedup`` weighs every committee once, with the
    greatest candidate party.
    """
    ca = candidates.select("cand_id", F.col("cand_pty_affiliation").alias("cand_party"))
    cm = committees.select("cmte_id", F.col("cmte_pty_affiliation").alias("cmte_party"))
    linked = cm.join(links.select("cmte_id", "cand_id").join(ca, "cand_id", "left"), "cmte_id", "left")
    if link_mode == "dedup":
        linked = linked.groupBy("cmte_id", "cmte_party").agg(F.max("cand_party").alias("cand_party"))
    elif link_mode != "reference":
        raise ValueError(f"link_mode must be 'reference' or 'dedup', not {link_mode!r}")
    bucket = party_bucket("cand_party", "cmte_party")
    return (
        linked.withColumn("party", bucket)
        .groupBy("cmte_id")
        .agg(
            F.count("*").alias("rows"),
            *[F.count_if(F.col("party") == p).alias(f"rows_{p}") for p in PARTIES],
        )
    )


def pair_activity(contributions, as_of) -> DataFrame:
    """Counts and sums per donor and committee: the first, map-side combined step.

    Amounts are added up as whole cents, which is exact and stays in fixed-width
    aggregation buffers.
    """
    recent = within_years("transaction_dt", as_of, 2)
    cents = F.col("_cents")
    return (
        contributions.select(
            "contributor_id", "cmte_id", "transaction_dt", to_cents("transaction_amt").alias("_cents")
        )
        .groupBy("contributor_id", "cmte_id")
        .agg(
            F.count("*").alias("n"),
            F.count(cents).alias("n_amt"),
            F.sum(cents).alias("amt"),
            F.min("transaction_dt").alias("first_dt"),
            F.max("transaction_dt").alias("last_dt"),
            F.count_if(recent).alias("n_recent"),
            F.sum(F.when(recent, cents).otherwise(0)).alias("amt_recent"),
        )
    )


def donor_profile(contributions, committees, links, candidates, as_of, link_mode="reference"):
    """24 measures per donor: activity, two-year activity, party mix, recency.

    Transactions are added up per donor and committee before the committees are
    joined, and the committee side carries link counts instead of links. So no
    row is ever repeated, the count of distinct committees is a plain count, and
    a committee with a large share of all transactions is combined map-side.
    Refunds are negative and net out.
    """
    mix = broadcast_if_small(
        committee_party_mix(committees, links, candidates, link_mode), committees
    )
    # A committee that is not in the table still gives one row, of party OTHER.
    known = F.col("rows").isNotNull()
    weights = {"w": F.coalesce("rows", F.lit(1))}
    for p in PARTIES:
        default = F.lit(1 if p == "OTHER" else 0)
        weights[f"w_{p}"] = F.when(known, F.col(f"rows_{p}")).otherwise(default)
    pairs = pair_activity(contributions, as_of).join(mix, "cmte_id", "left").withColumns(weights)

    def weighted(c, w="w"):
        return F.sum(F.col(c) * F.col(w))

    def party_cents(p):
        w = F.col(f"w_{p}")
        # Null only if all rows are of this party and none has an amount.
        return F.sum(
            F.when(w == 0, 0)
            .when(w == F.col("w"), F.col("amt") * w)
            .otherwise(F.coalesce("amt", F.lit(0)) * w)
        )

    sums = pairs.groupBy("contributor_id").agg(
        weighted("n").alias("total_donations"),
        weighted("amt").alias("total_amount"),
        weighted("n_amt").alias("n_amt"),
        F.min("first_dt").alias("first_donation_date"),
        F.max("last_dt").alias("last_donation_date"),
        F.count("cmte_id").alias("unique_committees"),
        weighted("n_recent").alias("donations_last_2years"),
        weighted("amt_recent").alias("amount_last_2years"),
        *[weighted("n", f"w_{p}").alias(f"{p.lower()}_donations") for p in PARTIES],
        *[party_cents(p).alias(f"{p.lower()}_amount") for p in PARTIES],
    )
    total, n_amt = F.col("total_amount"), F.col("n_amt")
    amounts = {p: f"{p.lower()}_amount" for p in PARTIES}
    return sums.select(
        "contributor_id",
        "total_donations",
        from_cents("total_amount").alias("total_amount"),
        "donations_last_2years",
        from_cents("amount_last_2years").alias("amount_last_2years"),
        recency_days("last_donation_date", as_of).alias("recency_days"),
        from_cents(F.when(n_amt > 0, half_up_quotient(total, n_amt))).alias("avg_donation_amount"),
        "first_donation_date",
        "last_donation_date",
        "unique_committees",
        *[f"{p.lower()}_donations" for p in PARTIES],
        *[from_cents(c).alias(c) for c in amounts.values()],
        pct_share("dem_amount", "total_amount").alias("dem_pct"),
        pct_share("rep_amount", "total_amount").alias("rep_pct"),
        primary_party(amounts).alias("primary_party"),
    )


ZERO_DEFAULTS = ["total_donations", "total_amount", "donations_last_2years", "amount_last_2years",
                 "unique_committees"] + [
    f"{p.lower()}_{what}" for p in PARTIES for what in ("donations", "amount")
]


def update_donors(donors: DataFrame, profile: DataFrame) -> DataFrame:
    """Donor rows with their profile; a donor without transactions keeps the defaults.

    Counts and amounts default to zero; dates, average, recency, percentages and
    party stay null.
    """
    stats = profile.withColumn("_found", F.lit(True))
    joined = donors.join(stats, donors["id"] == stats["contributor_id"], "left")
    measures = [c for c in profile.columns if c != "contributor_id"]
    return joined.select(
        *[donors[c] for c in donors.columns],
        *[
            (F.when(F.col("_found").isNull(), 0).otherwise(F.col(c)) if c in ZERO_DEFAULTS
             else F.col(c)).alias(c)
            for c in measures
        ],
    )
