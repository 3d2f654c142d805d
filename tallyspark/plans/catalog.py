"""Registered queries: a name to a function of the ledger returning a frame."""

from functools import lru_cache

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import explore as ex
from ..operators import profile, refunds, resolve, totals
from ..session import cut_lineage
from . import frames
from .ledger import AS_OF, Ledger

QUERIES = {}


def shown(df, digits=4):
    """Plain output types: doubles for decimals, text for dates, long for whole numbers.

    Doubles are cut to a grid. The shift keeps short fractions, such as averages
    of cents, away from the middle between two grid points, where the last bit
    of a double would decide.
    """
    scale = 10.0**digits
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            c = F.rint(c.cast("double") * scale + 0.123) / scale + F.lit(0.0)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
            c = c.cast("bigint")
        columns.append(c.alias(f.name))
    return df.select(*columns)


@lru_cache(maxsize=8)
def ledger_of(spark, sf_dir):
    """The (lazy) frames of one folder, built once per session."""
    return Ledger(spark, sf_dir)


def query(fn, name=None, digits=4):
    def run(spark, sf_dir):
        return shown(fn(ledger_of(spark, sf_dir)), digits)

    QUERIES[name or fn.__name__] = run
    return fn


# --- Scalar rules -----------------------------------------------------------

query(frames.parsed_names, "parse_names")
query(frames.donor_rules, "donor_rules")
query(frames.committee_rules, "committee_rules")


@query
def parse_filing_text(g):
    from ..functions.scalars import parse_mmddyyyy, safe_decimal, safe_int

    return frames.text_fields(g).select(
        "l_orderkey", "l_linenumber",
        parse_mmddyyyy("date_text").alias("transaction_dt"),
        safe_decimal("amount_text").alias("transaction_amt"),
        safe_int("number_text", "bigint").alias("file_num"),
    )


@query
def unit_vectors(g):
    from ..functions.scalars import l2_normalize

    unit = g.table("embeddings").select("vec_id", l2_normalize("embedding").alias("u"))
    return unit.select("vec_id", F.posexplode("u").alias("position", "value"))


# --- Raw rows to donors -----------------------------------------------------


@query
def pending_rows(g):
    from ..sources.filings import pending

    rows = frames.raw_rows(g).withColumn("id", F.col("sub_id"))
    return pending(rows, "itcont0.txt", (0, 10**15)).select("sub_id", "contributor_id", "cmte_id")


@query
def donor_keys(g):
    from ..functions.scalars import donor_key

    return frames.raw_rows(g).select("sub_id", donor_key().alias("donor_key"))


@query
def distinct_identities(g):
    ids = resolve.distinct_identities(frames.raw_rows(g))
    return ids.select("donor_key", "state", "zip_code", "employer", "occupation")


@query
def dedupe_donors(g):
    donors = resolve.dedupe_donors(frames.raw_rows(g))
    return donors.drop("id", "middle_name", "name_suffix")


@query
def link_contributions(g):
    raw = frames.raw_rows(g)
    donors = resolve.dedupe_donors(raw)
    linked = resolve.link_contributions(raw, donors)
    named = linked.join(donors.select(F.col("id").alias("contributor_id"), "donor_key"), "contributor_id")
    return named.select("donor_key", "cmte_id", "transaction_dt", "transaction_amt", "sub_id")


@query
def linked_by_key_hash(g):
    """Ids computed from the key agree with the ids of the donor table."""
    raw = frames.raw_rows(g)
    per_id = resolve.link_contributions(raw).groupBy("contributor_id").agg(
        F.count("*").alias("n"), F.sum("transaction_amt").alias("amount")
    )
    donors = resolve.dedupe_donors(raw)
    return donors.join(per_id, donors["id"] == per_id["contributor_id"]).select(
        "donor_key", "n", "amount"
    )


# --- Parties and donor profile ----------------------------------------------


@query
def attributed_transactions(g):
    rows = profile.attribute_parties(g.contributions, g.committees, g.links, g.candidates)
    return rows.select("sub_id", "contributor_id", "cmte_id", "cand_id", "cand_name", "party",
                       "transaction_amt")


@query
def donor_profile(g):
    return g.profile


@query
def donor_profile_dedup(g):
    return profile.donor_profile(
        g.contributions, g.committees, g.links, g.candidates, AS_OF, link_mode="dedup"
    )


@query
def updated_donors(g):
    return profile.update_donors(g.identities, g.profile)


@query
def committee_summary(g):
    return totals.committee_summary(g.committees, g.links, g.candidates)


@query
def donor_totals(g):
    return g.totals


@query
def donor_candidate_totals(g):
    return totals.donor_candidate_totals(g.totals)


@query
def donor_candidate_summary(g):
    return totals.donor_candidate_summary(g.totals)


# --- Refunds ----------------------------------------------------------------


def _patterns(g):
    return refunds.cross_year_refunds(g.contributions)


def _enriched(g):
    return refunds.enrich(_patterns(g), g.donors, g.committees)


@query
def gifts_and_refunds(g):
    gifts = refunds.donations_only(g.contributions).withColumn("kind", F.lit("gift"))
    back = refunds.refunds_only(g.contributions).withColumn("kind", F.lit("refund"))
    return gifts.unionByName(back).select("kind", "sub_id", "cmte_id", "transaction_amt")


@query
def yearly_donations(g):
    return refunds.yearly_donations(g.contributions)


@query
def yearly_refunds(g):
    return refunds.yearly_refunds(g.contributions)


@query
def cross_year_refunds(g):
    return _patterns(g)


@query
def matched_years_join(g):
    """The same patterns by the join of the two yearly tables."""
    return refunds.match_years(
        refunds.yearly_donations(g.contributions), refunds.yearly_refunds(g.contributions)
    )


@query
def refunds_two_years_later(g):
    return refunds.cross_year_refunds(g.contributions, year_gap=2)


@query
def largest_refunds(g):
    return refunds.largest_refunds(_patterns(g), 100)


@query
def enriched_refunds(g):
    timed = refunds.merge_timing(_enriched(g), _patterns(g))
    return timed.select(
        "contributor_id", "cmte_id", "donation_year", "total_donated", "total_refunded", "last_name",
        "state", "employer", "primary_party", "lifetime_amount", "committee_name",
        "committee_party", "days_to_refund",
    )


@query
def refund_summary(g):
    return refunds.refund_summary(cut_lineage(_patterns(g)), g.contributions)


@query
def refunds_by_year(g):
    return refunds.refunds_by_year(_patterns(g))


@query
def refunds_by_state(g):
    return refunds.refunds_by_state(_enriched(g))


@query
def refunds_by_party(g):
    return refunds.refunds_by_party(_enriched(g))


@query
def refund_timing(g):
    return refunds.refund_timing(_patterns(g))


@query
def refund_report(g):
    patterns = cut_lineage(_patterns(g))
    summary = refunds.refund_summary(patterns, g.contributions)
    return refunds.refund_report(summary, refunds.refund_timing(patterns))


@query
def refund_pct_histogram(g):
    from ..functions.scalars import clip

    capped = _patterns(g).withColumn("pct", clip("refund_pct", hi=200.0))
    return ex.histogram(capped, "pct", 50)


@query
def refund_days_histogram(g):
    from ..functions.scalars import clip

    capped = refunds.with_timing(_patterns(g)).withColumn("days", clip("days_to_refund", hi=730))
    return ex.histogram(capped, "days", 50)


# --- Exploration ------------------------------------------------------------


@query
def summary_statistics(g):
    return ex.summary_statistics(g.donors)


@query
def distribution_points(g):
    return ex.distribution_points(g.donors)


@query
def amount_histogram(g):
    return ex.histogram(ex.distribution_points(g.donors), "log_amount", 100)


@query
def donation_count_histogram(g):
    """Bins of the count: as many as the greatest count, at most 200."""
    donors = ex.giving(g.donors)
    most = donors.agg(F.least(F.max("total_donations"), F.lit(200))).first()[0]
    return ex.histogram(donors, "total_donations", int(most))


@query
def average_gift_histogram(g):
    from ..functions.scalars import log10_clip

    logs = ex.giving(g.donors).withColumn("log_avg", log10_clip("avg_donation_amount"))
    return ex.histogram(logs, "log_avg", 100)


@query
def amount_mean_and_median(g):
    return ex.mean_and_median(ex.giving(g.donors), "total_amount")


@query
def one_time_vs_repeat(g):
    return ex.one_time_vs_repeat(g.donors)


@query
def annual_trends(g):
    return ex.annual_trends(g.donors, 1995, 2001)


@query
def election_cycle_summary(g):
    """Years are moved on by twelve so that they meet the listed cycles."""
    moved = g.donors.withColumn("last_donation_date", F.add_months("last_donation_date", 12 * 17))
    return ex.election_cycle_summary(moved)


@query
def top_occupations(g):
    return ex.top_occupations(g.donors)


@query
def top_employers(g):
    return ex.top_employers(g.donors)


@query
def reranked_occupations(g):
    return ex.reranked(ex.top_occupations(g.donors), "occupation")


@query
def donor_segments(g):
    return ex.donor_segments(g.donors)


@query
def segment_totals(g):
    return ex.segment_totals(ex.donor_segments(g.donors))


@query
def segment_party_pivot(g):
    return ex.segment_party_pivot(ex.donor_segments(g.donors))


@query
def party_by_state(g):
    return ex.party_by_state(g.donors)


@query
def most_partisan_states(g):
    return ex.most_partisan_states(ex.party_by_state(g.donors))


@query
def transactions_by_year(g):
    return ex.transactions_by_year(g.contributions)


@query
def donor_tenure(g):
    return ex.donor_tenure(g.donors)


@query
def donor_retention(g):
    return ex.donor_retention(g.donors)


@query
def frequency_segmentation(g):
    return ex.frequency_segmentation(g.donors)


@query
def states_by_amount(g):
    return ex.geographic_top(g.donors)


@query
def states_by_donors(g):
    return ex.geographic_top(g.donors, by="num_donors")


def _facts(g):
    return ex.committee_year_facts(g.contributions, g.committees)


@query
def committee_year_facts(g):
    return _facts(g)


@query
def top_committees(g):
    return ex.top_committees(_facts(g))


@query
def party_by_year(g):
    return ex.party_by_year(_facts(g))


@query
def party_mean_contribution(g):
    return ex.party_mean_contribution(_facts(g))


@query
def top_committee_types(g):
    return ex.top_committee_types(_facts(g))


@query
def party_value_counts(g):
    return ex.value_counts(g.donors, "primary_party")
