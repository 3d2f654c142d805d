"""Declared types and widths of the seven tables."""

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(14,2)"

# --- Fixed values: table layouts, in file order. ---
CANDIDATES = """
cand_id varchar(9), cand_name varchar(200), cand_pty_affiliation varchar(3), cand_election_yr int,
cand_office_st varchar(2), cand_office varchar(1), cand_office_district varchar(2),
cand_ici varchar(1), cand_status varchar(1), cand_pcc varchar(9), cand_st1 varchar(34),
cand_st2 varchar(34), cand_city varchar(30), cand_st varchar(2), cand_zip varchar(9)
"""
COMMITTEES = """
cmte_id varchar(9), cmte_nm varchar(200), tres_nm varchar(90), cmte_st1 varchar(34),
cmte_st2 varchar(34), cmte_city varchar(30), cmte_st varchar(2), cmte_zip varchar(9),
cmte_dsgn varchar(1), cmte_tp varchar(1), cmte_pty_affiliation varchar(3),
cmte_filing_freq varchar(1), org_tp varchar(1), connected_org_nm varchar(200), cand_id varchar(9)
"""
LINKS = """
cand_id varchar(9), cand_election_yr int, fec_election_yr int, cmte_id varchar(9),
cmte_tp varchar(1), cmte_dsgn varchar(1), linkage_id bigint
"""
ITCONT = """
cmte_id varchar(9), amndt_ind varchar(1), rpt_tp varchar(3), transaction_pgi varchar(5),
image_num varchar(18), transaction_tp varchar(3), entity_tp varchar(3), name varchar(200),
city varchar(30), state varchar(2), zip_code varchar(9), employer varchar(38),
occupation varchar(38), transaction_dt date, transaction_amt decimal(14,2), other_id varchar(9),
tran_id varchar(32), file_num int, memo_cd varchar(1), memo_text varchar(100), sub_id bigint
"""
RAW_EXTRA = """
first_name varchar(100), last_name varchar(100), middle_name varchar(100),
name_suffix varchar(20), source_file varchar(255), status tinyint, error_message string
"""
CONTRIBUTIONS = """
contributor_id bigint, cmte_id varchar(9), transaction_pgi varchar(5), transaction_tp varchar(3),
transaction_dt date, transaction_amt decimal(14,2), amndt_ind varchar(1), rpt_tp varchar(3),
image_num varchar(18), entity_tp varchar(3), other_id varchar(9), tran_id varchar(32),
file_num int, sub_id bigint, memo_cd varchar(1), memo_text varchar(100)
"""
IDENTITY = """
id bigint, donor_key varchar(255), first_name varchar(100), last_name varchar(100),
middle_name varchar(100), name_suffix varchar(20), city varchar(30), state varchar(2),
zip_code varchar(9), employer varchar(38), occupation varchar(38)
"""
ACTIVITY = """
total_donations int, total_amount decimal(14,2), donations_last_2years int,
amount_last_2years decimal(14,2), recency_days int, avg_donation_amount decimal(14,2),
first_donation_date date, last_donation_date date, unique_committees int,
dem_donations int, dem_amount decimal(14,2), rep_donations int, rep_amount decimal(14,2),
lib_donations int, lib_amount decimal(14,2), gre_donations int, gre_amount decimal(14,2),
ind_donations int, ind_amount decimal(14,2), other_donations int, other_amount decimal(14,2),
dem_pct decimal(5,2), rep_pct decimal(5,2), primary_party varchar(10)
"""
DONOR_TOTALS = """
id bigint, contributor_id bigint, cmte_id varchar(9), cmte_name varchar(200), cmte_type varchar(1),
cmte_party varchar(3), cmte_state varchar(2), cand_id varchar(9), cand_name varchar(200),
cand_party varchar(3), cand_office varchar(1), cand_state varchar(2), total_donations int,
total_amount decimal(14,2), avg_amount decimal(14,2), min_amount decimal(14,2),
max_amount decimal(14,2), stddev_amount decimal(14,2), first_donation_date date,
last_donation_date date, days_since_first int, days_since_last int, donation_span_days int,
avg_days_between_donations decimal(10,2), donations_last_1year int,
amount_last_1year decimal(14,2), donations_last_2years int, amount_last_2years decimal(14,2),
donations_primary int, donations_general int, amount_primary decimal(14,2),
amount_general decimal(14,2), amount_trend decimal(10,4), is_recurring tinyint
"""
# --- End of fixed values. ---

TABLES = {
    "candidates": CANDIDATES,
    "committees": COMMITTEES,
    "candidate_committee_links": LINKS,
    "raw_contributions": ITCONT + "," + RAW_EXTRA,
    "contributions": CONTRIBUTIONS,
    "contributors": IDENTITY + "," + ACTIVITY,
    "donor_totals": DONOR_TOTALS,
}


def columns(layout):
    """(name, type, width) per column; width is None for all but varchar."""
    out = []
    for name, kind in re.findall(r"(\w+) ([a-z]+(?:\([\d,]+\))?)", layout):
        width = re.fullmatch(r"varchar\((\d+)\)", kind)
        out.append((name, "string" if width else kind, int(width[1]) if width else None))
    return out


def struct_type(table) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t, _ in columns(TABLES[table])))


def apply_schema(df: DataFrame, table) -> DataFrame:
    """Project to the declared columns and types; a column not in ``df`` is null.

    A value out of range for its type becomes null, and ``schema_errors`` lists
    the columns whose text is too long or whose value did not fit.
    """
    kept, errors = [], []
    for name, kind, width in columns(TABLES[table]):
        if name not in df.columns:
            kept.append(F.lit(None).cast(kind).alias(name))
            continue
        value = F.col(name)
        typed = value.try_cast(kind)
        kept.append(typed.alias(name))
        bad = value.isNotNull() & typed.isNull()
        if width is not None:
            bad = bad | (F.length(value) > width)
        errors.append(F.when(bad, F.lit(name)))
    return df.select(*kept, F.array_compact(F.array(*errors)).alias("schema_errors"))
