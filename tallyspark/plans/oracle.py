"""For each registered query, SQL with the same result."""

from .oracle_base import PARTIES, day, num, whole, with_views

SQL = {}


def nums(text, digits=4, prefix=""):
    return ", ".join(num(prefix + c, c, digits) for c in text.split())


def wholes(text, prefix=""):
    return ", ".join(whole(prefix + c, c) for c in text.split())


def days(text, prefix=""):
    return ", ".join(day(prefix + c, c) for c in text.split())


# --- Scalar rules -----------------------------------------------------------

_BLANKS = r"[\s]+"
_SUFFIX = (
    "'JR','SR','I','II','III','IV','V','VI','VII','VIII','MD','M.D.','DO','D.O.','DDS','D.D.S.','DMD','DVM',"
    "'RN','LPN','NP','PHD','PH.D.','EDD','ED.D.','JD','J.D.','MBA','MPA','MS','MA','ESQ','CPA','PE','RA',"
    "'AIA','CFP','CLU','CPCU'"
)
_PREFIX = (
    "'MR','MRS','MS','MISS','DR','PROF','REV','FR','PASTOR','HON','JUDGE','GEN','COL','MAJ','CAPT','LT',"
    "'SGT','CPL','PVT','SIR','DAME'"
)


def _name_sql():
    from .frames import NAME_FORMS

    whens = []
    for i, text in enumerate(NAME_FORMS):
        expr = "'" + text + "'"
        for mark, word in (
            ("{a}", "upper(split_part(p_name, ' ', 1))"),
            ("{b}", "upper(split_part(p_name, ' ', 2))"),
            ("{c}", "upper(p_type)"),
        ):
            expr = f"replace({expr}, '{mark}', {word})"
        whens.append(f"WHEN p_partkey % 17 = {i} THEN {expr}")
    return f"""
WITH named AS (SELECT p_partkey, CASE {' '.join(whens)} END AS name FROM part),
a AS (SELECT *, trim(name) AS t, contains(name, ',') AS comma FROM named),
b AS (SELECT *, CASE WHEN comma THEN trim(substr(t, strpos(t, ',') + 1)) ELSE t END AS body,
        CASE WHEN comma THEN trim(split_part(t, ',', 1)) END AS left_part FROM a),
c AS (SELECT *, [x for x in regexp_split_to_array(body, '\\s+') if x <> ''] AS w FROM b),
d AS (SELECT *, coalesce(list_position([upper(x) IN ({_PREFIX}) OR rtrim(upper(x), '.') IN ({_PREFIX}) for x in w], false), len(w) + 1) AS p FROM c),
e AS (SELECT *, w[p:] AS v FROM d),
f AS (SELECT *, CASE WHEN NOT comma AND len(v) = 1 THEN 0 ELSE
        coalesce(list_position([upper(x) IN ({_SUFFIX}) OR rtrim(upper(x), '.') IN ({_SUFFIX}) for x in list_reverse(v)], false) - 1, len(v)) END AS s FROM e),
g AS (SELECT *, v[1:len(v) - s] AS rest, v[len(v) - s + 1:] AS suff FROM f)
SELECT p_partkey, name,
  CASE WHEN comma AND len(rest) >= 1 THEN rest[1] WHEN NOT comma AND len(rest) >= 2 THEN rest[1] END AS first_name,
  CASE WHEN comma THEN left_part WHEN len(rest) >= 1 THEN rest[len(rest)] END AS last_name,
  CASE WHEN comma AND len(rest) > 1 THEN array_to_string(rest[2:], ' ')
       WHEN NOT comma AND len(rest) > 2 THEN array_to_string(rest[2:len(rest) - 1], ' ') END AS middle_name,
  CASE WHEN s > 0 THEN array_to_string(suff, ' ') END AS name_suffix
FROM g"""


SQL["parse_names"] = _name_sql()

SQL["donor_rules"] = with_views(f"""
SELECT {whole('id', 'id')}, coalesce(primary_party, 'OTHER') AS party,
  {num("round(coalesce(dem_amount, 0) / nullif(total_amount, 0) * 100, 2)", 'dem_share')},
  {whole('recency_days', 'recency')},
  {whole("date_diff('day', first_donation_date, last_donation_date)", 'tenure')},
  {whole("last_donation_date >= DATE '1999-12-31'", 'recent')},
  {whole('year(last_donation_date)', 'year')}, {whole('month(first_donation_date)', 'month')},
  CASE WHEN total_amount < 200 THEN 'Small (<$200)' WHEN total_amount BETWEEN 200 AND 2900
       THEN 'Medium ($200-$2,900)' ELSE 'Large (>$2,900)' END AS segment,
  CASE WHEN total_donations = 1 THEN '1x donors' WHEN total_donations = 2 THEN '2x donors'
       WHEN total_donations BETWEEN 3 AND 5 THEN '3-5x donors' WHEN total_donations BETWEEN 6 AND 12
       THEN '6-12x donors' ELSE '12+x donors' END AS frequency,
  CASE WHEN total_donations = 1 THEN 'One-Time' WHEN total_donations <= 5 THEN 'Repeat (2-5)'
       ELSE 'Loyal (6+)' END AS type,
  CASE WHEN id % 30 + 2000 IN (2012, 2016, 2020, 2024) THEN 'Presidential'
       WHEN id % 30 + 2000 IN (2010, 2014, 2018, 2022) THEN 'Midterm' ELSE 'Off-Year' END AS cycle,
  coalesce(nullif(left(trim(zip_code), 3), ''), 'UNK') AS zip3,
  coalesce(nullif(state, ''), 'UNK') AS state_known,
  trim(upper(coalesce(nullif(employer, ''), 'UNKNOWN'))) AS employer_clean,
  trim(upper(coalesce(nullif(occupation, ''), 'UNKNOWN'))) AS occupation_clean,
  CASE trim(coalesce(occupation, 'UNKNOWN')) WHEN 'SELF EMPLOYED' THEN 'SELF-EMPLOYED'
    WHEN 'INFORMATION REQUESTED' THEN 'UNKNOWN' WHEN 'NONE' THEN 'UNKNOWN' WHEN 'N/A' THEN 'UNKNOWN'
    WHEN '' THEN 'UNKNOWN' ELSE trim(coalesce(occupation, 'UNKNOWN')) END AS occupation_norm,
  CASE trim(coalesce(employer, 'UNKNOWN')) WHEN 'SELF EMPLOYED' THEN 'SELF-EMPLOYED'
    WHEN 'SELF' THEN 'SELF-EMPLOYED' WHEN 'INFORMATION REQUESTED' THEN 'UNKNOWN' WHEN 'NONE' THEN 'UNKNOWN'
    WHEN 'N/A' THEN 'UNKNOWN' WHEN '' THEN 'UNKNOWN' ELSE trim(coalesce(employer, 'UNKNOWN')) END AS employer_norm,
  {num("log10(greatest(CAST(total_amount AS DOUBLE), 1))", 'log_amount')},
  {num("CASE WHEN dem_pct > 100 THEN 100 WHEN dem_pct < 0 THEN 0 ELSE dem_pct END", 'dem_clipped')},
  CASE WHEN primary_party IN ('DEM', 'REP') THEN primary_party ELSE 'OTHER' END AS party_group,
  CASE WHEN primary_party IN ('DEM', 'REP') THEN primary_party ELSE 'OTHER' END AS party3
FROM donors""")

SQL["committee_rules"] = with_views("""
SELECT c.cmte_id, l.cand_id,
  CASE WHEN coalesce(a.cand_pty_affiliation, c.cmte_pty_affiliation) IN ('DEM', 'REP')
         THEN coalesce(a.cand_pty_affiliation, c.cmte_pty_affiliation)
       WHEN coalesce(a.cand_pty_affiliation, c.cmte_pty_affiliation) IN ('LIB','LBL','LBU','LP','LPF') THEN 'LIB'
       WHEN coalesce(a.cand_pty_affiliation, c.cmte_pty_affiliation) IN ('GRE','GRN','GLP','DGR') THEN 'GRE'
       WHEN coalesce(a.cand_pty_affiliation, c.cmte_pty_affiliation) IN ('IND','IDP','ICD') THEN 'IND'
       ELSE 'OTHER' END AS party,
  CASE c.cmte_pty_affiliation WHEN 'DEM' THEN 'Democrat' WHEN 'REP' THEN 'Republican'
    ELSE 'Other/Independent' END AS label,
  CASE c.cmte_tp WHEN 'H' THEN 'House' WHEN 'S' THEN 'Senate' WHEN 'P' THEN 'Presidential'
    WHEN 'N' THEN 'PAC - Non-Qualified' WHEN 'Q' THEN 'PAC - Qualified' WHEN 'O' THEN 'Super PAC'
    WHEN 'U' THEN 'Single-Issue' WHEN 'X' THEN 'Party - Non-Qualified' WHEN 'Y' THEN 'Party - Qualified'
    WHEN 'Z' THEN 'National Party' ELSE 'Other' END AS type_label,
  CAST(coalesce(c.cmte_st = a.cand_office_st, false) AS BIGINT) AS same_state,
  CAST(l.cand_id IS NOT NULL AS BIGINT) AS has_candidate
FROM committees c LEFT JOIN links l ON c.cmte_id = l.cmte_id LEFT JOIN candidates a ON l.cand_id = a.cand_id""")

SQL["parse_filing_text"] = f"""
WITH t AS (
  SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%m%d%Y') AS d,
    CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR) AS a FROM lineitem),
u AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_orderkey % 31 = 0 THEN left(d, 7) WHEN l_orderkey % 37 = 0 THEN '0230' || right(d, 4)
         WHEN l_orderkey % 41 = 0 THEN '' WHEN l_orderkey % 43 = 0 THEN NULL ELSE d END AS dt,
    CASE WHEN l_orderkey % 29 = 0 THEN 'abc' WHEN l_orderkey % 47 = 0 THEN '' WHEN l_orderkey % 53 = 0 THEN 'nan'
         ELSE a END AS amt,
    CASE WHEN l_orderkey % 59 = 0 THEN '12.5' WHEN l_orderkey % 61 = 0 THEN 'x'
         ELSE CAST(l_orderkey AS VARCHAR) END AS n FROM t)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CASE WHEN length(dt) = 8 THEN CAST(CAST(try_strptime(dt, '%m%d%Y') AS DATE) AS VARCHAR) END AS transaction_dt,
  {num("TRY_CAST(amt AS DECIMAL(14,2))", 'transaction_amt')},
  CASE WHEN regexp_full_match(n, '[0-9]+') THEN CAST(n AS BIGINT) END AS file_num
FROM u"""

SQL["unit_vectors"] = f"""
WITH e AS (SELECT vec_id, [CAST(x AS DOUBLE) for x in embedding] AS v FROM embeddings),
n AS (SELECT vec_id, v, sqrt(list_sum([x * x for x in v])) AS norm FROM e)
SELECT vec_id, CAST(i AS BIGINT) AS position,
  {num("CASE WHEN norm > 0 THEN v[i + 1] / norm ELSE v[i + 1] END", 'value')}
FROM n, unnest(range(0, len(v))) AS r(i)"""

# --- Raw rows to donors -----------------------------------------------------

_RAW = """
raw AS (
  SELECT c.*, i.first_name, i.last_name, i.city, i.state,
    CASE WHEN sub_id % 2 = 0 THEN i.zip_code || '1234' ELSE i.zip_code END AS zip_code, i.employer,
    CASE WHEN sub_id % 3 = 0 THEN NULL ELSE i.occupation END AS occupation,
    'itcont' || CAST(sub_id % 4 AS VARCHAR) || '.txt' AS source_file,
    CASE WHEN sub_id % 5 = 0 THEN 1 ELSE 0 END AS status
  FROM contributions c JOIN identities i ON c.contributor_id = i.id
),
keyed AS (
  SELECT *, upper(last_name) || '|' || upper(first_name) || '|' || upper(city) || '|'
    || upper(coalesce(state, '')) || '|' || left(coalesce(zip_code, ''), 5) || '|'
    || left(upper(coalesce(employer, '')), 20) AS donor_key FROM raw
)"""

SQL["pending_rows"] = with_views(
    "SELECT sub_id, contributor_id, cmte_id FROM raw WHERE status = 0 AND source_file = 'itcont0.txt' "
    "AND sub_id >= 0 AND sub_id < 1000000000000000", _RAW
)
SQL["donor_keys"] = with_views("SELECT sub_id, donor_key FROM keyed", _RAW)
SQL["distinct_identities"] = with_views(
    "SELECT donor_key, state, zip_code, employer, occupation FROM (SELECT DISTINCT donor_key, first_name, "
    "last_name, city, state, zip_code, employer, occupation FROM keyed)", _RAW
)
SQL["dedupe_donors"] = with_views("""
SELECT donor_key, first_name, last_name, city, state, zip_code, employer, occupation FROM (
  SELECT *, row_number() OVER (PARTITION BY donor_key ORDER BY sub_id, source_file, zip_code NULLS FIRST,
    employer NULLS FIRST, occupation NULLS FIRST) AS rn FROM keyed) WHERE rn = 1""", _RAW)
SQL["link_contributions"] = with_views(
    f"SELECT donor_key, cmte_id, {day('transaction_dt', 'transaction_dt')}, "
    f"{num('transaction_amt', 'transaction_amt')}, sub_id FROM keyed", _RAW
)
SQL["linked_by_key_hash"] = with_views(
    f"SELECT donor_key, count(*) AS n, {num('sum(transaction_amt)', 'amount')} FROM keyed GROUP BY donor_key",
    _RAW,
)

# --- Parties and donor profile ----------------------------------------------

SQL["attributed_transactions"] = with_views(
    f"SELECT sub_id, contributor_id, cmte_id, cand_id, cand_name, party, "
    f"{num('transaction_amt', 'transaction_amt')} FROM attributed"
)
_COUNTS = "total_donations unique_committees donations_last_2years " + " ".join(
    f"{p.lower()}_donations" for p in PARTIES
)
_AMOUNTS = "total_amount amount_last_2years avg_donation_amount dem_pct rep_pct " + " ".join(
    f"{p.lower()}_amount" for p in PARTIES
)
_PROFILE = (
    f"{wholes(_COUNTS)}, {nums(_AMOUNTS)}, {wholes('recency_days')}, "
    f"{days('first_donation_date last_donation_date')}, primary_party"
)
SQL["donor_profile"] = with_views(f"SELECT contributor_id, {_PROFILE} FROM profile")
SQL["donor_profile_dedup"] = SQL["donor_profile"].replace(
    """FROM contributions co LEFT JOIN committees cm ON co.cmte_id = cm.cmte_id
  LEFT JOIN links ln ON cm.cmte_id = ln.cmte_id LEFT JOIN candidates ca ON ln.cand_id = ca.cand_id""",
    """FROM contributions co LEFT JOIN committees cm ON co.cmte_id = cm.cmte_id
  LEFT JOIN (SELECT l.cmte_id, max(c.cand_id) AS cand_id, max(c.cand_name) AS cand_name,
    max(c.cand_pty_affiliation) AS cand_pty_affiliation FROM links l JOIN candidates c ON l.cand_id = c.cand_id
    GROUP BY l.cmte_id) ca ON cm.cmte_id = ca.cmte_id""",
).replace("ln.cand_id, ca.cand_name", "ca.cand_id, ca.cand_name")
SQL["updated_donors"] = with_views(
    f"SELECT id, last_name, first_name, city, state, zip_code, employer, occupation, {_PROFILE} FROM donors"
)
SQL["committee_summary"] = with_views(
    "SELECT cmte_id, cmte_party, cmte_type, cmte_state, cand_party, CAST(has_candidate AS BIGINT) AS has_candidate "
    "FROM committee_info"
)
_TOTALS_INT = (
    "total_donations days_since_first days_since_last donation_span_days donations_last_1year "
    "donations_last_2years donations_primary donations_general is_recurring"
)
_TOTALS_NUM = (
    "total_amount avg_amount min_amount max_amount stddev_amount avg_days_between_donations "
    "amount_last_1year amount_last_2years amount_primary amount_general amount_trend"
)
SQL["donor_totals"] = with_views(
    f"SELECT contributor_id, cmte_id, {wholes(_TOTALS_INT)}, {nums(_TOTALS_NUM)}, "
    f"{days('first_donation_date last_donation_date')}, cmte_name, cmte_type, cmte_party, cmte_state, "
    "cand_id, cand_name, cand_party, cand_office, cand_state FROM totals"
)
SQL["donor_candidate_totals"] = with_views(
    "SELECT contributor_id, cmte_id, cmte_name, cand_id, cand_name, cand_party, cand_office, cand_state, "
    f"{wholes('total_donations days_since_last donations_last_2years is_recurring')}, "
    f"{nums('total_amount avg_amount amount_last_2years')}, {days('first_donation_date last_donation_date')} "
    "FROM totals WHERE cand_id IS NOT NULL"
)
SQL["donor_candidate_summary"] = with_views(f"""
SELECT contributor_id, cand_id, max(cand_name) AS cand_name, max(cand_party) AS cand_party,
  max(cand_office) AS cand_office, max(cand_state) AS cand_state,
  {whole('count(DISTINCT cmte_id)', 'committees_donated_to')}, {whole('sum(total_donations)', 'total_donations')},
  {num('sum(total_amount)', 'total_amount')}, {num('avg(avg_amount)', 'avg_amount')},
  {day('min(first_donation_date)', 'first_donation_date')}, {day('max(last_donation_date)', 'last_donation_date')},
  {whole('min(days_since_last)', 'days_since_last')}, {whole('sum(donations_last_2years)', 'donations_last_2years')},
  {num('sum(amount_last_2years)', 'amount_last_2years')}, {whole('max(is_recurring)', 'is_recurring')}
FROM totals WHERE cand_id IS NOT NULL GROUP BY contributor_id, cand_id""")

# --- Refunds ----------------------------------------------------------------

SQL["gifts_and_refunds"] = with_views(
    f"SELECT CASE WHEN transaction_amt > 0 THEN 'gift' ELSE 'refund' END AS kind, sub_id, cmte_id, "
    f"{num('transaction_amt', 'transaction_amt')} FROM contributions WHERE transaction_amt <> 0 "
    "AND transaction_dt IS NOT NULL"
)
SQL["yearly_donations"] = with_views(
    f"SELECT contributor_id, cmte_id, {wholes('donation_year donation_count')}, {nums('total_donated')}, "
    f"{days('first_donation last_donation')} FROM yearly_d"
)
SQL["yearly_refunds"] = with_views(
    f"SELECT contributor_id, cmte_id, {wholes('refund_year refund_count')}, {nums('total_refunded')}, "
    f"{days('first_refund last_refund')} FROM yearly_r"
)
_PATTERN = (
    f"contributor_id, cmte_id, {wholes('donation_year donation_count refund_count refund_year')}, "
    f"{nums('total_donated total_refunded refund_pct')}, "
    f"{days('first_donation last_donation first_refund last_refund')}"
)
SQL["cross_year_refunds"] = with_views(f"SELECT {_PATTERN} FROM patterns")
SQL["matched_years_join"] = SQL["cross_year_refunds"]
SQL["refunds_two_years_later"] = SQL["cross_year_refunds"].replace(
    "d.donation_year + 1", "d.donation_year + 2"
)
SQL["largest_refunds"] = with_views(
    f"SELECT {_PATTERN} FROM (SELECT * FROM patterns ORDER BY total_refunded DESC, contributor_id, cmte_id, "
    "donation_year LIMIT 100)"
)
SQL["enriched_refunds"] = with_views(
    f"SELECT contributor_id, cmte_id, {wholes('donation_year days_to_refund')}, "
    f"{nums('total_donated total_refunded lifetime_amount')}, last_name, state, employer, primary_party, "
    "committee_name, committee_party FROM enriched"
)
_SUMMARY = f"""
  {whole('count(*)', 'total_patterns')}, {whole('count(DISTINCT contributor_id)', 'unique_contributors')},
  {whole('count(DISTINCT cmte_id)', 'unique_committees')}, {num('sum(total_donated)', 'total_donated')},
  {num('sum(total_refunded)', 'total_refunded')}, {num('avg(total_donated)', 'avg_donated')},
  {num('avg(total_refunded)', 'avg_refunded')}, {num('avg(refund_pct)', 'avg_refund_pct')},
  {whole('count(*) FILTER (WHERE refund_pct >= 100)', 'full_refunds')},
  {whole('count(*) FILTER (WHERE refund_pct > 0 AND refund_pct < 100)', 'partial_refunds')},
  {whole('count(*) FILTER (WHERE refund_pct > 100)', 'excess_refunds')},
  {whole('min(donation_year)', 'min_donation_year')}, {whole('max(donation_year)', 'max_donation_year')},
  {num('median(CAST(total_donated AS DOUBLE))', 'median_donated')},
  {num('median(CAST(total_refunded AS DOUBLE))', 'median_refunded')},
  {whole('(SELECT count(*) FROM contributions WHERE transaction_amt > 0)', 'total_contribution_count')},
  {num('(SELECT sum(transaction_amt) FROM contributions WHERE transaction_amt > 0)', 'total_contribution_amount')}"""
_TIMING = f"""
  {num('avg(days_to_refund)', 'avg_days_to_refund')}, {num('median(days_to_refund)', 'median_days_to_refund')},
  {whole('min(days_to_refund)', 'min_days_to_refund')}, {whole('max(days_to_refund)', 'max_days_to_refund')},
  {", ".join(whole(f'count(*) FILTER (WHERE days_to_refund <= {d})', f'refunds_within_{d}_days')
             for d in (30, 90, 180, 365))}"""
SQL["refund_summary"] = with_views(f"SELECT {_SUMMARY} FROM patterns")
SQL["refund_timing"] = with_views(f"SELECT {_TIMING} FROM patterns")
SQL["refund_report"] = with_views(f"""SELECT {_SUMMARY}, {_TIMING},
  {num('CAST(sum(total_refunded) AS DOUBLE) / (SELECT CAST(sum(transaction_amt) AS DOUBLE) FROM contributions WHERE transaction_amt > 0) * 100', 'refunds_pct_of_total')}
FROM patterns""")


def _even(expr, name):
    return num(f"round_even(CAST({expr} AS DOUBLE) * 100, 0) / 100", name)


SQL["refunds_by_year"] = with_views(f"""
SELECT {whole('donation_year', 'donation_year')}, {whole('count(DISTINCT contributor_id)', 'unique_contributors')},
  {whole('count(DISTINCT cmte_id)', 'unique_committees')}, {_even('sum(total_donated)', 'total_donated')},
  {_even('avg(CAST(total_donated AS DOUBLE))', 'avg_donated')}, {_even('sum(total_refunded)', 'total_refunded')},
  {_even('avg(CAST(total_refunded AS DOUBLE))', 'avg_refunded')}, {_even('avg(refund_pct)', 'avg_refund_pct')}
FROM patterns GROUP BY donation_year""")
SQL["refunds_by_state"] = with_views(f"""
SELECT state, {whole('count(DISTINCT contributor_id)', 'unique_contributors')},
  {_even('sum(total_donated)', 'total_donated')}, {_even('sum(total_refunded)', 'total_refunded')},
  {_even('avg(refund_pct)', 'avg_refund_pct')} FROM enriched WHERE state IS NOT NULL GROUP BY state""")
SQL["refunds_by_party"] = with_views(f"""
SELECT committee_party, {whole('count(DISTINCT contributor_id)', 'unique_contributors')},
  {whole('count(DISTINCT cmte_id)', 'unique_committees')},
  {_even('sum(total_donated)', 'total_donated')}, {_even('sum(total_refunded)', 'total_refunded')},
  {_even('avg(refund_pct)', 'avg_refund_pct')} FROM enriched WHERE committee_party IS NOT NULL
GROUP BY committee_party""")


def histogram_sql(source, expr, bins, digits=4):
    """Bins of ``expr`` over its own range; ``bins`` may be SQL."""
    return with_views(f"""
SELECT {whole('i', 'bin')}, {num('lo + (hi - lo) / nb * i', 'bin_start', digits)},
  {num('lo + (hi - lo) / nb * (i + 1)', 'bin_end', digits)}, {whole('coalesce(c.n, 0)', 'n')}
FROM (SELECT lo, hi, nb, unnest(range(0, CAST(nb AS BIGINT))) AS i FROM lim) s
LEFT JOIN (SELECT least(floor((x - lo) / (hi - lo) * nb), nb - 1) AS b, count(*) AS n FROM v, lim GROUP BY 1) c
  ON s.i = c.b""", f"""
v AS (SELECT CAST({expr} AS DOUBLE) AS x FROM {source}),
lim AS (SELECT min(x) AS lo, max(x) AS hi, {bins} AS nb FROM v)""")


SQL["refund_pct_histogram"] = histogram_sql("patterns", "least(refund_pct, 200)", 50)
SQL["refund_days_histogram"] = histogram_sql("patterns", "least(days_to_refund, 730)", 50)

# --- Exploration ------------------------------------------------------------

SQL["summary_statistics"] = with_views(f"""
SELECT {whole('count(*)', 'total_contributors')}, {num('sum(total_amount)', 'total_donated')},
  {num('avg(total_amount)', 'avg_total_per_contributor')}, {whole('sum(total_donations)', 'total_transactions')},
  {num('avg(total_donations)', 'avg_donations_per_contributor')}, {num('avg(avg_donation_amount)', 'avg_donation_amount')}
FROM giving""")
_LOG_AMOUNT = "log10(greatest(CAST(total_amount AS DOUBLE), 1))"
SQL["distribution_points"] = with_views(f"""
SELECT id, {whole('total_donations', 'total_donations')}, {num(_LOG_AMOUNT, 'log_amount')},
  CASE WHEN primary_party IN ('DEM', 'REP') THEN primary_party ELSE 'OTHER' END AS party_group FROM giving""")
SQL["amount_histogram"] = histogram_sql("giving", _LOG_AMOUNT, 100)
SQL["donation_count_histogram"] = histogram_sql("giving", "total_donations", "least(max(x), 200)")
SQL["average_gift_histogram"] = histogram_sql(
    "giving", "log10(greatest(CAST(avg_donation_amount AS DOUBLE), 1))", 100
)
SQL["amount_mean_and_median"] = with_views(
    f"SELECT {num('avg(total_amount)', 'mean')}, {num('median(CAST(total_amount AS DOUBLE))', 'median')} FROM giving"
)
SQL["one_time_vs_repeat"] = with_views(f"""
SELECT {whole('count(*) FILTER (WHERE total_donations = 1)', 'one_time')},
  {whole('count(*) FILTER (WHERE total_donations > 1)', 'repeat')},
  {num('count(*) FILTER (WHERE total_donations = 1) / count(*)', 'one_time_share')},
  {num('count(*) FILTER (WHERE total_donations > 1) / count(*)', 'repeat_share')} FROM giving""")
SQL["annual_trends"] = with_views(f"""
SELECT {wholes('year num_donors')}, {nums('total_donated avg_donation')},
  {num("coalesce((CAST(total_donated AS DOUBLE) / lag(CAST(total_donated AS DOUBLE)) OVER (ORDER BY year) - 1) * 100, 0)", 'yoy_growth')}
FROM (SELECT year(last_donation_date) AS year, count(*) AS num_donors, sum(total_amount) AS total_donated,
  avg(total_amount) AS avg_donation FROM giving WHERE year(last_donation_date) BETWEEN 1995 AND 2001 GROUP BY 1)""")
SQL["election_cycle_summary"] = with_views(f"""
SELECT CASE WHEN year IN (2012, 2016, 2020, 2024) THEN 'Presidential' ELSE 'Midterm' END AS cycle,
  {num('avg(total_donated)', 'total_donated')}, {num('avg(num_donors)', 'num_donors')},
  {num('avg(avg_donation)', 'avg_donation')}
FROM (SELECT year(last_donation_date) + 17 AS year, count(*) AS num_donors, sum(total_amount) AS total_donated,
  avg(total_amount) AS avg_donation FROM giving GROUP BY 1)
WHERE year BETWEEN 2010 AND 2024 AND year % 2 = 0 GROUP BY 1""")


def _top_sql(c, junk):
    return f"""SELECT {c}, {wholes('num_donors')}, {nums('total_donated avg_donation')} FROM (
  SELECT {c}, count(*) AS num_donors, sum(total_amount) AS total_donated, avg(total_amount) AS avg_donation
  FROM giving WHERE {c} IS NOT NULL AND {c} <> '' AND {c} NOT IN ({junk})
  GROUP BY {c} ORDER BY total_donated DESC, {c} LIMIT 15)"""


_JUNK = "'INFORMATION REQUESTED', 'NONE', 'N/A', 'NA'"
SQL["top_occupations"] = with_views(_top_sql("occupation", _JUNK))
SQL["top_employers"] = with_views(
    _top_sql("employer", _JUNK + ", 'SELF', 'SELF-EMPLOYED', 'SELF EMPLOYED'")
)
SQL["reranked_occupations"] = with_views(f"""
SELECT occupation, row_number() OVER (ORDER BY avg_donation DESC, occupation) AS rank_by_avg,
  row_number() OVER (ORDER BY num_donors DESC, occupation) AS rank_by_count
FROM ({_top_sql('occupation', _JUNK)})""")
_SEGMENT = """CASE WHEN total_amount < 200 THEN 'Small (<$200)' WHEN total_amount BETWEEN 200 AND 2900
  THEN 'Medium ($200-$2,900)' ELSE 'Large (>$2,900)' END"""
_SEGMENTS = f"""segs AS (SELECT {_SEGMENT} AS donor_segment, primary_party, count(*) AS num_donors,
  sum(total_amount) AS total_donated, avg(total_amount) AS avg_donation FROM giving GROUP BY 1, 2)"""
SQL["donor_segments"] = with_views(
    f"SELECT donor_segment, primary_party, {wholes('num_donors')}, {nums('total_donated avg_donation')} FROM segs",
    _SEGMENTS,
)
SQL["segment_totals"] = with_views(
    f"SELECT donor_segment, {whole('sum(num_donors)', 'num_donors')}, {num('sum(total_donated)', 'total_donated')}, "
    f"{num('avg(avg_donation)', 'avg_donation')} FROM segs GROUP BY donor_segment", _SEGMENTS,
)
SQL["segment_party_pivot"] = with_views(f"""
SELECT s.donor_segment, {", ".join(whole(f"coalesce(sum(num_donors) FILTER (WHERE primary_party = '{p}'), 0)", f'"{p}"') for p in PARTIES)}
FROM (VALUES ('Small (<$200)'), ('Medium ($200-$2,900)'), ('Large (>$2,900)')) s(donor_segment)
LEFT JOIN segs ON s.donor_segment = segs.donor_segment GROUP BY s.donor_segment""", _SEGMENTS)
_STATES = f"""bystate AS (SELECT *, DEM / total * 100 AS dem_pct, REP / total * 100 AS rep_pct,
  DEM / total * 100 - REP / total * 100 AS lean FROM (
  SELECT state, {", ".join(f"coalesce(CAST(sum(total_amount) FILTER (WHERE primary_party = '{p}') AS DOUBLE), 0) AS {p}" for p in PARTIES)},
    CAST(sum(total_amount) AS DOUBLE) AS total
  FROM giving WHERE length(state) = 2 GROUP BY state) WHERE total > 1e6)"""
SQL["party_by_state"] = with_views(
    f"SELECT state, {nums(' '.join(PARTIES) + ' total dem_pct rep_pct lean')} FROM bystate", _STATES
)
SQL["most_partisan_states"] = with_views(f"""
SELECT 'DEM' AS list, state, {nums('dem_pct lean')} FROM (SELECT * FROM bystate ORDER BY dem_pct DESC, state LIMIT 10)
UNION ALL
SELECT 'REP', state, {nums('dem_pct lean')} FROM (SELECT * FROM bystate ORDER BY lean, state LIMIT 10)""", _STATES)
SQL["transactions_by_year"] = with_views(f"""
SELECT {wholes('year num_donations num_refunds')}, {nums('total_donations total_refunds')},
  {num('num_refunds / (num_donations + num_refunds) * 100', 'refund_rate')},
  {num('CAST(total_refunds AS DOUBLE) / CAST(total_donations + total_refunds AS DOUBLE) * 100', 'refund_amount_rate')}
FROM (SELECT year(transaction_dt) AS year, count(*) FILTER (WHERE transaction_amt > 0) AS num_donations,
  count(*) FILTER (WHERE transaction_amt < 0) AS num_refunds,
  sum(CASE WHEN transaction_amt > 0 THEN transaction_amt ELSE 0 END) AS total_donations,
  sum(CASE WHEN transaction_amt < 0 THEN abs(transaction_amt) ELSE 0 END) AS total_refunds
FROM contributions WHERE year(transaction_dt) BETWEEN 1980 AND 2025 GROUP BY 1) WHERE num_donations > 100""")
_TENURE = """tenure AS (SELECT id, total_donations, total_amount, primary_party,
  date_diff('day', first_donation_date, last_donation_date) AS donor_tenure_days,
  CASE WHEN total_donations = 1 THEN 'One-Time' WHEN total_donations <= 5 THEN 'Repeat (2-5)'
       ELSE 'Loyal (6+)' END AS donor_type
  FROM giving WHERE first_donation_date IS NOT NULL AND last_donation_date IS NOT NULL)"""
SQL["donor_tenure"] = with_views(
    f"SELECT id, {wholes('total_donations donor_tenure_days')}, {nums('total_amount')}, primary_party, donor_type "
    "FROM tenure", _TENURE
)
SQL["donor_retention"] = with_views(f"""
SELECT donor_type, {whole('count(*)', 'num_donors')}, {num('avg(total_amount)', 'mean_lifetime_value')},
  {num('sum(total_amount)', 'total_donated')}, {num('avg(donor_tenure_days)', 'mean_tenure_days')}
FROM tenure GROUP BY donor_type""", _TENURE)
SQL["frequency_segmentation"] = with_views(f"""
SELECT CASE WHEN total_donations = 1 THEN '1x donors' WHEN total_donations = 2 THEN '2x donors'
       WHEN total_donations BETWEEN 3 AND 5 THEN '3-5x donors' WHEN total_donations BETWEEN 6 AND 12
       THEN '6-12x donors' ELSE '12+x donors' END AS frequency_category,
  {whole('count(*)', 'num_donors')}, {num('avg(total_amount)', 'avg_total_amount')} FROM giving GROUP BY 1""")


def _states_sql(by):
    return with_views(f"""SELECT state, {wholes('num_donors')}, {nums('total_donated')} FROM (
  SELECT state, count(*) AS num_donors, sum(total_amount) AS total_donated FROM giving
  WHERE state IS NOT NULL AND state <> '' GROUP BY state ORDER BY {by} DESC, state LIMIT 20)""")


SQL["states_by_amount"] = _states_sql("total_donated")
SQL["states_by_donors"] = _states_sql("num_donors")
SQL["committee_year_facts"] = with_views(
    f"SELECT cmte_id, cmte_nm, cmte_tp, cmte_pty_affiliation, party_label, {wholes('year num_contributions')}, "
    f"{nums('total_raised avg_contribution')} FROM facts"
)
SQL["top_committees"] = with_views(f"""
SELECT cmte_id, cmte_nm, party_label, {nums('total_raised')} FROM (
  SELECT cmte_id, cmte_nm, party_label, sum(total_raised) AS total_raised FROM facts WHERE cmte_nm IS NOT NULL
  GROUP BY ALL ORDER BY total_raised DESC, cmte_id LIMIT 15)""")
SQL["party_by_year"] = with_views(
    f"SELECT {whole('year', 'year')}, party_label, {num('sum(total_raised)', 'total_raised')} FROM facts GROUP BY year, party_label"
)
SQL["party_mean_contribution"] = with_views(
    f"SELECT party_label, {num('avg(avg_contribution)', 'avg_contribution')} FROM facts GROUP BY party_label"
)
SQL["top_committee_types"] = with_views(f"""
SELECT cmte_type_label, {nums('total_raised')} FROM (
  SELECT CASE cmte_tp WHEN 'H' THEN 'House' WHEN 'S' THEN 'Senate' WHEN 'P' THEN 'Presidential'
    WHEN 'N' THEN 'PAC - Non-Qualified' WHEN 'Q' THEN 'PAC - Qualified' WHEN 'O' THEN 'Super PAC'
    WHEN 'U' THEN 'Single-Issue' WHEN 'X' THEN 'Party - Non-Qualified' WHEN 'Y' THEN 'Party - Qualified'
    WHEN 'Z' THEN 'National Party' ELSE 'Other' END AS cmte_type_label, sum(total_raised) AS total_raised
  FROM facts GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8)""")
SQL["party_value_counts"] = with_views(f"""
SELECT primary_party, {whole('count(*)', 'n')}, {num('count(*) / sum(count(*)) OVER ()', 'share')}
FROM donors WHERE primary_party IS NOT NULL GROUP BY primary_party""")
