"""SQL text of the ledger views, for the reference database of the tests."""

PARTY_SETS = {
    "DEM": "'DEM'",
    "REP": "'REP'",
    "LIB": "'LIB','LBL','LBU','LP','LPF'",
    "GRE": "'GRE','GRN','GLP','DGR'",
    "IND": "'IND','IDP','ICD'",
}
PARTIES = [*PARTY_SETS, "OTHER"]


def num(expr, name, digits=4):
    """A double on the same shifted grid as the queries use."""
    return f"round(CAST({expr} AS DOUBLE) * 1e{digits} + 0.123) / 1e{digits} + 0.0 AS {name}"


def whole(expr, name):
    return f"CAST({expr} AS BIGINT) AS {name}"


def day(expr, name):
    return f"CAST({expr} AS VARCHAR) AS {name}"


def bucket(code):
    whens = " ".join(f"WHEN {code} IN ({codes}) THEN '{p}'" for p, codes in PARTY_SETS.items())
    return f"CASE {whens} ELSE 'OTHER' END"


def cents_average(total, n):
    """Half-away-from-zero average of a two-decimal sum, by whole-number arithmetic."""
    c = f"CAST(({total}) * 100 AS HUGEINT)"
    return (
        f"CASE WHEN ({n}) > 0 THEN sign({c}) * ((2 * abs({c}) + ({n})) // (2 * ({n}))) / 100.0 END"
    )


def primary(prefix=""):
    a = {p: f"{prefix}{p.lower()}_amount" for p in PARTIES}
    whens = ""
    for p in PARTIES[:-1]:
        rest = ", ".join(a[q] for q in PARTIES if q != p)
        whens += f" WHEN {a[p]} >= greatest({rest}) THEN '{p}'"
    anynull = " + ".join(a.values())
    return f"CASE WHEN ({anynull}) IS NULL THEN 'OTHER'{whens} ELSE 'OTHER' END"


def _party_sums():
    out = []
    for p in PARTIES:
        low = p.lower()
        out.append(f"count(*) FILTER (WHERE party = '{p}') AS {low}_donations")
        out.append(f"sum(CASE WHEN party = '{p}' THEN transaction_amt ELSE 0 END) AS {low}_amount")
    return ",\n    ".join(out)


VIEWS = f"""
contributions AS (
  SELECT o_custkey AS contributor_id,
    'C' || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS cmte_id,
    CASE WHEN l_orderkey % 97 = 0 AND l_linenumber = 1 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS transaction_dt,
    CASE WHEN l_orderkey % 101 = 0 AND l_linenumber = 2 THEN NULL
         ELSE CAST(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(14,2)) END AS transaction_amt,
    CASE WHEN l_linestatus = 'O' THEN 'P' ELSE 'G' END AS transaction_pgi,
    (l_orderkey * 10 + l_linenumber) * 1000000 + (l_partkey * 31 + l_suppkey * 7919) % 1000000 AS sub_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
committees AS (
  SELECT 'C' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS cmte_id, s_name AS cmte_nm,
    substr('HSPNQOUXYZW', CAST(s_suppkey % 11 + 1 AS BIGINT), 1) AS cmte_tp,
    'S' || chr(CAST(n_nationkey + 65 AS INTEGER)) AS cmte_st,
    CASE WHEN s_suppkey % 11 = 0 THEN NULL WHEN n_regionkey = 0 THEN 'DEM' WHEN n_regionkey = 1 THEN 'REP'
         WHEN n_regionkey = 2 THEN 'LIB' WHEN n_regionkey = 3 THEN 'GRE' ELSE 'IND' END AS cmte_pty_affiliation
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
candidates AS (
  SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 8, '0') AS cand_id, n_name AS cand_name,
    CASE WHEN n_nationkey = 9 THEN 'CON' WHEN n_nationkey = 12 THEN '' WHEN n_nationkey = 17 THEN NULL
         WHEN n_regionkey = 0 THEN 'DEM' WHEN n_regionkey = 1 THEN 'REP' WHEN n_regionkey = 2 THEN 'LBL'
         WHEN n_regionkey = 3 THEN 'GRN' ELSE 'IDP' END AS cand_pty_affiliation,
    substr('PSH', CAST(n_nationkey % 3 + 1 AS BIGINT), 1) AS cand_office,
    'S' || chr(CAST(n_nationkey + 65 AS INTEGER)) AS cand_office_st,
    2000 + n_nationkey % 3 * 2 AS cand_election_yr
  FROM nation
),
links AS (
  SELECT 'C' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS cmte_id,
    'N' || lpad(CAST(s_nationkey AS VARCHAR), 8, '0') AS cand_id FROM supplier WHERE s_suppkey % 7 <> 0
  UNION ALL
  SELECT 'C' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0'),
    'N' || lpad(CAST((s_nationkey + 1) % 25 AS VARCHAR), 8, '0') FROM supplier WHERE s_suppkey % 5 = 0
),
identities AS (
  SELECT c_custkey AS id, c_name AS last_name, 'F' || CAST(c_custkey % 7 AS VARCHAR) AS first_name,
    'CITY' || CAST(c_custkey % 40 AS VARCHAR) AS city,
    CASE WHEN c_custkey % 53 = 0 THEN NULL WHEN c_custkey % 59 = 0 THEN '' WHEN c_custkey % 61 = 0 THEN 'ZZZ'
         ELSE 'S' || chr(CAST(c_nationkey + 65 AS INTEGER)) END AS state,
    CASE WHEN c_custkey % 47 <> 0 THEN lpad(CAST(c_custkey * 37 % 1000 * 91 AS VARCHAR), 5, '0') END AS zip_code,
    CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 43 = 0 THEN '' WHEN c_custkey % 19 = 0 THEN 'SELF'
         WHEN c_custkey % 23 = 0 THEN 'NONE' ELSE 'Employer ' || CAST(c_custkey * c_custkey % 211 AS VARCHAR) END AS employer,
    CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN ' information requested '
         WHEN c_custkey % 31 = 0 THEN 'INFORMATION REQUESTED' WHEN c_custkey % 13 = 0 THEN 'SELF EMPLOYED'
         ELSE c_mktsegment || ' ' || CAST(c_custkey % 30 AS VARCHAR) END AS occupation
  FROM customer
),
attributed AS (
  SELECT co.*, cm.cmte_nm, cm.cmte_pty_affiliation AS cmte_party, ln.cand_id, ca.cand_name,
    ca.cand_pty_affiliation AS cand_party,
    {bucket("coalesce(ca.cand_pty_affiliation, cm.cmte_pty_affiliation)")} AS party
  FROM contributions co LEFT JOIN committees cm ON co.cmte_id = cm.cmte_id
  LEFT JOIN links ln ON cm.cmte_id = ln.cmte_id LEFT JOIN candidates ca ON ln.cand_id = ca.cand_id
),
sums AS (
  SELECT contributor_id, count(*) AS total_donations, sum(transaction_amt) AS total_amount,
    count(transaction_amt) AS n_amt, min(transaction_dt) AS first_donation_date,
    max(transaction_dt) AS last_donation_date, count(DISTINCT cmte_id) AS unique_committees,
    count(*) FILTER (WHERE transaction_dt >= DATE '1999-12-31') AS donations_last_2years,
    sum(CASE WHEN transaction_dt >= DATE '1999-12-31' THEN transaction_amt ELSE 0 END) AS amount_last_2years,
    {_party_sums()}
  FROM attributed GROUP BY contributor_id
),
profile AS (
  SELECT *, {cents_average('total_amount', 'n_amt')} AS avg_donation_amount,
    date_diff('day', last_donation_date, DATE '2001-12-31') AS recency_days,
    round(coalesce(dem_amount, 0) / nullif(total_amount, 0) * 100, 2) AS dem_pct,
    round(coalesce(rep_amount, 0) / nullif(total_amount, 0) * 100, 2) AS rep_pct,
    {primary()} AS primary_party
  FROM sums
),
donors AS (
  SELECT i.*,
    {", ".join(f"coalesce(p.{c}, 0) AS {c}" if c not in ("total_amount", "amount_last_2years")
               and not c.endswith("_amount")
               else f"CASE WHEN p.contributor_id IS NULL THEN 0 ELSE p.{c} END AS {c}"
               for c in ["total_donations", "total_amount", "donations_last_2years",
                         "amount_last_2years", "unique_committees"]
               + [f"{p.lower()}_{w}" for p in PARTIES for w in ("donations", "amount")])},
    p.first_donation_date, p.last_donation_date, p.avg_donation_amount, p.recency_days, p.dem_pct,
    p.rep_pct, p.primary_party
  FROM identities i LEFT JOIN profile p ON i.id = p.contributor_id
),
giving AS (SELECT * FROM donors WHERE total_amount > 0),
best_candidate AS (
  SELECT cmte_id, cand_id, cand_name, cand_party, cand_office, cand_state FROM (
    SELECT l.cmte_id, c.cand_id, c.cand_name, c.cand_pty_affiliation AS cand_party, c.cand_office,
      c.cand_office_st AS cand_state,
      row_number() OVER (PARTITION BY l.cmte_id ORDER BY c.cand_id DESC) AS rn
    FROM links l JOIN candidates c ON l.cand_id = c.cand_id) WHERE rn = 1
),
committee_info AS (
  SELECT cm.cmte_id, cm.cmte_pty_affiliation AS cmte_party, cm.cmte_tp AS cmte_type, cm.cmte_st AS cmte_state,
    max(ca.cand_pty_affiliation) AS cand_party,
    CASE WHEN max(ca.cand_id) IS NOT NULL THEN 1 ELSE 0 END AS has_candidate
  FROM committees cm LEFT JOIN links l ON cm.cmte_id = l.cmte_id
  LEFT JOIN candidates ca ON l.cand_id = ca.cand_id
  GROUP BY cm.cmte_id, cm.cmte_pty_affiliation, cm.cmte_tp, cm.cmte_st
),
pair_sums AS (
  SELECT contributor_id, cmte_id, count(*) AS total_donations, sum(transaction_amt) AS total_amount,
    avg(transaction_amt) AS avg_amount, min(transaction_amt) AS min_amount, max(transaction_amt) AS max_amount,
    stddev_pop(CAST(transaction_amt AS DOUBLE)) AS stddev_amount, min(transaction_dt) AS first_donation_date,
    max(transaction_dt) AS last_donation_date,
    count(*) FILTER (WHERE transaction_dt >= DATE '2000-12-31') AS donations_last_1year,
    sum(CASE WHEN transaction_dt >= DATE '2000-12-31' THEN transaction_amt ELSE 0 END) AS amount_last_1year,
    count(*) FILTER (WHERE transaction_dt >= DATE '1999-12-31') AS donations_last_2years,
    sum(CASE WHEN transaction_dt >= DATE '1999-12-31' THEN transaction_amt ELSE 0 END) AS amount_last_2years,
    count(*) FILTER (WHERE transaction_pgi = 'P') AS donations_primary,
    count(*) FILTER (WHERE transaction_pgi = 'G') AS donations_general,
    sum(CASE WHEN transaction_pgi = 'P' THEN transaction_amt ELSE 0 END) AS amount_primary,
    sum(CASE WHEN transaction_pgi = 'G' THEN transaction_amt ELSE 0 END) AS amount_general,
    nullif(regr_slope(CAST(transaction_amt AS DOUBLE), CAST(date_diff('day', DATE '2000-01-01', transaction_dt) AS DOUBLE)), 'nan'::DOUBLE) AS amount_trend
  FROM contributions GROUP BY contributor_id, cmte_id
),
totals AS (
  SELECT s.*, date_diff('day', first_donation_date, DATE '2001-12-31') AS days_since_first,
    date_diff('day', last_donation_date, DATE '2001-12-31') AS days_since_last,
    date_diff('day', first_donation_date, last_donation_date) AS donation_span_days,
    CASE WHEN total_donations > 1 THEN date_diff('day', first_donation_date, last_donation_date) / (total_donations - 1)
         ELSE 0 END AS avg_days_between_donations,
    CASE WHEN total_donations > 1 THEN 1 ELSE 0 END AS is_recurring,
    cm.cmte_nm AS cmte_name, cm.cmte_tp AS cmte_type, cm.cmte_pty_affiliation AS cmte_party, cm.cmte_st AS cmte_state,
    b.cand_id, b.cand_name, b.cand_party, b.cand_office, b.cand_state
  FROM pair_sums s LEFT JOIN committees cm ON s.cmte_id = cm.cmte_id LEFT JOIN best_candidate b ON cm.cmte_id = b.cmte_id
),
yearly_d AS (
  SELECT contributor_id, cmte_id, year(transaction_dt) AS donation_year, count(*) AS donation_count,
    sum(transaction_amt) AS total_donated, min(transaction_dt) AS first_donation, max(transaction_dt) AS last_donation
  FROM contributions WHERE transaction_amt > 0 AND transaction_dt IS NOT NULL GROUP BY ALL
),
yearly_r AS (
  SELECT contributor_id, cmte_id, year(transaction_dt) AS refund_year, count(*) AS refund_count,
    sum(abs(transaction_amt)) AS total_refunded, min(transaction_dt) AS first_refund, max(transaction_dt) AS last_refund
  FROM contributions WHERE transaction_amt < 0 AND transaction_dt IS NOT NULL GROUP BY ALL
),
patterns AS (
  SELECT d.*, r.refund_year, r.refund_count, r.total_refunded, r.first_refund, r.last_refund,
    CAST(r.total_refunded AS DOUBLE) / CAST(d.total_donated AS DOUBLE) * 100 AS refund_pct,
    date_diff('day', d.last_donation, r.first_refund) AS days_to_refund
  FROM yearly_d d JOIN yearly_r r ON d.contributor_id = r.contributor_id AND d.cmte_id = r.cmte_id
    AND r.refund_year = d.donation_year + 1
),
enriched AS (
  SELECT p.*, c.last_name, c.state, c.employer, c.primary_party, c.total_amount AS lifetime_amount,
    m.cmte_nm AS committee_name, m.cmte_pty_affiliation AS committee_party
  FROM patterns p
  LEFT JOIN donors c ON p.contributor_id = c.id LEFT JOIN committees m ON p.cmte_id = m.cmte_id
),
facts AS (
  SELECT cm.cmte_id, cm.cmte_nm, cm.cmte_tp, cm.cmte_pty_affiliation, year(transaction_dt) AS year,
    sum(transaction_amt) AS total_raised, count(*) AS num_contributions, avg(transaction_amt) AS avg_contribution,
    CASE WHEN upper(cm.cmte_pty_affiliation) IN ('DEM', 'D') THEN 'Democrat'
         WHEN upper(cm.cmte_pty_affiliation) IN ('REP', 'R') THEN 'Republican' ELSE 'Other/Independent' END AS party_label
  FROM contributions c JOIN committees cm ON c.cmte_id = cm.cmte_id
  WHERE transaction_amt > 0 AND year(transaction_dt) BETWEEN 1980 AND 2030
  GROUP BY ALL HAVING sum(transaction_amt) > 0
)
"""


def with_views(body, more=""):
    """``body`` over the ledger views and the further views in ``more``."""
    extra = f",\n{more}" if more else ""
    return f"WITH {VIEWS.strip()}{extra}\n{body}"
