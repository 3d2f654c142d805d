"""SQL counterparts of the queries in ``catalog_files``."""

from .oracle import _RAW, SQL, days
from .oracle_base import day, num, whole, with_views

_EMPTY = ", ".join(
    f"coalesce({c}, '') AS {c}" for c in ("state", "zip_code", "employer", "occupation")
)
# The reader strips the whole line, and nothing else of a field.
SQL["load_itcont"] = with_views(f"""
SELECT cmte_id, transaction_pgi, last_name || ', ' || first_name || ' Q JR' AS name, city, {_EMPTY},
  {day('transaction_dt', 'transaction_dt')}, {num('transaction_amt', 'transaction_amt')},
  {whole('sub_id % 1000', 'file_num')}, sub_id, first_name, last_name, 'Q' AS middle_name, 'JR' AS name_suffix,
  CAST(0 AS BIGINT) AS status FROM raw WHERE sub_id % 19 <> 0""", _RAW)
SQL["rejected_lines"] = with_views(
    "SELECT 'expected 21 fields, found 20' AS error_message, count(*) AS n FROM contributions WHERE sub_id % 19 = 0"
)
SQL["resume_load"] = with_views(
    f"SELECT sub_id, cmte_id, {num('transaction_amt', 'transaction_amt')} FROM contributions "
    "WHERE sub_id % 19 <> 0 AND sub_id % 3 = 0"
)
SQL["typed_contributions"] = with_views(f"""
SELECT CASE WHEN sub_id % 11 = 0 THEN 'tran_id' ELSE '' END AS errors, count(*) AS n,
  {num('sum(transaction_amt)', 'amount')} FROM contributions GROUP BY 1""")
SQL["saved_splits"] = with_views(f"""
SELECT id, primary_party, {days('first_donation_date last_donation_date')},
  CASE WHEN year(last_donation_date) <= 1999 THEN 'train' WHEN year(last_donation_date) = 2000 THEN 'val' ELSE 'test' END AS split
FROM donors WHERE year(last_donation_date) BETWEEN 1980 AND 2001""")
SQL["csv_round_trip"] = SQL["refunds_by_year"]
SQL["upserted_rows"] = f"""
WITH r AS (SELECT CASE WHEN l_orderkey % 7 <> 0 THEN l_orderkey END AS k, l_quantity, l_partkey, l_linenumber, l_suppkey,
    l_partkey % 2 AS stage FROM lineitem)
SELECT k AS l_orderkey, {num('arg_max(l_quantity, (stage, l_linenumber, l_partkey, l_suppkey, l_quantity))', 'l_quantity')},
  arg_min(l_partkey, (stage, l_linenumber, l_partkey, l_suppkey, l_quantity)) AS l_partkey FROM r WHERE k IS NOT NULL GROUP BY k
UNION ALL SELECT NULL, {num('l_quantity', 'l_quantity')}, l_partkey FROM r WHERE k IS NULL"""
SQL["merged_by_key"] = SQL["upserted_rows"]
SQL["streamed_ingest"] = with_views(f"""
SELECT {whole('(SELECT count(*) FROM keyed WHERE sub_id % 5 <> 0)', 'lines')},
  {whole('(SELECT count(*) FROM keyed WHERE sub_id % 5 IN (0, 1))', 'lines_again')}, count(*) AS rows,
  {num('sum(transaction_amt)', 'amount')}, {whole('count(DISTINCT donor_key)', 'donors')}
FROM (SELECT * FROM keyed WHERE sub_id % 19 <> 0
  QUALIFY row_number() OVER (PARTITION BY sub_id ORDER BY transaction_dt, transaction_amt) = 1)""", _RAW)


def _changed(key, new, old):
    return f"CASE WHEN right({key}, 1) IN ('0', '3', '6') THEN {new} ELSE {old} END"


# Only the columns a second edition may change have changed; the others keep the first value.
SQL["load_candidates"] = with_views(f"""
SELECT cand_id, {_changed('cand_id', "'NEW NAME'", 'cand_name')} AS cand_name,
  coalesce(cand_pty_affiliation, '') AS cand_pty_affiliation,
  {whole(_changed('cand_id', '2008', 'cand_election_yr'), 'cand_election_yr')}, cand_office, 'x' AS cand_st FROM candidates""")
SQL["load_committees"] = with_views(f"""
SELECT cmte_id, {_changed('cmte_id', "'NEW NAME'", 'cmte_nm')} AS cmte_nm, cmte_tp,
  {_changed('cmte_id', "'ZZ'", 'cmte_st')} AS cmte_st, coalesce(cmte_pty_affiliation, '') AS cmte_pty_affiliation
FROM committees""")
SQL["load_links"] = with_views(f"""
SELECT cand_id, cmte_id, CAST(2000 AS BIGINT) AS cand_election_yr,
  {whole(_changed('cmte_id', '2004', '2002'), 'fec_election_yr')}, CAST(7 AS BIGINT) AS linkage_id,
  {_changed('cmte_id', "'S'", "'H'")} AS cmte_tp FROM links""")
