"""SQL counterparts of the queries in ``catalog_models``."""

from .oracle import SQL, histogram_sql, nums, wholes
from .oracle_base import PARTIES, num, whole, with_views

# --- Samples and splits -----------------------------------------------------

SQL["modelling_cohort"] = with_views(
    f"SELECT id, primary_party, {num('total_amount', 'total_amount')} FROM donors "
    "WHERE total_donations >= 3 AND primary_party IS NOT NULL AND total_amount > 0"
)
SQL["temporal_splits"] = with_views(f"""
SELECT CASE WHEN y <= 1999 THEN 'train' WHEN y = 2000 THEN 'val' ELSE 'test' END AS split, id,
  {whole('y', 'last_donation_year')}
FROM (SELECT id, year(last_donation_date) AS y FROM donors) WHERE y BETWEEN 1980 AND 2001""")
_NUMBERED = """numbered AS (SELECT *, contributor_id * 1000000 + CAST(substr(cmte_id, 2) AS BIGINT) AS id FROM totals)"""
_CHUNKS = """
SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY id) AS rn FROM (
  SELECT n.*, (SELECT max(i) FROM range(0, 10) r(i) WHERE i * (hi - lo) // 10 <= n.id - lo) AS chunk
  FROM {source} n, (SELECT min(id) AS lo, max(id) AS hi FROM {source}))"""
SQL["spread_sample_pairs"] = with_views(
    f"SELECT id, {whole('total_donations', 'total_donations')} FROM ({_CHUNKS.format(source='numbered')}) WHERE rn <= 500",
    _NUMBERED,
)
SQL["stratified_split_counts"] = with_views(f"""
SELECT primary_party, split, {whole('n', 'n')} FROM (
  SELECT primary_party, unnest(['test', 'val', 'train']) AS split,
    unnest([round(n * 0.15), round(n * 0.15), n - 2 * round(n * 0.15)]) AS n
  FROM (SELECT primary_party, count(*) AS n FROM giving WHERE primary_party IS NOT NULL AND total_donations >= 1
        GROUP BY primary_party)) WHERE n > 0""")
SQL["shuffled_split_counts"] = f"""
SELECT {whole('floor(count(*) * 0.8)', 'train')}, {whole('floor(count(*) * 0.8)', 'ids')},
  {whole('count(*) - floor(count(*) * 0.8)', 'test')} FROM customer"""

# --- Features ---------------------------------------------------------------

_TENURE = "date_diff('day', first_donation_date, last_donation_date)"
SQL["temporal_features"] = with_views(f"""
SELECT id, {whole(f'coalesce({_TENURE}, 0)', 'donor_tenure_days')},
  {num(f'coalesce(total_donations / ({_TENURE} / 365.25 + 1), 0)', 'donation_frequency')},
  {whole('year(first_donation_date)', 'first_donation_year')}, {whole('year(last_donation_date)', 'last_donation_year')},
  {whole('month(first_donation_date)', 'first_donation_month')}, {whole('recency_days', 'recency_days')} FROM donors""")


def _entropy():
    total = " + ".join(f"CAST(coalesce({p.lower()}_amount, 0) AS DOUBLE)" for p in PARTIES)
    shares = ", ".join(
        f"CAST(coalesce({p.lower()}_amount, 0) AS DOUBLE) / (CASE WHEN ({total}) = 0 THEN 1 ELSE ({total}) END) + 1e-10"
        for p in PARTIES
    )
    return f"-(SELECT sum(CASE WHEN s > 0 THEN s * log2(s) ELSE 0 END) FROM (SELECT unnest([{shares}]) AS s))"


_BEHAVIOR = f"""behavior AS (SELECT *, {_entropy()} AS party_diversity,
  CASE WHEN total_donations > 1 THEN 1 ELSE 0 END AS is_repeat_donor,
  CASE WHEN total_donations >= 5 THEN 1 ELSE 0 END AS is_frequent_donor,
  CAST(amount_last_2years AS DOUBLE) / nullif(CAST(total_amount AS DOUBLE) + 1, 0) AS recent_activity_ratio,
  coalesce({_TENURE}, 0) AS donor_tenure_days,
  coalesce(total_donations / ({_TENURE} / 365.25 + 1), 0) AS donation_frequency,
  year(first_donation_date) AS first_donation_year, year(last_donation_date) AS last_donation_year,
  month(first_donation_date) AS first_donation_month FROM donors),
feats AS (SELECT *, 1 - party_diversity / log2(6) AS party_loyalty FROM behavior)"""
SQL["behavioral_features"] = with_views(
    f"SELECT id, {nums('party_diversity party_loyalty recent_activity_ratio')}, "
    f"{wholes('is_repeat_donor is_frequent_donor')} FROM feats WHERE total_amount > 0", _BEHAVIOR
)


def _clean(c):
    return f"trim(upper(coalesce(nullif({c}, ''), 'UNKNOWN')))"


def _top(source, c, n):
    return f"(SELECT v FROM (SELECT {_clean(c)} AS v, count(*) AS k FROM {source} GROUP BY 1 ORDER BY k DESC, v LIMIT {n}))"


def _grouped(source, n):
    return ", ".join(
        f"CASE WHEN {_clean(c)} IN {_top(source, c, n)} THEN {_clean(c)} ELSE 'OTHER' END AS {c}_grouped"
        for c in ("employer", "occupation")
    )


_PLACE = """coalesce(nullif(state, ''), 'UNK') AS state,
  coalesce(nullif(left(trim(zip_code), 3), ''), 'UNK') AS zip_prefix"""
SQL["demographic_features"] = with_views(f"SELECT id, {_PLACE}, {_grouped('donors', 40)} FROM donors")
_HISTORY = (
    "total_donations total_amount avg_donation_amount donations_last_2years amount_last_2years recency_days "
    "donor_tenure_days donation_frequency unique_committees party_diversity party_loyalty is_repeat_donor "
    "is_frequent_donor recent_activity_ratio first_donation_year last_donation_year first_donation_month "
    + " ".join(f"{p.lower()}_donations" for p in PARTIES)
).split()
SQL["feature_medians"] = with_views(
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {num(f'median(CAST({c} AS DOUBLE))', 'median')} FROM feats" for c in _HISTORY
    ), _BEHAVIOR,
)
SQL["imputed_features"] = with_views(f"""
SELECT id, {_PLACE}, {_grouped('tr', 100)},
  {", ".join(num(f'coalesce(CAST({c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM tr))', c) for c in _HISTORY)}
FROM feats WHERE last_donation_year > 2000 AND last_donation_year <= 2030""",
    _BEHAVIOR + ",\ntr AS (SELECT * FROM feats WHERE last_donation_year BETWEEN 1980 AND 2000)",
)
_ZIP = """zips AS (SELECT left(zip_code, 3) AS zip3, avg(avg_donation_amount) AS avg_donation,
  avg(total_donations) AS avg_donations_count, avg(dem_pct) AS dem_pct, avg(rep_pct) AS rep_pct,
  FROM donors WHERE zip_code IS NOT NULL GROUP BY 1),
zip_party AS (SELECT zip3, primary_party FROM (SELECT *, row_number() OVER (PARTITION BY zip3 ORDER BY n DESC, primary_party) AS rn
  FROM (SELECT left(zip_code, 3) AS zip3, primary_party, count(*) AS n FROM donors
        WHERE zip_code IS NOT NULL AND primary_party IS NOT NULL GROUP BY 1, 2)) WHERE rn = 1)""".replace("rep_pct,\n  FROM", "rep_pct\n  FROM")
SQL["zip_demographics"] = with_views(
    f"SELECT zip3, {nums('avg_donation avg_donations_count dem_pct rep_pct')}, primary_party "
    "FROM zips LEFT JOIN zip_party USING (zip3)", _ZIP
)
SQL["new_donor_features"] = with_views(f"""
SELECT newcomer, CASE WHEN newcomer % 4 <> 0 THEN 'SA' ELSE 'UNK' END AS state_known, left(zip, 3) AS zip_prefix,
  'UNKNOWN' AS employer_grouped, 'UNKNOWN' AS occupation_grouped,
  {num("CASE WHEN z.zip3 IS NULL THEN 0 ELSE avg_donation END", 'avg_donation_amount')},
  {num("CASE WHEN z.zip3 IS NULL THEN 0 ELSE avg_donations_count END", 'total_donations')},
  {num("CASE WHEN z.zip3 IS NULL THEN 0.5 ELSE dem_pct END", 'dem_pct')},
  {num("CASE WHEN z.zip3 IS NULL THEN 0.5 ELSE rep_pct END", 'rep_pct')},
  coalesce(p.primary_party, 'DEM') AS primary_party
FROM (SELECT s_suppkey AS newcomer, lpad(CAST(s_suppkey * 13 % 1200 * 83 AS VARCHAR), 5, '0') AS zip FROM supplier) n
LEFT JOIN zips z ON left(zip, 3) = z.zip3 LEFT JOIN zip_party p ON left(zip, 3) = p.zip3""", _ZIP)

# --- Repeat-gift likelihood -------------------------------------------------

_CUT = "DATE '1999-01-01'"
SQL["label_pairs"] = with_views(
    f"SELECT contributor_id, cmte_id, {whole(f'CASE WHEN last_donation_date < {_CUT} THEN 0 ELSE 1 END', 'donated_after_cutoff')} "
    f"FROM totals WHERE first_donation_date < {_CUT}"
)
_POINT = f"""point AS (
  SELECT contributor_id, cmte_id, count(*) AS cc_total_donations, sum(transaction_amt) AS cc_total_amount,
    avg(transaction_amt) AS cc_avg_amount, coalesce(stddev_pop(CAST(transaction_amt AS DOUBLE)), 0) AS cc_stddev_amount,
    date_diff('day', max(transaction_dt), {_CUT}) AS cc_days_since_last,
    date_diff('day', min(transaction_dt), max(transaction_dt)) AS cc_donation_span,
    CASE WHEN count(*) > 1 THEN date_diff('day', min(transaction_dt), max(transaction_dt)) / (count(*) - 1) ELSE 0 END AS cc_avg_frequency,
    count(*) FILTER (WHERE transaction_pgi = 'P') AS cc_donations_primary,
    count(*) FILTER (WHERE transaction_pgi = 'G') AS cc_donations_general,
    CASE WHEN count(*) > 1 THEN 1 ELSE 0 END AS cc_is_recurring
  FROM contributions WHERE transaction_dt < {_CUT} GROUP BY contributor_id, cmte_id
),
target AS (
  SELECT contributor_id, cmte_id, transaction_amt AS target_amount FROM (
    SELECT *, row_number() OVER (PARTITION BY contributor_id, cmte_id ORDER BY transaction_dt, sub_id, transaction_amt NULLS FIRST) AS rn
    FROM contributions WHERE transaction_dt >= {_CUT}) WHERE rn = 1
)"""
_POINT_COLUMNS = (
    f"{wholes('cc_total_donations cc_days_since_last cc_donation_span cc_donations_primary cc_donations_general cc_is_recurring')}, "
    f"{nums('cc_total_amount cc_avg_amount cc_stddev_amount cc_avg_frequency')}"
)
SQL["point_in_time_features"] = with_views(f"SELECT contributor_id, cmte_id, {_POINT_COLUMNS} FROM point", _POINT)
SQL["features_of_repeat_pairs"] = with_views(
    f"SELECT contributor_id, cmte_id, {_POINT_COLUMNS} FROM point WHERE (contributor_id, cmte_id) IN "
    f"(SELECT (contributor_id, cmte_id) FROM totals WHERE first_donation_date < {_CUT} AND last_donation_date >= {_CUT})",
    _POINT,
)
SQL["first_gift_after"] = with_views(
    f"SELECT contributor_id, cmte_id, {num('target_amount', 'target_amount')} FROM target", _POINT
)
SQL["first_gift_after_by_window"] = SQL["first_gift_after"]


def _training(lapsed, repeat):
    """Training rows from the lapsed and the repeat rows of ``totals``."""
    return f"""{_POINT},
pairs AS (
  SELECT contributor_id, cmte_id, total_donations AS cc_total_donations, total_amount AS cc_total_amount,
    avg_amount AS cc_avg_amount, coalesce(stddev_amount, 0) AS cc_stddev_amount,
    date_diff('day', last_donation_date, {_CUT}) AS cc_days_since_last, donation_span_days AS cc_donation_span,
    avg_days_between_donations AS cc_avg_frequency, donations_primary AS cc_donations_primary,
    donations_general AS cc_donations_general, is_recurring AS cc_is_recurring,
    CAST(avg_amount AS DOUBLE) AS target_amount, 0 AS donated_after_cutoff
  FROM {lapsed}
  UNION ALL BY NAME
  SELECT p.*, CAST(t.target_amount AS DOUBLE) AS target_amount, 1 AS donated_after_cutoff
  FROM point p JOIN target t ON p.contributor_id = t.contributor_id AND p.cmte_id = t.cmte_id
  JOIN {repeat} d ON p.contributor_id = d.contributor_id AND p.cmte_id = d.cmte_id
),
train AS (
  SELECT p.*, i.cmte_party, i.cmte_type, i.cmte_state, i.cand_party, i.has_candidate, d.state AS donor_state,
    left(d.zip_code, 3) AS donor_zip3, coalesce(d.occupation, 'UNKNOWN') AS occupation,
    coalesce(d.employer, 'UNKNOWN') AS employer,
    CASE WHEN d.state = i.cmte_state THEN 1 ELSE 0 END AS same_state
  FROM pairs p LEFT JOIN committee_info i ON p.cmte_id = i.cmte_id LEFT JOIN identities d ON p.contributor_id = d.id
)"""


_LAPSED = f"(SELECT * FROM totals WHERE last_donation_date < {_CUT})"
_REPEAT = f"(SELECT * FROM totals WHERE first_donation_date < {_CUT} AND last_donation_date >= {_CUT})"
SQL["likelihood_training_frame"] = with_views(
    f"SELECT contributor_id, cmte_id, {_POINT_COLUMNS}, {num('target_amount', 'target_amount')}, "
    f"{wholes('donated_after_cutoff has_candidate same_state')}, cmte_party, cmte_type, cmte_state, cand_party, "
    "donor_state, donor_zip3, occupation, employer FROM train", _training(_LAPSED, _REPEAT)
)


def _sampled(condition):
    source = f"(SELECT * FROM numbered WHERE {condition})"
    return f"(SELECT * FROM ({_CHUNKS.format(source=source)}) WHERE rn <= 200)"


SQL["likelihood_sampled_frame"] = with_views(
    f"SELECT contributor_id, cmte_id, {whole('donated_after_cutoff', 'donated_after_cutoff')}, "
    f"{num('target_amount', 'target_amount')} FROM train",
    _NUMBERED + "," + _training(
        _sampled(f"last_donation_date < {_CUT}"),
        _sampled(f"first_donation_date < {_CUT} AND last_donation_date >= {_CUT}"),
    ),
)
_SYN_OCC = """CASE trim(occupation) WHEN 'SELF EMPLOYED' THEN 'SELF-EMPLOYED' WHEN 'INFORMATION REQUESTED' THEN 'UNKNOWN'
  WHEN 'NONE' THEN 'UNKNOWN' WHEN 'N/A' THEN 'UNKNOWN' WHEN '' THEN 'UNKNOWN' ELSE trim(occupation) END"""
_SYN_EMP = """CASE trim(employer) WHEN 'SELF EMPLOYED' THEN 'SELF-EMPLOYED' WHEN 'SELF' THEN 'SELF-EMPLOYED'
  WHEN 'INFORMATION REQUESTED' THEN 'UNKNOWN' WHEN 'NONE' THEN 'UNKNOWN' WHEN 'N/A' THEN 'UNKNOWN'
  WHEN '' THEN 'UNKNOWN' ELSE trim(employer) END"""
_ENCODED = ["cmte_party", "cmte_type", "cmte_state", "cand_party", "donor_state", "donor_zip3", "occupation", "employer"]


def _model_views():
    cats = ["cmte_party", "cmte_type", "cmte_state", "cand_party", "donor_state", "donor_zip3"]
    known = ", ".join(f"coalesce({c}, 'UNKNOWN') AS {c}" for c in cats)
    views = f"""
cleaned AS (SELECT * REPLACE ({_SYN_OCC} AS occupation, {_SYN_EMP} AS employer) FROM train),
grouped AS (SELECT * REPLACE ({known},
  {", ".join(f"CASE WHEN {c} IN (SELECT v FROM (SELECT {c} AS v, count(*) AS k FROM cleaned WHERE contributor_id % 5 <> 0 GROUP BY 1 ORDER BY k DESC, v LIMIT 50)) THEN {c} ELSE 'OTHER' END AS {c}" for c in ("occupation", "employer"))})
  FROM cleaned)"""
    for c in _ENCODED:
        views += f""",
code_{c} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT {c} AS v FROM grouped WHERE contributor_id % 5 <> 0))"""
    return views


SQL["likelihood_model_frame"] = with_views(
    "SELECT contributor_id, cmte_id, "
    + ", ".join(
        num(f"coalesce({c}, 0)", c)
        for c in ("cc_total_donations", "cc_days_since_last", "cc_donation_span", "cc_avg_frequency", "cc_is_recurring",
                  "cc_stddev_amount", "cc_donations_primary", "cc_donations_general", "has_candidate", "same_state")
    )
    + ", " + ", ".join(num(f"coalesce(code_{c}.code, 0)", f"{c}_encoded") for c in _ENCODED)
    + " FROM grouped g "
    + " ".join(f"LEFT JOIN code_{c} ON g.{c} = code_{c}.v" for c in _ENCODED)
    + " WHERE contributor_id % 5 = 0",
    _training(_LAPSED, _REPEAT) + "," + _model_views(),
)

# --- Metrics ----------------------------------------------------------------

_PRED = f"""pred AS (SELECT *, CASE WHEN id % 3 <> 0 THEN primary_party
    ELSE (['DEM', 'REP', 'LIB', 'GRE', 'IND'])[id * 7 % 5 + 1] END AS predicted,
  {", ".join(f"CAST({p.lower()}_amount AS DOUBLE) * (0.8 + (id % 5) / 10.0) + id % 11 AS pred_{p.lower()}_amount" for p in PARTIES)}
  FROM donors WHERE primary_party IS NOT NULL)"""


def _class_views(source, truth, predicted):
    return f"""
lab AS (SELECT DISTINCT {truth} AS label FROM {source} UNION SELECT DISTINCT {predicted} FROM {source}),
cls AS (SELECT label, tp, support, CASE WHEN called > 0 THEN tp / called ELSE 0 END AS precision,
    CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall
  FROM (SELECT label, (SELECT count(*) FROM {source} WHERE {truth} = label AND {predicted} = label) AS tp,
    (SELECT count(*) FROM {source} WHERE {truth} = label) AS support,
    (SELECT count(*) FROM {source} WHERE {predicted} = label) AS called FROM lab)),
scores AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM cls)"""


_CLASS = f"label, {nums('precision recall f1')}, {wholes('support tp')}"
SQL["class_metrics"] = with_views(
    f"SELECT {_CLASS} FROM scores", _PRED + "," + _class_views("pred", "primary_party", "predicted")
)
SQL["weighted_metrics"] = with_views(
    f"SELECT {num('sum(tp) / sum(support)', 'accuracy')}, "
    + ", ".join(num(f"sum({m} * support) / sum(support)", f"{m}_weighted") for m in ("precision", "recall", "f1"))
    + " FROM scores", _PRED + "," + _class_views("pred", "primary_party", "predicted"),
)
SQL["confusion_matrix"] = with_views(
    "SELECT t.p AS truth, "
    + ", ".join(whole(f"count(*) FILTER (WHERE predicted = '{p}')", f'"{p}"') for p in PARTIES)
    + f" FROM (SELECT unnest({PARTIES}) AS p) t LEFT JOIN pred ON t.p = primary_party GROUP BY t.p", _PRED,
)
SQL["simplified_party_metrics"] = with_views(
    f"SELECT s.l AS label, {num('coalesce(precision, 0)', 'precision')}, {num('coalesce(recall, 0)', 'recall')}, "
    f"{num('coalesce(f1, 0)', 'f1')}, {whole('coalesce(support, 0)', 'support')} "
    "FROM (SELECT unnest(['DEM', 'REP', 'OTHER']) AS l) s LEFT JOIN scores ON s.l = label",
    _PRED + """,
three AS (SELECT CASE WHEN primary_party IN ('DEM', 'REP') THEN primary_party ELSE 'OTHER' END AS t,
  CASE WHEN predicted IN ('DEM', 'REP') THEN predicted ELSE 'OTHER' END AS p FROM pred),"""
    + _class_views("three", "t", "p"),
)
SQL["quality_label_metrics"] = (
    "WITH " + _class_views("labels", "quality", "toxic").strip()
    + f" SELECT {whole('label', 'label')}, {nums('precision recall f1')}, {wholes('support tp')} FROM scores"
)
SQL["party_class_weights"] = with_views(
    f"SELECT primary_party, {num('sum(count(*)) OVER () / (count(*) OVER () * count(*))', 'weight')} "
    "FROM donors WHERE primary_party IS NOT NULL GROUP BY primary_party"
)
_SCORED = """scored AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_extendedprice / 105000.0 AS score,
  l_discount AS tied_score, l_tax * l_tax * 100 AS low_score FROM lineitem)"""


def _auc(source, positive, score):
    """Rank-sum form with averaged ranks, as (auc, positives)."""
    return f"""(SELECT (sum(CASE WHEN y = 1 THEN r ELSE 0 END) - sum(y) * (sum(y) + 1) / 2)
    / (CAST(sum(y) AS DOUBLE) * (count(*) - sum(y))) AS auc, sum(y) AS support
  FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r
        FROM (SELECT {positive} AS y, {score} AS s FROM {source})))"""


SQL["roc_auc"] = f"""WITH {_SCORED}
SELECT 'score' AS name, {num('auc', 'auc', 8)}, {whole('support', 'support')} FROM {_auc('scored', 'label', 'score')}
UNION ALL
SELECT 'tied_score', {num('auc', 'auc', 8)}, {whole('support', 'support')} FROM {_auc('scored', 'label', 'tied_score')}"""
SQL["one_vs_rest_auc"] = with_views(
    f"""SELECT class, {num('auc', 'auc', 8)}, {whole('support', 'support')} FROM ovr
UNION ALL SELECT 'weighted', {num('sum(auc * support) / sum(support)', 'auc', 8)}, {whole('sum(support)', 'support')} FROM ovr""",
    _PRED + ",\novr AS (" + " UNION ALL ".join(
        f"SELECT '{p}' AS class, CASE WHEN isnan(auc) THEN NULL ELSE auc END AS auc, support FROM "
        + _auc("pred", f"CASE WHEN primary_party = '{p}' THEN 1 ELSE 0 END", f"pred_{p.lower()}_amount") for p in PARTIES
    ) + ")",
)


def _curve(score):
    return f"""WITH {_SCORED},
c AS (SELECT {score} AS threshold, sum(label) AS pos, count(*) - sum(label) AS neg FROM scored GROUP BY 1)
SELECT {num('threshold', 'threshold')},
  {num('sum(neg) OVER (ORDER BY threshold DESC) / sum(neg) OVER ()', 'fpr')},
  {num('sum(pos) OVER (ORDER BY threshold DESC) / sum(pos) OVER ()', 'tpr')} FROM c"""


SQL["roc_curve"] = _curve("low_score")
SQL["roc_curve_unique_scores"] = _curve("score")
_EDGES = ", ".join(repr(i * 0.1) for i in range(11))
SQL["calibration"] = f"""WITH {_SCORED},
b AS (SELECT i, ([{_EDGES}])[i + 1] AS lo, ([{_EDGES}])[i + 2] AS hi FROM range(0, 10) r(i))
SELECT {whole('i', 'bin')}, {num('coalesce(avg(low_score), (lo + hi) / 2)', 'mean_score')},
  {num('coalesce(avg(label), 0)', 'actual_rate')}, {whole('count(low_score)', 'n')}
FROM b LEFT JOIN scored ON (low_score >= CAST(lo AS DOUBLE) OR i = 0) AND (low_score < CAST(hi AS DOUBLE) OR i = 9)
GROUP BY i, lo, hi"""
SQL["score_histogram_by_class"] = f"""WITH {_SCORED},
lim AS (SELECT label, min(score) AS lo, max(score) AS hi FROM scored GROUP BY label)
SELECT {whole('s.label', 'label')}, {whole('s.i', 'bin')}, {num('lo + (hi - lo) / 30 * i', 'bin_start')},
  {num('lo + (hi - lo) / 30 * (i + 1)', 'bin_end')}, {whole('coalesce(c.n, 0)', 'n')}
FROM (SELECT *, unnest(range(0, 30)) AS i FROM lim) s
LEFT JOIN (SELECT scored.label, least(floor((score - lo) / (hi - lo) * 30), 29) AS b, count(*) AS n
  FROM scored JOIN lim ON scored.label = lim.label GROUP BY ALL) c ON s.label = c.label AND s.i = c.b"""
SQL["residual_histogram"] = histogram_sql("pred", "pred_dem_amount - CAST(dem_amount AS DOUBLE)", 50).replace(
    "v AS (SELECT", _PRED + ",\nv AS (SELECT"
).replace("FROM v)", "FROM v)")
SQL["amount_percentiles"] = f"""WITH {_SCORED}
SELECT {whole('label', 'label')}, {", ".join(num(f"quantile_cont(score, {q})", f"q{i}") for i, q in enumerate((0.05, 0.5, 0.95)))}
FROM scored GROUP BY label"""


def _regression(y, p):
    def r2(test):
        f = f" FILTER (WHERE {test})" if test else ""
        ss = f"sum(({y} - {p}) * ({y} - {p})){f}"
        spread = f"var_pop({y}){f} * count({y}){f}"
        return f"CASE WHEN {spread} > 0 THEN 1 - {ss} / ({spread}) WHEN {ss} = 0 THEN 1 ELSE 0 END"

    pos = f"{y} > 0"
    when = f"CASE WHEN count(*) FILTER (WHERE {pos}) > 0 THEN"
    return ", ".join([
        whole(f"count({y})", "n"), whole(f"count(*) FILTER (WHERE {pos})", "n_positive"),
        num(f"{when} avg(abs({y} - {p})) END", "mae"),
        num(f"{when} sqrt(avg(({y} - {p}) * ({y} - {p}))) END", "rmse"),
        num(f"{when} {r2('')} END", "r2"),
        num(f"{when} avg(abs({y} - {p})) FILTER (WHERE {pos}) END", "mae_nonzero"),
        num(f"{when} sqrt(avg(({y} - {p}) * ({y} - {p})) FILTER (WHERE {pos})) END", "rmse_nonzero"),
        num(f"{when} {r2(pos)} END", "r2_nonzero"),
        num(f"coalesce(avg(abs(({y} - {p}) / {y})) FILTER (WHERE {y} <> 0) * 100, 'inf'::DOUBLE)", "mape"),
        num(f"{when} avg(abs(({y} - {p}) / {y})) FILTER (WHERE {pos}) * 100 END", "mape_positive"),
    ])


SQL["regression_metrics_by_party"] = with_views(
    f"SELECT primary_party, {_regression('y', 'p')} FROM (SELECT primary_party, CAST(lib_amount AS DOUBLE) AS y, "
    "pred_lib_amount AS p FROM pred) GROUP BY primary_party", _PRED
)
_REST = "lib gre ind other".split()
SQL["party_amount_metrics"] = with_views(
    f"SELECT party, {_regression('y', 'p')} FROM long GROUP BY party",
    _PRED + f""",
long AS (SELECT 'DEM' AS party, CAST(dem_amount AS DOUBLE) AS y, pred_dem_amount AS p FROM pred
  UNION ALL SELECT 'REP', CAST(rep_amount AS DOUBLE), pred_rep_amount FROM pred
  UNION ALL SELECT 'OTHER', CAST({" + ".join(f"{p}_amount" for p in _REST)} AS DOUBLE),
    {" + ".join(f"pred_{p}_amount" for p in _REST)} FROM pred)""",
)
_THREE = "CASE WHEN {0} IN ('DEM', 'REP') THEN {0} ELSE 'OTHER' END"


def _model_row(name, predicted):
    source = f"(SELECT {_THREE.format('primary_party')} AS t, {predicted} AS p FROM pred)"
    views = _class_views(source, "t", "p").strip()
    return (
        f"SELECT '{name}' AS model_name, {num('sum(tp) / sum(support)', 'accuracy')}, "
        + ", ".join(num(f"sum({m} * support) / sum(support)", f"{m}_weighted") for m in ("precision", "recall", "f1"))
        + f" FROM (WITH {views} SELECT * FROM scores)"
    )


SQL["model_comparison"] = with_views(
    _model_row("Supervised", _THREE.format("predicted")) + " UNION ALL " + _model_row("Always DEM", "'DEM'"), _PRED
)
_LONG = """SELECT '{name}' AS model_name, 'DEM' AS party, CAST(dem_amount AS DOUBLE) AS y, {dem} AS p FROM pred
  UNION ALL SELECT '{name}', 'REP', CAST(rep_amount AS DOUBLE), {rep} FROM pred
  UNION ALL SELECT '{name}', 'OTHER', CAST({true} AS DOUBLE), {other} FROM pred"""
_TRUE = " + ".join(f"{p}_amount" for p in _REST)
SQL["amount_comparison"] = with_views(
    f"SELECT model_name, party, {_regression('y', 'p')} FROM long GROUP BY model_name, party",
    _PRED + ",\nlong AS ("
    + _LONG.format(name="Supervised", dem="pred_dem_amount", rep="pred_rep_amount", true=_TRUE,
                   other=" + ".join(f"pred_{p}_amount" for p in _REST))
    + " UNION ALL " + _LONG.format(name="Always DEM", dem="0.0", rep="0.0", true=_TRUE, other="0.0") + ")",
)
SQL["other_group_amounts"] = with_views(
    f"SELECT id, {num(' + '.join(f'{p}_amount' for p in _REST), 'other_group')} FROM donors"
)

# --- Clusters ---------------------------------------------------------------

_CLUSTERED = "cl AS (SELECT *, CASE WHEN id % 83 <> 0 THEN id * id % 12 END AS cluster FROM donors)"
_MEANS = {
    "avg_total_donations": "total_donations", "avg_total_amount": "total_amount",
    "avg_donation_amount": "avg_donation_amount", "avg_recency_days": "recency_days",
    "avg_unique_committees": "unique_committees", "avg_dem_pct": "dem_pct", "avg_rep_pct": "rep_pct",
    **{f"avg_{p.lower()}_amount": f"{p.lower()}_amount" for p in PARTIES},
}
SQL["cluster_means"] = with_views(
    f"SELECT {whole('cluster', 'cluster')}, {whole('count(*)', 'size')}, "
    + ", ".join(num(f"avg({c})", name) for name, c in _MEANS.items())
    + " FROM cl WHERE cluster IS NOT NULL GROUP BY cluster", _CLUSTERED,
)


def _ranked(c):
    return f"""(SELECT cluster, {c}, n, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, {c}) AS rank
  FROM (SELECT cluster, {c}, count(*) AS n FROM cl WHERE cluster IS NOT NULL AND {c} IS NOT NULL GROUP BY ALL))"""


def _modes():
    parts = {"employer": "avg_employer", "occupation": "avg_occupation", "primary_party": "dominant_party",
             "state": "dominant_state"}
    joins = " ".join(
        f"LEFT JOIN (SELECT cluster, {c} AS {n} FROM {_ranked(c)} WHERE rank = 1) m_{c} ON k.cluster = m_{c}.cluster"
        for c, n in parts.items()
    )
    cols = ", ".join(f"coalesce({n}, 'UNKNOWN') AS {n}" for n in parts.values())
    return (
        f"modes AS (SELECT k.cluster, k.size, k.avg_donations, k.avg_amount, {cols} FROM (SELECT cluster, count(*) AS size, "
        "avg(total_donations) AS avg_donations, avg(total_amount) AS avg_amount FROM cl WHERE cluster IS NOT NULL "
        f"GROUP BY cluster) k {joins})"
    )


SQL["cluster_modes"] = with_views(
    "SELECT cluster, avg_employer, avg_occupation, dominant_party, dominant_state FROM modes",
    _CLUSTERED + "," + _modes(),
)
SQL["cluster_top_occupations"] = with_views(
    f"SELECT cluster, occupation, n, rank FROM {_ranked('occupation')} WHERE rank <= 5", _CLUSTERED
)
SQL["cluster_top_states"] = with_views(
    f"SELECT cluster, state, n, rank FROM {_ranked('state')} WHERE rank <= 10", _CLUSTERED
)
SQL["cluster_party_distribution"] = with_views(
    f"SELECT cluster, primary_party, n FROM {_ranked('primary_party')}", _CLUSTERED
)
SQL["cluster_summary"] = with_views(
    f"SELECT cluster, size, dominant_party, {nums('avg_donations avg_amount')}, left(avg_occupation, 20) AS top_occupation, "
    "dominant_state AS top_state FROM modes", _CLUSTERED + "," + _modes(),
)
SQL["dominant_party_counts"] = with_views(
    f"SELECT dominant_party, count(*) AS n, {num('count(*) / (SELECT count(*) FROM modes)', 'share')}, "
    f"{num('(SELECT avg(size) FROM modes)', 'mean_size')} FROM modes GROUP BY dominant_party",
    _CLUSTERED + "," + _modes(),
)
SQL["interesting_clusters"] = with_views(
    " UNION ALL ".join(
        f"SELECT '{name}' AS list, cluster, {num(by, 'value')}, dominant_party FROM "
        f"(SELECT * FROM modes ORDER BY {by} DESC, cluster LIMIT 5)"
        for name, by in (("largest", "size"), ("highest_average", "avg_amount"), ("most_frequent", "avg_donations"))
    ), _CLUSTERED + "," + _modes(),
)
_EMB = """e AS (SELECT vec_id, label, i, CAST(embedding[i] AS DOUBLE) AS x FROM embeddings, unnest(range(1, len(embedding) + 1)) r(i)),
cen AS (SELECT label, i, avg(x) AS c FROM e GROUP BY label, i),
dist AS (SELECT e.label, vec_id, sum((x - c) * (x - c)) AS d2 FROM e JOIN cen ON e.label = cen.label AND e.i = cen.i GROUP BY e.label, vec_id)"""
SQL["cluster_quality"] = f"""WITH {_EMB},
sizes AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label)
SELECT {whole('min(n)', 'min_size')}, {whole('max(n)', 'max_size')}, {num('avg(n)', 'mean_size')},
  {num('stddev_pop(n)', 'std_size')}, {num('(SELECT sum(d2) FROM dist)', 'inertia')} FROM sizes"""
SQL["davies_bouldin"] = f"""WITH {_EMB},
s AS (SELECT label, avg(sqrt(d2)) AS s FROM dist GROUP BY label),
gap AS (SELECT a.label AS l, b.label AS m, sqrt(sum((a.c - b.c) * (a.c - b.c))) AS d FROM cen a JOIN cen b
  ON a.i = b.i AND a.label <> b.label GROUP BY a.label, b.label)
SELECT {num('avg(worst)', 'davies_bouldin', 6)} FROM (
  SELECT l, max((a.s + b.s) / d) AS worst FROM gap JOIN s a ON l = a.label JOIN s b ON m = b.label GROUP BY l)"""
SQL["silhouette"] = f"""WITH d AS (
  SELECT a.vec_id, a.label AS own, b.label AS other,
    sum(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) ** 2) AS s,
    count(*) AS n FROM embeddings a JOIN embeddings b ON true GROUP BY a.vec_id, a.label, b.label),
i AS (SELECT vec_id, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a,
  min(CASE WHEN own <> other THEN s / n END) AS b FROM d GROUP BY vec_id)
SELECT {num('avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END)', 'silhouette', 6)} FROM i"""
SQL["euclidean_silhouette"] = f"""WITH d AS (
  SELECT a.vec_id, a.label AS own, b.label AS other,
    sum(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))) AS s,
    count(*) AS n FROM embeddings a JOIN embeddings b ON true WHERE a.vec_id % 20 = 0 GROUP BY a.vec_id, a.label, b.label),
i AS (SELECT vec_id, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a,
  min(CASE WHEN own <> other THEN s / n END) AS b FROM d GROUP BY vec_id)
SELECT {num('avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END)', 'silhouette', 6)} FROM i"""

# --- Neighbours -------------------------------------------------------------

_UNIT = """raw AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
nrm AS (SELECT *, sqrt(list_inner_product(v, v)) AS n FROM raw),
u AS (SELECT vec_id, label, CASE WHEN n > 0 THEN [x / n for x in v] ELSE v END AS x FROM nrm),
pair AS (SELECT a.vec_id AS q, b.vec_id AS nb, a.label AS ql, b.label AS bl,
  round(greatest(list_distance(a.x, b.x) * list_distance(a.x, b.x), 0), 9) AS d FROM u a JOIN u b ON true)"""


def _nearest(where, k):
    return f"""(SELECT q, nb, d, row_number() OVER (PARTITION BY q ORDER BY d, nb) AS rank FROM pair WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY q ORDER BY d, nb) <= {k})"""


_NEIGHBOR = f"q AS query_id, nb AS neighbor_id, {num('d', 'distance', 8)}, rank"
SQL["exact_knn"] = f"WITH {_UNIT} SELECT {_NEIGHBOR} FROM {_nearest('true', 20)}"
SQL["knn_within_clusters"] = (
    f"WITH {_UNIT}, big AS (SELECT label FROM embeddings GROUP BY label HAVING count(*) >= 10) "
    f"SELECT {_NEIGHBOR} FROM {_nearest('ql = bl AND q <> nb AND ql IN (SELECT label FROM big)', 5)}"
)
SQL["neighbor_votes"] = f"""WITH {_UNIT}, near AS (SELECT n.q, e.label, nb * 3 % 101 * 1.0 AS amount
  FROM {_nearest('q <> nb', 15)} n JOIN embeddings e ON n.nb = e.vec_id),
votes AS (SELECT q, label, row_number() OVER (PARTITION BY q ORDER BY count(*) DESC, label) AS rn FROM near GROUP BY q, label)
SELECT v.q AS query_id, {whole('v.label', 'label')}, {num('(SELECT avg(amount) FROM near WHERE near.q = v.q)', 'amount')}
FROM votes v WHERE rn = 1"""

# --- Facts about results that no SQL can give --------------------------------

_COHORT = "giving WHERE primary_party IS NOT NULL AND total_donations >= 1"
SQL["sampled_donors_facts"] = with_views(
    f"SELECT {whole('least(500, count(*))', 'n')}, {whole('least(500, count(*))', 'ids')}, {whole('least(500, count(*))', 'members')} FROM {_COHORT}"
)
SQL["cluster_profile_lists"] = with_views(
    " UNION ALL ".join(
        f"SELECT {whole('cluster', 'cluster_id')}, (SELECT count(*) FROM cl c WHERE c.cluster = r.cluster) AS size, "
        f"'{name}' AS list, {c} AS value, n FROM {_ranked(c)} r WHERE rank <= {most}"
        for name, c, most in (("occupation", "occupation", 5), ("state", "state", 10), ("party", "primary_party", 6))
    ),
    _CLUSTERED,
)
SQL["kmeans_facts"] = "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS misplaced, CAST(10 AS BIGINT) AS centres FROM embeddings"
SQL["mini_batch_facts"] = "SELECT count(*) AS rows, CAST(1 AS BIGINT) AS near_lloyd FROM embeddings"
SQL["fitted_segments"] = with_views(f"""
SELECT split, {whole('sum(n)', 'n')}, (SELECT count(*) FROM {_COHORT}) AS profiled FROM (
  SELECT unnest(['test', 'val', 'train']) AS split,
    unnest([round(n * 0.15), round(n * 0.15), n - 2 * round(n * 0.15)]) AS n
  FROM (SELECT primary_party, count(*) AS n FROM {_COHORT} GROUP BY primary_party)) GROUP BY split HAVING sum(n) > 0""")
SQL["approximate_knn_rows"] = (
    "SELECT vec_id AS query_id, least(20, (SELECT count(*) FROM embeddings)) AS n, least(20, (SELECT count(*) FROM embeddings)) AS ids FROM embeddings"
)
SQL["saved_party_models"] = with_views(f"""
SELECT unnest(['Logistic Regression', 'Random Forest', 'Gradient Boosting', 'Support Vector Machine']) AS model_name,
  (SELECT {whole('sum(round(n * 0.15))', 'n')} FROM (SELECT primary_party, count(*) AS n FROM {_COHORT} GROUP BY primary_party)) AS rows,
  CAST(0 AS BIGINT) AS differing, CAST(1 AS BIGINT) AS metric_rows""")
