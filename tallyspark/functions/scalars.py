"""Scalar rules as Column expressions (no Python runs per row)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: party codes, labels and bounds that results depend on. ---
PARTIES = ["DEM", "REP", "LIB", "GRE", "IND", "OTHER"]
PARTY_CODES = {
    "DEM": ["DEM"],
    "REP": ["REP"],
    "LIB": ["LIB", "LBL", "LBU", "LP", "LPF"],
    "GRE": ["GRE", "GRN", "GLP", "DGR"],
    "IND": ["IND", "IDP", "ICD"],
}
COMMITTEE_TYPES = {
    "H": "House",
    "S": "Senate",
    "P": "Presidential",
    "N": "PAC - Non-Qualified",
    "Q": "PAC - Qualified",
    "O": "Super PAC",
    "U": "Single-Issue",
    "X": "Party - Non-Qualified",
    "Y": "Party - Qualified",
    "Z": "National Party",
}
PRESIDENTIAL_YEARS = [2012, 2016, 2020, 2024]
MIDTERM_YEARS = [2010, 2014, 2018, 2022]
SEGMENTS = ["Small (<$200)", "Medium ($200-$2,900)", "Large (>$2,900)"]
FREQUENCIES = ["1x donors", "2x donors", "3-5x donors", "6-12x donors", "12+x donors"]
DONOR_TYPES = ["One-Time", "Repeat (2-5)", "Loyal (6+)"]
OCCUPATION_SYNONYMS = {
    "SELF EMPLOYED": "SELF-EMPLOYED",
    "INFORMATION REQUESTED": "UNKNOWN",
    "NONE": "UNKNOWN",
    "N/A": "UNKNOWN",
    "": "UNKNOWN",
}
EMPLOYER_SYNONYMS = {
    "SELF EMPLOYED": "SELF-EMPLOYED",
    "SELF": "SELF-EMPLOYED",
    "NONE": "UNKNOWN",
    "N/A": "UNKNOWN",
    "INFORMATION REQUESTED": "UNKNOWN",
    "": "UNKNOWN",
}
JUNK_OCCUPATIONS = ["INFORMATION REQUESTED", "NONE", "N/A", "NA"]
JUNK_EMPLOYERS = [
    "INFORMATION REQUESTED", "NONE", "N/A", "NA", "SELF", "SELF-EMPLOYED", "SELF EMPLOYED",
]
# --- End of fixed values. ---

# What Python's str.strip and str.split take as blank within latin-1 text.
BLANK = r"[\s\x1c-\x1f\x85\xa0]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    return F.regexp_replace(_col(c), rf"^{BLANK}+|{BLANK}+$", "")


def parse_mmddyyyy(c) -> Column:
    """A date from exactly eight MMDDYYYY characters; anything else is null."""
    return F.when(F.length(_col(c)) == 8, F.try_to_date(_col(c), "MMddyyyy"))


def safe_decimal(c, precision=14, scale=2) -> Column:
    return _col(c).try_cast(f"decimal({precision},{scale})")


def safe_int(c, as_type="int") -> Column:
    return _col(c).try_cast(as_type)


def donor_key(last="last_name", first="first_name", city="city", state="state",
              zip_code="zip_code", employer="employer") -> Column:
    def text(c):
        return F.coalesce(_col(c), F.lit(""))

    return F.concat_ws(
        "|",
        F.upper(text(last)),
        F.upper(text(first)),
        F.upper(text(city)),
        F.upper(text(state)),
        F.left(text(zip_code), F.lit(5)),
        F.left(F.upper(text(employer)), F.lit(20)),
    )


def party_bucket(cand_party, cmte_party) -> Column:
    """One of six parties; the candidate's code wins, an empty code is OTHER."""
    code = F.coalesce(_col(cand_party), _col(cmte_party))
    out = None
    for party, codes in PARTY_CODES.items():
        hit = code.isin(codes)
        out = F.when(hit, party) if out is None else out.when(hit, party)
    return out.otherwise("OTHER")


def primary_party(amounts) -> Column:
    """First party whose amount is at least every other; OTHER when none is.

    ``amounts`` maps each of the six parties to a column. A null amount makes
    the comparison null, so it never counts as a win.
    """
    out = None
    for party in PARTIES[:-1]:
        wins = F.lit(True)
        for other in PARTIES:
            if other != party:
                wins = wins & (_col(amounts[party]) >= _col(amounts[other]))
        out = F.when(wins, party) if out is None else out.when(wins, party)
    return out.otherwise("OTHER")


def pct_share(part, total) -> Column:
    return F.round(F.coalesce(_col(part), F.lit(0)) / F.nullif(_col(total), F.lit(0)) * 100, 2)


def date_diff(later, earlier) -> Column:
    return F.datediff(_col(later), _col(earlier))


def as_date(value) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def recency_days(last, as_of) -> Column:
    return F.datediff(as_date(as_of), _col(last))


def within_years(c, as_of, years) -> Column:
    return _col(c) >= F.add_months(as_date(as_of), -12 * years)


def party_label(c) -> Column:
    code = F.upper(_col(c))
    return (
        F.when(code.isin("DEM", "D"), "Democrat")
        .when(code.isin("REP", "R"), "Republican")
        .otherwise("Other/Independent")
    )


def simplify_party(c) -> Column:
    return F.when(_col(c).isin("DEM", "REP"), _col(c)).otherwise("OTHER")


def party_group(c) -> Column:
    """DEM, REP or OTHER for the scatter points; null counts as OTHER."""
    code = F.upper(F.coalesce(_col(c), F.lit("OTHER")))
    return F.when(code.isin("DEM", "REP"), code).when(
        code.isin("OTHER", "LIB", "GRE", "IND", ""), "OTHER"
    )


def committee_type_label(c) -> Column:
    pairs = [F.lit(x) for item in COMMITTEE_TYPES.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[_col(c)], F.lit("Other"))


def election_cycle(year) -> Column:
    return (
        F.when(_col(year).isin(PRESIDENTIAL_YEARS), "Presidential")
        .when(_col(year).isin(MIDTERM_YEARS), "Midterm")
        .otherwise("Off-Year")
    )


def donor_segment(amount) -> Column:
    return (
        F.when(_col(amount) < 200, SEGMENTS[0])
        .when(_col(amount).between(200, 2900), SEGMENTS[1])
        .otherwise(SEGMENTS[2])
    )


def frequency_category(n) -> Column:
    return (
        F.when(_col(n) == 1, FREQUENCIES[0])
        .when(_col(n) == 2, FREQUENCIES[1])
        .when(_col(n).between(3, 5), FREQUENCIES[2])
        .when(_col(n).between(6, 12), FREQUENCIES[3])
        .otherwise(FREQUENCIES[4])
    )


def donor_type(n) -> Column:
    return (
        F.when(_col(n) == 1, DONOR_TYPES[0])
        .when(_col(n) <= 5, DONOR_TYPES[1])
        .otherwise(DONOR_TYPES[2])
    )


def fill_unknown(c, word="UNK") -> Column:
    return F.coalesce(F.nullif(_col(c), F.lit("")), F.lit(word))


def zip_prefix(c, n=3) -> Column:
    return fill_unknown(F.left(strip(c), F.lit(n)))


def clean_category(c) -> Column:
    return strip(F.upper(fill_unknown(c, "UNKNOWN")))


def _synonyms(c, table) -> Column:
    text = strip(F.coalesce(_col(c), F.lit("UNKNOWN")))
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[text], text)


def normalise_occupation(c) -> Column:
    return _synonyms(c, OCCUPATION_SYNONYMS)


def normalise_employer(c) -> Column:
    return _synonyms(c, EMPLOYER_SYNONYMS)


def log10_clip(c, lo=1) -> Column:
    return F.log10(F.greatest(_col(c).cast("double"), F.lit(float(lo))))


def clip(c, lo=None, hi=None) -> Column:
    """Bounded value; a null stays null."""
    x = _col(c)
    out = x
    if lo is not None:
        out = F.when(x < lo, F.lit(lo)).otherwise(out)
    if hi is not None:
        out = F.when(x > hi, F.lit(hi)).otherwise(out)
    return out


def same_state(a, b) -> Column:
    return F.coalesce(_col(a) == _col(b), F.lit(False)).cast("int")


def refund_pct(refunded, donated) -> Column:
    """Refunded over donated in percent; null when nothing was donated."""
    return (
        _col(refunded).cast("double") / F.nullif(_col(donated).cast("double"), F.lit(0.0)) * 100
    )


def has_flag(c) -> Column:
    return _col(c).isNotNull().cast("int")


def l2_normalize(c) -> Column:
    """Unit-length array of doubles; the zero vector stays as it is."""
    v = F.transform(_col(c), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.when(norm > 0, F.transform(v, lambda x: x / norm)).otherwise(v)


def to_cents(c) -> Column:
    """An amount, taken as the ledger's decimal(14,2), as whole cents."""
    return (_col(c).cast("decimal(14,2)") * 100).cast("bigint")


def from_cents(c) -> Column:
    return (_col(c).cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(20,2)")


def half_up_quotient(total, n) -> Column:
    """Whole-number quotient rounded half away from zero; ``n`` is positive."""
    t, k = _col(total), _col(n)
    return F.signum(t).cast("bigint") * F.call_function("div", F.abs(t) * 2 + k, k * 2)


def mean(c) -> Column:
    """Average of an exactly summed decimal (or whole number) as a double."""
    return F.sum(_col(c)).cast("double") / F.nullif(F.count(_col(c)), F.lit(0))


def half_even(c, places=2) -> Column:
    """Round scaled binary doubles half to even, as numpy's round does."""
    scale = 10.0 ** places
    return F.rint(_col(c).cast("double") * scale) / scale
