from datetime import date
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.functions import scalars as s


def column(spark, schema, values, expr):
    df = spark.createDataFrame([(i, v) if not isinstance(v, tuple) else (i, *v) for i, v in enumerate(values)],
                               f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_dates(spark):
    got = column(spark, "x string", ["12312023", "02302024", "1231202", "", None, "abcdefgh"], s.parse_mmddyyyy("x"))
    assert got == [date(2023, 12, 31), None, None, None, None, None]


def test_numbers(spark):
    texts = ["12.5", "-100", "abc", "nan", "1e3", "", None]
    assert column(spark, "x string", texts, s.safe_decimal("x")) == [
        Decimal("12.50"), Decimal("-100.00"), None, None, Decimal("1000.00"), None, None
    ]
    assert column(spark, "x string", ["7", "12.0", "x", ""], s.safe_int("x")) == [7, None, None, None]


def test_party_bucket(spark):
    pairs = [("DEM", "REP"), (None, "REP"), ("LBL", None), ("GRN", None), ("IDP", None), ("XYZ", "DEM"),
             ("", "DEM"), (None, None)]
    assert column(spark, "a string, b string", pairs, s.party_bucket("a", "b")) == [
        "DEM", "REP", "LIB", "GRE", "IND", "OTHER", "OTHER", "OTHER"
    ]


def test_primary_party(spark):
    rows = [(5, 5, 0, 0, 0, 0), (1, 2, 3, 0, 0, 0), (0, 0, 0, 0, 0, 9), (9, None, 0, 0, 0, 0),
            (-5, -1, -9, -9, -9, -9), (0, 0, 0, 0, 0, 0)]
    schema = ", ".join(f"{p} int" for p in s.PARTIES)
    got = column(spark, schema, rows, s.primary_party({p: p for p in s.PARTIES}))
    # A tie goes to the first party, and one missing amount leaves nobody ahead.
    assert got == ["DEM", "LIB", "OTHER", "OTHER", "REP", "DEM"]


def test_pct_share(spark):
    got = column(spark, "a double, b double", [(1.0, 3.0), (None, 3.0), (1.0, 0.0), (1.0, None)], s.pct_share("a", "b"))
    assert got == [33.33, 0.0, None, None]


@pytest.mark.parametrize("amount, segment", [(199.99, 0), (200, 1), (2900, 1), (2900.01, 2)])
def test_segments(spark, amount, segment):
    assert column(spark, "x double", [float(amount)], s.donor_segment("x")) == [s.SEGMENTS[segment]]


def test_frequency(spark):
    got = column(spark, "x int", [0, 1, 2, 3, 5, 6, 12, 13], s.frequency_category("x"))
    assert got == ["12+x donors", "1x donors", "2x donors", "3-5x donors", "3-5x donors", "6-12x donors",
                   "6-12x donors", "12+x donors"]


def test_within_years_at_leap_day(spark):
    got = column(spark, "x date", [date(2022, 2, 28), date(2022, 2, 27), None], s.within_years("x", "2024-02-29", 2))
    assert got == [True, False, None]


def test_zip_and_words(spark):
    assert column(spark, "x string", [" 12345", "", "  ", None], s.zip_prefix("x")) == ["123", "UNK", "UNK", "UNK"]
    assert column(spark, "x string", [" acme ", "", "   ", None], s.clean_category("x")) == [
        "ACME", "UNKNOWN", "", "UNKNOWN"
    ]
    assert column(spark, "x string", ["SELF", "NONE", None, " N/A "], s.normalise_employer("x")) == [
        "SELF-EMPLOYED", "UNKNOWN", "UNKNOWN", "UNKNOWN"
    ]
    assert column(spark, "x string", ["SELF"], s.normalise_occupation("x")) == ["SELF"]


def test_donor_key(spark):
    rows = [("Smith", "Jo", "Rome", "ny", "123456789", "A very long employer name"),
            ("SMITH", "JO", "ROME", "NY", "12345", "a very long employerX"),
            ("Smith", "Jo", "Troy", "ny", "12345", None)]
    schema = "last_name string, first_name string, city string, state string, zip_code string, employer string"
    a, b, c = column(spark, schema, rows, s.donor_key())
    assert a == b == "SMITH|JO|ROME|NY|12345|A VERY LONG EMPLOYER"
    assert c == "SMITH|JO|TROY|NY|12345|"


def test_rounding(spark):
    values = [0.125, 0.375, 2.675, 1.005, -0.125]
    assert column(spark, "x double", values, s.half_even("x")) == [float(v) for v in np.round(values, 2)]
    got = column(spark, "t long, n long", [(5, 2), (-5, 2), (4, 3), (0, 7)], s.half_up_quotient("t", "n"))
    assert got == [3, -3, 1, 0]


def test_cents_of_binary_amounts(spark):
    got = column(spark, "x double", [0.29, -1.15, 4.35, None], s.to_cents("x"))
    assert got == [29, -115, 435, None]
    assert column(spark, "c long", [-115, 0, None], s.from_cents("c")) == [Decimal("-1.15"), Decimal("0.00"), None]


def test_clip_and_same_state(spark):
    assert column(spark, "x double", [250.0, -1.0, None], s.clip("x", 0.0, 200.0)) == [200.0, 0.0, None]
    assert column(spark, "a string, b string", [("A", "A"), ("A", "B"), (None, None)], s.same_state("a", "b")) == [1, 0, 0]


def test_l2_normalize(spark):
    got = column(spark, "x array<float>", [[3.0, 4.0], [0.0, 0.0]], s.l2_normalize("x"))
    assert got == [[0.6, 0.8], [0.0, 0.0]]
    assert column(spark, "x date", [date(2020, 1, 1)], F.year("x")) == [2020]
