"""Resolution, profile and refunds on rows written out by hand."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import profile, refunds, resolve, totals
from tallyspark.sources.schemas import struct_type

TX = "contributor_id long, cmte_id string, transaction_dt date, transaction_amt decimal(14,2), transaction_pgi string, sub_id long"


def tx(spark, rows):
    full = [(d, c, date.fromisoformat(t) if t else None, None if a is None else Decimal(str(a)), "P", i)
            for i, (d, c, t, a) in enumerate(rows)]
    return spark.createDataFrame(full, TX)


@pytest.fixture(scope="module")
def dims(spark):
    cm = spark.createDataFrame(
        [("A", "REP", "H", "NY", "a"), ("B", "DEM", "S", "CA", "b"), ("C", None, "P", "TX", "c")],
        "cmte_id string, cmte_pty_affiliation string, cmte_tp string, cmte_st string, cmte_nm string",
    )
    links = spark.createDataFrame(
        [("B", "x"), ("B", "y"), ("C", "gone"), ("Z", "x")], "cmte_id string, cand_id string"
    )
    cands = spark.createDataFrame(
        [("x", "X", "GRN", "H", "NY"), ("y", "Y", "", "S", "CA")],
        "cand_id string, cand_name string, cand_pty_affiliation string, cand_office string, cand_office_st string",
    )
    return cm, links, cands


def test_profile_fan_out(spark, dims):
    rows = tx(spark, [(1, "A", "2023-05-01", 10), (1, "B", "2020-01-01", 7), (1, "Q", None, 1),
                      (1, "C", "2021-01-01", -3), (2, "A", "2023-05-01", None)])
    got = {r["contributor_id"]: r for r in profile.donor_profile(rows, *dims, "2024-01-01").collect()}
    one = got[1]
    # Committee B has two links, so its gift counts twice: once GRE and once OTHER.
    assert (one["total_donations"], one["unique_committees"]) == (5, 4)
    assert one["total_amount"] == Decimal("22.00")
    assert (one["gre_donations"], one["gre_amount"]) == (1, Decimal("7.00"))
    assert (one["other_donations"], one["other_amount"]) == (3, Decimal("5.00"))
    assert one["rep_amount"] == Decimal("10.00") and one["primary_party"] == "REP"
    assert one["avg_donation_amount"] == Decimal("4.40")
    assert one["donations_last_2years"] == 1 and one["recency_days"] == 245
    assert float(one["rep_pct"]) == 45.45
    two = got[2]
    assert two["total_amount"] is None and two["rep_amount"] is None and two["dem_amount"] == 0
    assert two["primary_party"] == "OTHER" and two["avg_donation_amount"] is None
    once = profile.donor_profile(rows, *dims, "2024-01-01", link_mode="dedup").where("contributor_id = 1").first()
    assert once["total_donations"] == 4 and once["gre_amount"] == Decimal("7.00")


def test_update_keeps_defaults(spark, dims):
    donors = spark.createDataFrame([(1,), (9,)], "id long")
    p = profile.donor_profile(tx(spark, [(1, "A", "2023-05-01", 10)]), *dims, "2024-01-01")
    rows = {r["id"]: r for r in profile.update_donors(donors, p).collect()}
    assert rows[9]["total_donations"] == 0 and rows[9]["other_amount"] == 0
    assert rows[9]["primary_party"] is None and rows[9]["recency_days"] is None


def test_hot_committee_and_no_broadcast(spark, dims, monkeypatch):
    """Same result when the committee table is too large to broadcast."""
    rows = tx(spark, [(i % 7, "B" if i % 3 else "A", "2023-05-01", i) for i in range(300)])
    small = profile.donor_profile(rows, *dims, "2024-01-01").collect()
    monkeypatch.setattr(profile, "broadcast_if_small", lambda df, counted: df)
    assert sorted(profile.donor_profile(rows, *dims, "2024-01-01").collect()) == sorted(small)


def test_refund_patterns(spark):
    rows = tx(spark, [
        (1, "A", "2020-01-01", 100), (1, "A", "2020-06-01", 50), (1, "A", "2021-02-01", -150),
        (1, "A", "2021-03-01", -10), (2, "A", "2020-01-01", 10), (2, "A", "2020-02-01", -5),
        (3, "A", "2020-01-01", 10), (3, "A", "2022-02-01", -5), (4, "B", "2020-01-01", 10),
        (4, "B", "2021-01-10", -10), (5, "B", "2020-12-31", 10), (5, "B", "2021-01-01", -4),
        (None, "B", "2020-12-31", 10), (None, "B", "2021-01-01", -4), (6, "B", None, 9),
    ])
    found = refunds.cross_year_refunds(rows)
    got = {r["contributor_id"]: r for r in found.collect()}
    assert set(got) == {1, 4, 5}
    assert got[1]["total_refunded"] == Decimal("160.00") and got[1]["refund_count"] == 2
    assert got[1]["refund_pct"] == pytest.approx(106.6666667) and got[4]["refund_pct"] == 100.0
    joined = refunds.match_years(refunds.yearly_donations(rows), refunds.yearly_refunds(rows))
    columns = ["contributor_id", "donation_year", "refund_year", "refund_count", "first_refund"]
    assert sorted(joined.select(columns).collect()) == sorted(found.select(columns).collect())
    assert [r["contributor_id"] for r in refunds.cross_year_refunds(rows, 2).collect()] == [3]
    summary = refunds.refund_summary(found, rows).first()
    # The full refunds include the excess one, and partial plus full is everything.
    assert (summary["full_refunds"], summary["partial_refunds"], summary["excess_refunds"]) == (2, 1, 1)
    assert summary["median_donated"] == 10.0 and summary["total_contribution_count"] == 8
    timing = refunds.refund_timing(found).first()
    assert timing["min_days_to_refund"] == 1 and timing["median_days_to_refund"] == 245.0
    assert timing["refunds_within_365_days"] == 2


def test_totals(spark, dims):
    rows = tx(spark, [(1, "B", "2020-01-01", 10), (1, "B", "2020-01-11", 20), (1, "B", "2020-01-21", 60)])
    r = totals.donor_totals(rows, *dims, "2020-12-31").first()
    assert (r["donation_span_days"], r["avg_days_between_donations"], r["is_recurring"]) == (20, 10.0, 1)
    assert r["amount_trend"] == pytest.approx(2.5) and r["stddev_amount"] == pytest.approx(21.6024690)
    assert (r["cand_id"], r["cand_party"], r["cmte_name"]) == ("y", "", "b")
    summary = {x["cmte_id"]: x for x in totals.committee_summary(*dims).collect()}
    assert summary["B"]["cand_party"] == "GRN" and summary["B"]["has_candidate"] == 1
    assert summary["C"]["has_candidate"] == 0 and summary["A"]["cand_party"] is None


def test_resolution(spark):
    names = struct_type("raw_contributions").fieldNames()
    base = dict.fromkeys(names)
    people = [
        dict(last_name="Smith", first_name="Jo", city="Rome", state="NY", zip_code="123456789", occupation="late", sub_id=2),
        dict(last_name="SMITH", first_name="JO", city="ROME", state="NY", zip_code="12345", occupation=None, sub_id=1),
        dict(last_name="SMITH", first_name="JO", city="TROY", state="NY", zip_code="12345", occupation="c", sub_id=None),
    ]
    raw = spark.createDataFrame([{**base, **p, "source_file": "f"} for p in people], struct_type("raw_contributions"))
    donors = resolve.dedupe_donors(raw)
    rows = {r["city"].upper(): r for r in donors.collect()}
    assert set(rows) == {"ROME", "TROY"}
    assert rows["ROME"]["last_name"] == "SMITH" and rows["ROME"]["occupation"] is None
    by_key = resolve.link_contributions(raw).select("contributor_id", "sub_id").collect()
    by_join = resolve.link_contributions(raw, donors).select("contributor_id", "sub_id").collect()
    assert sorted(by_key, key=str) == sorted(by_join, key=str)
    assert resolve.donor_id_collisions(donors).isEmpty()
    assert resolve.distinct_identities(raw).count() == 3
    assert raw.select(F.count("*")).first()[0] == 3
