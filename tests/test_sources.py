from decimal import Decimal

import pytest

from tallyspark.sources import filings, schemas, sinks
from tallyspark.sources.upsert import upsert


def line(n=21, **at):
    fields = [f"f{i}" for i in range(n)]
    for key, value in at.items():
        fields[int(key[1:])] = value
    return "|".join(fields)


@pytest.fixture
def itcont(tmp_path):
    good = line(_7="SMITH, JOHN JR", _13="12312023", _14="-12.50", _17="5", _20="100", _11="")
    quoted = line(22, _7='JOSÉ "PEP', _13="02302024", _14="abc", _17="x", _20="101")
    (tmp_path / "itcont1.txt").write_bytes(
        "\r\n".join([good, line(20), "", "   ", quoted]).encode("latin-1")
    )
    (tmp_path / "other.txt").write_text(line(_20="200"))
    return tmp_path


def test_load_itcont(spark, itcont):
    rows = {r["sub_id"]: r for r in filings.load_itcont(spark, f"{itcont}/itcont*.txt").collect()}
    assert set(rows) == {100, 101}
    a, b = rows[100], rows[101]
    assert (a["last_name"], a["first_name"], a["name_suffix"]) == ("SMITH", "JOHN", "JR")
    assert str(a["transaction_dt"]) == "2023-12-31" and a["transaction_amt"] == Decimal("-12.50")
    assert a["employer"] == "" and a["status"] == 0 and a["source_file"] == "itcont1.txt"
    assert b["name"] == 'JOSÉ "PEP' and b["transaction_dt"] is None and b["transaction_amt"] is None
    assert b["file_num"] is None and b["memo_text"] == "f19"


def test_rejects_and_resume(spark, itcont):
    path = f"{itcont}/itcont*.txt"
    good, rejects = filings.split_rejects(filings.read_lines(spark, path))
    assert good.count() == 2
    assert rejects.collect()[0]["error_message"] == "expected 21 fields, found 20"
    loaded = filings.load_itcont(spark, path).where("sub_id = 100")
    assert [r["sub_id"] for r in filings.load_itcont(spark, path, loaded).collect()] == [101]


def test_read_pipe_missing_and_extra(spark, tmp_path):
    (tmp_path / "x.txt").write_text("a|b\nc|d|e|f\n")
    rows = filings.read_pipe(spark, str(tmp_path / "x.txt"), ["p", "q", "r"]).orderBy("p").collect()
    assert [(r["p"], r["q"], r["r"]) for r in rows] == [("a", "b", None), ("c", "d", "e")]


def test_candidates_keep_first_and_fail_on_bad_year(spark, tmp_path):
    path = tmp_path / "cn.txt"
    path.write_text("C1|OLD|DEM|2020|NY|H|01|I|A|P1|S1|S2|CITY|NY|1\nC1|NEW|REP|2022|CA|S|02|C|B|P2|T1|T2|TOWN|CA|2\n")
    row = filings.load_candidates(spark, str(path)).collect()[0].asDict()
    assert (row["cand_name"], row["cand_pty_affiliation"], row["cand_election_yr"]) == ("NEW", "REP", 2022)
    assert (row["cand_office_st"], row["cand_st"], row["cand_pcc"]) == ("NY", "NY", "P1")
    path.write_text("C1|OLD|DEM|20x0|NY\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        filings.load_candidates(spark, str(path)).collect()


def test_upsert_nulls(spark):
    schema = "a string, b string, kept string, changed string, at int"
    old = spark.createDataFrame([("k", "x", None, "1", 0), (None, "x", "n", "1", 1)], schema)
    new = spark.createDataFrame([("k", "x", "late", None, 0), (None, "x", "m", "2", 1)], schema)
    rows = upsert(upsert(None, old, ["a", "b"], ["changed"], "at"), new, ["a", "b"], ["changed"], "at").collect()
    found = sorted((r["a"] or "", r["kept"], r["changed"]) for r in rows if r["a"])
    # The first null is kept and the newer null wins; a null in the key never meets another.
    assert found == [("k", None, None)]
    assert sorted((r["kept"], r["changed"]) for r in rows if r["a"] is None) == [("m", "2"), ("n", "1")]


def test_apply_schema(spark):
    df = spark.createDataFrame([("C12345678", 1e13, "ok"), ("C1234567890", 5.0, "ok")],
                               "cmte_id string, transaction_amt double, tran_id string")
    rows = schemas.apply_schema(df, "contributions").collect()
    assert [r["schema_errors"] for r in rows] == [["transaction_amt"], ["cmte_id"]]
    assert rows[0]["transaction_amt"] is None and rows[1]["transaction_amt"] == Decimal("5.00")
    assert schemas.struct_type("contributions").fieldNames() == [c for c in rows[0].asDict() if c != "schema_errors"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "2020-01-05", "bad")], "id int, first_donation_date string, last_donation_date string")
    sinks.save_splits(df, df, df, str(tmp_path / "s"))
    row = sinks.load_splits(spark, str(tmp_path / "s"))[1].collect()[0]
    assert str(row["first_donation_date"]) == "2020-01-05" and row["last_donation_date"] is None
    sinks.write_json(spark.sql("SELECT 1 AS cluster, map('a', 2L) AS top, struct('x' AS s) AS place"), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).collect()[0]["top"]["a"] == 2
