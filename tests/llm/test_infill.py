"""Fill-in-the-middle outputs against slices of strings, and exact round trips."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspark.llm import catalog, infill

SF = "/root/testdata/sf0.001"


def expected(doc_id, text):
    """(doc_id, n, form, prefix_chars, middle_chars, output) by string slices."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return doc_id, len(lines), "plain", None, None, text
    a, b = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
    pre, mid, suf = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h4 % 100 < 50:
        return doc_id, len(lines), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, len(lines), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@settings(max_examples=500, deadline=None)
@given(st.text("ab\n<PSM>ü€😀\r", max_size=60), st.integers(-5, 10**12))
def test_arrangement_and_its_inverse(text, doc_id):
    n, form, pre, mid, out = infill.arrange(text.encode(), doc_id)
    assert (doc_id, n, form, pre, mid, bytes(out).decode()) == expected(doc_id, text)
    assert bytes(infill.rearrange(bytes(out), form)).decode() == text


def test_query_on_given_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda x: hashlib.sha256((x or "").encode()).hexdigest()
    want = {r.doc_id: (*expected(r.doc_id, r.text)[1:5], sha(expected(r.doc_id, r.text)[5]), sha(r.text)) for r in rows}
    assert {r.doc_id: tuple(r)[1:] for r in catalog.QUERIES["op11_infill"](spark, SF).collect()} == want


def test_odd_rows(spark):
    odd = [
        (1, None), (2, ""), (3, "\n"), (4, "\n\n\n"), (5, "no line feed"), (6, "same\n"), (6, "same\n"), (None, "a\nb\nc"),
        (8, "holds <M> itself\nx"), (9, "ß€😀\n" * 50_000), (10, "x" * 300_000), (11, "<P\n>\n<S\n>"), (-7, "a\r\nb\r\n"),
    ]
    docs = spark.createDataFrame([(d, t, "x", 0, "y") for d, t in odd], "doc_id long, text string, output string, n int, restored string")
    made = infill.restore(infill.transform(docs)).collect()
    key = lambda r: (str(r[0]), r[2], r[5])
    assert sorted((tuple(r)[:6] for r in made), key=key) == sorted((expected(d, t) for d, t in odd), key=key)
    texts = {d: t or "" for d, t in odd}
    assert all(r.restored == texts[r.doc_id] for r in made)
    assert infill.transform(docs.limit(0)).count() == 0 and infill.digest(infill.transform(docs.limit(0))).count() == 0


def test_rate_and_other_columns(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("a\nb\nc\n").alias("text"))
    counts = {r["form"]: r["count"] for r in infill.transform(docs, rate=40, spm_share=25).groupBy("form").count().collect()}
    assert 1100 < counts["plain"] < 1300 and 130 < counts["spm"] < 270
    kept = infill.restore(infill.transform(docs).withColumn("more", F.lit(1)).withColumn("restored", F.lit(None)))
    assert kept.where("restored <> 'a\nb\nc\n' or more <> 1").count() == 0 and kept.columns.count("restored") == 1
