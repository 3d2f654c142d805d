"""Importance resampling against plain counters."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspark.llm import catalog, resample

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, longest=1):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lower)
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def expected(docs, target, buckets=10_000, longest=1, seed=2024, min_words=20, percent=10):
    """[(doc_id, n_features, weight, score, rank)] by counters and one sort."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    made = [(d, *features(t, longest)) for d, t in docs]
    s, t = Counter(bucket(f) for _, _, x in made for f in x), Counter(bucket(f) for x in target for f in features(x, longest)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for d, n, x in made:
        weight = sum(gain[bucket(f)] for f in x) // len(x) if x else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, n, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    enough = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    drawn = enough[: percent * len(enough) // 100]
    out = [(d, n, w, s, k + 1) for k, (d, _, n, w, s) in enumerate(drawn)]
    left = Counter(rows) - Counter(drawn)
    return sorted([*out, *((d, n, w, s, None) for d, _, n, w, s in left.elements())], key=str)


def test_query_on_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = catalog.QUERIES["op13_resample"](spark, SF).collect()
    assert sorted(map(tuple, found), key=str) == expected(docs, target)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=40), unique=True, max_size=30))
def test_crcs(words):
    assert resample.crcs(words).tolist() == [zlib.crc32(w) for w in words]


def test_crcs_of_long_features():
    random = np.random.default_rng(1)
    words = [random.bytes(n) for n in (1023, 1024, 1025, 2047, 2048, 2049, 3072, 100_000, 100_000, 1_000_003)]
    assert resample.crcs(words).tolist() == [zlib.crc32(w) for w in words]


@pytest.mark.parametrize("longest", [1, 3])
def test_odd_rows_and_small_pieces(spark, monkeypatch, longest):
    docs = [
        (1, None), (2, ""), (3, " \n.,"), (4, "one"), (5, "A b-c d'E f g h"), (5, "A b-c d'E f g h"), (None, "a b c d e f"), (None, "q"),
        (7, "ÄÖ äö İ ſ K 123 \x00 x\x7fy"), (8, "long " * 60_000 + "z" * 5000), (9, "w" * 30_000), (10, "b c a"), (11, "c b a b c"),
    ]
    frame = spark.createDataFrame([(d, t, "s", 0.5, 1) for d, t in docs], "doc_id long, text string, score string, rank double, _n int")
    target = spark.createDataFrame([("a b c",), (None,), ("b",)], "text string")
    monkeypatch.setattr(resample, "PIECE", 7)
    monkeypatch.setattr(resample, "WORDS_AT_ONCE", 10)
    options = {"buckets": 50, "longest": longest, "min_words": 1, "percent": 60}
    found = resample.digest(resample.resample(frame, target, **options)).collect()
    want = expected(docs, ["a b c", None, "b"], **options)
    assert sorted(map(tuple, found), key=str) == want
    # Pieces are cut between words, so the size of a piece does not matter.
    assert [w for x in resample.word_lists("ab  cd " * 5) for w in x] == [b"ab", b"cd"] * 5


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    target = spark.createDataFrame([], "text string")
    assert resample.resample(docs, target).count() == 0
    some = spark.createDataFrame([(i, "word " * 30) for i in range(20)], "doc_id long, text string")
    rows = resample.digest(resample.resample(some, target)).collect()
    assert sorted(map(tuple, rows), key=str) == expected([(i, "word " * 30) for i in range(20)], [])
    assert sum(r["rank"] is not None for r in rows) == 2
