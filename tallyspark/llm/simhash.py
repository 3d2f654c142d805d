"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints link at up to three differing bits. Half of that radius is one bit for
one end and two for the other: an odd number of differing bits joins an even and an odd
fingerprint (by count of ones), so the odd ones emit all variants within two flips and
the even ones all within one, and two linked ones always meet in a common variant.

Variants are shuffled by a few of their bits. All variants of a fingerprint that share
those bits travel as one row and are spelt out by the task that gets them, so a
fingerprint costs tens of shuffled rows for its 2,081 variants.

Members of a variant are linked to one member within a flip of it, not to each other:
every such link is within three bits, all links of the graph are implied by them, and a
group of any size costs a number of rows linear in its size.
"""

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.components import connected_components
from tallyspark.llm.texts import unused, words_of
from tallyspark.session import stored

SHINGLE_WORDS = 3
SEED = 42
BITS = 64
# Distinct fingerprints of odd parity that a bucket of variants holds on average: with 1,541
# variants each, some 50 MB in a task.
FINGERPRINTS_PER_BUCKET = 800
# Shingles turned into bits at once.
SHINGLES_AT_ONCE = 200_000


def simhash(text, words=SHINGLE_WORDS):
    """The unsigned fingerprint of one text: bits set in over half of the shingles' hashes; zero without words."""
    found = words_of(text)
    if not found:
        return 0
    if len(found) < words:
        shingles, n = [b" ".join(found)], 1
    else:
        shingles, n = map(b" ".join, zip(*(found[i:] for i in range(words)))), len(found) - words + 1
    counts = np.zeros(BITS, dtype=np.int64)
    hashes = map(xxhash.xxh64_intdigest, shingles, itertools.repeat(SEED))
    for start in range(0, n, SHINGLES_AT_ONCE):
        block = np.fromiter(itertools.islice(hashes, SHINGLES_AT_ONCE), dtype="<u8", count=min(SHINGLES_AT_ONCE, n - start))
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, ids="doc_id", text="text") -> DataFrame:
    """(doc_id, fp: the fingerprint as a signed 64-bit integer) for every row; null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = np.array([simhash(t.as_py()) for t in batch.column(1)], dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    return docs.select(docs[ids].cast("bigint"), docs[text]).mapInArrow(run, "doc_id bigint, fp bigint")


def bucket_bits(fingerprint_count):
    """How many bits choose the bucket; their number grows with the table, so buckets do not."""
    return int(min(40, max(4, np.ceil(np.log2(max(1, fingerprint_count) / 2 / FINGERPRINTS_PER_BUCKET)))))


def _masks(bits):
    """(flips, mask) for every way to flip at most two of the highest ``bits`` bits, as signed integers."""
    single = [1 << (BITS - 1 - i) for i in range(bits)]
    masks = [(0, 0), *((1, m) for m in single), *((2, a | b) for a, b in itertools.combinations(single, 2))]
    return [(flips, m - (1 << 64) if m >> 63 else m) for flips, m in masks]


def links(distinct: DataFrame, bits) -> DataFrame:
    """(a, b) fingerprints within three bits of each other, enough of them to imply every such link.

    ``distinct`` holds each fingerprint once as ``fp``; ``bits`` choose the bucket.
    """
    choices = F.array(*[F.struct(F.lit(k).alias("flips"), F.lit(m).alias("mask")) for k, m in _masks(bits)])
    allowed = F.when(F.bit_count("fp") % 2 == 1, F.lit(2)).otherwise(F.lit(1))
    sent = (
        distinct.withColumn("choice", F.explode(F.filter(choices, lambda c: c["flips"] <= allowed)))
        .select(
            F.shiftrightunsigned(F.col("fp").bitwiseXOR(F.col("choice.mask")), BITS - bits).alias("bucket"),
            "fp",
            F.col("choice.flips").alias("flips"),
            F.col("choice.mask").alias("mask"),
        )
    )

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = meet_in_bucket(
            rows["fp"].to_numpy().view("<u8"), rows["flips"].to_numpy(), rows["mask"].to_numpy().view("<u8"), BITS - bits
        )
        return pd.DataFrame({"a": a.view("<i8"), "b": b.view("<i8")})

    return sent.groupBy("bucket").applyInPandas(meet, "a bigint, b bigint").distinct()


def meet_in_bucket(fp, flips, mask, low_bits):
    """Verified links among the variants of one bucket.

    Row i stands for the variants of ``fp[i]`` that have ``mask[i]`` flipped (``flips[i]`` bits) and
    any of the low bits up to the radius of ``fp[i]``: two flips if its ones are odd, else one.
    """
    odd = np.bitwise_count(fp) % 2 == 1
    base = fp ^ mask
    single = np.uint64(1) << np.arange(low_bits, dtype=np.uint64)
    i, j = np.triu_indices(low_bits, 1)
    double = single[i] | single[j]
    near0, near1 = np.flatnonzero(flips <= 1), np.flatnonzero(flips == 0)
    value = np.concatenate([base[near0], (base[near1][:, None] ^ single).ravel()])
    owner = np.concatenate([fp[near0], np.repeat(fp[near1], low_bits)])
    order = np.lexsort((owner, value))
    value, owner = value[order], owner[order]
    first = np.flatnonzero(np.r_[True, value[1:] != value[:-1]]) if len(value) else np.array([], dtype=np.int64)
    centre_of, centre = value[first], owner[first]
    starts = np.repeat(centre, np.diff(np.r_[first, len(value)]))
    found = [(owner, starts)]

    def far(variants, owners):
        if len(centre_of):
            at = np.minimum(np.searchsorted(centre_of, variants), len(centre_of) - 1)
            hit = centre_of[at] == variants
            found.append((owners[hit], centre[at[hit]]))

    two, one = np.flatnonzero(odd & (flips == 2)), np.flatnonzero(odd & (flips == 1))
    far(base[two], fp[two])
    far((base[one][:, None] ^ single).ravel(), np.repeat(fp[one], low_bits))
    for part in np.array_split(np.flatnonzero(odd & (flips == 0)), max(1, int(odd.sum()) // 500)):
        far((base[part][:, None] ^ double).ravel(), np.repeat(fp[part], len(double)))
    a, b = (np.concatenate(x) for x in zip(*found))
    keep = (a != b) & (np.bitwise_count(a ^ b) <= 3)
    pairs = np.unique(np.stack([a[keep], b[keep]], axis=1), axis=0)
    return pairs[:, 0].copy(), pairs[:, 1].copy()


def near_duplicates(docs: DataFrame, ids="doc_id", text="text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable by links) for every row.

    Null and empty texts have fingerprint zero and link like any other. Rows with a repeated id
    stay separate rows with equal results; a null id joins its component but never names it (a
    component of null ids only has a null one). Other columns of ``docs`` do not matter.
    """
    prints = stored(fingerprints(docs, ids, text), "fingerprints")
    groups = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    components = connected_components(links(groups.select("fp"), bucket_bits(groups.count())))
    labelled = groups.join(components.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("label", "fp").alias("label")
    )
    least = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named = labelled.join(least, "label").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, ids="doc_id", text="text") -> DataFrame:
    """The rows of ``docs`` that stay if of each component only the document with the least id does.

    Of rows that share an id one stays at most. Rows with a null id cannot be told apart and stay.
    """
    key = unused(docs, "component_member")
    found = stored(near_duplicates(docs, ids, text), "components").where("doc_id is not null")
    dropped = found.where("doc_id <> component_id").select(F.col("doc_id").alias(key))
    repeated = found.where("doc_id = component_id").groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias("n")).where("n > 1").select(key)
    same = docs[ids] == F.col(key)
    left = docs.join(dropped, same, "left_anti")
    once = left.join(repeated, left[ids] == repeated[key], "left_anti")
    return once.unionByName(left.join(repeated, left[ids] == repeated[key], "left_semi").dropDuplicates([ids]))
