"""Importance resampling towards a target distribution, by hashed word features.

Feature counts of the corpus and of the target text are added up per hash bucket; the log ratio of the two
is a bucket's gain, a document's weight is the mean gain of its features, and Gumbel noise by document id turns
the best scores into a draw without replacement.

Buckets are CRC-32 remainders. The distinct features of some 200,000 words are grouped by byte length into
two-dimensional byte matrices, all CRCs of a matrix advance column by column, and the buckets are scattered
back to the places of the features. Tasks hand on at most one row a bucket.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.texts import slices
from tallyspark.operators.ranking import running_sums
from tallyspark.session import broadcast_if_small, stored

BUCKETS, LONGEST, SEED = 10_000, 1, 2024
MIN_WORDS, PERCENT = 20, 10
# Documents whose results leave a worker together, words hashed together, bytes of a text split together.
ROWS_AT_ONCE, WORDS_AT_ONCE, PIECE = 2_000, 200_000, 1 << 20
# Bytes of the rows that a longer feature is hashed in.
SEGMENT = 1024

# Lower case for A-Z, itself for digits, small letters and bytes beyond ASCII, a space for all else.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _crc_table():
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


TABLE = _crc_table()


def _advance(state, matrix):
    """CRC registers after the rows of a byte matrix, column by column."""
    for column in np.ascontiguousarray(matrix.T):
        state = TABLE[(state ^ column) & 0xFF] ^ (state >> 8)
    return state


# Registers after SEGMENT zero bytes, for each value of each of a register's four bytes.
_SHIFTED = _advance(
    (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).ravel(), np.zeros((1, SEGMENT), np.uint8)
).reshape(4, 256)


def _long_crc(feature):
    """The register after a long feature: its segments advance together, as rows of one matrix, and are then chained."""
    first = len(feature) % SEGMENT
    raw = np.frombuffer(feature, np.uint8)
    state = int(_advance(np.full(1, 0xFFFFFFFF, np.uint32), raw[None, :first])[0])
    for part in _advance(np.zeros(len(raw) // SEGMENT, np.uint32), raw[first:].reshape(-1, SEGMENT)).tolist():
        state = part ^ int(_SHIFTED[0, state & 255] ^ _SHIFTED[1, state >> 8 & 255] ^ _SHIFTED[2, state >> 16 & 255] ^ _SHIFTED[3, state >> 24])
    return state


def crcs(features):
    """The CRC-32 of each of a list of different byte strings."""
    found = np.empty(len(features), np.uint32)
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for places in np.split(order, cuts) if len(features) else []:
        length = int(lengths[places[0]])
        if length >= 2 * SEGMENT:
            found[places] = [_long_crc(features[i]) for i in places]
        else:
            matrix = np.frombuffer(b"".join([features[i] for i in places]), np.uint8).reshape(len(places), length)
            found[places] = _advance(np.full(len(places), 0xFFFFFFFF, np.uint32), matrix)
    return found ^ np.uint32(0xFFFFFFFF)


def word_lists(text):
    """The words of a text, as lists of one piece of the text each, cut between words."""
    raw = (text or "").encode().translate(LETTERS)
    start = 0
    while start < len(raw):
        end = raw.find(b" ", start + PIECE)
        end = len(raw) if end < 0 else end
        yield raw[start:end].split()
        start = end


def runs(words, before, longest):
    """Features that end in ``words``: all runs of 1 to ``longest`` words; ``before`` are the words in front."""
    found = list(words)
    for n in range(2, longest + 1):
        kept = [*before[len(before) - n + 1 :], *words] if len(before) >= n - 1 else [*before, *words]
        found += map(b" ".join, zip(*(kept[k:] for k in range(n))))
    return found


def bucketed(texts, buckets, longest):
    """(document numbers, buckets, words of each document) of the features of some texts, as arrays of bounded size."""
    owners, features, words = [], [], []

    def hashed():
        places = {}
        at = np.fromiter((places.setdefault(f, len(places)) for f in features), np.int64, len(features))
        owner = np.repeat(np.array([o for o, _, _ in owners], np.int64), [n for _, n, _ in owners])
        counts = np.array([(o, w) for o, _, w in owners], np.int64).reshape(-1, 2)
        return owner, (crcs(list(places)) % np.uint32(buckets)).astype(np.int64)[at], counts

    for number, text in enumerate(texts):
        before = []
        for words in word_lists(text):
            found = runs(words, before, longest)
            owners.append((number, len(found), len(words)))
            features += found
            before = [*before, *words][-(longest - 1) :] if longest > 1 else []
            if len(features) >= WORDS_AT_ONCE:
                yield hashed()
                owners, features = [], []
    if owners:
        yield hashed()


def bucket_counts(docs: DataFrame, text="text", buckets=BUCKETS, longest=LONGEST) -> DataFrame:
    """(bucket, n): features of all texts, at most one row per bucket; empty for a table without words."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, ROWS_AT_ONCE):
            for _, found, _ in bucketed((t.as_py() for t in batch.column(0)), buckets, longest):
                total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    counted = docs.select(docs[text].alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets=BUCKETS) -> DataFrame:
    """(bucket, gain) for every bucket, from the counts of corpus and target: 1000 times the smoothed log ratio, floored."""
    every = corpus.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    joined = every.join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
    s, t = (F.coalesce(c, F.lit(0)).cast("double") for c in ("s", "t"))
    all_s, all_t = (c.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double")).scalar() for c in (corpus, target))
    ratio = ((t + 1) * (all_s + buckets)) / ((s + 1) * (all_t + buckets))
    return joined.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain"))


def weights(docs: DataFrame, gain, ids="doc_id", text="text", longest=LONGEST) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row; ``gain`` is the array of the buckets' gains."""
    gain = np.asarray(gain, np.int64)

    def run(batches):
        for batch in slices(batches, ROWS_AT_ONCE):
            n = batch.num_rows
            words, features, sums = (np.zeros(n, np.int64) for _ in range(3))
            for owner, found, counts in bucketed((t.as_py() for t in batch.column(1)), len(gain), longest):
                features += np.bincount(owner, minlength=n)
                sums += np.bincount(owner, gain[found], minlength=n).astype(np.int64)
                words += np.bincount(counts[:, 0], counts[:, 1], minlength=n).astype(np.int64)
            weight = np.where(features > 0, sums // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, (words, features, weight))], names=["doc_id", "n_words", "n_features", "weight"]
            )

    rows = docs.select(docs[ids].cast("bigint").alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(ids, seed=SEED):
    """Gumbel noise of a document id in thousandths, floored; a null id counts as the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ids.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranked(scored: DataFrame, min_words=MIN_WORDS, percent=PERCENT) -> DataFrame:
    """``scored`` (doc_id, n_words, score, ...) with ``rank`` of the drawn rows, null for all others.

    Rows are counted per score first; the running counts (no window runs over the whole table) tell which
    scores are drawn, and only their rows are numbered, apart for each score.
    """
    enough = F.col("n_words") >= min_words
    per_score = scored.where(enough).groupBy(F.col("score").alias("_score")).agg(F.count("*").alias("_n"))
    counted = stored(running_sums(per_score.withColumn("_down", -F.col("_score")), [], "_down", ["_n"]), "scores")
    drawn = F.floor(F.col("_n_total") * percent / 100)
    reached = counted.where(F.col("_n_before") < drawn).select("_score", F.col("_n_before").alias("_before"), drawn.alias("_drawn"))
    reached = broadcast_if_small(reached, reached)
    same = enough & (F.col("score") == F.col("_score"))
    within = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight")
    top = scored.join(reached, same).withColumn("rank", F.col("_before") + F.row_number().over(within))
    top = top.withColumn("rank", F.when(F.col("rank") <= F.col("_drawn"), F.col("rank"))).select(*scored.columns, "rank")
    return top.unionByName(scored.join(reached, same, "left_anti").withColumn("rank", F.lit(None).cast("bigint")))


def resample(docs: DataFrame, target: DataFrame, ids="doc_id", text="text", target_text="text", buckets=BUCKETS, longest=LONGEST,
             seed=SEED, min_words=MIN_WORDS, percent=PERCENT) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for every row of ``docs``, drawn towards ``target``.

    A null text has no words and weight 0, like a text without words; neither is drawn unless ``min_words`` is 0.
    Equal scores go to the smaller id, null ids last; rows that share an id draw the same noise and are ranked
    each. Other columns do not matter. An empty table gives an empty table; without target words every
    gain compares with even smoothing. ``gains`` are one number per bucket and come to the driver.
    """
    corpus, wanted = (stored(bucket_counts(*part, buckets, longest), "counts") for part in ((docs, text), (target, target_text)))
    found = gains(corpus, wanted, buckets)
    gain = [r["gain"] for r in sorted(found.collect(), key=lambda r: r["bucket"])]
    weighted = weights(docs, gain, ids, text, longest)
    scored = stored(weighted.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    return ranked(scored, min_words, percent)


def digest(resampled: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return resampled.select("doc_id", "n_features", "weight", "score", "rank")


def digest_sql():
    """DuckDB SQL for the registered query: CRC-32 of the different words, byte by byte."""
    tokens = (
        r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    )
    return f"""
        WITH d AS (SELECT row_number() OVER () AS row, doc_id, {tokens} AS w FROM documents),
        b AS (SELECT {tokens} AS w FROM benchmark),
        dw AS (SELECT row, word, count(*) AS n FROM (SELECT row, unnest(w) AS word FROM d) GROUP BY ALL),
        bw AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM b) GROUP BY ALL),
        x AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, y: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        v AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
        c AS (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(h) // 2),
            lambda k: ('0x' || h[2 * k + 1:2 * k + 2])::BIGINT)), lambda s, y: xor(t[1 + (xor(s, y) & 255)], s >> 8)), 4294967295)
            % {BUCKETS} AS bucket FROM v, x),
        s AS (SELECT bucket, sum(n)::DOUBLE AS n FROM dw JOIN c USING (word) GROUP BY bucket),
        t AS (SELECT bucket, sum(n)::DOUBLE AS n FROM bw JOIN c USING (word) GROUP BY bucket),
        g AS (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM s) + {BUCKETS})
            / ((s.n + 1) * ((SELECT coalesce(sum(n), 0) FROM t) + {BUCKETS}))))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
        m AS (SELECT row, sum(n)::BIGINT AS n, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
            FROM dw JOIN c USING (word) JOIN g USING (bucket) GROUP BY row),
        e AS (SELECT d.row, doc_id, coalesce(m.n, 0) AS n_features, coalesce(weight, 0) AS weight,
            ('0x' || sha256('{SEED}:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT::DOUBLE AS h FROM d LEFT JOIN m USING (row)),
        f AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM e),
        r AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM f WHERE n_features >= {MIN_WORDS})
        SELECT doc_id, n_features, weight, score,
          CASE WHEN rank <= {PERCENT} * (SELECT count(*) FROM r) // 100 THEN rank END AS rank
        FROM f LEFT JOIN r USING (row)
    """
