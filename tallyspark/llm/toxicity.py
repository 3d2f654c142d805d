"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled rows: one of wording that is over-represented
in toxic texts, one of ordinary wording. A window is compressed with either; what the toxic
dictionary saves over the ordinary one is the window's distance. A window is one word between
fixed letters that both dictionaries hold, so its length depends on the word only, and equal
words are compressed once per worker. How many windows of a text pass each of several
thresholds, of bytes saved and of the saved share of the word's own bytes, goes into a
logistic calibration that is fitted on the labelled rows.
"""

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallyspark.llm.texts import remainder, slices, unused
from tallyspark.session import stored

# Labelled rows that the dictionaries and the calibration are fitted on, at most.
TRAINING_ROWS = 40_000
# Words of the two dictionaries, at most; a toxic one is in so many training rows at least, and its likelihood
# ratio is one that chance gives to less than one of a million words.
TOXIC_WORDS, ORDINARY_WORDS, LEAST_ROWS, LEAST_RATIO = 300, 1500, 3, 25.0
# Bytes, and shares of a word's bytes, that a window must save to count.
THRESHOLDS = (1, 2, 3, 4, 5, 6, 7, 8)
SHARES = (0.3, 0.4, 0.5, 0.6)
# Bytes are told apart from this number on.
LEAST_SAVED = -4
LEVEL = 6
HELD_OUT = 5
# Words a worker remembers; it starts anew when they are full. Only speed depends on it.
REMEMBERED_WORDS = 300_000
# Documents that are scored before their results leave the worker.
ROWS_AT_ONCE = 500

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FRAME = b"0123456789 9876543210 0246813579"


def words_of(text):
    return WORD.findall(text.encode("utf-8").lower()) if text else []


class Distance(dict):
    """What the toxic dictionary saves over the ordinary one, by word, as the number of a class of bytes and share."""

    def __init__(self, toxic, ordinary):
        self.toxic, self.ordinary = _compressor(toxic), _compressor(ordinary)
        self.empty = len(self.ordinary.compress(b" " + FRAME))

    def __missing__(self, word):
        window = b" " + word + b" " + FRAME
        usual = len(self.ordinary.compress(window))
        saved = usual - len(self.toxic.compress(window))
        share = saved / max(1, usual - self.empty + 1)
        level = min(max(saved, LEAST_SAVED), THRESHOLDS[-1]) - LEAST_SAVED
        number = level * (len(SHARES) + 1) + sum(share >= limit for limit in SHARES)
        if len(word) <= 64:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = number
        return number


def _compressor(words):
    """A compressor with a dictionary of words, the most telling last, where they are nearest to the window."""
    content = b" " + b" ".join(words) + b" " + FRAME
    parameters = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, min_match=3, source_size=64, dict_size=len(content), write_checksum=False, write_content_size=False, write_dict_id=False
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


def features(text, distance):
    """How many windows of a whole text pass each threshold, by number and by share, and their mean distance."""
    found = words_of(text)
    levels, n = THRESHOLDS[-1] - LEAST_SAVED + 1, max(1, len(found))
    classes = np.fromiter(map(distance.__getitem__, found), dtype=np.int64, count=len(found))
    counts = np.bincount(classes, minlength=levels * (len(SHARES) + 1)).reshape(levels, -1)
    passed = np.array([
        *(counts[t - LEAST_SAVED :].sum() for t in THRESHOLDS), *(counts[:, k + 1 :].sum() for k in range(len(SHARES)))
    ], dtype=np.float64)
    mean = (counts.sum(axis=1) * np.arange(LEAST_SAVED, levels + LEAST_SAVED)).sum() / n
    return [*np.log1p(passed), *(10 * passed / n), mean]


def fit_logistic(x, y, rounds=100, ridge=0.5):
    """Weights (the first for the constant) of a logistic regression by Newton's method."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def training_rows(docs: DataFrame, labels: DataFrame, ids="doc_id", text="text", label="toxic", limit=TRAINING_ROWS) -> DataFrame:
    """(text, label) of at most ``limit`` labelled rows that are not held out, chosen by a hash of the id.

    Of an id with several labels the greatest counts; rows without text, id or label teach nothing.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(ids).isNotNull()).groupBy(F.col(ids).alias("known_id")).agg(F.max(label).alias("label"))
    known = known.where(remainder(F.col("known_id"), HELD_OUT) != 0).orderBy(F.xxhash64("known_id"), "known_id").limit(limit)
    rows = docs.where(F.col(text).isNotNull()).join(F.broadcast(known), F.col(ids) == F.col("known_id"))
    return rows.select(F.col(text).alias("text"), F.col("label").cast("int").alias("label"))


def train_dictionaries(rows: DataFrame):
    """The words of the toxic and of the ordinary dictionary, the most telling last.

    A word is toxic by the likelihood ratio of its rows among toxic and ordinary ones; ordinary words
    are those in the most ordinary rows. Only these words come to the driver.
    """

    def run(batches):
        for batch in batches:
            counts = {}
            for text, label in zip(batch.column(0), batch.column(1)):
                for word in set(words_of(text.as_py())):
                    if len(word) <= 64:
                        pair = counts.setdefault(word, [0, 0])
                        pair[1 if label.as_py() else 0] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array([c[1] for c in counts.values()], pa.int64()), pa.array([c[0] for c in counts.values()], pa.int64())],
                names=["word", "toxic", "ordinary"],
            )

    total = rows.agg(F.sum("label").alias("toxic"), F.count("*").alias("n")).first()
    toxic_rows, ordinary_rows = total["toxic"] or 0, total["n"] - (total["toxic"] or 0)
    if not toxic_rows or not ordinary_rows:
        return None
    counts = stored(
        rows.mapInArrow(run, "word binary, toxic bigint, ordinary bigint").groupBy("word").agg(F.sum("toxic").alias("a"), F.sum("ordinary").alias("b")),
        "words",
    )
    a, b, share = F.col("a"), F.col("b"), toxic_rows / (toxic_rows + ordinary_rows)
    expected = (a + b) * share
    ratio = 2 * (a * F.log(a / expected) + F.when(b > 0, b * F.log(b / (a + b - expected))).otherwise(0))
    telling = counts.where((a >= LEAST_ROWS) & (a * ordinary_rows > b * toxic_rows) & (ratio >= LEAST_RATIO)).orderBy(F.desc(ratio), "word").limit(TOXIC_WORDS)
    usual = counts.orderBy(F.desc("b"), "word").limit(ORDINARY_WORDS)
    toxic = [bytes(r["word"]) for r in telling.select("word").collect()][::-1]
    ordinary = [w for w in (bytes(r["word"]) for r in usual.select("word").collect()) if w not in set(toxic)][::-1]
    return toxic, ordinary


def _with_features(rows, dictionaries, keep, kinds):
    """The columns ``keep`` of ``rows`` with the features of ``text``."""

    def run(batches):
        distance = Distance(*dictionaries)
        for batch in batches:
            values = [features(t.as_py(), distance) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(values, pa.list_(pa.float64()))], names=[*keep, "x"])

    return rows.select("text", *keep).mapInArrow(run, ", ".join(f"{c} {k}" for c, k in zip(keep, kinds)) + ", x array<double>")


def train(docs: DataFrame, labels: DataFrame, ids="doc_id", text="text", label="toxic", limit=TRAINING_ROWS):
    """(dictionaries, weights); dictionaries are None and the weights a constant if one class has no rows."""
    rows = stored(training_rows(docs, labels, ids, text, label, limit), "training")
    dictionaries = train_dictionaries(rows)
    if dictionaries is None:
        total = rows.agg(F.coalesce(F.sum("label"), F.lit(0)).alias("toxic"), F.count("*").alias("n")).first()
        share = (total["toxic"] + 0.5) / (total["n"] + 1) if total["n"] else 0.01
        return None, np.array([np.log(share / (1 - share))])
    # At most ``limit`` rows of a few numbers.
    frame = _with_features(rows, dictionaries, ["label"], ["int"]).toPandas()
    return dictionaries, fit_logistic(np.array(frame["x"].tolist()), frame["label"].to_numpy(dtype=np.float64))


def score(docs: DataFrame, model, text="text", name="score") -> DataFrame:
    """``docs`` with its own columns and ``name``: the chance that a row is toxic."""
    dictionaries, weights = model
    docs = docs.drop(name)
    if dictionaries is None:
        return docs.withColumn(name, F.lit(float(1 / (1 + np.exp(-weights[0])))))
    place = docs.columns.index(text)

    def run(batches):
        distance = Distance(*dictionaries)
        for batch in slices(batches, ROWS_AT_ONCE):
            x = np.array([features(t.as_py(), distance) for t in batch.column(place)]).reshape(batch.num_rows, -1)
            p = 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, ids="doc_id", text="text", label="toxic", limit=TRAINING_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Null and empty texts score as texts without any window. Rows with a repeated or null id are scored
    each; an empty table gives an empty table. Without labelled rows of both classes the score is the share
    of toxic ones (0.01 without any rows). Other columns do not matter.
    """
    rows = docs.select(F.col(ids).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    scored = score(rows, train(docs, labels, ids, text, label, limit))
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), HELD_OUT) == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, ids="doc_id", text="text", label="toxic", limit=TRAINING_ROWS) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, with the columns of ``docs``."""
    name = unused(docs, "toxic_score")
    scored = score(docs, train(docs, labels, ids, text, label, limit), text, name)
    return scored.where(F.col(name) < 0.5).drop(name)
