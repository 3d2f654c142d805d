"""Small shared pieces: tables, blocks of rows, ASCII lower-casing in Spark."""

from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(column):
    """A-Z in lower case, all else as it is."""
    return F.translate(column, UPPER, LOWER)


def remainder(column, modulus):
    """crc32 of an id written as text, modulo ``modulus``; null ids count as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % modulus


def words_of(text):
    """The words of a text as bytes: A-Z in lower case, split at ASCII white space; null has none."""
    return text.encode("utf-8").lower().split() if text else []


def unused(frame, name):
    """``name``, or with underscores behind it if ``frame`` has such a column."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batches, rows):
    """Arrow batches of at most ``rows`` rows, so that results of a large batch do not pile up in a worker."""
    for batch in batches:
        for start in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(start, rows)
