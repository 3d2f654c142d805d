"""Fill-in-the-middle transformation by in-place rotation of blocks.

A text is cut at two places between lines into prefix, middle and suffix. Sentinels are
inserted into a byte array at the cuts, and the blocks are brought into the order of the form
by three-reversal rotations inside that array; the inverse rotations restore the text exactly.
Documents are independent of each other, so both directions are one pass without a shuffle.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyspark.llm.texts import slices

# The strings that begin prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
# End of fixed values.

SEED, RATE, SPM_SHARE = 7, 100, 50
# Documents whose results leave a worker together.
ROWS_AT_ONCE = 200

SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def rotate(block, start, middle, end):
    """Exchange ``block[start:middle]`` and ``block[middle:end]`` in place: each part is reversed, then both together."""
    for a, b in ((start, middle), (middle, end), (start, end)):
        block[a:b] = block[a:b][::-1]


def draws(seed, doc_id):
    """Four unsigned 32-bit integers of a document; a null id counts as the empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def line_ends(raw):
    """The place behind each line of UTF-8 bytes: behind every line feed, and the end of a last line without one."""
    ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    return ends if not raw or raw.endswith(b"\n") else np.append(ends, len(raw))


def characters(raw, start, end):
    """Code points of ``raw[start:end]``, which is cut between characters."""
    return int(np.count_nonzero((np.frombuffer(raw, np.uint8)[start:end] & 0xC0) != 0x80))


def arrange(raw, doc_id, seed=SEED, rate=RATE, spm_share=SPM_SHARE):
    """(lines, form, prefix characters, middle characters, output) of UTF-8 bytes; the numbers are None for plain."""
    ends = line_ends(raw)
    n = len(ends)
    h1, h2, h3, h4 = draws(seed, doc_id)
    if not raw or h3 % 100 >= rate or any(s in raw for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, raw
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (int(ends[k - 1]) if k else 0 for k in (first, second))
    out = bytearray(raw)
    out[b:b] = SUFFIX
    out[a:a] = MIDDLE
    out[0:0] = PREFIX
    a, b = a + len(PREFIX), b + len(PREFIX) + len(MIDDLE)
    if h4 % 100 < spm_share:
        form = "spm"
        rotate(out, 0, b, len(out))
    else:
        form = "psm"
        rotate(out, a, b, len(out))
    return n, form, characters(raw, 0, a - len(PREFIX)), characters(raw, a - len(PREFIX), b - len(PREFIX) - len(MIDDLE)), out


def rearrange(output, form):
    """The text of an output and its form, as UTF-8 bytes."""
    if form == "plain":
        return output
    out = bytearray(output)
    size = len(out)
    if form == "spm":
        # The suffix stands first; behind it are prefix and middle.
        suffix = out.index(PREFIX)
        rotate(out, 0, suffix, size)
        b = size - suffix
        a = out.index(MIDDLE)
    else:
        a = out.index(SUFFIX)
        middle = out.index(MIDDLE)
        b = a + size - middle
        rotate(out, a, middle, size)
    for at, sentinel in ((b, SUFFIX), (a, MIDDLE), (0, PREFIX)):
        del out[at : at + len(sentinel)]
    return out


def transform(docs: DataFrame, ids="doc_id", text="text", seed=SEED, rate=RATE, spm_share=SPM_SHARE) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of ``docs``.

    ``n`` counts lines, ``form`` is plain, psm or spm. A null text counts as empty; an empty text, and one
    that holds a sentinel, is plain, its output the text itself and its numbers null. The draws depend
    on seed and id only, so repeated rows give repeated results; a null id stays null and draws as
    the empty text. ``rate`` is the share of texts, in a hundred, that are not plain. Other columns
    do not matter, and an empty table gives an empty table.
    """

    def run(batches):
        for batch in slices(batches, ROWS_AT_ONCE):
            names, rows = batch.column(0), []
            for doc_id, value in zip(names.to_pylist(), batch.column(1)):
                raw = (value.as_py() or "").encode()
                *facts, out = arrange(raw, doc_id, seed, rate, spm_share)
                rows.append((*facts, bytes(out)))
            lines, forms, prefix, middle, outputs = zip(*rows) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    names, pa.array(lines, pa.int64()), pa.array(forms, pa.string()), pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()), pa.array(outputs, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return docs.select(docs[ids].cast("bigint").alias("doc_id"), docs[text].alias("text")).mapInArrow(run, SCHEMA)


def restore(transformed: DataFrame, output="output", form="form") -> DataFrame:
    """``transformed`` with the column ``restored``: the text that an output of the given form was made from.

    Null where output or form is null. All other columns stay; a column named restored is replaced.
    """
    rows = transformed.drop("restored")
    outputs, forms = rows.columns.index(output), rows.columns.index(form)
    schema = StructType([*rows.schema.fields, StructField("restored", StringType())])

    def run(batches):
        for batch in slices(batches, ROWS_AT_ONCE):
            texts = [
                None if o.as_py() is None or f.as_py() is None else bytes(rearrange(o.as_py().encode(), f.as_py()))
                for o, f in zip(batch.column(outputs), batch.column(forms))
            ]
            yield batch.append_column("restored", pa.array(texts, pa.binary()).cast(pa.string()))

    return rows.mapInArrow(run, schema)


def digest(transformed: DataFrame) -> DataFrame:
    """The columns of the registered query, from the operator's outputs and the texts restored from them."""
    return restore(transformed).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.encode("output", "UTF-8"), 256).alias("output_sha256"),
        F.sha2(F.encode("restored", "UTF-8"), 256).alias("restored_sha256"),
    )


def digest_sql():
    """DuckDB SQL for the registered query: lists of lines, cut and joined."""
    p, s, m = (x.decode() for x in (PREFIX, SUFFIX, MIDDLE))
    return rf"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        l AS (
          SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
            ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
          FROM t
        ), c AS (
          SELECT *, len(lines) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a,
            greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
            CASE WHEN text = '' OR h3 % 100 >= {RATE} OR contains(text, '{p}') OR contains(text, '{s}') OR contains(text, '{m}') THEN 'plain'
              WHEN h4 % 100 < {SPM_SHARE} THEN 'spm' ELSE 'psm' END AS form
          FROM l
        ), x AS (
          SELECT doc_id, n, form, text, array_to_string(lines[1:a], '') AS pre, array_to_string(lines[a + 1:b], '') AS mid,
            array_to_string(lines[b + 1:n], '') AS suf
          FROM c
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
          CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
          sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '{s}' || suf || '{p}' || pre || '{m}' || mid
            ELSE '{p}' || pre || '{s}' || suf || '{m}' || mid END) AS output_sha256,
          sha256(text) AS restored_sha256
        FROM x
    """
