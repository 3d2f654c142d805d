"""WARC archives as a PySpark data source, and pages archived with revisit records.

Reading plans partitions of whole files packed by size. A record's headers are parsed first;
predicates on its type and header fields, pushed down by Spark, are decided on them, and the
rest of an unwanted record is passed over: by seeking in a plain file or behind a member that states
its length, by inflating without keeping otherwise. Memory holds one record and one batch at a time.

Writing rolls files of one gzip member a record, each stating its lengths. Tasks only add files
of fresh names; the driver's commit names those that count in one manifest, so files of failed or repeated
tasks are never read.
"""

import base64
import hashlib
import json
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from tallyspark.session import broadcast_if_small, discard, shared_dir

# Bytes of archive that one reading task gets, of a batch that leaves it, and of a written file.
PARTITION_BYTES, BATCH_BYTES, FILE_BYTES = 64 << 20, 8 << 20, 64 << 20
# Bytes read at a time, and of the longest header block that is accepted.
CHUNK, LONGEST_HEADER = 1 << 20, 1 << 20

# Names and markers of the formats.
VERSION, END = b"WARC/1.1", b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP, LENGTHS = b"\x1f\x8b\x08", b"sl"
FIELDS = {
    "record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date",
    "content_type": "content-type", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to",
}
# End of fixed values.

READ_SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, content_type string, payload_digest string, "
    "refers_to string, headers map<string,string>, http_headers map<string,string>, payload_bytes bigint, payload binary, "
    "payload_sha1 string, file string, offset bigint"
)
# Columns that a frame to be written has; target_uri, refers_to and payload may be null.
WRITTEN = ["record_id", "target_uri", "refers_to", "payload", "payload_sha1"]


def base32_sha1(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- Writing -----------------------------------------------------------------


def member(record):
    """One gzip member that states its own and its inflated length in an extra field."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    size = 24 + len(body) + 8
    extra = LENGTHS + (8).to_bytes(2, "little") + size.to_bytes(4, "little") + len(record).to_bytes(4, "little")
    head = GZIP + b"\x04\0\0\0\0\0\xff" + len(extra).to_bytes(2, "little") + extra
    return head + body + zlib.crc32(record).to_bytes(4, "little") + len(record).to_bytes(4, "little")


def header_value(text):
    """A header value on one line: control characters and spaces as percent escapes."""
    return "".join(c if " " < c != "\x7f" else f"%{ord(c):02X}" for c in text)


def record(fields, block):
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields if v is not None), b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + END + block + END


def page_record(record_id, uri, refers_to, payload, sha1, date):
    """A response with its payload, or a revisit of ``refers_to`` with the HTTP header alone; ``sha1`` are the digest's bytes."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(payload) + END
    fields = [
        ("WARC-Type", "revisit" if refers_to is not None else "response"),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if uri is None else header_value(uri)),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{base64.b32encode(sha1).decode()}"),
    ]
    if refers_to is None:
        return record(fields, http + payload)
    return record([*fields, ("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", PROFILE)], http)


@dataclass
class Written(WriterCommitMessage):
    files: list


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, schema, options, overwrite):
        self.path, self.overwrite = options["path"], overwrite
        self.date = options.get("date", "1970-01-01T00:00:00Z")
        self.file_bytes = int(options.get("fileBytes", FILE_BYTES))
        missing = set(WRITTEN) - set(schema.names)
        if missing:
            raise ValueError(f"columns that an archive needs are missing: {sorted(missing)}")

    def write(self, iterator):
        store, folder = fs.FileSystem.from_uri(self.path)
        store.create_dir(folder, recursive=True)
        files, out = [], None
        try:
            for batch in iterator:
                columns = [batch.column(name) for name in WRITTEN]
                for row in zip(*columns):
                    record_id, uri, refers_to, payload, sha1 = (x.as_py() for x in row)
                    if out is None:
                        name = f"part-{uuid.uuid4().hex}.warc.gz"
                        out, size = store.open_output_stream(f"{folder}/{name}", compression=None), 0
                        files.append([name, 0])
                        size += out.write(member(record([
                            ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", self.date),
                            ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
                        ], b"format: WARC File Format 1.1\r\n")))
                    payload = payload.encode() if isinstance(payload, str) else payload or b""
                    size += out.write(member(page_record(record_id, uri, refers_to, payload, sha1, self.date)))
                    files[-1][1] = size
                    if size >= self.file_bytes:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages):
        store, folder = fs.FileSystem.from_uri(self.path)
        store.create_dir(folder, recursive=True)
        earlier = [] if not self.overwrite else manifests(store, folder)
        listed = [f for m in messages if m is not None for f in m.files]
        with store.open_output_stream(f"{folder}/_committed-{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps(listed).encode())
        for name in earlier:
            store.delete_file(name)

    def abort(self, messages):
        store, folder = fs.FileSystem.from_uri(self.path)
        for name in (f for m in messages if m is not None for f, _ in m.files):
            store.delete_file(f"{folder}/{name}")


# --- Reading -----------------------------------------------------------------


def manifests(store, folder):
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return [f.path for f in found if f.base_name.startswith("_committed-") and f.base_name.endswith(".json")]


def archives(path):
    """(name, bytes) of the archives of a file or folder: those its manifests name, or all if it has none."""
    store, folder = fs.FileSystem.from_uri(path)
    info = store.get_file_info(folder)
    if info.type == fs.FileType.File:
        return [(folder, info.size)]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    listed = manifests(store, folder)
    if listed:
        found = []
        for name in listed:
            with store.open_input_stream(name, compression=None) as f:
                found += [(f"{folder}/{n}", size) for n, size in json.loads(f.read())]
        return sorted(found)
    files = store.get_file_info(fs.FileSelector(folder, recursive=True))
    return sorted((f.path, f.size) for f in files if f.is_file and f.base_name.endswith((".warc", ".warc.gz")))


class Bytes:
    """A file read forward in chunks; what is skipped beyond the chunk is never read."""

    def __init__(self, file):
        self.file, self.chunk, self.at, self.begin = file, b"", 0, 0

    @property
    def place(self):
        return self.begin + self.at

    def peek(self, n):
        """Up to ``n`` bytes from here on, fewer at the end of the file."""
        if len(self.chunk) - self.at < n:
            self.begin += self.at
            self.chunk = self.chunk[self.at :] + self.file.read(max(CHUNK, n))
            self.at = 0
        return self.chunk[self.at : self.at + n]

    def skip(self, n):
        if self.at + n <= len(self.chunk):
            self.at += n
        else:
            self.begin, self.chunk, self.at = self.place + n, b"", 0
            self.file.seek(self.begin)


class Plain:
    """One record of an uncompressed file."""

    def __init__(self, source):
        self.source = source

    def head(self):
        n = 4096
        while True:
            seen = self.source.peek(n)
            at = seen.find(END)
            if at >= 0:
                self.source.skip(at + 4)
                return seen[:at]
            if len(seen) < n or n >= LONGEST_HEADER:
                raise ValueError("a record's header has no end")
            n *= 4

    def block(self, length):
        found = self.source.peek(length)
        self.source.skip(length)
        return found

    def close(self, left):
        """Pass over ``left`` bytes of the block and the end of the record."""
        self.source.skip(left)
        if self.source.peek(4) == END:
            self.source.skip(4)


class Member:
    """One record that is a gzip member, inflated only as far as it is asked for."""

    def __init__(self, source):
        self.source, self.start = source, source.place
        head = source.peek(24)
        stated = head[3] == 4 and head[12:14] == LENGTHS and int.from_bytes(head[10:12], "little") == 12
        self.size = int.from_bytes(head[16:20], "little") if stated else None
        self.inflate, self.ready = zlib.decompressobj(31), b""

    def more(self, n):
        """Inflate until ``n`` bytes are ready or the member ends."""
        while len(self.ready) < n and not self.inflate.eof:
            given = self.inflate.unconsumed_tail
            if not given:
                given = self.source.peek(min(CHUNK, self.start + self.size - self.source.place) if self.size else 1 << 16)
                if not given:
                    raise ValueError("a gzip member has no end")
                self.source.skip(len(given))
            self.ready += self.inflate.decompress(given, n - len(self.ready))

    def head(self):
        n = 1024
        while True:
            self.more(n)
            at = self.ready.find(END)
            if at >= 0:
                seen, self.ready = self.ready[:at], self.ready[at + 4 :]
                return seen
            if len(self.ready) < n or n >= LONGEST_HEADER:
                raise ValueError("a record's header has no end")
            n *= 4

    def block(self, length):
        self.more(length)
        found, self.ready = self.ready[:length], self.ready[length:]
        return found

    def close(self, left):
        if self.size:
            end = self.start + self.size
            if self.source.place > end:
                raise ValueError("a gzip member states a wrong length")
            self.source.skip(end - self.source.place)
            return
        while not self.inflate.eof:
            self.ready = b""
            self.more(1 << 16)
        # The decompressor has taken bytes of the next member.
        spare = len(self.inflate.unused_data)
        self.source.begin, self.source.chunk, self.source.at = self.source.place - spare, b"", 0
        self.source.file.seek(self.source.begin)


def fields_of(lines):
    """{name in lower case: value} of header lines; a line that begins with white space goes on with the one before."""
    found, last = {}, None
    for line in lines:
        if line[:1] in (b" ", b"\t") and last:
            found[last] += " " + line.strip().decode("utf-8", "replace")
        elif b":" in line:
            name, value = line.split(b":", 1)
            last = name.strip().decode("utf-8", "replace").lower()
            found[last] = value.strip().decode("utf-8", "replace")
    return found


def column_of(name, headers):
    """The value of a header column: without angle brackets, and the digest without its label."""
    value = headers.get(FIELDS[name])
    if value is None:
        return None
    if name in ("record_id", "refers_to"):
        return value.removeprefix("<").removesuffix(">")
    return value.removeprefix("sha1:") if name == "payload_digest" else value


def holds(test, headers):
    """Whether a pushed filter is true of a record's headers."""
    if isinstance(test, Not):
        return _truth(test.child, headers) is False
    return _truth(test, headers) is True


def _truth(test, headers):
    value = column_of(test.attribute[0], headers)
    if isinstance(test, IsNull):
        return value is None
    if isinstance(test, IsNotNull):
        return value is not None
    if isinstance(test, EqualNullSafe):
        return value == test.value
    if value is None:
        return None
    if isinstance(test, In):
        return value in test.value or (None if None in test.value else False)
    if test.value is None:
        return None
    return {
        EqualTo: lambda: value == test.value,
        GreaterThan: lambda: value.encode() > test.value.encode(),
        GreaterThanOrEqual: lambda: value.encode() >= test.value.encode(),
        LessThan: lambda: value.encode() < test.value.encode(),
        LessThanOrEqual: lambda: value.encode() <= test.value.encode(),
        StringContains: lambda: test.value in value,
        StringStartsWith: lambda: value.startswith(test.value),
        StringEndsWith: lambda: value.endswith(test.value),
    }[type(test)]()


def decidable(test):
    """Whether a filter concerns a header column only, in a form that ``holds`` knows."""
    if isinstance(test, Not):
        return not isinstance(test.child, Not) and decidable(test.child)
    known = (
        EqualTo, EqualNullSafe, In, IsNull, IsNotNull, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, StringContains,
        StringStartsWith, StringEndsWith,
    )
    return isinstance(test, known) and len(test.attribute) == 1 and test.attribute[0] in FIELDS


@dataclass
class Files(InputPartition):
    names: list


class ArchiveReader(DataSourceReader):
    def __init__(self, schema, options):
        self.path, self.tests = options["path"], []
        self.payload = options.get("payload", "true").lower() == "true"
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.schema = to_arrow_schema(schema)

    def pushFilters(self, filters):
        for test in filters:
            if decidable(test):
                self.tests.append(test)
            else:
                yield test

    def partitions(self):
        parts, size = [], 0
        for name, length in archives(self.path):
            if not parts or size + length > self.partition_bytes:
                parts.append(Files([]))
                size = 0
            parts[-1].names.append(name)
            size += length
        return parts or [Files([])]

    def read(self, partition):
        store, _ = fs.FileSystem.from_uri(self.path)
        rows, size = [], 0
        for name in partition.names:
            with store.open_input_file(name) as file:
                source = Bytes(file)
                while source.peek(1):
                    place = source.place
                    try:
                        row = self.next_record(source)
                    except (ValueError, zlib.error) as e:
                        raise ValueError(f"{name}, byte {place}: {e}") from e
                    if row is not None:
                        rows.append((*row, name, place))
                        size += 500 + len(row[10] or b"")
                        if size >= BATCH_BYTES:
                            yield self.batch(rows)
                            rows, size = [], 0
        if rows:
            yield self.batch(rows)

    def batch(self, rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(values, kind) for values, kind in zip(zip(*rows), self.schema.types)], schema=self.schema
        )

    def next_record(self, source):
        """The row of the record at hand, None if a filter refuses it; ``source`` moves behind it."""
        part = Member(source) if source.peek(3) == GZIP else Plain(source)
        version, *lines = part.head().split(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise ValueError("no WARC record")
        headers = fields_of(lines)
        left = int(headers["content-length"])
        if not all(holds(test, headers) for test in self.tests):
            part.close(left)
            return None
        http, payload, sha1, size = None, None, None, left
        if headers.get("content-type", "").startswith("application/http"):
            if self.payload:
                block, left = part.block(left), 0
                head, _, payload = block.partition(END)
            else:
                head = part.block(min(left, LONGEST_HEADER)).partition(END)[0]
                left -= min(left, LONGEST_HEADER)
            http = fields_of(head.split(b"\r\n")[1:])
            size = size - len(head) - 4
            if headers.get("warc-type") == "revisit":
                # The payload is with the record referred to; its length is that of the HTTP header.
                payload, size = None, int(http["content-length"]) if "content-length" in http else None
        elif self.payload:
            payload, left = part.block(left), 0
        if payload is not None:
            size, sha1 = len(payload), base32_sha1(payload)
        part.close(left)
        columns = [column_of(name, headers) for name in FIELDS]
        return *columns, list(headers.items()), None if http is None else list(http.items()), size, payload, sha1


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(path)`` and ``frame.write.format("warc").save(path)``.

    Options: ``payload`` (false: null payloads, not decoded), ``partitionBytes``; writing: ``date``, ``fileBytes``.
    """

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return READ_SCHEMA

    def reader(self, schema):
        return ArchiveReader(schema, self.options)

    def writer(self, schema, overwrite):
        return ArchiveWriter(schema, self.options, overwrite)


def register(spark: SparkSession):
    """Make the format known to a session, with its filters pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


# --- Pages -------------------------------------------------------------------


def with_revisits(pages: DataFrame, folder, ids="page_id", uri="url", text="html", min_bytes=0) -> DataFrame:
    """The columns of ``WRITTEN`` for every row of ``pages``; ``refers_to`` names the page whose equal payload it repeats.

    Payloads meet by their SHA-1. Only digests that occur more than once are joined back, one row of each, so a
    payload of a third of all rows is one small row; the table is written to ``folder`` and
    broadcast if it has few rows.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(ids).alias("id"), F.col(uri).cast("string").alias("target_uri"), F.coalesce(F.col(text), F.lit("")).alias("payload"))
    digested = rows.withColumn("payload_sha1", F.unhex(F.sha1("payload")))
    long = F.octet_length("payload") >= min_bytes
    counted = digested.where(long).groupBy("payload_sha1").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    counted.where("n > 1 and first is not null").select("payload_sha1", "first").write.parquet(f"{folder}/repeated")
    repeated = spark.read.parquet(f"{folder}/repeated")
    joined = digested.join(broadcast_if_small(repeated, repeated), "payload_sha1", "left")

    def name(column):
        return F.concat(F.lit("urn:x-page:"), F.coalesce(column.cast("string"), F.lit("null")))

    repeats = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id")) & long
    return joined.select(
        name(F.col("id")).alias("record_id"), "target_uri", F.when(repeats, name(F.col("first"))).alias("refers_to"), "payload", "payload_sha1"
    )


def archive(pages: DataFrame, path, **columns):
    """Write every row of ``pages`` as a record of the archives in the folder ``path``.

    A null page text counts as empty, a null url has no target URI; control characters and spaces in it are escaped.
    Among equal payloads of at least ``min_bytes`` the rows of the smallest id are responses and the others
    revisit it (a null id is never the smallest, unless all are null: then all are responses). Rows that share an id
    share a record id. Other columns do not matter, and an empty table gives a folder without archives.
    """
    spark = pages.sparkSession
    register(spark)
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    with_revisits(pages, folder, **columns).write.format("warc").mode("append").save(path)
    discard(spark, folder)


def read(spark: SparkSession, path, payload=True) -> DataFrame:
    """The records of a WARC file or of a folder of them, plain or gzipped record by record."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def digest(records: DataFrame) -> DataFrame:
    """The columns of the registered query, read back; a response's bytes and digest are those of the payload itself."""

    def page(column):
        return F.regexp_extract(column, "^urn:x-page:(-?[0-9]+)$", 1).try_cast("bigint")

    return records.where(F.col("record_type").isin("response", "revisit")).select(
        page(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        F.coalesce("payload_sha1", "payload_digest").alias("payload_digest"),
        "record_type",
        page(F.col("refers_to")).alias("refers_to"),
    )


def archived_pages(pages: DataFrame) -> DataFrame:
    """``digest`` of the pages, archived in the shared folder and read back from there."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/archives-{uuid.uuid4().hex}"
    archive(pages, path)
    return digest(read(spark, path))


def digest_sql():
    """DuckDB SQL for the registered query; five hexadecimal digits are four letters of base 32."""
    letters = " || ".join(f"'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((x >> {shift}) & 31)::INT]" for shift in (15, 10, 5, 0))
    return f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
        f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
        SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
          array_to_string(list_transform(range(0, 8), lambda k: list_transform([('0x' || h[5 * k + 1:5 * k + 5])::BIGINT], lambda x: {letters})[1]), '')
            AS payload_digest,
          CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN page_id <> first THEN first END AS refers_to
        FROM p JOIN f USING (h)
    """
