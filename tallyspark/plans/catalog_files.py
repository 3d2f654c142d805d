"""Registered queries that write the tables as filings and read those back."""

import uuid

from pyspark.sql import functions as F

from ..operators import refunds, resolve
from ..session import cut_lineage, shared_dir
from ..sources import filings, schemas, sinks
from ..sources.upsert import merge_into, table_by_key, upsert
from ..streaming import incremental
from . import frames
from .catalog import query


def _folder(g, name):
    """A new folder for the files of one run, in the shared folder."""
    return f"{shared_dir(g.spark)}/filings-{uuid.uuid4().hex}/{name}"


def _text(df, path):
    """One latin-1 pipe-delimited line per row."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws("|", *fields).alias("value")).write.text(path)
    return path


def _itcont(g, *keep):
    """Transactions as filing lines, with the columns ``keep``; one in nineteen lacks its last field."""
    raw = frames.raw_rows(g)
    columns = {
        "transaction_dt": F.date_format("transaction_dt", "MMddyyyy"),
        "name": F.concat(F.col("last_name"), F.lit(", "), F.col("first_name"), F.lit(" Q JR")),
        "file_num": F.col("sub_id") % 1000,
    }
    rows = raw.select(*[columns.get(c, F.col(c)).alias(c) for c in filings.ITCONT_FIELDS])
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in filings.ITCONT_FIELDS]
    line = F.concat_ws("|", *fields)
    short = F.concat_ws("|", *fields[:-1])
    return rows.select(F.when(F.col("sub_id") % 19 == 0, short).otherwise(line).alias("value"), *keep)


def _land(lines, folder, run):
    """One file of lines for each remainder of sub_id, by the same names in every run."""
    path = lines.sparkSession._jvm.org.apache.hadoop.fs.Path
    parts = f"{folder}-{run}"
    split = lines.select("value", (F.col("sub_id") % 4).alias("part"))
    split.repartition("part").write.partitionBy("part").option("compression", "none").text(parts)
    files = path(parts).getFileSystem(lines.sparkSession._jsc.hadoopConfiguration())
    files.mkdirs(path(f"{folder}/{run}"))
    for found in files.globStatus(path(f"{parts}/part=*/*.txt")):
        name = found.getPath().getParent().getName().replace("part=", "itcont")
        files.rename(found.getPath(), path(f"{folder}/{run}/{name}.txt"))


@query
def load_itcont(g):
    path = _folder(g, "itcont")
    _itcont(g).write.text(path)
    rows = filings.load_itcont(g.spark, path)
    return rows.select(
        "cmte_id", "transaction_pgi", "name", "city", "state", "zip_code", "employer", "occupation",
        "transaction_dt", "transaction_amt", "file_num", "sub_id", "first_name", "last_name",
        "middle_name", "name_suffix", "status",
    )


@query
def rejected_lines(g):
    path = _folder(g, "itcont")
    _itcont(g).write.text(path)
    _, rejects = filings.split_rejects(filings.read_lines(g.spark, path))
    return rejects.groupBy("error_message").agg(F.count("*").alias("n"))


@query
def resume_load(g):
    """The rest of a file of which two thirds were loaded before."""
    path = _folder(g, "itcont")
    _itcont(g).write.text(path)
    loaded = filings.load_itcont(g.spark, path).where(F.col("sub_id") % 3 != 0)
    return filings.load_itcont(g.spark, path, loaded).select("sub_id", "cmte_id", "transaction_amt")


def _second_edition(df, key, changes):
    """The rows again, some thirty percent of them with changed values."""
    third = F.right(key, F.lit(1)).isin("0", "3", "6")
    return df.withColumns({c: F.when(third, v).otherwise(F.col(c)) for c, v in changes.items()})


def _master(g, df, table, key, changes):
    """Load a first file, then a second edition onto it."""
    names = [n for n, _, _ in schemas.columns(schemas.TABLES[table])]
    known = {c: F.col(c) for c in df.columns}
    full = df.select(*[known.get(n, F.lit("x")).alias(n) for n in names])
    load = {"candidates": filings.load_candidates, "committees": filings.load_committees,
            "candidate_committee_links": filings.load_links}[table]
    first = load(g.spark, _text(full, _folder(g, "first")))
    second = _second_edition(full, key, changes)
    return load(g.spark, _text(second, _folder(g, "second")), first)


@query
def load_candidates(g):
    rows = _master(
        g, g.candidates, "candidates", "cand_id",
        {"cand_name": F.lit("NEW NAME"), "cand_st": F.lit("ZZ"), "cand_election_yr": F.lit(2008)},
    )
    return rows.select("cand_id", "cand_name", "cand_pty_affiliation", "cand_election_yr", "cand_office", "cand_st")


@query
def load_committees(g):
    rows = _master(
        g, g.committees, "committees", "cmte_id",
        {"cmte_nm": F.lit("NEW NAME"), "cmte_tp": F.lit("Q"), "cmte_st": F.lit("ZZ")},
    )
    return rows.select("cmte_id", "cmte_nm", "cmte_tp", "cmte_st", "cmte_pty_affiliation")


@query
def load_links(g):
    rows = g.links.withColumns({"fec_election_yr": F.lit(2002), "linkage_id": F.lit(7), "cmte_tp": F.lit("H")})
    out = _master(
        g, rows, "candidate_committee_links", "cmte_id",
        {"fec_election_yr": F.lit(2004), "linkage_id": F.lit(9), "cmte_tp": F.lit("S")},
    )
    return out.select("cand_id", "cmte_id", "cand_election_yr", "fec_election_yr", "linkage_id", "cmte_tp")


@query
def upserted_rows(g):
    """Line items of one part after another onto one row per order."""
    rows = g.table("lineitem").select(
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_orderkey")).alias("l_orderkey"),
        "l_quantity", "l_partkey",
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("at"),
    )
    old, new = rows.where("l_partkey % 2 = 0"), rows.where("l_partkey % 2 = 1")
    first = upsert(None, old, ["l_orderkey"], ["l_quantity"], "at")
    return upsert(first, new, ["l_orderkey"], ["l_quantity"], "at")


@query
def merged_by_key(g):
    """The same two editions as ``upserted_rows``, merged into a stored table whose untouched folders are left alone."""
    rows = g.table("lineitem").select(
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_orderkey")).alias("l_orderkey"),
        "l_quantity", "l_partkey",
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("at"),
    )
    path = _folder(g, "merged")
    for part in (rows.where("l_partkey % 2 = 0"), rows.where("l_partkey % 2 = 1")):
        merge_into(path, part, ["l_orderkey"], ["l_quantity"], "at")
    return table_by_key(g.spark, path, rows.drop("at").schema)


@query
def typed_contributions(g):
    """Widths and types of the contribution table, with the columns that do not fit."""
    linked = resolve.link_contributions(frames.raw_rows(g))
    wide = linked.withColumn(
        "tran_id", F.when(F.col("sub_id") % 11 == 0, F.repeat(F.lit("t"), 33)).otherwise("ok")
    )
    return (
        schemas.apply_schema(wide, "contributions")
        .groupBy(F.concat_ws(",", "schema_errors").alias("errors"))
        .agg(F.count("*").alias("n"), F.sum("transaction_amt").alias("amount"))
    )


@query
def saved_splits(g):
    from .catalog_models import temporal_splits as split_rows

    rows = g.donors.select("id", "primary_party", "first_donation_date", "last_donation_date")
    marked = rows.join(split_rows(g).select("id", "split"), "id")
    parts = [marked.where(F.col("split") == s).drop("split") for s in sinks.SPLITS]
    path = _folder(g, "splits")
    sinks.save_splits(*parts, path)
    read = sinks.load_splits(g.spark, path)
    out = read[0].withColumn("split", F.lit("train"))
    for name, df in zip(sinks.SPLITS[1:], read[1:]):
        out = out.unionByName(df.withColumn("split", F.lit(name)))
    return out


@query
def csv_round_trip(g):
    path = _folder(g, "refunds")
    sinks.write_csv(refunds.refunds_by_year(cut_lineage(refunds.cross_year_refunds(g.contributions))), path)
    schema = "donation_year int, unique_contributors long, unique_committees long, total_donated double, " \
             "avg_donated double, total_refunded double, avg_refunded double, avg_refund_pct double"
    return g.spark.read.option("header", True).schema(schema).csv(path)


@query
def streamed_ingest(g):
    """Two runs over a growing folder: the second finds files with new rows and rows that came before."""
    folder, out, mark = (_folder(g, n) for n in ("landing", "tables", "marks"))
    lines = _itcont(g, "sub_id")
    _land(lines.where("sub_id % 5 <> 0"), folder, "first")
    first = incremental.ingest_incremental(g.spark, f"{folder}/*", out, mark, "*.txt")
    _land(lines.where("sub_id % 5 in (0, 1)"), folder, "second")
    again = incremental.ingest_incremental(g.spark, f"{folder}/*", out, mark, "*.txt")
    table = incremental.read_table(g.spark, out, "contributions")
    donors = incremental.read_table(g.spark, out, "donors")
    return table.agg(
        F.lit(first).cast("long").alias("lines"), F.lit(again).cast("long").alias("lines_again"),
        F.count("*").alias("rows"), F.sum("transaction_amt").alias("amount"),
    ).withColumn("donors", donors.agg(F.count("*")).scalar())
