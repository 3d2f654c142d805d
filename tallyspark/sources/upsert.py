"""Insert-or-update on a key as one aggregation, into a frame or into a table cut by key."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, shared_dir, stored_at


def _whole(keys):
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def upsert(existing: DataFrame, incoming: DataFrame, keys, update_cols, order) -> DataFrame:
    """Rows of ``existing`` with ``incoming`` applied in the order of column ``order``.

    When a key comes again only ``update_cols`` take the newer value; all other
    columns keep the first one. A row with a null in its key matches nothing.
    """
    names = [c for c in incoming.columns if c not in (order, "source_file")]
    rows = incoming.select(*names, F.struct(F.lit(1).alias("new"), F.col(order).alias("at")).alias("_at"))
    if existing is not None:
        no_order = F.lit(None).cast(incoming.schema[order].dataType)
        old = existing.select(
            *names, F.struct(F.lit(0).alias("new"), no_order.alias("at")).alias("_at")
        )
        rows = old.unionByName(rows)
    whole = _whole(keys)
    keyed = rows.where(whole)
    kept = [c for c in names if c not in keys and c not in update_cols]
    # Each struct holds all columns of one row, so the null values in it are kept too.
    merged = keyed.groupBy(*keys).agg(
        F.min_by(F.struct(*([*kept] or [F.lit(0).alias("_none")])), F.col("_at")).alias("_first"),
        F.max_by(F.struct(*update_cols), F.col("_at")).alias("_last"),
    )
    merged = merged.select(
        *[
            F.col(c) if c in keys else F.col(f"_last.{c}" if c in update_cols else f"_first.{c}")
            for c in names
        ]
    )
    return merged.unionByName(rows.where(~whole).select(*names))


# Folders of a table cut by key. A folder should stay below some GB: choose more for a larger table, once and for all.
KEY_FOLDERS = 256


def merge_into(path, incoming: DataFrame, keys, update_cols, order, folders=KEY_FOLDERS):
    """Apply ``incoming`` to the Parquet table at ``path`` as ``upsert`` does; returns the numbers of the folders read.

    The table lies in one folder per ``key_folder``, a hash of the keys modulo ``folders``; it must keep that number
    for its life. Only folders that hold a key of ``incoming`` are read and rewritten. Rows with a null in their
    key go to folder ``folders`` of their own, which is appended to and never read. The merged rows are stored in the
    shared folder before any old one is replaced, and a merge of keyed rows that broke off can be run again.
    An empty ``incoming`` changes nothing.
    """
    spark = incoming.sparkSession
    names = [c for c in incoming.columns if c not in (order, "source_file")]
    of_key = F.pmod(F.xxhash64(*keys), F.lit(folders)).cast("int")
    scratch = f"{shared_dir(spark)}/merge-{uuid.uuid4().hex}"
    rows = stored_at(incoming.withColumn("key_folder", F.when(_whole(keys), of_key).otherwise(folders)), f"{scratch}/incoming")
    # At most ``folders`` numbers.
    touched = sorted(r[0] for r in rows.select("key_folder").distinct().collect())
    keyed = [n for n in touched if n < folders]

    def write(frame, mode):
        cut = frame.hint("rebalance", "key_folder").write.partitionBy("key_folder")
        cut.option("partitionOverwriteMode", "dynamic").mode(mode).parquet(path)

    if keyed:
        old = table_by_key(spark, path, incoming.select(*names).schema, keyed)
        merged = upsert(old, rows.where(F.col("key_folder") < folders).drop("key_folder"), keys, update_cols, order)
        write(stored_at(merged.withColumn("key_folder", of_key), f"{scratch}/merged"), "overwrite")
    if folders in touched:
        write(rows.where(F.col("key_folder") == folders).select(*names, "key_folder"), "append")
    discard(spark, scratch)
    return keyed


def table_by_key(spark, path, schema, numbers=None):
    """The rows of a table cut by key, of the folders ``numbers`` only if they are given; None if nothing was written yet."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return None
    rows = spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema)}, key_folder int").parquet(path)
    return (rows if numbers is None else rows.where(F.col("key_folder").isin(numbers))).drop("key_folder")
