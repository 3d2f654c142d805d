"""Session settings and lineage cutting."""

import re
import tempfile
import uuid
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings a job on this package relies on. AQE sizes the shuffles and splits
# skewed join partitions at run time; the broadcast threshold is the size check
# behind every broadcast join (no operator forces one on data that grows).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores="8", name="tallyspark", **extra):
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark):
    """The folder every executor sees, as named by the cluster.

    Only a local session that names none gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    # One process only: executors of a local cluster are processes with folders of their own.
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _own_folder(spark.sparkContext.applicationId)


@lru_cache(maxsize=None)
def _own_folder(application):
    return tempfile.mkdtemp(prefix="tallyspark-")


def stored(df: DataFrame, name) -> DataFrame:
    """``df`` written once to a new Parquet table in the shared folder, and read from there.

    For a table that many jobs read. Its files outlive the executors that wrote
    them, and the scan keeps column pruning and filter pushdown.
    """
    return stored_at(df, f"{shared_dir(df.sparkSession)}/tables-{uuid.uuid4().hex}/{name}")


def stored_at(df: DataFrame, path) -> DataFrame:
    """``df`` written to a new folder that the caller names (and may ``discard``), and read from there."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark, path):
    """Remove a folder that a job stored, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` as a stored table of no particular name."""
    return stored(df, "rows")


def one_row(df: DataFrame, name="row"):
    """A one-row frame as a scalar subquery column of type struct."""
    return df.select(F.struct(*[F.col(c) for c in df.columns]).alias(name)).scalar()


# Rows a broadcast table may have. The tables joined this way hold less than 200
# bytes per row, so this bounds a broadcast to some 50 MB.
BROADCAST_ROWS = 250_000


def broadcast_if_small(df: DataFrame, counted: DataFrame, limit=BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if ``counted`` has at most ``limit`` rows.

    ``df`` has at most one row per row of ``counted``. A larger table is left to
    an ordinary shuffled join, whose skewed partitions AQE splits.
    """
    if counted.select(F.lit(1)).limit(limit + 1).count() <= limit:
        return F.broadcast(df)
    return df


def union_all(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)
