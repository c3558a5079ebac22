"""Session settings and the few helpers every operator shares: table access, lineage cuts, size-checked broadcasts.

Written states are removed with the frames that read them if the session sets
``spark.cleaner.referenceTracking.cleanCheckpoints``, as ``local_session`` does.
"""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most rows and bytes a side may have to be broadcast; measured before each broadcast, never assumed.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = 8, memory: str = "12g", app: str = "postloom") -> SparkSession:
    """A single-machine session for tests and the bench; on a cluster the session is the caller's."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app).config(map=SETTINGS)
    builder = builder.config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", str(cores))
    spark = builder.config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands this package to the executors' Python workers once a session, so that it need not be installed there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(os.path.join(root, "postloom")):  # not if it is already run from an archive
        base = os.path.join(tempfile.mkdtemp(prefix="postloom-"), "postloom")
        context.addPyFile(shutil.make_archive(base, "zip", root, "postloom"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir). Only in a local session without one, as in tests, a local folder is made; on a cluster that is an error."""
    context = spark.sparkContext
    now = context._jsc.sc().getCheckpointDir()
    if now.isDefined():
        return now.get()
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder and not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(folder or os.path.join(tempfile.gettempdir(), f"postloom-{os.getpid()}-{uuid.uuid4().hex[:8]}"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it from there, so that its lineage ends and lost executors cost no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Frees the shuffle files and written states of frames that are no longer in use, and what the driver holds for them.

    They go when the JVM collects its garbage, which a driver with little to do may put off for the whole run.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _row_bytes(df: DataFrame):
    """About as many bytes as a row holds: texts by their length, nested values by their JSON form, others by eight."""
    total = F.lit(0)
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            size = F.octet_length(c)
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            size = F.octet_length(F.to_json(F.struct(c)))
        else:
            size = F.lit(8)
        total = total + F.coalesce(size, F.lit(1))
    return total.cast("bigint")


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES, written: bool = False) -> bool:
    """Whether df has at most the given rows and bytes; reads no more than that number of rows, and only their sizes travel.

    written: df was ``cut``; one task then reads that number of rows, without an exchange, as each exchange keeps a
    thread of the driver and its memory for a minute.
    """
    sizes = df.select(_row_bytes(df).alias("_b"))
    n, held = (sizes.coalesce(1) if written else sizes).limit(rows + 1).agg(F.count("*"), F.sum("_b")).first()
    return n <= rows and (held or 0) <= most_bytes


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES, written: bool = False) -> DataFrame:
    """Marks df for a broadcast only after its size was checked; otherwise the join shuffles and AQE splits skewed keys.

    df is computed for the check and again for the join, so callers ``cut`` it first where that is dear, and say so in ``written``.
    """
    return F.broadcast(df) if is_small(df, rows, most_bytes, written) else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> DataFrame:
    """df over all cores if it comes in fewer partitions (one small file); larger inputs stay as they are read, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def filled(column: str):
    """Neither NULL nor the empty string."""
    return F.col(column).isNotNull() & (F.col(column) != "")
