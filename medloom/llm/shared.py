"""Tables written to the folder that all executors share, and small plan helpers."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_READ = "spark.sql.parquet.columnarReaderBatchSize"
#: Parquet bytes of a table that a join may broadcast.
BROADCAST_BYTES = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, the warehouse, or in local mode a temporary folder.
    A folder without a scheme is one of the default file system, as Spark itself takes it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        local = spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master
        found = f"file://{tempfile.mkdtemp(prefix='medloom-')}" if local else f"{spark.conf.get('spark.sql.warehouse.dir')}/_medloom"
        spark.conf.set("spark.checkpoint.dir", found)
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(found)
    files = path.getFileSystem(sc._jsc.hadoopConfiguration())
    return re.sub("^file:/(?!//)", "file:///", path.makeQualified(files.getUri(), files.getWorkingDirectory()).toString())


def new_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def store(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the lineage ends there, and columns stay prunable."""
    spark = df.sparkSession
    path = new_path(spark, what)
    df.write.parquet(path)
    return stored(spark, path, df.schema)


def stored(spark: SparkSession, path: str, schema) -> DataFrame:
    """The Parquet table in a folder of the shared one, which may have no file at all."""
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(sc._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    out = spark.read.schema(schema).parquet(path)
    out._medloom_path = path
    return out


def _folder(df: DataFrame):
    """Hadoop's file system and path of what ``store`` wrote, or two Nones."""
    path = getattr(df, "_medloom_path", None)
    if not path:
        return None, None
    sc = df.sparkSession.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()), where


def drop_stored(*frames: DataFrame) -> None:
    """Delete what ``store`` wrote once nothing will read it again."""
    for df in frames:
        files, where = _folder(df)
        if files:
            files.delete(where, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps: it does when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_or_hashed(df: DataFrame, table: DataFrame | None = None, most: int = BROADCAST_BYTES) -> DataFrame:
    """A stored table (or columns of one, ``table``) for a join: to be broadcast if its files take up to ``most`` bytes,
    else to be shuffled and hashed."""
    files, where = _folder(df if table is None else table)
    return F.broadcast(df) if files and files.getContentSummary(where).getLength() <= most else df.hint("shuffle_hash")


def text_batches(spark: SparkSession) -> None:
    """Arrow batches of fewer rows, where the session has Spark's default: the rows are whole texts, and a batch is held by
    the executor and by its Python worker, more than once while it grows.  So are the rows that are read from Parquet
    together: they lie in one array, which an executor's heap grows for."""
    if spark.conf.get(_BATCH, "10000") == "10000":
        spark.conf.set(_BATCH, "1000")
    if spark.conf.get(_READ, "4096") == "4096":
        spark.conf.set(_READ, "512")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(*names: str):
    """A 64-bit identity of a row's values; nulls differ from every value."""
    return F.xxhash64(*[c for n in names for c in (F.col(n).isNull(), F.col(n))])


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
