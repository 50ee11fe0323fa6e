"""Tables in the folder that all executors share, where a plan's lineage is cut."""

from __future__ import annotations

import gc
import tempfile
import uuid
from contextlib import suppress

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_own_dir: list[str] = []
_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``). Where it is unset a local one serves a local master, and no other."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own_dir:
        _own_dir.append("file://" + tempfile.mkdtemp(prefix="strandlake-"))
    return _own_dir[0]


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/strandlake/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def materialise(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to a Parquet table in the shared folder and read it back: lineage ends there."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._strandlake_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    if path in _made:
        _made.remove(path)


def discard(df: DataFrame | None) -> None:
    """Delete a table that ``materialise`` wrote and no plan needs any more."""
    path = getattr(df, "_strandlake_path", None)
    if path:
        _delete(df.sparkSession, path)


def mark() -> int:
    """A point in time for ``sweep``."""
    return len(_made)


def sweep(spark: SparkSession, since: int, *keep: DataFrame) -> None:
    """Delete what was written to the shared folder since a ``mark``, but for the tables in ``keep``.

    For callers that have written the result they wanted: nothing may be read from the other tables any more.
    """
    kept = {getattr(df, "_strandlake_path", None) for df in keep}
    for path in [p for p in _made[since:] if p not in kept]:
        _delete(spark, path)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished plans now: it does so when the driver collects its garbage.

    Memory outside the heap goes back to the system as well: what the driver's many threads have freed there, the allocator keeps otherwise.
    """
    gc.collect()
    spark._jvm.System.gc()
    _trim(spark)


def _trim(spark: SparkSession) -> None:
    """The JVM's command System.trim_native_heap (Linux, Java 17.0.9 and later); where there is none, nothing happens."""
    jvm = spark._jvm
    server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    call = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    args = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
    args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    with suppress(Py4JJavaError):
        call.invoke(server, args)


def with_places(table: DataFrame, with_path: bool = False) -> DataFrame:
    """Adds ``file`` (rank of the file's path; ``path`` itself, too, if asked) and ``line`` (row in the file, from 0) to a table read from files.

    Each split of a file counts its rows, running sums over the splits give where it starts, and the place in the split
    comes from the row ids that Spark deals out in reading order. Only the counts, a row for each split, are sorted.
    """
    columns = table.columns
    rows = table.select(
        *columns, F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    splits = rows.groupBy("_path", "_block").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(
        F.col("_path").alias("_p"), F.col("_block").alias("_b"), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
        (F.dense_rank().over(Window.orderBy("_path")) - 1).cast("long").alias("file"),
    )
    out = rows.join(splits, (F.col("_path") == F.col("_p")) & (F.col("_block") == F.col("_b")))
    path = [F.col("_path").alias("path")] if with_path else []
    return out.select(*columns, *path, "file", (F.col("_base") + F.col("_id") - F.col("_first")).alias("line"))


def ranked(df: DataFrame, *order, label: str = "ranked") -> DataFrame:
    """Adds ``rank`` (from 0) in the order of ``order``: sorted into files by ranges, then numbered file after file."""
    columns = df.columns
    placed = with_places(materialise(df.orderBy(*order), label))
    sizes = placed.groupBy("file").agg(F.count("*").alias("_n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(F.col("file").alias("_f"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return placed.join(bases, F.col("file") == F.col("_f")).select(*columns, (F.col("_base") + F.col("line")).alias("rank"))
