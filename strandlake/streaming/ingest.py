"""Families from a folder that fills up: each micro-batch is appended to a table, and consensus is called on demand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandlake.sources.readers import FAMILY_COLUMNS


def stream_families(spark: SparkSession, path: str) -> DataFrame:
    """A stream of families from eight-column text files; other lines are left out."""
    parts = F.split(F.regexp_replace("value", r"\r$", ""), "\t")
    rows = spark.readStream.text(path).select(parts.alias("p")).where(F.size("p") == len(FAMILY_COLUMNS))
    return rows.select(*[F.get("p", F.lit(i)).alias(c) for i, c in enumerate(FAMILY_COLUMNS)])


def append_families(families: DataFrame, table: str, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Write the stream to Parquet, partitioned by a hash of the barcode, so a barcode's reads lie together.

    A batch is written under its number: a batch that is tried again replaces itself.
    """
    def write(batch: DataFrame, number: int) -> None:
        shard = F.pmod(F.xxhash64("barcode"), F.lit(buckets)).cast("int")
        batch.withColumn("shard", shard).repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(f"{table}/batch={number}")

    return families.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingested(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.option("basePath", table).parquet(f"{table}/batch=*").select(*FAMILY_COLUMNS)
