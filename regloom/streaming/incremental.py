"""Scheduled re-collection: new raw files in, a new snapshot out."""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators.reconcile import latest_per_key
from ..operators.snapshot import carry_forward
from ..session import checkpoint_dir


def read_new_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                   **options) -> DataFrame:
    """File stream over a landing folder; every file is read once."""
    return (spark.readStream.schema(schema).format(fmt).options(**options).load(path)
            .withColumn("file", F.col("_metadata.file_path")))


def _snapshot_path(base: str, batch: int) -> str:
    return f"{base}/batch={batch:08d}"


def _numbers(spark: SparkSession, pattern: str) -> list[int]:
    """Sorted numbers that end the names of the folders a pattern finds."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(int(re.search(r"(\d+)(?:/_SUCCESS)?$", s.getPath().toString())[1]) for s in found)


def upsert_snapshots(rows: DataFrame, base: str, key: str, order: list[str], mined: list[str],
                     name: str, merge=carry_forward):
    """Run once over all new files. Each batch writes a complete new snapshot
    ``batch=N`` from snapshot N-1 and its own rows; a repeated batch rewrites
    its own folder only, so the result is the same.

    The stream's checkpoint lies in the shared folder and its name says at
    which snapshot it began. If it is lost, the stream begins again behind the
    last complete snapshot: it reads all files once more, on top of that
    snapshot, and overwrites none.
    """
    spark = rows.sparkSession
    home = f"{checkpoint_dir(spark)}/{name}"
    begun = _numbers(spark, f"{home}-from-*")
    stored = _numbers(spark, f"{base}/batch=*/_SUCCESS")
    first = begun[-1] if begun else stored[-1] + 1 if stored else 0

    def apply(batch: DataFrame, batch_id: int) -> None:
        fresh = latest_per_key(batch, [key], order)
        if first + batch_id > 0:
            previous = spark.read.parquet(_snapshot_path(base, first + batch_id - 1))
            fresh = merge(fresh, previous, mined, key)
        fresh.write.mode("overwrite").parquet(_snapshot_path(base, first + batch_id))

    return (rows.writeStream.foreachBatch(apply)
            .option("checkpointLocation", f"{home}-from-{first:08d}")
            .trigger(availableNow=True).start())


def once_per_record(rows: DataFrame, key: list[str], collected: str, within: str) -> DataFrame:
    """Rows of a stream without those sent again. Rows are the same if all columns
    ``key`` are; the first to arrive stays. The state of a record is held until the
    watermark, ``within`` behind the latest ``collected``, has passed it by ``within``
    more; a copy that comes even later is dropped as late itself, so it is not
    taken for new. Rows without a time are the same as copies of their key only
    while that is held."""
    return rows.withWatermark(collected, within).dropDuplicatesWithinWatermark(key)
