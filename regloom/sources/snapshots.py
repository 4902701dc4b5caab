"""Snapshots kept in place, bucketed by key and rewritten slot by slot.

A snapshot is a table partitioned by ``slot``, a hash of the key, and bucketed and
sorted by the key inside. An upsert reads and rewrites only the slots into which
new keys fall; the others keep their files. As the stored side is bucketed by the
join key, it is not shuffled: the new rows go to the buckets.

Slots are replaced when the job commits, so a job that fails leaves the former
rows, and one that is repeated gives the same table.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.snapshot import carry_forward

SLOTS, BUCKETS = 64, 8


def slot_of(key: str, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def open_snapshot(spark: SparkSession, name: str, path: str, schema: str, key: str = "id", buckets: int = BUCKETS) -> DataFrame:
    """The snapshot below ``path`` as table ``name`` of this session, made if there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}, slot INT) USING parquet PARTITIONED BY (slot) "
              f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.catalog.recoverPartitions(name)
    return spark.table(name)


def merged(fresh: DataFrame, stored: DataFrame, mined: list[str], key: str = "id", slots: int = SLOTS
           ) -> tuple[DataFrame, list[int]]:
    """The rows of all slots into which keys of ``fresh`` fall, new fields over stored
    ones and ``mined`` ones carried forward, and these slots: at most ``slots`` numbers."""
    fresh = fresh.withColumn("slot", slot_of(key, slots))
    touched = sorted(r["slot"] for r in fresh.select("slot").distinct().collect())
    old = stored.filter(F.col("slot").isin(touched))
    return carry_forward(fresh, old, mined, key), touched


def upsert(fresh: DataFrame, name: str, mined: list[str], key: str = "id", slots: int = SLOTS) -> list[int]:
    """Merge rows, one per key, into the table ``name``; the slots that were rewritten."""
    spark = fresh.sparkSession
    stored = spark.table(name)
    rows, touched = merged(fresh, stored, mined, key, slots)
    if touched:
        before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            rows.select(*stored.columns).write.insertInto(name, overwrite=True)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
        spark.catalog.refreshTable(name)
    return touched
