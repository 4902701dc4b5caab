"""Reading raw records and writing raw, canonical and catalogue tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators import catalogue

CORRUPT = "_corrupt"


def read_json_objects(spark: SparkSession, path: str, schema: T.StructType,
                      skip: str = r"/_index\.json$", single: bool = True) -> DataFrame:
    """A folder of one-object JSON files, with the file each row came from.
    Index files are skipped; a file that does not parse keeps its text in
    ``_corrupt`` and goes to quarantine in ``guard``."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    df = (spark.read.schema(full).option("multiLine", single).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    return (df.withColumn("file", F.col("_metadata.file_path"))
            .filter(~F.col("file").rlike(skip)))


def guard(rows: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every required field, and the others with a reason."""
    reason = F.lit(None).cast("string")
    for name in reversed(required):
        reason = F.when(F.col(name).isNull(), F.lit(f"no {name}")).otherwise(reason)
    if CORRUPT in rows.columns:
        reason = F.when(F.col(CORRUPT).isNotNull(), "unreadable").otherwise(reason)
    marked = rows.withColumn("reason", reason)
    good = marked.filter("reason IS NULL").drop("reason", CORRUPT)
    return good, marked.filter("reason IS NOT NULL")


def land(rows: DataFrame, path: str, run_id: str, sort_by: list[str] | None = None) -> None:
    """Append a collector's rows as Parquet under its run. Compacts the many
    small files; sorting inside partitions keeps row groups selective."""
    out = rows.withColumn("run_id", F.lit(run_id))
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    out.write.mode("append").partitionBy("run_id").parquet(path)


def index_of(rows: DataFrame, key: str, source: str = "source") -> DataFrame:
    """The collector's index: number of records and of distinct keys per
    source. The key list is the key column of the landed table itself."""
    return rows.groupBy(source).agg(F.count(F.lit(1)).alias("count"),
                                    F.count_distinct(key).alias("keys"))


def write_canonical(records: DataFrame, path: str) -> None:
    """A new snapshot, one folder per source."""
    records.write.mode("errorifexists").partitionBy("source").parquet(path)


def write_catalogue(entries: DataFrame, path: str) -> DataFrame:
    """The catalogue, then from the written table its small vocabulary. Going
    through the table computes the entries once and survives lost executors."""
    spark = entries.sparkSession
    entries.write.mode("errorifexists").partitionBy("source").parquet(f"{path}/catalogue")
    stored = spark.read.parquet(f"{path}/catalogue")
    catalogue.facet_counts(stored).write.mode("errorifexists").parquet(f"{path}/facets")
    return stored


def mining_targets(records: DataFrame, mined: DataFrame | None = None,
                   only_unclassified: bool = False, excluded: list[str] = (),
                   limit: int | None = None, key: str = "id",
                   url: str = "summary_report_url", category: str = "category",
                   source: str = "source") -> DataFrame:
    """Records worth mining: with a report, not excluded, not yet mined, and on
    request only those without a known technology. A limit takes them in key
    order. The anti join comes before any text is read."""
    out = records.filter(F.col(url).isNotNull() & (F.col(url) != ""))
    if excluded:
        out = out.filter(~F.col(source).isin(*excluded))
    if only_unclassified:
        out = out.filter(F.col(category).isNull() | (F.col(category) == "other"))
    if mined is not None:
        out = out.join(mined.select(key).distinct(), key, "left_anti")
    return out if limit is None else out.orderBy(key).limit(limit)
