"""Session settings and the shared checkpoint folder."""
from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[str] = []


def get_spark(app: str = "regloom", master: str | None = None, **conf) -> SparkSession:
    """A session in UTC with adaptive execution and skew-join splitting on.

    ANSI mode keeps its default (on): every cast of free text in the library
    is therefore a ``try_`` form.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **{k: str(v) for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Session options the jobs rely on, whoever made the session. Unions whose
    sides are partitioned alike must not be zipped partition by partition, as
    adaptive execution may coalesce the sides differently."""
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    return spark


def union(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, by column name, safe in any session (see ``prepare``)."""
    prepare(frames[0].sparkSession)
    return functools.reduce(DataFrame.unionByName, frames)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master, whose executors share the driver's disk, may name
    none: a temporary folder is then made and set. Elsewhere that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write an intermediate table to the shared folder and read it back, so
    that what follows neither recomputes it nor depends on an executor."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/regloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.parquet(path)


def drop_intermediates(spark: SparkSession) -> int:
    """Remove the intermediate tables this driver has written; call it when
    their results have been stored. Returns how many there were."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths, _WRITTEN[:] = list(_WRITTEN), []
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
    return len(paths)
