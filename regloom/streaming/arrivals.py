"""Runs of a stream over files that arrive one drop after the other."""
from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import checkpoint_dir

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed processors need, for the queries begun inside."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def run_to_table(stream: Callable[[DataFrame], DataFrame], drops: Iterable[DataFrame], name: str) -> tuple[DataFrame, list[dict]]:
    """The rows that ``stream`` appends over the drops, each landed before a run that
    reads what is new and ends, and the progress of all runs. Input, output and
    checkpoint lie in the shared folder, so a lost run is begun again by the next."""
    progress: list[dict] = []
    base = landing = None
    for drop in drops:
        spark = drop.sparkSession
        if base is None:
            base = f"{checkpoint_dir(spark)}/regloom-{name}-{uuid.uuid4().hex}"
            landing = f"{base}/landing"
        drop.write.mode("append").parquet(landing)
        rows = stream(spark.readStream.schema(drop.schema).parquet(landing))
        query: StreamingQuery = (rows.writeStream.format("parquet").outputMode("append")
                                 .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
                                 .trigger(availableNow=True).start())
        query.awaitTermination()
        progress += [p if isinstance(p, dict) else json.loads(p.json) for p in query.recentProgress]
    return spark.read.schema(rows.schema).parquet(f"{base}/out"), progress


def dropped_late(progress: list[dict]) -> int:
    """Rows that state operators dropped as late. Aggregations count what is left
    after combining inside a task, other operators count rows."""
    return sum(s.get("numRowsDroppedByWatermark", 0) for p in progress for s in p.get("stateOperators", []))
