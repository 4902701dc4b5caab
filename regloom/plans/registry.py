"""Queries by name, each with its independent SQL where SQL can say it."""
from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, sf_dir) under a name, with its SQL."""

    def add(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(prepare(spark), sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add
