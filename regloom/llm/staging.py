"""Row keys and tables written to the session's shared folder."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import checkpoint_dir, materialize

__all__ = ["keep_rows", "materialize", "new_folder", "row_key"]


def row_key(docs: DataFrame) -> Column:
    """64-bit key of a row's id, text, language and source. Equal rows have
    equal keys, so their verdicts are equal and a semi-join keeps them all."""
    return F.xxhash64(F.lit("row"), *[F.col(c) for c in ("doc_id", "text", "lang", "source") if c in docs.columns],
                      *[F.col(c).isNull() for c in ("doc_id", "text", "lang", "source") if c in docs.columns])


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder below the shared one, not yet made."""
    return f"{checkpoint_dir(spark)}/regloom-{name}-{uuid.uuid4().hex}"


def keep_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs``, whatever their columns are called, whose key is in ``keys``."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), row_key(docs).alias("row_key"))
    return held.join(keys.select("row_key"), "row_key", "left_semi").select("doc.*")
