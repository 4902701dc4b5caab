"""Columns that are computed once a row, whatever reads them."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` names it."""
    return F.transform(F.array(value), lambda x: use(x))[0]


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns as the output of a generator of one row. Filters on the columns of a plain
    projection are moved below it, expressions and all, and later projections may
    repeat them; a generator's output is neither moved nor repeated."""
    row = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    return df.select("*", F.inline_outer(row))
