"""Running values over long groups without one task per group.

A window with a running frame sorts a whole group in one task. Here a group is
cut into blocks of consecutive positions: each block runs alone and takes the
value carried in from the blocks before it, which is a window over one row per
block. A table holding a third of all rows is thus spread over many tasks.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

BLOCK = 8192


def running_max(df: DataFrame, keys: list[str], position: str, values: dict[str, Column],
                inclusive: bool = True, block: int = BLOCK) -> DataFrame:
    """Add, per row, the largest non-null value of each column among the rows
    of the same keys up to ``position`` (before it when not ``inclusive``).

    Rows are written once with the values of their own block, so that rows that come
    partitioned by their keys are not shuffled, nor worked out twice, for the carried ones."""
    work = df.withColumn("_block", F.floor(F.col(position) / block))
    for name, value in values.items():
        work = work.withColumn(f"_v_{name}", value)
    upto = 0 if inclusive else -1
    here = (Window.partitionBy(*keys, "_block").orderBy(position)
            .rowsBetween(Window.unboundedPreceding, upto))
    earlier = (Window.partitionBy(*keys).orderBy("_block")
               .rowsBetween(Window.unboundedPreceding, -1))
    local = materialize(work.select("*", *[F.max(f"_v_{n}").over(here).alias(f"_l_{n}") for n in values]), "running")
    carried = local.groupBy(*keys, "_block").agg(
        *[F.max(f"_v_{n}").alias(f"_b_{n}") for n in values])
    carried = carried.select(*keys, "_block",
                             *[F.max(f"_b_{n}").over(earlier).alias(f"_c_{n}") for n in values])
    # One row per block; blocks that receive nothing need not join.
    carried = carried.filter(" OR ".join(f"_c_{n} IS NOT NULL" for n in values))
    joined = local.join(carried, [*keys, "_block"], "left")
    out = joined.select(
        *df.columns,
        *[F.greatest(f"_l_{n}", f"_c_{n}").alias(n) for n in values])
    return out


def running_position(df: DataFrame, keys: list[str], position: str, name: str = "pos",
                     block: int = BLOCK) -> DataFrame:
    """1-based rank of each row inside its keys, by ``position`` (unique there)."""
    work = df.withColumn("_block", F.floor(F.col(position) / block))
    here = Window.partitionBy(*keys, "_block").orderBy(position)
    earlier = (Window.partitionBy(*keys).orderBy("_block")
               .rowsBetween(Window.unboundedPreceding, -1))
    before = (work.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
              .select(*keys, "_block",
                      F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
    local = work.withColumn("_rn", F.row_number().over(here))
    return (local.join(before, [*keys, "_block"], "left")
            .select(*df.columns, (F.col("_rn") + F.col("_before")).cast("int").alias(name)))
