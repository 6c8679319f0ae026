"""Values of neighbouring rows in long ordered series.

A window over a whole series would put a series of any length into one task. Here a series is cut into blocks of
its order, a window works inside each block, and one summary row per block carries what crosses its borders.
Blocks are hashed by (keys, block), which the join with the summaries keeps; only the summaries are moved again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "_block"


def in_blocks(df: DataFrame, block: Column) -> DataFrame:
    return df.withColumn(BLOCK, block.cast("long"))


def inside(keys: Sequence[str], *order: Column | str):
    """The window of the rows of a block."""
    return Window.partitionBy(*keys, BLOCK).orderBy(*order)


def across(keys: Sequence[str], forward: bool = True):
    """The window of the summaries of a series."""
    return Window.partitionBy(*keys).orderBy(F.col(BLOCK).asc() if forward else F.col(BLOCK).desc())


def with_summary(df: DataFrame, summary: DataFrame, keys: Sequence[str], *columns: Column) -> DataFrame:
    """df with columns of its block's summary."""
    names = [f"_k{i}" for i in range(len(keys))]
    right = summary.select(*(F.col(k).alias(n) for k, n in zip(keys, names)), F.col(BLOCK).alias("_kb"), *columns)
    same = F.col(BLOCK) == F.col("_kb")
    for k, n in zip(keys, names):
        same = same & F.col(k).eqNullSafe(F.col(n))
    return df.join(right, same, "left").drop("_kb", *names)


def cumulative(df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str], step: Callable[[Column, Column], Column], name: str, step_name: str) -> DataFrame:
    """Adds `step_name`, the step of each row, and `name`, the sum of the steps up to it.

    step(row, before) gives a number from two structs of the fields; before is null for the first row of a series.
    """
    row = F.struct(*fields)
    window = inside(keys, *order)
    local = df.withColumn("_before", F.lag(row).over(window)).withColumn("_step", F.when(F.col("_before").isNotNull(), step(row, F.col("_before"))))
    at = F.struct(*order)
    blocks = local.groupBy(*keys, BLOCK).agg(F.min_by(row, at).alias("_first"), F.max_by(row, at).alias("_last"), F.coalesce(F.sum("_step"), F.lit(0)).alias("_steps"))
    over = across(keys)
    entered = blocks.withColumn("_enter", step(F.col("_first"), F.lag("_last").over(over)))
    passed = F.coalesce(F.sum(F.col("_enter") + F.col("_steps")).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("_enter")
    summed = local.withColumn("_sum", F.coalesce(F.sum("_step").over(window.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    rows = with_summary(summed, entered, keys, F.col("_enter"), passed.alias("_passed"))
    return rows.withColumns({step_name: F.coalesce("_step", "_enter"), name: F.col("_sum") + F.col("_passed")}).drop("_before", "_step", "_sum", "_enter", "_passed")
