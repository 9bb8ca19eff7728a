"""Running serial numbers inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retrolane.operators.hotkeys import shared

# Enough to spread a group over a large cluster while the cut points stay a short list.
MOST_SLICES = 512
# Rows that the cut points are chosen from, for each slice.
SAMPLED = 16


def _cuts(df: DataFrame, order: Sequence[str], slices: int) -> DataFrame:
    """One row: ascending order tuples that cut the rows into slices of about equal size.

    The rows with the smallest hashes are a sample that depends on the rows alone, so whoever
    evaluates it gets the same cuts; only the sample reaches one task.
    """
    drawn = df.select(F.xxhash64(*df.columns).alias("draw"), F.struct(*order).alias("at"))
    drawn = drawn.orderBy("draw", "at").limit(slices * SAMPLED)
    points = F.sort_array(F.collect_list("at"))
    step = F.size("points") / F.lit(float(slices))
    chosen = F.transform(F.sequence(F.lit(1), F.lit(slices - 1)), lambda i: F.get("points", F.floor(i * step).cast("int")))
    return drawn.agg(points.alias("points")).select(F.array_distinct(chosen).alias("cuts"))


def _slice_of(order: Sequence[str], most: int) -> Column:
    """How many of the ascending ``cuts`` lie below the row, by halving steps."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(most.bit_length()))])
    key = F.struct(*order)
    return F.aggregate(
        steps, F.lit(0), lambda below, step: F.when(F.get("cuts", below + step - 1) < key, below + step).otherwise(below)
    )


def _ranked(df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str, size: str | None) -> DataFrame:
    whole = Window.partitionBy(*groups)
    ranked = df.withColumn(name, F.row_number().over(whole.orderBy(*order)).cast("bigint"))
    return ranked.withColumn(size, F.count("*").over(whole)) if size else ranked


def numbered(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    name: str = "sno",
    size: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Adds ``name`` = 1, 2, … per group in ``order``; ``size`` names a column for the group's row count.

    A plain ``row_number`` would sort a whole group in one task. Here the order is cut into slices of
    about equally many rows, rows are ranked per (group, slice), and each slice is shifted by the row
    counts of the slices before it. Cuts are whole order tuples, so a first value that holds most rows
    is cut as well. Cuts, counts and ranks read the rows from one exchange, as a part of the query:
    building it starts no job. NULL groups are groups like any other. ``slices=1`` is for groups known
    to be small and ranks them directly.
    """
    slices = slices or min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_SLICES)
    if slices == 1:
        return _ranked(df, groups, order, name, size)
    df = shared(df)
    sliced = df.withColumn("cuts", _cuts(df, order, slices).scalar()).withColumn("slice", _slice_of(order, slices - 1)).drop("cuts")

    before = Window.partitionBy(*groups).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    keys = [*groups, "slice"]
    shifts = (
        sliced.groupBy(*keys)
        .agg(F.count("*").alias("slice_rows"))
        .withColumn("shift", F.coalesce(F.sum("slice_rows").over(before), F.lit(0)))
        .withColumn("group_rows", F.sum("slice_rows").over(Window.partitionBy(*groups)))
        .select(*[F.col(key).alias(f"of_{key}") for key in keys], "shift", "group_rows")
    )
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    # null-safe equality keeps NULL groups, and leaves no filter to push below the shared exchange
    same = [F.col(key).eqNullSafe(F.col(f"of_{key}")) for key in keys]
    placed = (
        sliced.withColumn("rank", rank)
        .join(shifts, same)
        .withColumn(name, (F.col("rank") + F.col("shift")).cast("bigint"))
    )
    if size:
        placed = placed.withColumn(size, F.col("group_rows"))
    return placed.drop("slice", "rank", "shift", "group_rows", *[f"of_{key}" for key in keys])
