"""Counting and percentage expressions.

Percentages follow exact decimal arithmetic with halves rounded up, written on
integers so that no floating-point ratio is rounded. A zero denominator gives
NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TURNAROUND_DAYS = (1, 2, 3, 5)


def percent(part: str, whole: str) -> Column:
    """Whole-number percentage."""
    return F.expr(f"(200 * {part} + {whole}) div (2 * nullif({whole}, 0))")


def percent_one_decimal(part: str, whole: str) -> Column:
    return F.expr(f"cast((2000 * {part} + {whole}) div (2 * nullif({whole}, 0)) AS DOUBLE) / 10")


def percent_floor(part: str, whole: str) -> Column:
    """Integer ratio in percent, cut off rather than rounded."""
    return F.expr(f"({part} * 100) div nullif({whole}, 0)")


def zero_if_null(*columns: str) -> list[Column]:
    return [F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name) for name in columns]


def bucket_names(days: Sequence[int] = TURNAROUND_DAYS) -> list[str]:
    return [f"within_{day}_day" for day in days] + [f"over_{days[-1]}_day"]


def row_buckets(elapsed: Column, days: Sequence[int] = TURNAROUND_DAYS) -> list[Column]:
    """Cumulative day buckets counted over rows."""
    within = [F.count_if(elapsed <= day).alias(f"within_{day}_day") for day in days]
    return [*within, F.count_if(elapsed > days[-1]).alias(f"over_{days[-1]}_day")]


def item_buckets(shortest: str, longest: str, days: Sequence[int] = TURNAROUND_DAYS) -> list[Column]:
    """The same buckets over distinct items already reduced to their extreme durations.

    An item counts as within ``k`` days when any of its rows is, i.e. when its
    shortest duration is, and as over the last bound when its longest is.
    """
    within = [F.count_if(F.col(shortest) <= day).alias(f"within_{day}_day") for day in days]
    return [*within, F.count_if(F.col(longest) > days[-1]).alias(f"over_{days[-1]}_day")]
