"""Grouped counts with a grand-total row, from one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def per_item_with_total(
    rows: DataFrame, label: str, item: Sequence[str], *aggregates: Column, within: Sequence[str] = ()
) -> DataFrame:
    """One row per (label, item) and one per item over all labels, told apart by ``is_total``.

    Counting these rows afterwards gives distinct items per label and in total.
    The shuffle runs on the item key, so a label that holds most rows is spread.
    ``within`` columns take part in both groupings.
    """
    inner = [*within, *item]
    return rows.groupingSets([[label, *inner], inner], label, *inner).agg(
        F.grouping(label).cast("int").alias("is_total"), *aggregates
    )


def named_total(rows: DataFrame, label: str, total: str) -> DataFrame:
    """Writes the total's name into its label and drops exact duplicate rows, as a set union does."""
    named = F.when(F.col("is_total") == 1, F.lit(total)).otherwise(F.col(label))
    return rows.withColumn(label, named).drop("is_total").distinct()
