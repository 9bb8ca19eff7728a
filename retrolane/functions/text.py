"""Text expressions shared by reports and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_text(column: Column, *values: str) -> Column:
    """Equality without regard to letter case, as the source databases compare text."""
    return F.lower(column).isin([value.lower() for value in values])


def before_dash(column: str) -> Column:
    """Text before the first dash; empty when there is none."""
    return F.expr(f"substr({column}, 1, instr({column}, '-') - 1)")


def yes_no(column: str) -> Column:
    return F.when(F.col(column).isNotNull(), "Y").otherwise("N")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def recipients(*addresses: Column) -> Column:
    """Comma-joined addresses, leaving out missing and empty ones."""
    return F.concat_ws(",", *[F.nullif(address, F.lit("")) for address in addresses])


def line_breaks(column: Column) -> Column:
    return F.replace(column, F.lit("\n"), F.lit("<br />"))


def title_names(names: Sequence[str]) -> list[str]:
    return [name.title() for name in names]


def titled(df: DataFrame) -> DataFrame:
    """Column names in title case, for printed headers."""
    return df.toDF(*title_names(df.columns))
