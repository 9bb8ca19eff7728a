"""Dispatches per courier family over the last days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retrolane.clock import Clock, moment
from retrolane.functions.labels import Sites, courier_family, warehouse_label
from retrolane.operators.totals import named_total, per_item_with_total
from retrolane.plans.parts import dispatched, items, sheets, with_user
from retrolane.sources.catalog import Catalog


def _dispatch_rows(c: Catalog, clock: Clock, days: int) -> DataFrame:
    """Returned items on sheets created in the window, with the age in days of the sheet's last update."""
    recent = sheets(c).where(clock.closed_days("sheet_created", days))
    age = F.datediff(F.to_date(moment(clock.midnight())), F.to_date("dispatch_date"))
    recent = recent.select("sheet_id", courier_family("sheet_courier").alias("courier"), age.alias("age"))
    stock = items(c).where(F.col("status") == "RTV").select("item_id", "item_warehouse_id", "created_by_id")
    return dispatched(c, recent, stock)


def day_name(age: int) -> str:
    return "yest" if age == 1 else f"yest_minus_{age - 1}"


def _distinct_on_day(age: int, exact: bool) -> Column:
    """Distinct items updated on one day.

    The report counts ``CASE WHEN on that day THEN item ELSE 0 END``, so the
    value 0 is counted once as soon as any other row exists. ``exact`` leaves
    that extra 0 out.
    """
    real = F.coalesce(F.sum(F.when(F.col("age") == age, F.col("distinct_items"))), F.lit(0))
    if exact:
        return real.cast("bigint")
    elsewhere = F.sum("rows") > F.coalesce(F.sum(F.when(F.col("age") == age, F.col("rows"))), F.lit(0))
    zero_seen = F.coalesce(F.max(F.when(F.col("age") == age, F.col("has_zero"))), F.lit(False))
    return (real + (elsewhere & ~zero_seen).cast("int")).cast("bigint")


def _pivot(rows: DataFrame, keys: list[str], days: int, exact: bool, last_counts_rows: bool) -> DataFrame:
    """Families by age, with a total over all families.

    Rows shrink in steps: per (family, age, item), then per (family, age), and
    only then are the day columns laid out.
    """
    per_item = per_item_with_total(rows, "courier", ["age", "item_id"], F.count("*").alias("rows"), within=keys)
    per_day = per_item.groupBy("is_total", *keys, "courier", "age").agg(
        F.count("*").alias("distinct_items"),
        F.sum("rows").alias("rows"),
        F.max(F.col("item_id") == 0).alias("has_zero"),
    )
    columns = [_distinct_on_day(age, exact).alias(day_name(age)) for age in range(1, days + 1)]
    if last_counts_rows and not exact:
        columns[-1] = F.sum("rows").alias(day_name(days))
    laid_out = per_day.groupBy("is_total", *keys, "courier").agg(*columns)
    return named_total(laid_out, "courier", "Total")


def courier_wise_rtv(c: Catalog, clock: Clock, days: int = 7, exact: bool = False) -> DataFrame:
    """Items dispatched per courier family on each of the last days."""
    rows = _dispatch_rows(c, clock, days).select("courier", "age", "item_id")
    return _pivot(rows, [], days, exact, last_counts_rows=False)


def warehouse_courier_rtv(c: Catalog, clock: Clock, sites: Sites, days: int = 7, exact: bool = False) -> DataFrame:
    """The same per site of the user who put the item away; items of no site are left out.

    The oldest column counts rows, whatever their day, unless ``exact``.
    """
    rows = with_user(c, _dispatch_rows(c, clock, days).withColumnRenamed("created_by_id", "user_id"), "user_id", "left")
    site = warehouse_label("username", "item_warehouse_id", sites)
    labelled = rows.select(site.alias("warehouse"), "courier", "age", "item_id").where(F.col("warehouse").isNotNull())
    return _pivot(labelled, ["warehouse"], days, exact, last_counts_rows=True)
