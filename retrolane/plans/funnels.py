"""Daily funnels of both databases.

Each source is reduced to one row per day before anything is joined, so the
joins only ever see a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retrolane.clock import Clock
from retrolane.functions.labels import is_courier_debit, is_hold, is_non_faulty
from retrolane.functions.metrics import zero_if_null
from retrolane.plans.parts import dispatched, items, real_change, sheet_lines, sheets, with_rules
from retrolane.sources.catalog import Catalog


def per_day(rows: DataFrame, column: str, count: str) -> DataFrame:
    return rows.groupBy(F.to_date(column).alias("date")).agg(F.count("*").alias(count))


def _returns_funnel(c: Catalog, window: Column) -> DataFrame:
    initiated = per_day(c.crp.where(window), "created", "total_rpi")
    received = per_day(real_change(c.crp_history, "RPR").where(window), "created", "total_rpr")
    checked = per_day(real_change(c.cri_history, "PDC").where(window), "created", "total_qc")
    days = initiated.join(received, "date", "left").join(checked, "date", "left")
    return days.select("date", *zero_if_null("total_rpi", "total_rpr", "total_qc"))


def rms_daily_funnel_to_now(c: Catalog, clock: Clock, days: int = 6) -> DataFrame:
    """Packages initiated, received and items checked per day, up to now."""
    return _returns_funnel(c, clock.days_to_now("created", days))


def rms_daily_funnel(c: Catalog, clock: Clock, days: int = 7) -> DataFrame:
    """The same over closed days."""
    return _returns_funnel(c, clock.closed_days("created", days))


def wms_daily_flow_to_now(c: Catalog, clock: Clock, days: int = 6) -> DataFrame:
    """Items put away, returned, passed out and left for liquidation per day, up to now.

    Gate passes reach one day further back than the rest.
    """
    stock = (
        c.inventory.where(clock.days_to_now("created", days))
        .groupBy(F.to_date("created").alias("date"))
        .agg(F.count("*").alias("total_putaway"), F.count_if(F.col("status") == "RTV").alias("total_returns"))
    )
    passes = per_day(c.gate_pass.where(clock.days_to_now("created", days + 1)), "created", "total_gatepass")
    counted = stock.join(passes, "date", "left").select(
        "date", *zero_if_null("total_putaway", "total_returns", "total_gatepass")
    )
    left_over = F.col("total_putaway") - (F.col("total_returns") + F.col("total_gatepass"))
    return counted.withColumn("total_liquidation", left_over)


def side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Days of ``left`` with the figures of ``right``; a day missing there counts as zero."""
    figures = [name for name in right.columns if name != "date"]
    return left.join(right, "date", "left").select(*left.columns, *zero_if_null(*figures))


def rpi_report(c: Catalog, clock: Clock, days: int = 6) -> DataFrame:
    return side_by_side(rms_daily_funnel_to_now(c, clock, days), wms_daily_flow_to_now(c, clock, days))


def rule_flags() -> dict[str, Column]:
    return {
        "hold_45_days": is_hold("normal_rule"),
        "soi_non_faulty": is_non_faulty("normal_rule"),
        "courier_debit": is_courier_debit("bulk_rule"),
    }


def distinct_items_per_day(rows: DataFrame) -> DataFrame:
    """Distinct items per ``date`` in total and per rule kind.

    Rows are reduced to one per (day, item) first. Counting several conditional
    distincts directly would multiply every row by the number of conditions.
    """
    flags = [F.max(flag).alias(name) for name, flag in rule_flags().items()]
    per_item = rows.groupBy("date", "item_id").agg(*flags)
    return per_item.groupBy("date").agg(
        F.count("item_id").alias("total_putaway"),
        *[F.count_if(F.col(name) & F.col("item_id").isNotNull()).alias(name) for name in rule_flags()],
    )


def wms_daily_flow(c: Catalog, clock: Clock, days: int = 7) -> DataFrame:
    """Items put away per closed day, by rule kind, and items dispatched that day."""
    recent = items(c).where(clock.closed_days("putaway_date", days))
    stock = distinct_items_per_day(with_rules(c, recent).withColumn("date", F.to_date("putaway_date")))
    sent = dispatched(
        c,
        sheets(c).where(clock.closed_days("dispatch_date", days)).select("sheet_id", "dispatch_date"),
        items(c).where(F.col("status") == "RTV").select("item_id"),
    )
    sent = sent.groupBy(F.to_date("dispatch_date").alias("date")).agg(
        F.count_distinct("item_id").alias("total_dispatch")
    )
    return side_by_side(stock, sent)


def daily_summary(c: Catalog, clock: Clock, days: int = 7) -> DataFrame:
    return side_by_side(rms_daily_funnel(c, clock, days), wms_daily_flow(c, clock, days))


def putaway_and_rtv(c: Catalog, clock: Clock, days: int = 7) -> DataFrame:
    """Per put-away day: items, dispatch sheets begun, sheets completed, sheets pending.

    Items are counted without the sheet join, sheets with it; each branch needs
    one distinct key only.
    """
    recent = items(c).where(clock.closed_days("putaway_date", days)).withColumn("date", F.to_date("putaway_date"))
    putaway = recent.groupBy("date").agg(F.count_distinct("item_id").alias("total_putaway"))
    per_sheet = (
        recent.select("date", "item_id", "status")
        .join(sheet_lines(c), "item_id")
        .join(sheets(c).select("sheet_id"), "sheet_id", "left_semi")
        .groupBy("date", "sheet_id")
        .agg(F.max(F.col("status") == "RTV").alias("completed"))
    )
    started = per_sheet.groupBy("date").agg(
        F.count("*").alias("total_rtv_initiated"), F.count_if("completed").alias("total_rtv_completed")
    )
    joined = side_by_side(putaway, started)
    return joined.withColumnRenamed("date", "putaway_date").withColumn(
        "pending", F.col("total_rtv_initiated") - F.col("total_rtv_completed")
    )
