"""Stock-keeping checks: full boxes, courier numbers left, recipients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retrolane.functions.text import before_dash, same_text
from retrolane.sources.catalog import Catalog


def full_boxes(c: Catalog) -> DataFrame:
    """Boxes filled to capacity, with the group their name starts with."""
    names = c.warehouse.select(F.col("id").alias("warehouse_id"), F.col("name").alias("warehouse_name"))
    full = c.boxes.where(F.col("used") == F.col("capacity"))
    return full.join(names, "warehouse_id").select(
        before_dash("box_name").alias("group_name"), "box_name", "capacity", "used", "warehouse_name"
    )


def tracking_numbers_left(c: Catalog) -> DataFrame:
    """Unused way-bill numbers per enabled courier.

    Numbers are counted per code first, so the join to couriers sees one row per code.
    """
    left = (
        c.tracking_numbers.where(F.col("is_used") == 0)
        .groupBy("courier_code")
        .agg(F.count("tracking_number").alias("numbers"))
    )
    enabled = c.couriers.where(F.col("enabled") == 1).select(F.col("code").alias("courier_code"))
    return left.join(enabled, "courier_code").groupBy("courier_code").agg(F.sum("numbers").alias("total_left"))


def report_recipients(c: Catalog, report: str) -> DataFrame:
    """The configured address list of a report."""
    return c.reports.where(same_text(F.col("name"), report)).select("to_email")


def report_address(c: Catalog, report: str) -> Column:
    """The same as a one-value subquery, for use inside another plan."""
    return report_recipients(c, report).agg(F.min("to_email")).scalar()
