"""Mails to sellers and receiving centres: who gets which items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retrolane.clock import Clock
from retrolane.functions.text import recipients
from retrolane.operators.hotkeys import splittable_join
from retrolane.operators.digest import ROWS_PER_PART, html_parts
from retrolane.plans.operations import report_address
from retrolane.plans.parts import dispatched, items, sheet_lines, sheets
from retrolane.sources.catalog import Catalog

# Report names under which the constant addresses are kept.
CENTER_REPORT = "Email To Center"
SELLER_REPORT = "Email To Seller"

CENTER_COLUMNS = (
    "barcode", "ticket_id", "suborder_code", "order_code", "forward_awb_number", "product_name", "issue_category",
    "seller_name", "soi_center_name", "dispatch_courier", "dispatch_waybill_no", "dispatch_date",
)
SELLER_COLUMNS = ("suborder", "vendor_name", "product_name", "issue_category", "sent_on", "awb_no")
ROW_KEY = ("item_id", "sheet_id", "manifest_id")


def _manifested(c: Catalog, clock: Clock, days: int, destination: Column) -> DataFrame:
    """Items on sheets with the wanted destination that were manifested since midnight ``days`` ago."""
    recent = c.manifest.where(clock.days_to_now("created", days)).select(F.col("id").alias("manifest_id"))
    sheet_of = c.manifest_rtv_sheet_detail.withColumnRenamed("rtv_sheet_id", "sheet_id")
    packed = recent.join(sheet_of, "manifest_id").join(sheets(c).where(destination), "sheet_id")
    return dispatched(c, packed, items(c))


def center_items(c: Catalog, clock: Clock, days: int = 1) -> DataFrame:
    """Items sent to receiving centres, one row each, keyed by the centre's name."""
    centers = c.receiver_detail.where(F.col("name").isNotNull()).select(
        F.col("id").alias("receiver_id"), F.col("name").alias("soi_center_name")
    )
    rows = _manifested(c, clock, days, F.col("return_warehouse") == "1").join(centers, "receiver_id")
    return rows.select(
        *ROW_KEY, "barcode", "ticket_id", "suborder_code", "order_code", "forward_awb_number", "product_name",
        "issue_category", "seller_name", "soi_center_name", F.col("sheet_courier").alias("dispatch_courier"),
        F.col("awb_number").alias("dispatch_waybill_no"),
        F.date_format("sheet_created", "dd-MMM-yy").alias("dispatch_date"),
    )


def seller_items(c: Catalog, clock: Clock, days: int = 150) -> DataFrame:
    """Items sent back to vendors, one row each, keyed by vendor code."""
    rows = _manifested(c, clock, days, F.col("return_warehouse") == "vendor").where(F.col("vendor_code").isNotNull())
    return rows.select(
        *ROW_KEY, "vendor_code", F.col("suborder_code").alias("suborder"), F.col("seller_name").alias("vendor_name"),
        "product_name", "issue_category", F.col("sheet_created").alias("sent_on"),
        F.concat("awb_number", F.lit("("), "sheet_courier", F.lit(")")).alias("awb_no"),
    )


def receiver_addresses(c: Catalog, wanted: DataFrame, inventory_key: str) -> DataFrame:
    """Per wanted ticket or suborder, the addresses of the highest-numbered receiver it was sent to."""
    alternates = c.receiver_email.groupBy(F.col("code").alias("receiver_name")).agg(
        F.min("email").alias("alternate_email")
    )
    receivers = c.receiver_detail.select(
        F.col("id").alias("receiver_id"), F.col("name").alias("receiver_name"), F.col("email").alias("primary_email")
    )
    reached = (
        items(c)
        .select("item_id", F.col(inventory_key).alias("sought"))
        .join(wanted, "sought", "left_semi")
        .join(sheet_lines(c), "item_id")
        .join(sheets(c).select("sheet_id", "receiver_id"), "sheet_id")
        .groupBy("sought", "receiver_id")
        .agg(F.count("*").alias("rows"))
    )
    known = splittable_join(reached.join(receivers, "receiver_id"), alternates, "receiver_name", "left")
    best = F.max_by(F.struct("primary_email", "alternate_email"), "receiver_id").alias("best")
    return known.groupBy("sought").agg(best).select("sought", "best.*")


def _digest(
    c: Catalog, rows: DataFrame, key: str, sought: str, inventory_key: str, report: str
) -> DataFrame:
    """One row per mail: its key, item count and address list.

    The items themselves stay in the item listing and in the HTML parts, so no
    mail's contents are ever gathered into one row.
    """
    first = F.min_by(F.col(sought), F.struct(*ROW_KEY)).alias("sought")
    heads = rows.groupBy(key).agg(F.count("*").alias("n_items"), first)
    addresses = receiver_addresses(c, heads.select("sought"), inventory_key)
    to_email = recipients(F.col("primary_email"), F.col("alternate_email"), report_address(c, report))
    found = heads.join(addresses.withColumn("found", F.lit(True)), "sought", "left")
    # without a receiver nothing is mailed, not even to the report's own address
    return found.select(key, "n_items", F.when(F.col("found"), to_email).alias("to_email"))


def center_digest(c: Catalog, clock: Clock, days: int = 1) -> DataFrame:
    rows = center_items(c, clock, days)
    return _digest(c, rows, "soi_center_name", "ticket_id", "ticket_id", CENTER_REPORT)


def seller_digest(c: Catalog, clock: Clock, days: int = 150) -> DataFrame:
    rows = seller_items(c, clock, days)
    return _digest(c, rows, "vendor_code", "suborder", "suborder_code", SELLER_REPORT)


def center_digest_body(
    c: Catalog, clock: Clock, days: int = 1, rows_per_part: int = ROWS_PER_PART
) -> DataFrame:
    rows = center_items(c, clock, days)
    return html_parts(rows, "soi_center_name", CENTER_COLUMNS, ROW_KEY, rows_per_part=rows_per_part)


def seller_digest_body(
    c: Catalog, clock: Clock, days: int = 150, rows_per_part: int = ROWS_PER_PART
) -> DataFrame:
    rows = seller_items(c, clock, days)
    return html_parts(rows, "vendor_code", SELLER_COLUMNS, ROW_KEY, rows_per_part=rows_per_part)
