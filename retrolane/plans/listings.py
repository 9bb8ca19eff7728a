"""Item listings enriched with the customer's details from the returns database."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retrolane.clock import Clock, moment
from retrolane.functions.text import same_text, text_or_empty, yes_no
from retrolane.operators.hotkeys import asked_keys, fanout_left_join, shared, splittable_join
from retrolane.operators.lookup import with_customer
from retrolane.plans.parts import (
    dispatched,
    items,
    sheet_lines,
    sheets,
    with_gate_pass,
    with_rules,
    with_user,
    with_warehouse,
)
from retrolane.sources.catalog import Catalog

# Rule names the reports look for.
ELECTRONICS_RULE = "3PL Electronics"
NON_FAULTY_RULE = "SOI - non faulty"
LIQUIDATION_BULK_RULES = ("Bulk Courier Debit", "Return to Customer")
LIQUIDATION_RULES = ("Liquidate",)

CUSTOMER_TAIL = ("customer_name", "city", "state", "mobile", "email", "pincode")


def gate_pass_columns() -> list[Column]:
    return [yes_no("gate_pass_date").alias("gatepass"), text_or_empty("gate_pass_date").alias("gatepass_date")]


def rule_listing(c: Catalog, rule_name: str, since: datetime) -> DataFrame:
    """Dispatched items put away under one rule, with gate-pass flag and customer."""
    rule = c.rules.where(same_text(F.col("rule_name"), rule_name)).select(F.col("id").alias("rule_id"))
    recent = sheets(c).where(F.col("sheet_created") > moment(since)).select("sheet_id")
    ruled = items(c).join(rule, "rule_id").withColumnRenamed("created_by_id", "user_id")
    rows = with_user(c, dispatched(c, recent, ruled), "user_id")
    rows = shared(
        rows.select(
            "putaway_date", "suborder_code", "sheet_id", "barcode", "issue_category", "product_name",
            "forward_awb_number", "seller_name", "vendor_code", "username",
        )
    )
    full = with_customer(c, with_gate_pass(c, rows, asked=rows), asked=rows)
    return full.select(
        "putaway_date", "ticket_id", "suborder_code", F.col("sheet_id").alias("rtv_sheet_detail_id"), "barcode",
        "issue_category", "product_name", F.col("forward_awb_number").alias("rpu_waybill_no"), "seller_name",
        "vendor_code", *gate_pass_columns(), "username", *CUSTOMER_TAIL, F.col("item_price").alias("price"), "weight",
    )


def liquidation_listing(c: Catalog, since: datetime) -> DataFrame:
    """Items under a courier-debit, return-to-customer or liquidation rule.

    Rules are matched by number in both rule tables, whatever the bulk flag says.
    """
    normal = c.rules.select(F.col("id").alias("rule_id"), F.col("rule_name").alias("normal_rule"))
    bulk = c.bulk_upload_rules.select(
        F.col("id").alias("rule_id"), F.col("rule_name").alias("bulk_rule"), F.lit(True).alias("has_bulk")
    )
    ruled = (
        items(c)
        .where(F.col("putaway_date") > moment(since))
        .join(normal, "rule_id", "left")
    )
    ruled = (
        splittable_join(ruled, bulk, "rule_id", "left")
        .where(
            same_text(F.col("bulk_rule"), *LIQUIDATION_BULK_RULES) | same_text(F.col("normal_rule"), *LIQUIDATION_RULES)
        )
        .withColumn("rule_name", F.when(F.col("has_bulk"), F.col("bulk_rule")).otherwise(F.col("normal_rule")))
    )
    ruled = with_user(c, ruled.withColumnRenamed("created_by_id", "user_id"), "user_id")
    ruled = shared(
        ruled.select(
            "item_id", "putaway_date", "rule_name", "suborder_code", "barcode", "issue_category", "product_name",
            "forward_awb_number", "seller_name", "vendor_code", "username",
        )
    )
    rows = fanout_left_join(ruled, sheet_lines(c), "item_id", wanted=asked_keys(ruled, "item_id"))
    full = with_customer(c, with_gate_pass(c, rows, asked=ruled), asked=ruled)
    return full.select(
        "putaway_date", "rule_name", "ticket_id", "suborder_code", F.col("sheet_id").alias("rtv_sheet_detail_id"),
        "barcode", "issue_category", "product_name", F.col("forward_awb_number").alias("rpu_waybill_no"),
        "seller_name", "vendor_code", *gate_pass_columns(), "username", *CUSTOMER_TAIL,
        F.col("item_price").alias("price"), "weight",
    )


def latest_dispatch(c: Catalog, wanted: DataFrame) -> DataFrame:
    """Per wanted item the sheet dispatched last, so that many dispatches of one item stay one row."""
    lines = splittable_join(sheet_lines(c), asked_keys(wanted, "item_id"), "item_id", "left_semi")
    sent = lines.join(sheets(c).select("sheet_id", "dispatch_date", "sheet_courier"), "sheet_id")
    latest = F.max(F.struct(F.col("dispatch_date").alias("rtv_date"), "sheet_id", "sheet_courier")).alias("latest")
    return sent.groupBy("item_id").agg(latest).select("item_id", "latest.*")


def putaway_master(c: Catalog, clock: Clock, days: int = 1) -> DataFrame:
    """One row per barcode put away in the window, showing its latest dispatch.

    The row kept per barcode is the one dispatched last; ties fall to the higher
    sheet number and then to the lower item number.
    """
    recent = items(c).where(clock.closed_days("putaway_date", days)).withColumnRenamed("created_by_id", "user_id")
    recent = shared(
        recent.select(
            "item_id", "barcode", "putaway_date", "forward_awb_number", "suborder_code", "issue_category", "rule_id",
            "is_bulk_rule", "status", "product_name", "price", "user_id", "item_warehouse_id",
        )
    )
    rows = with_user(c, with_rules(c, recent), "user_id")
    rows = with_warehouse(c, rows, "item_warehouse_id")
    rows = splittable_join(rows, latest_dispatch(c, recent), "item_id", "left")
    shown = (
        "putaway_date", "forward_awb_number", "suborder_code", "issue_category", "rule_name", "status",
        "product_name", "price", "sheet_courier", "username", "warehouse_code",
    )
    latest = F.max(F.struct("rtv_date", "sheet_id", (-F.col("item_id")).alias("reversed_item_id"), *shown))
    one = rows.groupBy("barcode").agg(latest.alias("latest")).select("barcode", "latest.*")
    full = with_customer(c, one, asked=recent)
    return full.select(
        "putaway_date", "ticket_id", F.col("forward_awb_number").alias("rpu_waybill_no"), "barcode", "suborder_code",
        "issue_category", "rule_name", "status", "product_name", "price", "rtv_date",
        F.col("sheet_courier").alias("courier_code"), "username", "warehouse_code", *CUSTOMER_TAIL, "item_price",
        "weight",
    ).orderBy(F.desc_nulls_last("rtv_date"), "barcode")


def rtv_data(c: Catalog, clock: Clock, days: int = 7) -> DataFrame:
    """Dispatches of the last days, newest first, with the customer."""
    recent = sheets(c).where(clock.last("dispatch_date", days=days) & F.col("sheet_courier").isNotNull())
    recent = with_warehouse(c, recent, "sheet_warehouse_id")
    recent = with_user(c, recent.withColumnRenamed("updated_by_id", "user_id"), "user_id", "left")
    rows = shared(
        dispatched(c, recent, items(c)).select(
            "sheet_created", "dispatch_date", "sheet_id", "item_id", "suborder_code", "barcode", "product_name",
            "issue_category", "seller_name", "vendor_code", "price", "putaway_date", "forward_awb_number",
            "manifest_date", "sheet_courier", "awb_number", "username", "warehouse_code",
        )
    )
    full = with_customer(c, rows, asked=rows)
    return full.orderBy(F.desc("dispatch_date"), "sheet_id", "item_id").select(
        F.col("sheet_created").alias("rtv_date"), F.col("sheet_id").alias("rtv_sheet_detail_id"), "ticket_id",
        "suborder_code", "customer_name", "barcode", "product_name", "issue_category", "seller_name", "vendor_code",
        "price", "putaway_date", F.col("forward_awb_number").alias("rpu_waybill_no"), "manifest_date",
        F.col("sheet_courier").alias("rtv_courier"), F.col("awb_number").alias("rtv_waybill_no"), "username",
        "warehouse_code", "city", "state", "mobile", "email", "pincode", "item_price", "weight",
    )
