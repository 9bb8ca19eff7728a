"""Pieces that several reports share: renamed tables and the usual joins.

Joins carry no broadcast hints. Spark broadcasts a side when its measured size
is under the session's threshold and otherwise shuffles, splitting skewed
partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retrolane.operators.hotkeys import asked_keys, fanout_left_join, splittable_join
from retrolane.sources.catalog import Catalog


def items(c: Catalog) -> DataFrame:
    return c.inventory.withColumnsRenamed(
        {"id": "item_id", "created": "putaway_date", "warehouse_id": "item_warehouse_id"}
    )


def sheets(c: Catalog) -> DataFrame:
    return c.rtv_sheet_detail.withColumnsRenamed(
        {
            "id": "sheet_id",
            "created": "sheet_created",
            "updated": "dispatch_date",
            "courier_code": "sheet_courier",
            "warehouse_id": "sheet_warehouse_id",
        }
    )


def sheet_lines(c: Catalog) -> DataFrame:
    return c.rtv_sheet_detail_inventory.withColumnsRenamed(
        {"rtv_sheet_detail_id": "sheet_id", "product_details_id": "item_id"}
    )


def dispatched(c: Catalog, wanted_sheets: DataFrame, wanted_items: DataFrame) -> DataFrame:
    """Items on dispatch sheets; the (usually windowed) sheets come first so that they cut the lines early."""
    return splittable_join(sheet_lines(c), wanted_sheets, "sheet_id", "inner").join(wanted_items, "item_id")


def with_rules(c: Catalog, rows: DataFrame) -> DataFrame:
    """Adds ``rule_name`` and, split by kind, ``normal_rule`` and ``bulk_rule``.

    The bulk flag decides which rule table a number refers to, so both tables
    form one dimension keyed by number and kind. An item whose flag is unknown
    gets no rule.
    """
    normal = c.rules.select(F.col("id").alias("rule_id"), F.lit(0).alias("bulk"), "rule_name")
    bulk = c.bulk_upload_rules.select(F.col("id").alias("rule_id"), F.lit(1).alias("bulk"), "rule_name")
    kind = (F.col("is_bulk_rule") == 1).cast("int")
    named = rows.withColumn("bulk", kind).join(normal.unionByName(bulk), ["rule_id", "bulk"], "left")
    return named.withColumn("normal_rule", F.when(F.col("bulk") == 0, F.col("rule_name"))).withColumn(
        "bulk_rule", F.when(F.col("bulk") == 1, F.col("rule_name"))
    )


def with_user(c: Catalog, rows: DataFrame, key: str, how: str = "inner") -> DataFrame:
    return rows.join(c.users.select(F.col("id").alias(key), "username"), key, how)


def with_warehouse(c: Catalog, rows: DataFrame, key: str, how: str = "inner") -> DataFrame:
    known = c.warehouse.select(F.col("id").alias(key), F.col("code").alias("warehouse_code"))
    return rows.join(known, key, how)


def with_gate_pass(c: Catalog, rows: DataFrame, asked: DataFrame) -> DataFrame:
    """Adds gate-pass dates; an item with several passes appears once per pass.

    ``asked`` is a frame, best a shared one, that holds at least the rows' barcodes.
    """
    passes = c.gate_pass.where(F.col("barcode").isNotNull())
    passes = passes.select("barcode", F.col("created").alias("gate_pass_date"))
    return fanout_left_join(rows, passes, "barcode", wanted=asked_keys(asked, "barcode"))


def real_change(history: DataFrame, status: str) -> DataFrame:
    """Moves into ``status`` from another, known status."""
    return history.where((F.col("next_status_code") == status) & (F.col("previous_status_code") != status))
