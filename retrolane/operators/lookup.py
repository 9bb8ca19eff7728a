"""Enrichment of warehouse listings from the returns database."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retrolane.operators.hotkeys import asked_keys, splittable_join
from retrolane.sources.catalog import Catalog

CUSTOMER_COLUMNS = (
    "ticket_id", "customer_name", "city", "state", "mobile", "email", "pincode", "item_price", "weight",
)


def returned_items(c: Catalog, barcodes: DataFrame) -> DataFrame:
    """Returned items of the wanted (distinct) barcodes; cuts the returns side before any further join."""
    returned = c.cri.select(
        F.col("code").alias("barcode"), F.col("id").alias("cri_id"), "crp_id", "cc_id", "item_price", "weight"
    )
    return splittable_join(returned, barcodes, "barcode", "left_semi")


def customer_details(c: Catalog, barcodes: DataFrame) -> DataFrame:
    """One row per barcode: its first returned item that has package, complaint and pick-up."""
    packages = c.crp.select(F.col("id").alias("crp_id"), "pickup_detail_id")
    complaints = c.cc.select(F.col("id").alias("cc_id"), F.col("ticket_code").alias("ticket_id"))
    pickups = c.pickup_detail.select(
        F.col("id").alias("pickup_detail_id"), F.col("name").alias("customer_name"), "city",
        F.col("state_code").alias("state"), "mobile", "email", "pincode",
    )
    found = (
        returned_items(c, barcodes)
        .join(packages, "crp_id")
        .join(complaints, "cc_id")
        .join(pickups, "pickup_detail_id")
    )
    first = F.min_by(F.struct(*CUSTOMER_COLUMNS), "cri_id").alias("first")
    return found.groupBy("barcode").agg(first).select("barcode", "first.*")


def customer_names(c: Catalog, barcodes: DataFrame) -> DataFrame:
    """One row per barcode with the pick-up name of its first returned item."""
    packages = c.crp.select(F.col("id").alias("crp_id"), "pickup_detail_id")
    pickups = c.pickup_detail.select(F.col("id").alias("pickup_detail_id"), F.col("name").alias("found_name"))
    found = returned_items(c, barcodes).join(packages, "crp_id").join(pickups, "pickup_detail_id")
    return found.groupBy("barcode").agg(F.min_by("found_name", "cri_id").alias("found_name"))


def with_customer(c: Catalog, rows: DataFrame, asked: DataFrame) -> DataFrame:
    """Adds the customer columns to a listing keyed by ``barcode``; no match leaves NULLs.

    ``asked`` holds at least the listing's barcodes, best a shared frame that the listing
    was made from. It may yield more of them, since it only narrows what is looked up.
    """
    details = customer_details(c, asked_keys(asked, "barcode"))
    return splittable_join(rows, details, "barcode", "left")
