"""Courier manifests: the items each courier receives, in the courier's own column layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retrolane.clock import Clock
from retrolane.operators.hotkeys import asked_keys, fanout_left_join, shared, splittable_join
from retrolane.operators.serial import numbered
from retrolane.operators.template import courier_templates, fill_template, mailed_couriers
from retrolane.plans.parts import items, sheet_lines, sheets
from retrolane.sources.catalog import Catalog


def manifest_lines(c: Catalog, manifests: DataFrame) -> DataFrame:
    """Keys of the manifests' lines: manifest, sheet, item, courier and warehouse.

    A manifest must reach a named warehouse to be exported, so the joins up to
    there are inner ones; a sheet without items keeps one line.
    """
    names = c.warehouse.where(F.col("name").isNotNull()).select(
        F.col("id").alias("sheet_warehouse_id"), F.col("name").alias("warehouse")
    )
    sheet_of = c.manifest_rtv_sheet_detail.withColumnRenamed("rtv_sheet_id", "sheet_id")
    chosen = manifests.select(
        F.col("id").alias("manifest_id"), F.col("created").alias("manifest_created"), "courier_code"
    )
    packed = chosen.join(sheet_of, "manifest_id").join(sheets(c).select("sheet_id", "sheet_warehouse_id"), "sheet_id")
    packed = shared(packed.join(names, "sheet_warehouse_id"))
    return fanout_left_join(packed, sheet_lines(c), "sheet_id", wanted=asked_keys(packed, "sheet_id"))


def with_line_details(c: Catalog, lines: DataFrame, asked: DataFrame) -> DataFrame:
    """Adds what a template may show of sheet, receiver, warehouse, address and item.

    ``asked`` is a shared frame that holds at least the lines' items: the stock is cut to them first.
    """
    receivers = c.receiver_detail.select(
        F.col("id").alias("receiver_id"), F.col("name").alias("receiver_name"), F.col("email").alias("receiver_email"),
        "address_line1", "address_line2", F.col("city").alias("receiver_city"), F.col("state").alias("receiver_state"),
        F.col("pincode").alias("receiver_pincode"), "contact_number",
    )
    codes = c.warehouse.select(F.col("id").alias("sheet_warehouse_id"), F.col("code").alias("warehouse_code"))
    addresses = c.address_details.select(F.col("id").alias("sheet_warehouse_id"), F.col("id").alias("address_id"))
    sheet_columns = sheets(c).select("sheet_id", "receiver_id", "awb_number", "bag", "sheet_created")
    return (
        lines.join(sheet_columns, "sheet_id", "left")
        .join(receivers, "receiver_id", "left")
        .join(codes, "sheet_warehouse_id", "left")
        .join(addresses, "sheet_warehouse_id", "left")
        .join(splittable_join(items(c), asked_keys(asked, "item_id"), "item_id", "left_semi"), "item_id", "left")
    )


def export_lines(c: Catalog, lines: DataFrame, constants: bool) -> DataFrame:
    """Filled templates of manifest lines whose couriers have one.

    Lines are numbered while they carry keys only; the wide columns join afterwards.
    Filling in constants needs no wide columns at all.
    """
    lines = shared(lines.withColumn("serial_key", F.coalesce("item_id", "sheet_id")))
    numbered_lines = numbered(lines, ["courier_code", "warehouse"], ["serial_key", "sheet_id", "manifest_id"])
    if not constants:
        numbered_lines = with_line_details(c, numbered_lines, lines)
    filled = fill_template(numbered_lines.join(courier_templates(c.couriers), "courier_code"), constants)
    subject = F.concat("mail_subject", F.lit(" : "), "warehouse")
    return filled.select("courier_code", "warehouse", "sno", "cells", "to_email", "mail_body", subject.alias("subject"))


def _export(c: Catalog, manifests: DataFrame, constants: bool) -> DataFrame:
    """Filled templates of the manifests' lines."""
    wanted = manifests.join(mailed_couriers(c.couriers), "courier_code", "left_semi")
    return export_lines(c, manifest_lines(c, wanted), constants)


def courier_manifest_export(c: Catalog, clock: Clock, days: int = 1) -> DataFrame:
    """Items manifested in the last days per courier and warehouse, one filled template per row."""
    return _export(c, c.manifest.where(clock.last("created", days=days)), constants=False)


def pending(clock: Clock, minutes: int) -> Column:
    """Manifests printed in the last minutes whose mail flag is still up."""
    return clock.last("created", minutes=minutes) & (F.col("is_email_sent") == 1)


def manifest_on_print(c: Catalog, clock: Clock, minutes: int = 10) -> DataFrame:
    """Newly printed manifests, filled with the template's constants."""
    return _export(c, c.manifest.where(pending(clock, minutes)), constants=True)


def manifest_flags_after(c: Catalog, clock: Clock, minutes: int | None = None) -> DataFrame:
    """The manifest table after the mails: flags of enabled couriers with a template taken down.

    All raised flags of such couriers go down, as the mail run resets a courier as a whole. With
    ``minutes`` only those of manifests printed within them do, so that older ones stay to be mailed.
    """
    sent = F.col("is_email_sent") == 1 if minutes is None else pending(clock, minutes)
    mailed = mailed_couriers(c.couriers).withColumn("mailed", F.lit(True))
    flag = F.when(sent & F.col("mailed"), F.lit(0)).otherwise(F.col("is_email_sent"))
    return c.manifest.join(mailed, "courier_code", "left").select(
        *[flag.alias(name) if name == "is_email_sent" else F.col(name) for name in c.manifest.columns]
    )


def manifest_flags_raised(c: Catalog) -> DataFrame:
    """The manifest table after the daily export: flags of enabled couriers with a template are up."""
    mailed = mailed_couriers(c.couriers).withColumn("mailed", F.lit(True))
    flag = F.when(F.col("mailed"), F.lit(1)).otherwise(F.col("is_email_sent"))
    return c.manifest.join(mailed, "courier_code", "left").select(
        *[flag.alias(name) if name == "is_email_sent" else F.col(name) for name in c.manifest.columns]
    )


def long_form(export: DataFrame) -> DataFrame:
    """One row per exported cell."""
    cells = export.select("courier_code", "warehouse", "sno", F.posexplode("cells").alias("pos", "cell"))
    return cells.select("courier_code", "warehouse", "sno", "pos", "cell.title", "cell.value")


def courier_table(export: DataFrame, courier: str, titles: list[str]) -> DataFrame:
    """One courier's export as ordinary columns, ready for a CSV sink."""
    own = export.where(F.col("courier_code") == courier)
    columns = [F.col("cells")[position]["value"].alias(title) for position, title in enumerate(titles)]
    return own.select("warehouse", "sno", *columns)
