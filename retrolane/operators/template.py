"""Courier soft-data templates: which columns each courier wants in its export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retrolane.functions.text import line_breaks, recipients

TEMPLATE_SCHEMA = "Column ARRAY<STRUCT<Title: STRING, Map: STRING, Value: STRING>>"

# What a template's Map may name. Anything else is an error; text is never run as SQL.
EXPORT_FIELDS: dict[str, str] = {
    "rtvlNo": "concat('RTVL', sheet_id)",
    "inventory.barcode": "barcode",
    "inventory.suborder_code": "suborder_code",
    "inventory.order_code": "order_code",
    "inventory.product_name": "product_name",
    "inventory.issue_category": "issue_category",
    "inventory.seller_name": "seller_name",
    "inventory.vendor_code": "vendor_code",
    "inventory.forward_awb_number": "forward_awb_number",
    "inventory.price": "price",
    "inventory.weight": "weight",
    "inventory.shipping_mode": "shipping_mode",
    "rtv_sheet_detail.awb_number": "awb_number",
    "rtv_sheet_detail.created": "sheet_created",
    "rtv_sheet_detail.bag": "bag",
    "receiver_detail.name": "receiver_name",
    "receiver_detail.email": "receiver_email",
    "receiver_detail.address_line1": "address_line1",
    "receiver_detail.address_line2": "address_line2",
    "receiver_detail.city": "receiver_city",
    "receiver_detail.state": "receiver_state",
    "receiver_detail.pincode": "receiver_pincode",
    "receiver_detail.contact_number": "contact_number",
    "warehouse.code": "warehouse_code",
    "warehouse.name": "warehouse",
    "address_details.id": "address_id",
    "manifest.created": "manifest_created",
    "manifest.courier_code": "courier_code",
}


def mailing(couriers: DataFrame) -> DataFrame:
    """Couriers that are mailed: enabled and with a template."""
    return couriers.where((F.col("enabled") == 1) & (F.col("soft_data_template") != ""))


def mailed_couriers(couriers: DataFrame) -> DataFrame:
    """Each code of a courier that is mailed, once; templates are not parsed for it."""
    return mailing(couriers).where("code IS NOT NULL").select(F.col("code").alias("courier_code")).distinct()


def courier_templates(couriers: DataFrame) -> DataFrame:
    """Enabled couriers that have a template, with the mail texts and the parsed column list."""
    wanted = mailing(couriers)
    greeting = F.lit("Hi<br><br>Please find attached Manifest File.")
    return wanted.select(
        F.col("code").alias("courier_code"),
        recipients(F.col("primary_email"), F.col("secondary_email")).alias("to_email"),
        F.coalesce(line_breaks(F.col("soft_data_header")), greeting).alias("mail_body"),
        F.coalesce("soft_data_subject", F.lit("Returns Support")).alias("mail_subject"),
        F.from_xml("soft_data_template", TEMPLATE_SCHEMA)["Column"].alias("columns"),
    )


def field_map(fields: dict[str, str] = EXPORT_FIELDS) -> Column:
    """The exportable values of a row, as text by field name."""
    pairs = [part for name, text in fields.items() for part in (F.lit(name), F.expr(f"cast({text} AS STRING)"))]
    return F.create_map(*pairs)


def unknown_fields(couriers: DataFrame) -> DataFrame:
    """(courier_code, title, field) of template columns that name no known field, to be mended before an export."""
    columns = courier_templates(couriers).select("courier_code", F.explode("columns").alias("column"))
    known = F.col("column.Map").isin("sno", *EXPORT_FIELDS)
    return columns.where(~F.coalesce(known, F.lit(False))).select(
        "courier_code", F.col("column.Title").alias("title"), F.col("column.Map").alias("field")
    )


def mapped_value(column: Column) -> Column:
    """Template value taken from the row's field. A name that is none of the fields stops the export."""
    known = F.map_contains_key("fields", F.coalesce(column["Map"], F.lit("")))
    error = F.raise_error(F.concat(F.lit("template names an unknown field: "), F.coalesce(column["Map"], F.lit("none"))))
    return F.when(known, F.try_element_at(F.col("fields"), column["Map"])).otherwise(error)


def constant_value(column: Column) -> Column:
    """Template value taken from the template's own constant; missing means empty."""
    return F.coalesce(column["Value"], F.lit(""))


def fill_template(rows: DataFrame, constants: bool) -> DataFrame:
    """One (title, value) pair per template column, as an array on each row.

    ``rows`` carry ``columns``, ``sno`` and, unless constants are asked for, the
    fields named in :data:`EXPORT_FIELDS`.
    """
    if not constants:
        rows = rows.withColumn("fields", field_map())
    value = constant_value if constants else mapped_value

    def cell(column: Column) -> Column:
        text = F.when(column["Map"] == "sno", F.col("sno").cast("string")).otherwise(value(column))
        return F.struct(column["Title"].alias("title"), text.alias("value"))

    return rows.withColumn("cells", F.transform("columns", cell)).drop("fields", "columns")
