"""Schemas of the two operational databases, as DDL strings."""

WAREHOUSE_DB = {
    "inventory": (
        "id BIGINT, barcode STRING, suborder_code STRING, order_code STRING, ticket_id STRING, "
        "issue_category STRING, product_name STRING, forward_awb_number STRING, seller_name STRING, "
        "vendor_code STRING, customer_name STRING, rule_id INT, is_bulk_rule INT, created_by_id BIGINT, "
        "warehouse_id BIGINT, status STRING, price DOUBLE, weight DOUBLE, shipping_mode STRING, "
        "manifest_date TIMESTAMP_NTZ, created TIMESTAMP_NTZ"
    ),
    "rtv_sheet_detail": (
        "id BIGINT, created TIMESTAMP_NTZ, updated TIMESTAMP_NTZ, courier_code STRING, awb_number STRING, "
        "bag STRING, return_warehouse STRING, receiver_id BIGINT, warehouse_id BIGINT, updated_by_id BIGINT"
    ),
    "rtv_sheet_detail_inventory": "rtv_sheet_detail_id BIGINT, product_details_id BIGINT",
    "rules": "id INT, rule_name STRING",
    "bulk_upload_rules": "id INT, rule_name STRING",
    "users": "id BIGINT, username STRING",
    "warehouse": "id BIGINT, code STRING, name STRING",
    "address_details": "id BIGINT",
    "gate_pass": "barcode STRING, created TIMESTAMP_NTZ",
    "boxes": "box_name STRING, capacity INT, used INT, warehouse_id BIGINT",
    "couriers": (
        "code STRING, name STRING, primary_email STRING, secondary_email STRING, soft_data_header STRING, "
        "soft_data_template STRING, soft_data_subject STRING, enabled INT"
    ),
    "tracking_numbers": "courier_code STRING, tracking_number STRING, is_used INT",
    "manifest": "id BIGINT, created TIMESTAMP_NTZ, updated TIMESTAMP_NTZ, courier_code STRING, is_email_sent INT",
    "manifest_rtv_sheet_detail": "manifest_id BIGINT, rtv_sheet_id BIGINT",
    "receiver_detail": (
        "id BIGINT, name STRING, email STRING, address_line1 STRING, address_line2 STRING, city STRING, "
        "state STRING, pincode BIGINT, contact_number STRING"
    ),
    "receiver_email": "code STRING, email STRING",
    "reports": "name STRING, to_email STRING",
    "report_sites": "name STRING, site STRING, to_email STRING",
    "qc": "barcode STRING, qc_date_time TIMESTAMP_NTZ",
    "rpr": "barcode STRING, rpr_date_time TIMESTAMP_NTZ",
}

RETURNS_DB = {
    "crp": (
        "id BIGINT, created TIMESTAMP_NTZ, pickup_detail_id BIGINT, updated_by STRING, returns_center_code STRING"
    ),
    "cri": "id BIGINT, code STRING, crp_id BIGINT, cc_id BIGINT, item_price DOUBLE, weight DOUBLE",
    "cc": "id BIGINT, ticket_code STRING",
    "pickup_detail": (
        "id BIGINT, name STRING, city STRING, state_code STRING, mobile STRING, email STRING, pincode BIGINT"
    ),
    "crp_history": (
        "crp_id BIGINT, created TIMESTAMP_NTZ, previous_status_code STRING, next_status_code STRING"
    ),
    "cri_history": (
        "cri_id BIGINT, created TIMESTAMP_NTZ, status_date TIMESTAMP_NTZ, previous_status_code STRING, "
        "next_status_code STRING"
    ),
}

TABLES = {**WAREHOUSE_DB, **RETURNS_DB}

# Columns every table carries for bookkeeping; exports leave them out.
AUDIT_COLUMNS = ("id", "created", "updated", "created_by_id", "updated_by_id")


def exportable_columns(columns: list[str]) -> list[str]:
    """Names a soft-data export may use: those not contained in an audit name."""
    return [name for name in columns if not any(name in audit for audit in AUDIT_COLUMNS)]
