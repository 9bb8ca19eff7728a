"""The domain tables as DuckDB common table expressions over the star-schema views.

Written independently of the Spark package; FIXTURES.md lists the mapping.
"""

from __future__ import annotations

import re

ITEM = "((l_orderkey * 10 + l_linenumber) * 1000000 + (l_partkey * 31 + l_suppkey) % 1000000)"
CODE = f"('CRI' || {ITEM})"


def courier(key: str) -> str:
    return f"(['DTDC', 'jv', 'GATI', 'Delhivery', 'SAP', 'Delhidart', 'Ecom'])[{key} % 7 + 1] || ' ' || {key}"


def days(text: str) -> str:
    return f"to_days(cast({text} AS INTEGER))"


TABLES = {
    "inventory": f"""
        SELECT {ITEM} AS id, {CODE} AS barcode, 'SUB' || l_orderkey || '-' || l_linenumber AS suborder_code,
               'ORD' || l_orderkey AS order_code, 'Z' || l_orderkey AS ticket_id,
               CASE l_returnflag WHEN 'A' THEN 'Wrong item' WHEN 'N' THEN 'Damaged, leaking'
                    ELSE 'Size change' END AS issue_category,
               'Product ' || l_partkey AS product_name, 'RPU' || l_orderkey AS forward_awb_number,
               'Seller''s ' || l_suppkey AS seller_name, 'V' || l_suppkey AS vendor_code,
               CASE WHEN l_tax <= 0.065 THEN 'Customer of ' || l_orderkey END AS customer_name,
               cast(l_partkey % 27 AS INTEGER) AS rule_id,
               CASE WHEN l_discount > 0.085 THEN NULL WHEN l_tax < 0.025 THEN 1 ELSE 0 END AS is_bulk_rule,
               l_suppkey AS created_by_id, l_suppkey % 12 AS warehouse_id,
               CASE WHEN l_returnflag = 'R' THEN 'RTV' ELSE 'IN' END AS status, l_extendedprice AS price,
               cast(l_quantity AS DOUBLE) / 8 AS weight,
               CASE WHEN l_linenumber IN (2, 4, 6) THEN 'AIR' ELSE 'SURFACE' END AS shipping_mode,
               l_shipdate AS manifest_date, l_shipdate AS created
        FROM lineitem""",
    "rtv_sheet_detail": f"""
        SELECT o_orderkey AS id, o_orderdate - {days('o_custkey % 4')} AS created, o_orderdate AS updated,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
                    ELSE {courier('(o_custkey % 25)')} END AS courier_code,
               'AWB' || o_orderkey AS awb_number, 'BAG' || (o_orderkey % 97) AS bag,
               CASE o_orderstatus WHEN 'P' THEN 'vendor' WHEN 'O' THEN '1' ELSE '2' END AS return_warehouse,
               o_custkey AS receiver_id, o_custkey % 27 AS warehouse_id, o_custkey % 110 AS updated_by_id
        FROM orders""",
    "rtv_sheet_detail_inventory": f"""
        SELECT l_orderkey AS rtv_sheet_detail_id, {ITEM} AS product_details_id FROM lineitem
        WHERE l_linestatus = 'F'""",
    "rules": """
        SELECT n_nationkey AS id,
               CASE n_nationkey WHEN 0 THEN 'Liquidate' WHEN 1 THEN 'SOI - non faulty' WHEN 2 THEN '3PL Electronics'
                    WHEN 3 THEN 'liquidate - outlet' WHEN 4 THEN 'SOI - Non Faulty Premium'
                    ELSE 'Rule ' || n_name END AS rule_name
        FROM nation""",
    "bulk_upload_rules": """
        SELECT n_nationkey AS id,
               CASE n_regionkey WHEN 0 THEN 'Bulk Courier Debit' WHEN 1 THEN 'Return to Customer'
                    WHEN 2 THEN 'courier debit - east' ELSE 'Bulk ' || n_name END AS rule_name
        FROM nation""",
    "users": "SELECT s_suppkey AS id, s_name AS username FROM supplier",
    "warehouse": """
        SELECT cast(n_nationkey AS BIGINT) AS id, CASE WHEN n_name <> 'NATION_8' THEN n_name END AS code,
               n_name || ' WH' AS name
        FROM nation""",
    "gate_pass": f"""
        SELECT {CODE} AS barcode, l_shipdate + INTERVAL 2 DAY AS created FROM lineitem WHERE l_returnflag = 'A'
        UNION ALL
        SELECT {CODE}, l_shipdate + INTERVAL 3 DAY FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 45""",
    "boxes": """
        SELECT CASE WHEN p_size = 11 THEN 'BOX' || p_partkey
                    ELSE replace(p_brand, '#', '-') || '-' || p_partkey END AS box_name,
               p_size AS capacity, cast(p_partkey % 50 AS INTEGER) AS used, p_partkey % 27 AS warehouse_id
        FROM part""",
    "couriers": f"""
        SELECT {courier('n_nationkey')} AS code, 'ops' || n_nationkey || '@courier.example' AS primary_email,
               CASE WHEN n_nationkey % 2 = 1 THEN 'alt' || n_nationkey || '@courier.example' END AS secondary_email,
               CASE WHEN n_regionkey <> 3 THEN 'Manifest for ' || n_name END AS soft_data_subject,
               CASE WHEN n_regionkey = 4 THEN 0 ELSE 1 END AS enabled,
               CASE WHEN n_regionkey = 1 THEN '' WHEN n_regionkey IN (0, 2) THEN 'fields' ELSE 'service' END AS layout
        FROM nation""",
    "tracking_numbers": f"""
        SELECT {courier('(o_custkey % 25)')} AS courier_code, 'TN' || o_orderkey AS tracking_number,
               CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_used
        FROM orders""",
    "manifest": f"""
        SELECT event_id AS id, ts AS created, ts AS updated, {courier('(user_id % 25)')} AS courier_code,
               CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS is_email_sent
        FROM events""",
    "manifest_rtv_sheet_detail": "SELECT event_id AS manifest_id, event_id AS rtv_sheet_id FROM events",
    "receiver_detail": """
        SELECT c_custkey AS id, c_name AS name,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name || '@x.example' END AS email,
               c_custkey || ' High Street' AS address_line1,
               CASE WHEN c_custkey % 3 > 0 THEN 'Floor ' || (c_custkey % 9) END AS address_line2,
               'City ' || c_nationkey AS city, 'State ' || (c_nationkey % 5) AS state,
               100000 + c_custkey % 1000 AS pincode, '+91' || (9000000000 + c_custkey) AS contact_number
        FROM customer""",
    "receiver_email": """
        SELECT c_name AS code, c_name || '@alt.example' AS email FROM customer
        WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "report_sites": """
        SELECT 'Warehouse Wise Summary Reports' AS name,
               CASE n_nationkey WHEN 0 THEN 'Delhi Nuvo WH' WHEN 1 THEN 'Bang WH' ELSE 'Mum WH' END AS site,
               'site' || n_nationkey || '@ops.example' AS to_email
        FROM nation WHERE n_nationkey < 3""",
    "qc": f"""
        SELECT {CODE} AS barcode, o_orderdate - {days('l_linenumber')} AS qc_date_time
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_tax < 0.055
        UNION ALL
        SELECT {CODE}, o_orderdate - {days('l_linenumber + 1')}
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_tax < 0.005""",
    "rpr": f"""
        SELECT {CODE} AS barcode, o_orderdate - {days('l_linenumber + 1')} AS rpr_date_time
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_tax > 0.015""",
    "crp": """
        SELECT o_orderkey AS id, o_orderdate AS created, o_custkey AS pickup_detail_id,
               'agent' || (o_custkey % 13) AS updated_by,
               CASE o_orderstatus WHEN 'F' THEN 'RMS-NUVO-BANG' WHEN 'O' THEN 'RMS-DEL'
                    ELSE 'RMS-NUVO-DEL' END AS returns_center_code
        FROM orders""",
    "cri": f"""
        SELECT {ITEM} AS id, {CODE} AS code, l_orderkey AS crp_id, l_partkey AS cc_id, l_extendedprice AS item_price,
               l_quantity AS weight
        FROM lineitem WHERE l_discount < 0.095
        UNION ALL
        SELECT -{ITEM}, {CODE}, l_orderkey, l_partkey, l_extendedprice + 1, l_quantity
        FROM lineitem WHERE l_discount < 0.095 AND l_quantity > 49""",
    "cc": "SELECT c_custkey AS id, 'Z' || c_custkey AS ticket_code FROM customer",
    "pickup_detail": """
        SELECT c_custkey AS id, c_name AS name, 'City ' || c_nationkey AS city,
               'S' || (c_nationkey % 5) AS state_code, '90000' || c_custkey AS mobile,
               c_name || '@mail.example' AS email, 100000 + c_custkey AS pincode
        FROM customer""",
    "crp_history": """
        SELECT o_orderkey AS crp_id, o_orderdate AS created, 'NEW' AS previous_status_code,
               'RPR' AS next_status_code
        FROM orders WHERE o_orderstatus <> 'O'
        UNION ALL
        SELECT o_orderkey, o_orderdate, CASE WHEN o_orderpriority <> '1-URGENT' THEN 'RPR' END, 'RPR'
        FROM orders WHERE o_orderstatus = 'F'""",
    "cri_history": f"""
        SELECT {ITEM} AS cri_id, o_orderdate + {days('l_linenumber - 1')} AS created,
               o_orderdate + {days('l_linenumber - 1')} AS status_date,
               CASE WHEN l_quantity <> 1 THEN 'RPR' END AS previous_status_code,
               CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'REJ' ELSE 'PDC' END AS next_status_code
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        UNION ALL
        SELECT {ITEM}, o_orderdate + {days('l_linenumber + 1')}, o_orderdate + {days('l_linenumber + 1')}, 'REJ', 'PDC'
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity > 47""",
}


def with_tables(body: str, steps: dict[str, str] | None = None) -> str:
    """``body`` preceded by the table and step definitions it mentions, directly or through steps."""
    steps = steps or {}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in [*TABLES, *steps]:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                if name in steps:
                    visit(steps[name])
                needed.append(name)

    visit(body)
    parts = [f"{name} AS ({(steps | TABLES)[name] if name not in steps else steps[name]})" for name in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + body
