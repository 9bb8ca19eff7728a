"""Domain tables derived from the star-schema test tables.

Every table is a projection (or one join) of the given Parquet files, so its
size grows with them and filters on dates and keys reach the scans. The column
mapping is listed in FIXTURES.md; the oracle repeats it in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retrolane.functions.labels import Sites
from retrolane.sources.catalog import Catalog

ITEM_ID = "(l_orderkey * 10 + l_linenumber) * 1000000 + (l_partkey * 31 + l_suppkey) % 1000000"
BARCODE = f"concat('CRI', {ITEM_ID})"

# Soft-data templates of the test couriers (fixed texts).
TEMPLATE_FIELDS = (
    "<Template>"
    "<Column><Title>S No</Title><Map>sno</Map></Column>"
    "<Column><Title>Barcode</Title><Map>inventory.barcode</Map></Column>"
    "<Column><Title>AWB</Title><Map>rtv_sheet_detail.awb_number</Map></Column>"
    "<Column><Title>Origin</Title><Map>warehouse.name</Map><Value>HUB</Value></Column>"
    "<Column><Title>Weight</Title><Map>inventory.weight</Map></Column>"
    "<Column><Title>Mode</Title><Map>inventory.shipping_mode</Map></Column>"
    "<Column><Title>Bag</Title><Map>rtv_sheet_detail.bag</Map></Column>"
    "<Column><Title>Address</Title><Map>receiver_detail.address_line1</Map></Column>"
    "<Column><Title>Floor</Title><Map>receiver_detail.address_line2</Map></Column>"
    "<Column><Title>City</Title><Map>receiver_detail.city</Map></Column>"
    "<Column><Title>State</Title><Map>receiver_detail.state</Map></Column>"
    "<Column><Title>Pin</Title><Map>receiver_detail.pincode</Map></Column>"
    "<Column><Title>Phone</Title><Map>receiver_detail.contact_number</Map></Column>"
    "</Template>"
)
TEMPLATE_SERVICE = (
    "<Template>"
    "<Column><Title>S No</Title><Map>sno</Map></Column>"
    "<Column><Title>Reference</Title><Map>rtvlNo</Map></Column>"
    "<Column><Title>Receiver</Title><Map>receiver_detail.name</Map></Column>"
    "<Column><Title>Price</Title><Map>inventory.price</Map></Column>"
    "<Column><Title>Service</Title><Map>manifest.courier_code</Map><Value>SURFACE</Value></Column>"
    "</Template>"
)

REPORT_NAMES = (
    "Email To Center", "Email To Seller", "Manifest Data", "QC TO RTS", "RPR To RTS", "RPI", "RTV Data",
    "Putaway and RTV", "Putaway Master", "Liquidation", "FC_VOI", "3PL Electronics", "Box Capacity",
    "Tracking Numbers Left", "Summary Reports", "Warehouse Wise Summary Reports",
)


def courier_code(key: str) -> str:
    names = "array('DTDC', 'jv', 'GATI', 'Delhivery', 'SAP', 'Delhidart', 'Ecom')"
    return f"concat(element_at({names}, cast({key} % 7 as int) + 1), ' ', {key})"


def back(column: str, days: str) -> str:
    return f"timestampadd(DAY, -cast({days} as int), {column})"


def ahead(column: str, days: str) -> str:
    return f"timestampadd(DAY, cast({days} as int), {column})"


# Columns used of the given star-schema files; declared so that reading starts no inference job.
STAR_SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING",
    "part": "p_partkey BIGINT, p_brand STRING, p_size INT",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING",
}


class _Star:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def ordered_items(self) -> DataFrame:
        """Line items with the date of their order."""
        return self.read("lineitem").join(
            self.read("orders"), F.col("l_orderkey") == F.col("o_orderkey")
        )

    def inventory(self) -> DataFrame:
        return self.read("lineitem").selectExpr(
            f"{ITEM_ID} AS id",
            f"{BARCODE} AS barcode",
            "concat('SUB', l_orderkey, '-', l_linenumber) AS suborder_code",
            "concat('ORD', l_orderkey) AS order_code",
            "concat('Z', l_orderkey) AS ticket_id",
            "CASE l_returnflag WHEN 'A' THEN 'Wrong item' WHEN 'N' THEN 'Damaged, leaking' "
            "ELSE 'Size change' END AS issue_category",
            "concat('Product ', l_partkey) AS product_name",
            "concat('RPU', l_orderkey) AS forward_awb_number",
            "concat(\"Seller's \", l_suppkey) AS seller_name",
            "concat('V', l_suppkey) AS vendor_code",
            "CASE WHEN l_tax > 0.065 THEN NULL ELSE concat('Customer of ', l_orderkey) END AS customer_name",
            "cast(l_partkey % 27 AS INT) AS rule_id",
            "CASE WHEN l_discount > 0.085 THEN NULL WHEN l_tax < 0.025 THEN 1 ELSE 0 END AS is_bulk_rule",
            "l_suppkey AS created_by_id",
            "l_suppkey % 12 AS warehouse_id",
            "CASE WHEN l_returnflag = 'R' THEN 'RTV' ELSE 'IN' END AS status",
            "l_extendedprice AS price",
            "cast(l_quantity AS DOUBLE) / 8 AS weight",
            "CASE WHEN l_linenumber % 2 = 0 THEN 'AIR' ELSE 'SURFACE' END AS shipping_mode",
            "l_shipdate AS manifest_date",
            "l_shipdate AS created",
        )

    def rtv_sheet_detail(self) -> DataFrame:
        return self.read("orders").selectExpr(
            "o_orderkey AS id",
            back("o_orderdate", "o_custkey % 4") + " AS created",
            "o_orderdate AS updated",
            "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL "
            f"ELSE {courier_code('(o_custkey % 25)')} END AS courier_code",
            "concat('AWB', o_orderkey) AS awb_number",
            "concat('BAG', o_orderkey % 97) AS bag",
            "CASE o_orderstatus WHEN 'P' THEN 'vendor' WHEN 'O' THEN '1' ELSE '2' END AS return_warehouse",
            "o_custkey AS receiver_id",
            "o_custkey % 27 AS warehouse_id",
            "o_custkey % 110 AS updated_by_id",
        )

    def rtv_sheet_detail_inventory(self) -> DataFrame:
        return (
            self.read("lineitem")
            .where("l_linestatus = 'F'")
            .selectExpr("l_orderkey AS rtv_sheet_detail_id", f"{ITEM_ID} AS product_details_id")
        )

    def rules(self) -> DataFrame:
        return self.read("nation").selectExpr(
            "n_nationkey AS id",
            "CASE n_nationkey WHEN 0 THEN 'Liquidate' WHEN 1 THEN 'SOI - non faulty' "
            "WHEN 2 THEN '3PL Electronics' WHEN 3 THEN 'liquidate - outlet' "
            "WHEN 4 THEN 'SOI - Non Faulty Premium' ELSE concat('Rule ', n_name) END AS rule_name",
        )

    def bulk_upload_rules(self) -> DataFrame:
        return self.read("nation").selectExpr(
            "n_nationkey AS id",
            "CASE n_regionkey WHEN 0 THEN 'Bulk Courier Debit' WHEN 1 THEN 'Return to Customer' "
            "WHEN 2 THEN 'courier debit - east' ELSE concat('Bulk ', n_name) END AS rule_name",
        )

    def users(self) -> DataFrame:
        return self.read("supplier").selectExpr("s_suppkey AS id", "s_name AS username")

    def warehouse(self) -> DataFrame:
        return self.read("nation").selectExpr(
            "cast(n_nationkey AS BIGINT) AS id",
            "CASE WHEN n_name = 'NATION_8' THEN NULL ELSE n_name END AS code",
            "concat(n_name, ' WH') AS name",
        )

    def address_details(self) -> DataFrame:
        return self.read("nation").selectExpr("cast(n_nationkey AS BIGINT) AS id")

    def gate_pass(self) -> DataFrame:
        return (
            self.read("lineitem")
            .where("l_returnflag = 'A'")
            .selectExpr(
                f"{BARCODE} AS barcode",
                f"explode(CASE WHEN l_quantity > 45 THEN array({ahead('l_shipdate', '2')}, "
                f"{ahead('l_shipdate', '3')}) ELSE array({ahead('l_shipdate', '2')}) END) AS created",
            )
        )

    def boxes(self) -> DataFrame:
        return self.read("part").selectExpr(
            "CASE WHEN p_size = 11 THEN concat('BOX', p_partkey) "
            "ELSE concat(replace(p_brand, '#', '-'), '-', p_partkey) END AS box_name",
            "p_size AS capacity",
            "cast(p_partkey % 50 AS INT) AS used",
            "p_partkey % 27 AS warehouse_id",
        )

    def couriers(self) -> DataFrame:
        return self.read("nation").selectExpr(
            courier_code("n_nationkey") + " AS code",
            "n_name AS name",
            "concat('ops', n_nationkey, '@courier.example') AS primary_email",
            "CASE WHEN n_nationkey % 2 = 0 THEN NULL "
            "ELSE concat('alt', n_nationkey, '@courier.example') END AS secondary_email",
            "CASE WHEN n_regionkey = 0 THEN NULL "
            "ELSE concat('Dear ', n_name, chr(10), 'Please find the manifest.') END AS soft_data_header",
            f"CASE WHEN n_regionkey = 1 THEN '' WHEN n_regionkey IN (0, 2) THEN '{TEMPLATE_FIELDS}' "
            f"ELSE '{TEMPLATE_SERVICE}' END AS soft_data_template",
            "CASE WHEN n_regionkey = 3 THEN NULL ELSE concat('Manifest for ', n_name) END AS soft_data_subject",
            "CASE WHEN n_regionkey = 4 THEN 0 ELSE 1 END AS enabled",
        )

    def tracking_numbers(self) -> DataFrame:
        return self.read("orders").selectExpr(
            courier_code("(o_custkey % 25)") + " AS courier_code",
            "concat('TN', o_orderkey) AS tracking_number",
            "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_used",
        )

    def manifest(self) -> DataFrame:
        return manifests(self.read("events"))

    def manifest_rtv_sheet_detail(self) -> DataFrame:
        return self.read("events").selectExpr("event_id AS manifest_id", "event_id AS rtv_sheet_id")

    def receiver_detail(self) -> DataFrame:
        return self.read("customer").selectExpr(
            "c_custkey AS id",
            "c_name AS name",
            "CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE concat(c_name, '@x.example') END AS email",
            "concat(c_custkey, ' High Street') AS address_line1",
            "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE concat('Floor ', c_custkey % 9) END AS address_line2",
            "concat('City ', c_nationkey) AS city",
            "concat('State ', c_nationkey % 5) AS state",
            "cast(100000 + c_custkey % 1000 AS BIGINT) AS pincode",
            "concat('+91', 9000000000 + c_custkey) AS contact_number",
        )

    def receiver_email(self) -> DataFrame:
        return (
            self.read("customer")
            .where("c_mktsegment IN ('BUILDING', 'MACHINERY')")
            .selectExpr("c_name AS code", "concat(c_name, '@alt.example') AS email")
        )

    def reports(self) -> DataFrame:
        names = ", ".join(f"'{name}'" for name in REPORT_NAMES)
        return self.read("nation").selectExpr(
            f"try_element_at(array({names}), n_nationkey + 1) AS name",
            "concat('report', n_nationkey, '@ops.example') AS to_email",
        )

    def report_sites(self) -> DataFrame:
        return self.read("nation").selectExpr(
            "'Warehouse Wise Summary Reports' AS name",
            "try_element_at(array('Delhi Nuvo WH', 'Bang WH', 'Mum WH'), n_nationkey + 1) AS site",
            "concat('site', n_nationkey, '@ops.example') AS to_email",
        ).where("site IS NOT NULL")

    def qc(self) -> DataFrame:
        one, two = back("o_orderdate", "l_linenumber"), back("o_orderdate", "l_linenumber + 1")
        return (
            self.ordered_items()
            .where("l_tax < 0.055")
            .selectExpr(
                f"{BARCODE} AS barcode",
                f"explode(CASE WHEN l_tax < 0.005 THEN array({one}, {two}) ELSE array({one}) END) AS qc_date_time",
            )
        )

    def rpr(self) -> DataFrame:
        return (
            self.ordered_items()
            .where("l_tax > 0.015")
            .selectExpr(f"{BARCODE} AS barcode", back("o_orderdate", "l_linenumber + 1") + " AS rpr_date_time")
        )

    def crp(self) -> DataFrame:
        return self.read("orders").selectExpr(
            "o_orderkey AS id",
            "o_orderdate AS created",
            "o_custkey AS pickup_detail_id",
            "concat('agent', o_custkey % 13) AS updated_by",
            "CASE o_orderstatus WHEN 'F' THEN 'RMS-NUVO-BANG' WHEN 'O' THEN 'RMS-DEL' "
            "ELSE 'RMS-NUVO-DEL' END AS returns_center_code",
        )

    def cri(self) -> DataFrame:
        return (
            self.read("lineitem")
            .where("l_discount < 0.095")
            .selectExpr(
                f"{BARCODE} AS code",
                "l_orderkey AS crp_id",
                "l_partkey AS cc_id",
                "l_quantity AS weight",
                f"inline(CASE WHEN l_quantity > 49 THEN array(struct({ITEM_ID} AS id, l_extendedprice AS item_price), "
                f"struct(-({ITEM_ID}) AS id, l_extendedprice + 1 AS item_price)) "
                f"ELSE array(struct({ITEM_ID} AS id, l_extendedprice AS item_price)) END)",
            )
            .select("id", "code", "crp_id", "cc_id", "item_price", "weight")
        )

    def cc(self) -> DataFrame:
        return self.read("customer").selectExpr("c_custkey AS id", "concat('Z', c_custkey) AS ticket_code")

    def pickup_detail(self) -> DataFrame:
        return self.read("customer").selectExpr(
            "c_custkey AS id",
            "c_name AS name",
            "concat('City ', c_nationkey) AS city",
            "concat('S', c_nationkey % 5) AS state_code",
            "concat('90000', c_custkey) AS mobile",
            "concat(c_name, '@mail.example') AS email",
            "100000 + c_custkey AS pincode",
        )

    def crp_history(self) -> DataFrame:
        orders = self.read("orders")
        received = orders.where("o_orderstatus <> 'O'").selectExpr(
            "o_orderkey AS crp_id", "o_orderdate AS created", "'NEW' AS previous_status_code"
        )
        touched = orders.where("o_orderstatus = 'F'").selectExpr(
            "o_orderkey AS crp_id",
            "o_orderdate AS created",
            "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE 'RPR' END AS previous_status_code",
        )
        return received.unionByName(touched).withColumn("next_status_code", F.lit("RPR"))

    def cri_history(self) -> DataFrame:
        day, later = ahead("o_orderdate", "l_linenumber - 1"), ahead("o_orderdate", "l_linenumber + 1")
        first = (
            f"struct({day} AS created, CASE WHEN l_quantity = 1 THEN NULL ELSE 'RPR' END AS previous_status_code, "
            "CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'REJ' ELSE 'PDC' END AS next_status_code)"
        )
        again = f"struct({later} AS created, 'REJ' AS previous_status_code, 'PDC' AS next_status_code)"
        return (
            self.ordered_items()
            .selectExpr(
                f"{ITEM_ID} AS cri_id",
                f"inline(CASE WHEN l_quantity > 47 THEN array({first}, {again}) ELSE array({first}) END)",
            )
            .select(
                "cri_id", "created", F.col("created").alias("status_date"), "previous_status_code", "next_status_code"
            )
        )


def manifests(events: DataFrame) -> DataFrame:
    """Events as printed manifests."""
    return events.selectExpr(
        "event_id AS id",
        "ts AS created",
        "ts AS updated",
        courier_code("(user_id % 25)") + " AS courier_code",
        "CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS is_email_sent",
    )


def from_star(spark: SparkSession, folder: str) -> Catalog:
    star = _Star(spark, folder)
    return Catalog(spark, lambda name: getattr(star, name)())


# Made-up user names behind each site, for the test tables.
TEST_SITES = Sites(
    main_at_two=("Supplier#000000002", "supplier#000000014"),
    main_at_seven=("Supplier#000000007",),
    delhi_detail=("Supplier#000000002",),
    qc_second=("agent0", "customer"),
    qc_bang=("agent1",),
    qc_bang_by_center=("agent2", "agent3"),
    qc_main=("agent4",),
    qc_main_by_center=("agent2",),
    qc_hyd=("agent5", "agent6"),
    qc_mum=("agent7",),
    qc_chn=("agent8",),
)


def manifest_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """The event table read as a stream of printed manifests, a bounded number of files at a time."""
    reader = spark.readStream.schema(STAR_SCHEMAS["events"]).option("maxFilesPerTrigger", files_per_batch)
    return manifests(reader.option("pathGlobFilter", "events.parquet").parquet(folder))
