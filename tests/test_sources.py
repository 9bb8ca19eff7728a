from datetime import datetime, timedelta

import pytest

from __spark_entry__ import PLANS
from retrolane.sources.catalog import bounds_query, from_parquet, jdbc_options, source_query, typed, window_predicates
from retrolane.sources.schemas import RETURNS_DB, TABLES, WAREHOUSE_DB, exportable_columns
from retrolane.sources.star import from_star

FOLDER = "/root/testdata/sf0.001"


def test_star_tables_have_the_declared_schema(spark):
    c = from_star(spark, FOLDER)
    for name, schema in TABLES.items():
        declared = spark.createDataFrame([], schema).dtypes
        assert sorted(getattr(c, name).dtypes) == sorted(declared), name


def test_databases_share_no_table():
    assert not set(WAREHOUSE_DB) & set(RETURNS_DB)


def test_parquet_catalog_reads_by_name(spark, tmp_path):
    spark.createDataFrame([(1, "x")], TABLES["rules"]).write.parquet(f"{tmp_path}/rules")
    assert [tuple(row) for row in from_parquet(spark, str(tmp_path)).rules.collect()] == [(1, "x")]
    with pytest.raises(AttributeError):
        from_parquet(spark, str(tmp_path)).no_such_table  # noqa: B018


def test_jdbc_scan_is_split_by_key_only_when_asked():
    whole = jdbc_options("jdbc:x", "rules")
    assert "partitionColumn" not in whole
    split = jdbc_options("jdbc:x", "inventory", "id", (0, 1000), 8)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "id", "0", "1000", "8",
    )


def test_audit_columns_and_their_parts_are_not_exported():
    columns = ["id", "created", "updated_by", "by_id", "barcode", "date"]
    assert exportable_columns(columns) == ["barcode"]


@pytest.mark.parametrize("name", ["rtv_data", "qc_to_rts_summary", "courier_wise_rtv", "seller_digest", "putaway_master"])
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    df = PLANS[name](from_star(spark, FOLDER))
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("Cartesian", "BroadcastNestedLoop", "Python", "ArrowEval"):
        assert word not in plan


def test_date_filter_and_column_pruning_reach_the_scan(spark):
    plan = PLANS["rms_daily_funnel_7d"](from_star(spark, FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1998-08-25T00:00)" in plan
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan


def test_live_tables_are_read_under_the_catalogs_names(spark):
    query = source_query("inventory")
    assert query.startswith("(SELECT id, barcode, suborderCode AS suborder_code, order_code, ticket_id, issueCategory AS")
    assert query.endswith("manifestDate AS manifest_date, created FROM inventory) AS inventory_rows")
    assert source_query("cc") == "(SELECT id, zendesk_ticket_code AS ticket_code FROM customer_complaint) AS cc_rows"
    assert not set(WAREHOUSE_DB) & set(RETURNS_DB)
    for name in TABLES:
        assert source_query(name).count("SELECT") == 1
    live = spark.createDataFrame([("7", "t", 1)], "id STRING, ticket_code STRING, extra INT")
    assert typed(live, "cc").schema.simpleString() == "struct<id:bigint,ticket_code:string>"


def test_key_ranges_are_asked_under_the_live_names():
    assert bounds_query("inventory", "id") == "(SELECT MIN(id) AS low, MAX(id) AS high FROM inventory) AS inventory_bounds"
    assert bounds_query("cri", "id").endswith("FROM customer_returned_item) AS cri_bounds")
    assert "MAX(updatedBy_id)" in bounds_query("rtv_sheet_detail", "updated_by_id")


def test_window_parts_cover_the_window_once(spark):
    start, end = datetime(2014, 10, 11), datetime(2014, 10, 18)
    moments = [start + timedelta(hours=part) for part in range(-3, 7 * 24 + 4)] + [end, end + timedelta(microseconds=1), None]
    rows = spark.createDataFrame([(moment,) for moment in moments], "created TIMESTAMP_NTZ")
    for slices in (1, 3, 8):
        parts = window_predicates("created", start, end, slices)
        assert len(parts) == slices
        counts = [rows.where(part).count() for part in parts]
        assert sum(counts) == sum(moment is not None and start <= moment <= end for moment in moments)
        assert rows.where(" OR ".join(f"({part})" for part in parts)).count() == sum(counts)
    assert rows.where(window_predicates("created", end, start, 4)[0]).count() == 0
    assert window_predicates("created", start, start, 1) == [
        "created >= '2014-10-11 00:00:00.000000' AND created <= '2014-10-11 00:00:00.000000'"
    ]


def test_views_offer_all_tables_to_sql_until_dropped(spark, make):
    catalog = make(inventory=[{"barcode": "b1"}, {"barcode": "b2"}])
    catalog.create_views()
    try:
        assert spark.sql("select barcode from inventory order by barcode").collect() == [("b1",), ("b2",)]
        assert all(spark.table(name).schema == getattr(catalog, name).schema for name in TABLES)
    finally:
        catalog.drop_views()
    assert not {view.name for view in spark.catalog.listTables()} & set(TABLES)
