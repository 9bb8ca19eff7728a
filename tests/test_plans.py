"""What the plans of the reports look like once they have run: tables read once, no jobs at build time, spread keys."""

import re
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from retrolane.clock import Clock
from retrolane.operators.hotkeys import POSITION, asked_keys, fanout_left_join, shared, with_position
from retrolane.operators.readthrough import QUALITY_CHECK, RECEIPT
from retrolane.operators.serial import _cuts, _slice_of, numbered
from retrolane.plans import listings, manifests, turnaround
from retrolane.sources.catalog import from_parquet
from retrolane.sources.schemas import TABLES
from retrolane.sources.star import TEST_SITES, from_star

FOLDER = "/root/testdata/sf0.001"
DAY = Clock.at("1998-09-01 12:00:00")
PRINT = Clock.at("2024-01-30 18:00:00")
DAYS = 1500
SINCE = datetime(1997, 1, 1)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The test tables as Parquet, so that a plan names the table that a scan reads."""
    root = str(tmp_path_factory.mktemp("tables"))
    star = from_star(spark, FOLDER)
    for name in TABLES:
        getattr(star, name).write.parquet(f"{root}/{name}")
    return from_parquet(spark, root)


def scans(df) -> Counter:
    """How often each table is read in the plan that ran; a reused exchange reads nothing.

    A table whose exchange is first met where nothing came of it (no hot keys) does not show at all.
    """
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return Counter(re.findall(r"Location: InMemoryFileIndex\(\d+ paths\)\[file:[^\]]*?/(\w+)\]", final))


@pytest.mark.parametrize("milestone", [QUALITY_CHECK, RECEIPT])
def test_turnaround_reads_dispatches_and_cache_once(spark, stored, milestone):
    once = {"inventory", "rtv_sheet_detail", "rtv_sheet_detail_inventory", milestone.table}
    for report in (turnaround.to_dispatch_detail, turnaround.refreshed_summary):
        read = scans(report(stored, DAY, TEST_SITES, milestone, DAYS))
        assert all(read[name] <= 1 for name in once) and read["inventory"] == 1, (report, read)


def test_refreshed_summary_equals_the_summary_over_the_refreshed_cache(stored):
    for milestone in (QUALITY_CHECK, RECEIPT):
        whole = turnaround.with_refreshed_cache(stored, DAY, milestone, DAYS)
        slow = turnaround.to_dispatch_summary(whole, DAY, TEST_SITES, milestone, DAYS)
        assert turnaround.refreshed_summary(stored, DAY, TEST_SITES, milestone, DAYS).collect() == slow.collect()


def test_listings_and_exports_read_their_rows_once(stored):
    reports = [
        listings.rtv_data(stored, DAY, DAYS),
        listings.liquidation_listing(stored, SINCE),
        listings.rule_listing(stored, listings.ELECTRONICS_RULE, SINCE),
        manifests.courier_manifest_export(stored, PRINT),
    ]
    for report in reports:
        read = scans(report)
        rows = ("inventory", "rtv_sheet_detail_inventory", "gate_pass", "manifest", "manifest_rtv_sheet_detail")
        assert all(read[name] <= 1 for name in rows), read
    assert scans(reports[0])["inventory"] == 1


def test_building_an_export_starts_no_job(spark, stored):
    tracker = spark.sparkContext.statusTracker()
    group = "building"
    spark.sparkContext.setJobGroup(group, "nothing should run")
    try:
        manifests.courier_manifest_export(stored, PRINT)
        numbered(spark.range(1000).withColumn("g", F.col("id") % 3), ["g"], ["id"])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(tracker.getJobIdsForGroup(group)) == []


def test_a_hot_first_order_value_is_cut(spark):
    rows = spark.range(20_000).select(
        F.lit(None).cast("string").alias("g"), F.when(F.col("id") < 19_000, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("n")
    )
    order = ["k", "n"]
    sliced = rows.withColumn("cuts", _cuts(rows, order, 16).scalar()).withColumn("slice", _slice_of(order, 15))
    sizes = [row["count"] for row in sliced.groupBy("slice").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 4_000
    result = numbered(rows, ["g"], order, size="total", slices=16)
    assert result.where("total <> 20000 OR sno <> n + 1").count() == 0 and result.count() == 20_000


def test_slices_count_the_cuts_below(spark):
    for many in (1, 2, 3, 7, 8, 63):
        cuts = F.array(*[F.struct(F.lit(2 * at).alias("k")) for at in range(many)])
        found = spark.range(-1, 2 * many + 2).select(F.col("id").cast("int").alias("k")).withColumn("cuts", cuts)
        for row in found.withColumn("slice", _slice_of(["k"], many)).collect():
            assert row["slice"] == sum(2 * at < row["k"] for at in range(many))


def test_equal_rows_of_a_hot_key_fall_into_several_tasks(spark):
    left = spark.createDataFrame([(n % 3, n) for n in range(9)], "k INT, n INT")
    right = spark.createDataFrame([(1, "same")] * 400 + [(0, "x"), (0, "x"), (5, "y")], "k INT, v STRING").repartition(4)
    salts = with_position(right).where("k = 1").select(F.pmod(F.xxhash64(POSITION), F.lit(40)).alias("salt"))
    assert salts.distinct().count() > 30
    expected = left.join(right, "k", "left").groupBy("n", "v").count().collect()
    for options in ({}, {"wanted": asked_keys(left, "k")}):
        joined = fanout_left_join(left, right, "k", 10, **options)
        assert joined.columns == ["k", "n", "v"]
        assert sorted(map(str, joined.groupBy("n", "v").count().collect())) == sorted(map(str, expected))


def test_asked_keys_of_a_shared_frame_keep_its_exchange(spark, stored):
    rows = shared(stored.inventory.select("barcode", "id", "status"))
    read = scans(rows.join(asked_keys(rows, "barcode").withColumnRenamed("barcode", "b"), F.col("barcode") == F.col("b"), "left"))
    assert read["inventory"] == 1
