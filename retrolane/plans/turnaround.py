"""How long items take from receipt and quality check to dispatch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retrolane.clock import Clock
from retrolane.functions.labels import Sites, detail_warehouse_label, qc_site_label, warehouse_label
from retrolane.functions.metrics import bucket_names, item_buckets, percent_one_decimal, row_buckets
from retrolane.operators.hotkeys import ABSENT, asked_keys, distinct_keys, fanout_left_join, shared, splittable_join
from retrolane.operators.readthrough import Milestone, status_change
from retrolane.operators.totals import named_total, per_item_with_total
from retrolane.plans.parts import (
    dispatched,
    items,
    sheets,
    with_rules,
    with_user,
    with_warehouse,
)
from retrolane.sources.catalog import Catalog


def _recent_dispatches(c: Catalog, clock: Clock, days: int, *columns: str) -> DataFrame:
    """Items dispatched in the window and marked as returned to the vendor, as much of them as is asked for."""
    recent = sheets(c).where(clock.closed_days("dispatch_date", days))
    recent = recent.select("sheet_id", "dispatch_date", "sheet_warehouse_id", F.col("updated_by_id").alias("user_id"))
    return dispatched(c, recent, items(c).where(F.col("status") == "RTV")).select(*columns)


def dispatched_barcodes(c: Catalog, clock: Clock, days: int = 7) -> DataFrame:
    """Barcodes the turnaround listing asks a status date for."""
    return distinct_keys(_recent_dispatches(c, clock, days, "barcode"), "barcode")


DETAIL = (
    "barcode", "suborder_code", "issue_category", "putaway_date", "dispatch_date", "rule_id", "is_bulk_rule",
    "user_id", "item_warehouse_id", "sheet_warehouse_id",
)
TIMED = ("item_id", "barcode", "item_warehouse_id", "dispatch_date", "user_id", "sheet_warehouse_id")


def to_dispatch_detail(c: Catalog, clock: Clock, sites: Sites, milestone: Milestone, days: int = 7) -> DataFrame:
    """Dispatched items with the milestone's date from the cache or, failing that, from history.

    Several cached dates of one barcode repeat its row. The dispatches and the cache's part of them
    are each computed once, for the barcodes asked for as for the rows.
    """
    rows = shared(_recent_dispatches(c, clock, days, *DETAIL))
    barcodes = asked_keys(rows, "barcode")
    dates = milestone.resolve(c, barcodes)

    wide = with_user(c, with_rules(c, rows), "user_id", "left")
    wide = with_warehouse(c, wide, "sheet_warehouse_id", "left")
    label = F.coalesce(detail_warehouse_label("username", "item_warehouse_id", sites), F.col("warehouse_code"))
    wide = wide.withColumn("warehouse", label).select(
        "barcode", "suborder_code", "issue_category", "putaway_date", "dispatch_date", "rule_name", "username",
        "warehouse_code", "warehouse",
    )
    return fanout_left_join(wide, dates, "barcode", counted=milestone.held(c, barcodes)).select(
        "suborder_code", "issue_category", "putaway_date", "dispatch_date",
        F.col("status_time").alias(milestone.date_column), "rule_name", "username", "warehouse_code", "warehouse",
    )


def cache_additions(c: Catalog, clock: Clock, milestone: Milestone, days: int = 7) -> DataFrame:
    """Rows to append to the cache: every history date of the barcodes it did not hold."""
    found = milestone.additions(c, dispatched_barcodes(c, clock, days))
    return found.withColumnRenamed("status_time", milestone.date_column)


def with_refreshed_cache(c: Catalog, clock: Clock, milestone: Milestone, days: int = 7) -> Catalog:
    """The catalog as the summary sees it: after the listing filled its cache."""
    cache = milestone.refreshed(c, dispatched_barcodes(c, clock, days))
    return c.replacing(**{milestone.table: cache.withColumnRenamed("status_time", milestone.date_column)})


def to_dispatch_summary(c: Catalog, clock: Clock, sites: Sites, milestone: Milestone, days: int = 7) -> DataFrame:
    """Share of distinct items dispatched within 1, 2, 3, 5 and over 5 days of the milestone, per warehouse.

    The dates are those the cache holds. The total row is present even when nothing was dispatched.
    """
    return _timed_summary(c, _recent_dispatches(c, clock, days, *TIMED), milestone.cached(c), sites)


def refreshed_summary(c: Catalog, clock: Clock, sites: Sites, milestone: Milestone, days: int = 7) -> DataFrame:
    """The summary after the listing has filled its cache.

    The same rows as :func:`to_dispatch_summary` over :func:`with_refreshed_cache`, from one reading
    of the dispatches and one of the cache.
    """
    rows = shared(_recent_dispatches(c, clock, days, *TIMED))
    return _timed_summary(c, rows, milestone.extended(c, asked_keys(rows, "barcode")), sites)


def _timed_summary(c: Catalog, rows: DataFrame, dates: DataFrame, sites: Sites) -> DataFrame:
    rows = with_warehouse(c, with_user(c, rows, "user_id", "left"), "sheet_warehouse_id", "left")
    label = F.coalesce(warehouse_label("username", "item_warehouse_id", sites), F.col("warehouse_code"))
    # a missing barcode has no date; coalescing it leaves no filter to push below the dispatches' exchange
    rows = rows.withColumn("barcode", F.coalesce("barcode", F.lit(ABSENT["string"])))
    timed = rows.join(dates, "barcode").select(
        label.alias("warehouse"), "item_id", F.datediff("dispatch_date", "status_time").alias("elapsed")
    )
    per_item = per_item_with_total(
        timed, "warehouse", ["item_id"], F.min("elapsed").alias("shortest"), F.max("elapsed").alias("longest")
    )
    counts = per_item.groupBy("is_total", "warehouse").agg(
        F.count("*").alias("total_dispatch"), *item_buckets("shortest", "longest")
    )
    names = bucket_names()
    zero = c.spark.range(1).select(
        F.lit(1).alias("is_total"), F.lit(None).cast("string").alias("warehouse"),
        *[F.lit(0).cast("bigint").alias(name) for name in ["total_dispatch", *names]],
    )
    summed = (
        counts.unionByName(zero)
        .groupBy("is_total", "warehouse")
        .agg(*[F.sum(name).alias(name) for name in ["total_dispatch", *names]])
    )
    shares = [percent_one_decimal(name, "total_dispatch").alias(f"pct_{name}") for name in names]
    report = summed.select("is_total", "warehouse", *shares, "total_dispatch")
    return named_total(report, "warehouse", "total").orderBy(
        F.asc_nulls_first("total_dispatch"), F.asc_nulls_first("warehouse")
    )


def rpr_to_qc_summary(c: Catalog, clock: Clock, sites: Sites, days: int = 7) -> DataFrame:
    """Quality checks within 1, 2, 3, 5 and over 5 days of receipt, per site, counted over rows.

    Rows add up, so the total is the sum of the few site rows.
    """
    passed = status_change(c.cri_history, "PDC").where(clock.closed_days("status_date", days))
    received = status_change(c.crp_history, "RPR").select("crp_id", F.col("created").alias("received_at"))
    site = F.coalesce(qc_site_label("updated_by", "returns_center_code", sites), F.col("updated_by"))
    checked = (
        passed.select("cri_id", "status_date")
        .join(c.cri.select(F.col("id").alias("cri_id"), "crp_id", "cc_id"), "cri_id")
        .join(c.cc.select(F.col("id").alias("cc_id")), "cc_id", "left_semi")
    )
    # packages and receipts are cut to those checked in the window before they meet
    wanted = distinct_keys(checked, "crp_id")
    parcels = c.crp.select(F.col("id").alias("crp_id"), site.alias("qc_warehouse")).join(wanted, "crp_id", "left_semi")
    parcels = parcels.join(splittable_join(received, wanted, "crp_id", "left_semi"), "crp_id")
    rows = splittable_join(checked, parcels, "crp_id", "inner")
    rows = rows.withColumn("elapsed", F.datediff("status_date", "received_at"))
    names = bucket_names()
    per_site = rows.groupBy("qc_warehouse").agg(F.count("*").alias("total_qc"), *row_buckets(F.col("elapsed")))
    summed = per_site.rollup("qc_warehouse").agg(
        F.grouping("qc_warehouse").cast("int").alias("is_total"),
        *[F.sum(name).alias(name) for name in ["total_qc", *names]],
    )
    figures = [
        column for name in names for column in (F.col(name), percent_one_decimal(name, "total_qc").alias(f"pct_{name}"))
    ]
    report = summed.select("is_total", "qc_warehouse", "total_qc", *figures)
    return named_total(report, "qc_warehouse", "Total").orderBy(
        F.asc_nulls_first("total_qc"), F.asc_nulls_first("qc_warehouse")
    )
