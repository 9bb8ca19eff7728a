"""What became of the packages received on each day."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retrolane.clock import Clock
from retrolane.functions.labels import Sites, qc_site_label, warehouse_label
from retrolane.functions.metrics import percent, percent_floor
from retrolane.operators.hotkeys import asked_keys, distinct_keys, fanout_left_join, shared, splittable_join
from retrolane.plans.funnels import rule_flags, side_by_side
from retrolane.plans.parts import items, real_change, with_rules, with_user
from retrolane.session import shared_folder
from retrolane.sources.catalog import Catalog


def received(c: Catalog, window: Column) -> DataFrame:
    """Receipt times and barcodes of the packages received in a window on ``created``."""
    arrivals = real_change(c.crp_history, "RPR").where(window)
    parcels = c.crp.select(F.col("id").alias("crp_id"))
    barcodes = c.cri.where(F.col("code").isNotNull()).select("crp_id", F.col("code").alias("barcode"))
    known = arrivals.select("crp_id", F.col("created").alias("rpr_date_time")).join(parcels, "crp_id", "left_semi")
    return splittable_join(barcodes, known, "crp_id", "inner").select("barcode", "rpr_date_time")


def rpr_cohort_staging(c: Catalog, clock: Clock, days: int = 7) -> DataFrame:
    return received(c, clock.closed_days("created", days))


def cohort_items(c: Catalog, clock: Clock, days: int = 7) -> DataFrame:
    """Every received item with what the cohort reports need of it: barcode, receipt, parcel and site.

    ``known`` tells whether its parcel exists; only such items are put away and have a site.
    """
    arrivals = real_change(c.crp_history, "RPR").where(clock.closed_days("created", days))
    arrivals = arrivals.select("crp_id", F.col("created").alias("rpr_date_time"))
    codes = c.cri.select(F.col("id").alias("cri_id"), "crp_id", F.col("code").alias("barcode"))
    parcels = c.crp.select(F.col("id").alias("crp_id"), "updated_by", "returns_center_code", F.lit(True).alias("known"))
    return splittable_join(splittable_join(codes, arrivals, "crp_id", "inner"), parcels, "crp_id", "left")


def store_cohort(c: Catalog, clock: Clock, days: int = 7, buckets: int | None = None) -> DataFrame:
    """Writes the cohort once, bucketed by barcode, for all cohort reports of a run.

    What joins or groups a stored cohort by barcode reads it without a shuffle. The table lies in the
    shared folder under a name of its own; it has as many buckets as the session has shuffle partitions.
    """
    name = f"cohort_{uuid.uuid4().hex}"
    buckets = buckets or int(c.spark.conf.get("spark.sql.shuffle.partitions"))
    # one file for each bucket
    dealt = cohort_items(c, clock, days).repartition(buckets, "barcode")
    writer = dealt.write.bucketBy(buckets, "barcode").sortBy("barcode")
    writer.option("path", f"{shared_folder(c.spark)}/{name}").saveAsTable(name)
    return c.spark.table(name)


def _staged(c: Catalog, clock: Clock, days: int, cohort: DataFrame | None) -> DataFrame:
    """Barcodes and receipt times, from the stored cohort where there is one."""
    if cohort is None:
        return rpr_cohort_staging(c, clock, days)
    return cohort.where("known AND barcode IS NOT NULL").select("barcode", "rpr_date_time")


def _received_and_checked(c: Catalog, clock: Clock, days: int, cohort: DataFrame | None = None) -> DataFrame:
    """Received items with the number of quality checks found for each, and of those with a date."""
    if cohort is None:
        arrivals = real_change(c.crp_history, "RPR").where(clock.closed_days("created", days))
        cohort = arrivals.select("crp_id", F.to_date("created").alias("date")).join(
            c.cri.select(F.col("id").alias("cri_id"), "crp_id"), "crp_id"
        )
    else:
        cohort = cohort.withColumn("date", F.to_date("rpr_date_time"))
    # only the cohort's part of the history is counted
    history = real_change(c.cri_history, "PDC").select("cri_id", "status_date")
    history = splittable_join(history, distinct_keys(cohort, "cri_id"), "cri_id", "left_semi")
    passed = history.groupBy("cri_id").agg(
        F.count("*").alias("checks"), F.count("status_date").alias("dated_checks")
    )
    return splittable_join(cohort, passed, "cri_id", "left")


def _qc_share(rows: DataFrame, *keys: str) -> DataFrame:
    """Items are counted once per quality check found, and once when none was found."""
    counted = rows.groupBy(*keys).agg(
        F.sum(F.coalesce("checks", F.lit(1))).alias("total_rpr"),
        F.sum(F.coalesce("dated_checks", F.lit(0))).alias("total_qc"),
    )
    return counted.withColumn("pct_qc", percent("total_qc", "total_rpr"))


def rpr_cohort_qc(c: Catalog, clock: Clock, days: int = 7, cohort: DataFrame | None = None) -> DataFrame:
    """Per received day: items, quality checks and their share."""
    return _qc_share(_received_and_checked(c, clock, days, cohort), "date")


def rpr_cohort_putaway(c: Catalog, clock: Clock, days: int = 7, cohort: DataFrame | None = None) -> DataFrame:
    """Per received day: what was put away, under which rules, and dispatched.

    Put-aways are distinct items; returns and the share's base are rows. Rows
    are first combined per (day, item), which also folds the items not found
    into one row per day.
    """
    if cohort is None:
        received_items = shared(rpr_cohort_staging(c, clock, days))
        barcodes = asked_keys(received_items, "barcode")
    else:
        received_items = _staged(c, clock, days, cohort)
        barcodes = distinct_keys(received_items, "barcode")
    stock = items(c).select("item_id", "barcode", "rule_id", "is_bulk_rule", "status")
    # only the cohort's items are counted and joined; a small cohort is broadcast here and spares the shuffle of stock
    found = fanout_left_join(received_items, stock, "barcode", wanted=barcodes)
    rows = with_rules(c, found).withColumn("date", F.to_date("rpr_date_time"))
    per_item = rows.groupBy("date", "item_id").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("status") == "RTV").alias("returned"),
        *[F.max(flag).alias(name) for name, flag in rule_flags().items()],
    )
    counted = per_item.groupBy("date").agg(
        F.count("item_id").alias("total_putaway"),
        *[F.count_if(name).alias(name) for name in rule_flags()],
        F.sum("returned").alias("total_returns"),
        F.sum("rows").alias("received"),
    )
    return counted.withColumn("pct_rtv", percent("total_returns", "received")).drop("received")


def rpr_cohort_summary(c: Catalog, clock: Clock, days: int = 7, cohort: DataFrame | None = None) -> DataFrame:
    return side_by_side(rpr_cohort_qc(c, clock, days, cohort), rpr_cohort_putaway(c, clock, days, cohort))


def warehouse_rpr_cohort_qc(
    c: Catalog, clock: Clock, sites: Sites, days: int = 7, cohort: DataFrame | None = None
) -> DataFrame:
    """Received and checked items per site and day; packages of no site are left out."""
    site = qc_site_label("updated_by", "returns_center_code", sites)
    if cohort is not None:
        checked = _received_and_checked(c, clock, days, cohort).where("known").withColumn("warehouse", site)
        return _qc_share(checked.where(F.col("warehouse").isNotNull()), "warehouse", "date")
    parcels = c.crp.select(F.col("id").alias("crp_id"), site.alias("warehouse")).where(F.col("warehouse").isNotNull())
    return _qc_share(_received_and_checked(c, clock, days).join(parcels, "crp_id"), "warehouse", "date")


def _rule_counts(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count("item_id").alias("putaway"),
        *[F.count_if(flag).alias(name) for name, flag in rule_flags().items()],
        F.count_if(F.col("status") == "RTV").alias("total_dispatch"),
    )


def _site_items(c: Catalog, rows: DataFrame, sites: Sites) -> DataFrame:
    """Rules and the site of the user who put the item away; items of no site are left out."""
    named = with_user(c, with_rules(c, rows).withColumnRenamed("created_by_id", "user_id"), "user_id", "left")
    labelled = named.withColumn("warehouse", warehouse_label("username", "item_warehouse_id", sites))
    return labelled.where(F.col("warehouse").isNotNull())


STOCK = ("item_id", "barcode", "rule_id", "is_bulk_rule", "status", "created_by_id", "item_warehouse_id")


def warehouse_rpr_cohort_putaway(
    c: Catalog, clock: Clock, sites: Sites, days: int = 7, cohort: DataFrame | None = None
) -> DataFrame:
    """Per site and received day: rows put away, by rule kind, and dispatched.

    Only found items can carry a site, so the barcode join is an inner one.
    """
    rows = _staged(c, clock, days, cohort).join(items(c).select(*STOCK), "barcode")
    labelled = _site_items(c, rows, sites).withColumn("date", F.to_date("rpr_date_time"))
    return _rule_counts(labelled, "warehouse", "date")


def warehouse_rpr_summary(
    c: Catalog, clock: Clock, sites: Sites, days: int = 7, cohort: DataFrame | None = None
) -> DataFrame:
    """Both site cohorts side by side for the days they share, with two cut-off ratios."""
    checked = warehouse_rpr_cohort_qc(c, clock, sites, days, cohort)
    put_away = warehouse_rpr_cohort_putaway(c, clock, sites, days, cohort)
    return (
        checked.join(put_away, ["warehouse", "date"])
        .withColumn("pct_dispatch", percent_floor("total_dispatch", "total_rpr"))
        .withColumn("pct_putaway_qc", percent_floor("putaway", "total_qc"))
    )


def warehouse_putaway_returns(c: Catalog, clock: Clock, sites: Sites, days: int = 7) -> DataFrame:
    """Per site and put-away day: rows put away, by rule kind, and dispatched."""
    recent = items(c).where(clock.closed_days("putaway_date", days)).select(*STOCK, "putaway_date")
    labelled = _site_items(c, recent, sites).withColumn("date", F.to_date("putaway_date"))
    return _rule_counts(labelled, "warehouse", "date")

