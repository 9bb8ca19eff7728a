"""Status dates kept in a cache table and completed from the status history."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retrolane.operators.hotkeys import POSITION, distinct_keys, shared, splittable_join, with_position
from retrolane.operators.lookup import returned_items
from retrolane.sources.catalog import Catalog


def status_change(history: DataFrame, status: str) -> DataFrame:
    """History rows that really moved into ``status``; an unknown previous status does not count."""
    return history.where(
        (F.col("next_status_code") == status) & (F.col("next_status_code") != F.col("previous_status_code"))
    )


def complained_items(c: Catalog, barcodes: DataFrame) -> DataFrame:
    """Returned items of the wanted barcodes that have a complaint."""
    return returned_items(c, barcodes).join(c.cc.select(F.col("id").alias("cc_id")), "cc_id", "left_semi")


def qc_history(c: Catalog, barcodes: DataFrame) -> DataFrame:
    """Every quality-check time of the wanted barcodes."""
    packaged = complained_items(c, barcodes).join(c.crp.select(F.col("id").alias("crp_id")), "crp_id", "left_semi")
    passed = status_change(c.cri_history, "PDC").select("cri_id", F.col("created").alias("status_time"))
    return packaged.join(passed, "cri_id").select("barcode", "status_time")


def received_history(c: Catalog, barcodes: DataFrame) -> DataFrame:
    """Every receipt time of the wanted barcodes."""
    received = status_change(c.crp_history, "RPR").select("crp_id", F.col("created").alias("status_time"))
    packages = received.join(c.crp.select(F.col("id").alias("crp_id")), "crp_id", "left_semi")
    items = complained_items(c, barcodes)
    return splittable_join(items, packages, "crp_id", "inner").select("barcode", "status_time")


@dataclass(frozen=True)
class Milestone:
    """A cached status: its table, its date column and where missing dates come from."""

    table: str
    date_column: str
    history: Callable[[Catalog, DataFrame], DataFrame]

    def cached(self, c: Catalog) -> DataFrame:
        return (
            getattr(c, self.table)
            .select("barcode", F.col(self.date_column).alias("status_time"))
            .where(F.col("status_time").isNotNull())
        )

    def held(self, c: Catalog, barcodes: DataFrame) -> DataFrame:
        """The cache cut to the wanted (distinct) barcodes, with positions, behind one exchange.

        Whatever asks the cache in a query reads this exchange, so the cache is read once.
        """
        known = with_position(self.cached(c).where(F.col("barcode").isNotNull()))
        return shared(splittable_join(known, barcodes, "barcode", "left_semi"))

    def additions(self, c: Catalog, barcodes: DataFrame) -> DataFrame:
        """History rows of the barcodes the cache does not hold yet; these are appended to it."""
        known = distinct_keys(self.held(c, barcodes), "barcode")
        return self.history(c, barcodes.join(known, "barcode", "left_anti"))

    def resolve(self, c: Catalog, barcodes: DataFrame) -> DataFrame:
        """Cached times, else the first historical one, for the wanted (distinct) barcodes; with positions."""
        first = self.additions(c, barcodes).groupBy("barcode").agg(F.min("status_time").alias("status_time"))
        return self.held(c, barcodes).unionByName(first.withColumn(POSITION, F.lit(0).cast("bigint")))

    def extended(self, c: Catalog, barcodes: DataFrame) -> DataFrame:
        """The dates of the wanted (distinct) barcodes as the cache holds them after the additions were appended."""
        return self.held(c, barcodes).drop(POSITION).unionByName(self.additions(c, barcodes))

    def refreshed(self, c: Catalog, barcodes: DataFrame) -> DataFrame:
        """The whole cache as it stands after the additions were appended."""
        return self.cached(c).unionByName(self.additions(c, barcodes))


QUALITY_CHECK = Milestone("qc", "qc_date_time", qc_history)
RECEIPT = Milestone("rpr", "rpr_date_time", received_history)
