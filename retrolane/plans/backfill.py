"""One-off data fixes, written as new versions of a table instead of updates in place."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retrolane.clock import moment
from retrolane.operators.hotkeys import distinct_keys
from retrolane.operators.lookup import customer_names
from retrolane.plans.cohorts import received
from retrolane.sinks.files import stored
from retrolane.sources.catalog import Catalog


def rpr_backfill(c: Catalog, before: datetime) -> DataFrame:
    """Receipt dates of every barcode received before a cut-off."""
    return received(c, F.col("created") < moment(before))


def _found_names(c: Catalog, excluded: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Names from the returns database for the barcodes that lack one, and those that rows with a name share.

    Both are written to the shared folder: they are read more than once, and from its size on disk Spark
    knows whether to broadcast the second one, which is small unless barcodes repeat.
    """
    missing = c.inventory.where(F.col("customer_name").isNull() & F.col("barcode").isNotNull())
    if excluded:
        missing = missing.where(~F.col("barcode").isin(list(excluded)))
    names = customer_names(c, distinct_keys(missing, "barcode")).where("found_name IS NOT NULL")
    names = stored(names, "names")
    named = distinct_keys(c.inventory.where("customer_name IS NOT NULL"), "barcode")
    return names, stored(names.join(named, "barcode", "left_semi"), "shared-names")


def _filled(inventory: DataFrame, names: DataFrame, shared_names: DataFrame) -> DataFrame:
    """Only rows without a name, and those that share a barcode with one, travel to their name."""
    parts = []
    for lacking, found in (("customer_name IS NULL", names), ("customer_name IS NOT NULL", shared_names)):
        filled = inventory.where(lacking).join(found, "barcode", "left")
        parts.append(filled.withColumn("customer_name", F.coalesce("found_name", "customer_name")).select(*inventory.columns))
    return parts[0].unionByName(parts[1])


def customer_name_fill(c: Catalog, excluded: Sequence[str] = ()) -> DataFrame:
    """Inventory with missing customer names taken from the returns database.

    As the update goes by barcode, every row of a barcode that lacked a name
    takes the found one. Rows without a match keep what they had.
    """
    return _filled(c.inventory, *_found_names(c, excluded))


def customer_name_partitions(c: Catalog, by: str, excluded: Sequence[str] = ()) -> DataFrame:
    """The partitions of inventory that the name fill changes, whole and filled; for `overwrite_partitions`.

    ``by`` is the column the table is partitioned by. Which partitions change is found from the
    narrow columns; all others are never read in full.
    """
    names, shared_names = _found_names(c, excluded)
    narrow = c.inventory.select("barcode", "customer_name", F.col(by).alias("touched"))
    gained = narrow.where("customer_name IS NULL").join(names, "barcode", "left_semi").select("touched")
    replaced = narrow.where("customer_name IS NOT NULL").join(shared_names, "barcode").where("customer_name <> found_name")
    changed = stored(gained.unionByName(replaced.select("touched")).distinct(), "touched")
    whole = c.inventory.join(changed, F.col(by).eqNullSafe(F.col("touched")), "left_semi")
    return _filled(whole, names, shared_names)
