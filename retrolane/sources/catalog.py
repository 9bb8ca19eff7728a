"""Named tables of both databases, resolved when a plan asks for them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import cache

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from retrolane.sources.schemas import RETURNS_DB, TABLES, WAREHOUSE_DB


# Names that the live databases use where the catalog's differ.
SOURCE_TABLES = {
    "cri": "customer_returned_item",
    "crp": "customer_returned_package",
    "cc": "customer_complaint",
}
SOURCE_COLUMNS = {
    "inventory": {
        "suborder_code": "suborderCode",
        "issue_category": "issueCategory",
        "forward_awb_number": "forwardAwbNumber",
        "created_by_id": "createdBy_id",
        "manifest_date": "manifestDate",
    },
    "rtv_sheet_detail": {"receiver_id": "receiverDetail_id", "updated_by_id": "updatedBy_id"},
    "rtv_sheet_detail_inventory": {"product_details_id": "productDetails_id"},
    "manifest_rtv_sheet_detail": {"rtv_sheet_id": "rtvSheet_id"},
    "cc": {"ticket_code": "zendesk_ticket_code"},
}


class Catalog:
    """``catalog.inventory`` is the DataFrame the resolver gives for that name, resolved once."""

    def __init__(self, spark: SparkSession, resolve: Callable[[str], DataFrame]):
        self.spark = spark
        self._resolve = cache(resolve)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self._resolve(name)

    def replacing(self, **tables: DataFrame) -> Catalog:
        """A catalog in which some tables are swapped, e.g. for a refreshed cache."""
        return Catalog(self.spark, lambda name: tables[name] if name in tables else self._resolve(name))

    def create_views(self) -> None:
        """Temporary views of all tables, for queries written in SQL."""
        for name in TABLES:
            self._resolve(name).createOrReplaceTempView(name)

    def drop_views(self) -> None:
        for name in TABLES:
            self.spark.catalog.dropTempView(name)


def from_frames(spark: SparkSession, frames: Mapping[str, DataFrame]) -> Catalog:
    return Catalog(spark, lambda name: frames[name])


def from_parquet(spark: SparkSession, root: str) -> Catalog:
    """Tables stored as ``<root>/<table>``; schemas are declared, never inferred."""
    return Catalog(spark, lambda name: spark.read.schema(TABLES[name]).parquet(f"{root}/{name}"))


def source_query(name: str) -> str:
    """The projection that gives a live table the catalog's column names, as a derived table."""
    own = SOURCE_COLUMNS.get(name, {})
    columns = [field.split()[0] for field in TABLES[name].split(", ")]
    chosen = ", ".join(f"{own[column]} AS {column}" if column in own else column for column in columns)
    return f"(SELECT {chosen} FROM {SOURCE_TABLES.get(name, name)}) AS {name}_rows"


def typed(df: DataFrame, name: str) -> DataFrame:
    """A live table with the declared types."""
    fields = [field.split() for field in TABLES[name].split(", ")]
    return df.select(*[F.col(column).cast(kind).alias(column) for column, kind in fields])


def jdbc_options(
    url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None, slices: int = 1
) -> dict[str, str]:
    """Reader options for one table; a numeric key splits the scan into parallel range queries."""
    options = {"url": url, "dbtable": table, "fetchsize": "10000"}
    if key and bounds and slices > 1:
        options |= {
            "partitionColumn": key,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(slices),
        }
    return options


def bounds_query(name: str, key: str) -> str:
    """One row with the least and greatest value of a key of a live table, as a derived table.

    Both are index look-ups where the key is one; the answer sets the ranges of a parallel scan.
    """
    column = SOURCE_COLUMNS.get(name, {}).get(key, key)
    return f"(SELECT MIN({column}) AS low, MAX({column}) AS high FROM {SOURCE_TABLES.get(name, name)}) AS {name}_bounds"


def key_bounds(reader: DataFrameReader, url: str, name: str, key: str) -> tuple[int, int] | None:
    """The key's range as the source has it now; None for a table without rows."""
    row = reader.format("jdbc").options(url=url, dbtable=bounds_query(name, key)).load().first()
    return None if row is None or row["low"] is None else (int(row["low"]), int(row["high"]))


def window_predicates(column: str, start: datetime, end: datetime, slices: int) -> list[str]:
    """Conditions that cut a window, both ends included, into parts of equal length for parallel reading.

    They meet without gap or overlap, so every row of the window is read once; the source
    evaluates them, so rows outside never leave it. A row without a time is in no part.
    """
    if end < start:
        return ["1 = 0"]
    step = (end - start) / max(1, slices)
    cuts = [start + part * step for part in range(max(1, slices))]

    def text(moment: datetime) -> str:
        return moment.isoformat(sep=" ", timespec="microseconds")

    parts = [f"{column} >= '{text(low)}' AND {column} < '{text(high)}'" for low, high in zip(cuts, cuts[1:], strict=False)]
    return [*parts, f"{column} >= '{text(cuts[-1])}' AND {column} <= '{text(end)}'"]


@dataclass(frozen=True)
class Window:
    """A window on a live table's time column that is read instead of the whole table."""

    column: str
    start: datetime
    end: datetime


def from_jdbc(
    spark: SparkSession,
    warehouse_url: str,
    returns_url: str,
    keys: Mapping[str, tuple[str, tuple[int, int] | None]],
    slices: int,
    properties: Mapping[str, str],
    windows: Mapping[str, Window] | None = None,
    report_sites: DataFrame | None = None,
) -> Catalog:
    """Both live databases side by side.

    ``keys`` gives the numeric split column and its range for the large tables; without a range the
    source is asked for it when the table is first used. ``windows`` names tables of which only a
    time window is wanted: the source filters them, in parallel parts. ``report_sites`` holds the
    addresses of sites, which no live table has. Credentials come in through ``properties`` and are
    never stored here.
    """
    windows = windows or {}

    def resolve(name: str) -> DataFrame:
        if name == "report_sites":
            return spark.createDataFrame([], TABLES[name]) if report_sites is None else report_sites
        url = warehouse_url if name in WAREHOUSE_DB else returns_url
        if name in windows:
            window = windows[name]
            parts = window_predicates(window.column, window.start, window.end, slices)
            read = spark.read.jdbc(url, source_query(name), predicates=parts, properties=dict(properties))
            return typed(read, name)
        key, bounds = keys.get(name, (None, None))
        if key and bounds is None and slices > 1:
            bounds = key_bounds(spark.read.options(**properties), url, name, key)
        reader = spark.read.format("jdbc").options(**jdbc_options(url, source_query(name), key, bounds, slices))
        return typed(reader.options(**properties).load(), name)

    return Catalog(spark, resolve)
