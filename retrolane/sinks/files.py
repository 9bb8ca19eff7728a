"""Report files: one folder per report and run, written in parallel."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from retrolane.clock import Clock
from retrolane.functions.text import title_names
from retrolane.session import shared_folder


def run_folder(root: str, report: str, clock: Clock) -> str:
    return f"{root}/report={report.replace(' ', '_')}/run_ts={clock.run_stamp()}"


def write_csv(df: DataFrame, root: str, report: str, clock: Clock, titles: Sequence[str] | None = None) -> str:
    """Writes a listing as CSV files with a header line; missing values stay empty.

    Types are turned into text only here. Values are quoted when they contain a
    comma, a quote or a line break, and quotes inside are doubled.
    """
    folder = run_folder(root, report, clock)
    shown = df.toDF(*(titles or title_names([name.replace("_", " ") for name in df.columns])))
    options = {
        "header": "true",
        "nullValue": "",
        "emptyValue": "",
        "quote": '"',
        "escape": '"',
        "timestampFormat": "yyyy-MM-dd HH:mm:ss",
        "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    }
    shown.write.mode("errorifexists").options(**options).csv(folder)
    return folder


def append_cache(additions: DataFrame, folder: str) -> None:
    """Adds rows to a Parquet cache table; an empty set of rows adds nothing."""
    additions.write.mode("append").parquet(folder)


def write_version(df: DataFrame, root: str, table: str, clock: Clock) -> str:
    """Writes a table's new version beside the old one, which is only ever read."""
    folder = f"{root}/{table}/version={clock.run_stamp()}"
    df.write.mode("errorifexists").parquet(folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to a folder of its own in the shared folder, and read from there."""
    folder = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


# A task keeps up to this many files open; with rows of more partitions, it sorts the rest.
OPEN_FILES = 32
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_partitions(df: DataFrame, folder: str, by: Sequence[str], mode: str = "errorifexists") -> None:
    """Writes a table laid out by some columns, each row by the task that holds it.

    Nothing is shuffled, nor sorted where a task meets few partitions, so none of the rows spill and no
    partition is written by one task. Each partition gets a file from every task that has rows of it.
    """
    conf = df.sparkSession.conf
    before = conf.get(WRITERS)
    conf.set(WRITERS, str(max(int(before), OPEN_FILES)))
    try:
        writer = df.write.partitionBy(*by).mode(mode).option("partitionOverwriteMode", "dynamic")
        writer.option("compression", "zstd").parquet(folder)
    finally:
        conf.set(WRITERS, before)


def overwrite_partitions(df: DataFrame, folder: str, by: Sequence[str]) -> None:
    """Replaces the partitions that ``df`` has rows of; the files of all others stay as they are.

    ``df`` may be made from the table itself: its new files are written beside the old ones before
    any partition changes hands. It must hold whole partitions. Without rows nothing changes.
    """
    write_partitions(df, folder, by, "overwrite")
