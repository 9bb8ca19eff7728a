"""Runs of reports whose outputs appear together or not at all.

A run writes listings, mail bodies and recipients under its own number. Readers see a run only once
its row is in the ledger, and that row is written last, as one file. A run that dies half-way leaves
files that nobody reads; the next one has a number of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retrolane.clock import Clock
from retrolane.sinks.files import run_folder, write_csv

LEDGER = "run STRING, as_of STRING, report STRING, kind STRING, place STRING"
BODY = "mail STRING, section INT, part BIGINT, parts BIGINT, n_rows BIGINT, body_html STRING"
RECIPIENTS = "mail STRING, to_email STRING"


class Run:
    """One run: outputs are added, then committed. Used as a context, it commits if nothing failed."""

    def __init__(self, spark: SparkSession, root: str, clock: Clock):
        self.spark, self.root, self.clock = spark, root.rstrip("/"), clock
        self.number = f"{clock.run_stamp()}-{uuid.uuid4().hex[:8]}"
        self.outputs: list[tuple[str, str, str]] = []

    def _place(self, kind: str, report: str) -> str:
        return f"{self.root}/{kind}/run={self.number}/report={report.replace(' ', '_')}"

    def listing(self, report: str, rows: DataFrame, titles: Sequence[str] | None = None) -> None:
        """A listing as CSV files under the report's run-stamped folder."""
        base = f"{self.root}/files/run={self.number}"
        place = run_folder(base, report, self.clock)
        write_csv(rows, base, report, self.clock, titles)
        self.outputs.append((report, "listing", place))

    def body(self, report: str, parts: DataFrame) -> None:
        """A mail body in parts: those of one table or of several assembled ones."""
        if "mail" not in parts.columns:
            key = next(name for name in parts.columns if name not in ("part", "parts", "n_rows", "body_html"))
            parts = parts.withColumnRenamed(key, "mail")
        if "section" not in parts.columns:
            parts = parts.withColumn("section", F.lit(1))
        place = self._place("bodies", report)
        kinds = [field.split() for field in BODY.split(", ")]
        parts.select(*[F.col(name).cast(kind).alias(name) for name, kind in kinds]).write.parquet(place)
        self.outputs.append((report, "body", place))

    def recipients(self, report: str, mails: DataFrame) -> None:
        """Addresses: (mail, to_email), or a digest with its own key."""
        key = next(name for name in mails.columns if name not in ("to_email", "n_items"))
        place = self._place("recipients", report)
        mails.select(F.col(key).cast("string").alias("mail"), "to_email").write.parquet(place)
        self.outputs.append((report, "recipients", place))

    def commit(self) -> None:
        """Makes the run visible. A run without outputs is one that did nothing and is entered as such."""
        rows = [(self.number, self.clock.run_stamp(), *output) for output in self.outputs]
        rows = rows or [(self.number, self.clock.run_stamp(), None, None, None)]
        entry = self.spark.createDataFrame(rows, LEDGER).coalesce(1)
        entry.write.mode("errorifexists").parquet(f"{self.root}/ledger/entry={self.number}")

    def __enter__(self) -> Run:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.commit()


def committed(spark: SparkSession, root: str) -> DataFrame:
    """Outputs of the runs that ended: (run, as_of, report, kind, place)."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{root.rstrip('/')}/ledger").drop("entry")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def _visible(spark: SparkSession, root: str, kind: str, folder: str, schema: str) -> DataFrame:
    """Rows of one kind of all committed runs, with run and report; other runs' folders are pruned."""
    outputs = committed(spark, root).where(F.col("kind") == kind)
    known = outputs.select("run", F.replace("report", F.lit(" "), F.lit("_")).alias("report"), F.col("report").alias("title"))
    try:
        stored = spark.read.schema(f"{schema}, run STRING, report STRING").parquet(f"{root.rstrip('/')}/{folder}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], f"{schema}, run STRING, report STRING")
    return stored.join(known, ["run", "report"]).drop("report").withColumnRenamed("title", "report")


def bodies(spark: SparkSession, root: str) -> DataFrame:
    return _visible(spark, root, "body", "bodies", BODY)


def mail_recipients(spark: SparkSession, root: str) -> DataFrame:
    return _visible(spark, root, "recipients", "recipients", RECIPIENTS)
