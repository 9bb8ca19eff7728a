"""Newly printed manifests as a stream.

A manifest whose mail flag is up is mailed once, when its courier is enabled, has a template and the
manifest has lines; until then it waits, however long. A batch keeps four tables beside its output,
each in a folder of its own that running the batch again overwrites:

- ``seen``: ids that have arrived, in buckets of neighbouring ids. A batch reads the buckets its own
  ids fall into, so the look-back does not grow with the stream's age.
- ``open``: manifests of due couriers that have no lines yet; the next batch tries them again.
- ``parked``: manifests of couriers that are not due, by courier. They are read only in the batch
  that finds their courier due again, and only those parked since it last was.
- ``couriers``: which couriers are due, and since which batch. Written last, it marks a whole batch.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from retrolane.operators.template import mailed_couriers
from retrolane.plans.manifests import export_lines, long_form, manifest_lines
from retrolane.sources.catalog import Catalog

MANIFEST = "id BIGINT, created TIMESTAMP_NTZ, courier_code STRING"
PENDING = f"{MANIFEST}, due BOOLEAN"
LINES = "sheet_warehouse_id BIGINT, sheet_id BIGINT, manifest_id BIGINT, manifest_created TIMESTAMP_NTZ, courier_code STRING, warehouse STRING, item_id BIGINT"
SEEN = "id BIGINT, bucket BIGINT, batch BIGINT"
COURIERS = "courier_code STRING, due BOOLEAN, since BIGINT"
CELLS = "courier_code STRING, warehouse STRING, sno BIGINT, pos INT, title STRING, value STRING, batch BIGINT"
WINDOWS = "manifest_id BIGINT, window_start TIMESTAMP_NTZ, courier_code STRING, warehouse STRING, batch BIGINT"

BUCKET_IDS = 1 << 16
PLACE = "courier-"  # before a code that names a folder, as an empty name can't
#: A batch whose ids fall into more buckets reads the whole ledger instead of naming them.
MOST_BUCKETS = 4096


def due(manifests: DataFrame, couriers: DataFrame) -> DataFrame:
    """Manifests to mail: flag up, courier enabled and with a template."""
    return manifests.where("is_email_sent = 1").join(mailed_couriers(couriers), "courier_code", "left_semi")


def _stored(spark: SparkSession, schema: str, path: str, base: str | None = None) -> DataFrame:
    """A stored part, or no rows if it was never written."""
    reader = spark.read.schema(schema)
    try:
        return (reader.option("basePath", base) if base else reader).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _written(df: DataFrame, schema: str, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def _unseen(raised: DataFrame, number: int, folder: str) -> DataFrame:
    """The raised manifests that no earlier batch has seen; their ids are entered into the ledger.

    What a batch enters depends on its rows and earlier batches alone, so entering it again changes nothing.
    """
    spark = raised.sparkSession
    bucketed = raised.withColumn("bucket", F.floor(F.col("id") / BUCKET_IDS))
    buckets = [row[0] for row in bucketed.select("bucket").distinct().limit(MOST_BUCKETS + 1).collect()]
    ledger = f"{folder}/seen"
    # a missing id counts as one id, in the ledger as in the batch
    names = ["__HIVE_DEFAULT_PARTITION__" if bucket is None else str(bucket) for bucket in buckets]
    path = f"{ledger}/bucket={{{','.join(names)}}}" if 0 < len(names) <= MOST_BUCKETS else ledger
    earlier = _stored(spark, SEEN, path, ledger).where(F.col("batch") < number).select(F.col("id").alias("known"))
    new = bucketed.join(earlier, F.col("id").eqNullSafe(F.col("known")), "left_anti")
    entries = new.select("id", "bucket", F.lit(number).alias("batch"))
    # one file for each bucket, so that a bucket's reader opens few
    entries = entries.repartition("bucket")
    entries.write.partitionBy("bucket", "batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(ledger)
    return _stored(spark, SEEN, path, ledger).where(F.col("batch") == number).select("id")


def _released(spark: SparkSession, now: DataFrame, before: DataFrame, number: int, folder: str) -> DataFrame:
    """Parked manifests of couriers that have become due; only their folders are read."""
    back = now.join(before.where(~F.col("due")), "courier_code").select("courier_code", "since")
    back = {row["courier_code"]: row["since"] for row in back.collect()}  # couriers that changed: few, often none
    if not back:
        return spark.createDataFrame([], MANIFEST)
    live = F.lit(False)
    for code, since in back.items():
        live |= (F.col("place") == PLACE + code) & (F.col("batch") >= since)
    parked = _stored(spark, f"{MANIFEST}, place STRING, batch BIGINT", f"{folder}/parked")
    return parked.where(live & (F.col("batch") < number)).select("id", "created", "courier_code")


def _courier_states(now: DataFrame, before: DataFrame, waiting: DataFrame, number: int) -> DataFrame:
    """Every courier that is due or has been met, whether it is due, and since when."""
    codes = now.select("courier_code").unionByName(before.select("courier_code"))
    codes = codes.unionByName(waiting.select("courier_code")).where("courier_code IS NOT NULL").distinct()
    known = before.select("courier_code", F.col("due").alias("was"), "since")
    states = codes.join(now.withColumn("due", F.lit(True)), "courier_code", "left").join(known, "courier_code", "left")
    is_due = F.coalesce("due", F.lit(False))
    since = F.when(F.col("was") == is_due, F.col("since")).otherwise(F.lit(number).cast("bigint"))
    return states.select("courier_code", is_due.alias("due"), since.alias("since"))


def take_batch(c: Catalog, batch: DataFrame, number: int, folder: str) -> None:
    """Writes one batch: the manifests taken, their cells and windows, and what goes on waiting."""
    spark = c.spark
    here = f"batch={number}"
    last = f"batch={number - 1}"
    now = mailed_couriers(c.couriers)
    before = _stored(spark, COURIERS, f"{folder}/couriers/{last}")

    raised = batch.where("is_email_sent = 1").dropDuplicates(["id"]).select("id", "created", "courier_code")
    raised = _written(raised, MANIFEST, f"{folder}/raised/{here}")
    unseen = _unseen(raised, number, folder)
    new = raised.join(unseen.withColumnRenamed("id", "fresh"), F.col("id").eqNullSafe(F.col("fresh")), "left_semi")
    waiting = _stored(spark, MANIFEST, f"{folder}/open/{last}")
    pending = new.unionByName(waiting).unionByName(_released(spark, now, before, number, folder))
    flagged = pending.join(now.withColumn("due", F.lit(True)), "courier_code", "left")
    flagged = flagged.select("id", "created", "courier_code", F.coalesce("due", F.lit(False)).alias("due"))
    pending = _written(flagged, PENDING, f"{folder}/pending/{here}")

    ready = pending.where("due").drop("due")
    lines = _written(manifest_lines(c, ready), LINES, f"{folder}/lines/{here}")
    cells = long_form(export_lines(c, lines, constants=True))
    cells.write.mode("overwrite").parquet(f"{folder}/cells/{here}")
    start = F.expr("date_trunc('HOUR', manifest_created) + make_dt_interval(0, 0, 10 * floor(minute(manifest_created) / 10))")
    windows = lines.select(
        "manifest_id", start.cast("timestamp_ntz").alias("window_start"), "courier_code", "warehouse"
    )
    windows.distinct().write.mode("overwrite").parquet(f"{folder}/windows/{here}")

    taken = lines.select(F.col("manifest_id").alias("id")).distinct()
    ready.join(taken, "id", "left_anti").write.mode("overwrite").parquet(f"{folder}/open/{here}")
    parked = pending.where(~F.col("due")).drop("due")
    placed = parked.withColumn("place", F.concat(F.lit(PLACE), "courier_code"))
    placed.write.partitionBy("place").mode("overwrite").parquet(f"{folder}/parked/{here}")
    states = _courier_states(now, before, parked, number)
    states.write.mode("overwrite").parquet(f"{folder}/couriers/{here}")


def _owner(spark: SparkSession, folder: str, checkpoint: str) -> None:
    """Binds an output folder to one stream, so that no other progress ever writes into it."""
    stream = spark.read.text(f"{checkpoint}/metadata").first()[0]
    bound = _stored(spark, "stream STRING", f"{folder}/owner").first()
    if bound is None:
        spark.createDataFrame([(stream,)], "stream STRING").coalesce(1).write.mode("overwrite").parquet(f"{folder}/owner")
    elif bound["stream"] != stream:
        raise ValueError(f"{folder} was written by another stream; give this progress folder an output folder of its own")


def run_stream(
    c: Catalog, source: DataFrame, folder: str, checkpoint: str, changes: DataFrame | None = None
) -> StreamingQuery:
    """Works off what has arrived since the last run. Both folders must be shared by all executors.

    The source's own options bound how many files a batch takes. ``changes`` is a stream of courier
    rows (``code``) that starts a batch when couriers change, even if no manifest arrives with them;
    without it waiting manifests go with the next ones that do. A progress folder and an output folder
    belong together: a batch stops if the output is another stream's.
    """
    columns = ("id", "created", "courier_code", "is_email_sent")
    source = source.select(*columns)
    if changes is not None:
        kinds = {field.name: field.dataType for field in source.schema.fields}
        nudge = {"courier_code": F.col("code")}
        source = source.unionByName(
            changes.select(*[nudge.get(name, F.lit(None)).cast(kinds[name]).alias(name) for name in columns])
        )

    def take(batch: DataFrame, number: int) -> None:
        _owner(c.spark, folder, checkpoint)
        take_batch(c, batch, number, folder)

    return (
        source.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def cells_written(spark: SparkSession, folder: str) -> DataFrame:
    """The filled templates of all batches, one row per cell; serial numbers run per batch."""
    return spark.read.schema(CELLS).parquet(f"{folder}/cells")


def windows_written(spark: SparkSession, folder: str) -> DataFrame:
    """Manifests per ten-minute window, courier and warehouse, from what the stream has taken so far."""
    written = spark.read.schema(WINDOWS).parquet(f"{folder}/windows")
    return written.groupBy("window_start", "courier_code", "warehouse").agg(F.countDistinct("manifest_id").alias("manifests"))


def manifests_waiting(spark: SparkSession, folder: str) -> DataFrame:
    """Manifests not mailed yet: those without lines and those of couriers that are not due.

    ``reason`` is ``no lines`` or ``courier``; rows without a courier wait for ever, as ``courier``.
    """
    states = spark.read.schema(f"{COURIERS}, batch BIGINT").parquet(f"{folder}/couriers")
    final = states.agg(F.max("batch").alias("batch"))
    opened = _stored(spark, f"{MANIFEST}, batch BIGINT", f"{folder}/open").join(final, "batch")
    parked = _stored(spark, f"{MANIFEST}, batch BIGINT", f"{folder}/parked").withColumnRenamed("batch", "at")
    resting = states.join(final, "batch").where(~F.col("due")).select("courier_code", "since")
    live = parked.join(resting, "courier_code", "left").where("at >= since OR courier_code IS NULL")
    return opened.select("id", "created", "courier_code", F.lit("no lines").alias("reason")).unionByName(
        live.select("id", "created", "courier_code", F.lit("courier").alias("reason"))
    )
