from datetime import timedelta

import pytest

from retrolane.session import shared_folder
from retrolane.streaming.on_print import (
    cells_written,
    manifests_waiting,
    run_stream,
    take_batch,
    windows_written,
)
from tests.conftest import at

SCHEMA = "id BIGINT, created TIMESTAMP_NTZ, updated TIMESTAMP_NTZ, courier_code STRING, is_email_sent INT"
START = at("2024-01-01 00:00")
TEMPLATE = "<Columns><Column><Title>No</Title><Map>sno</Map></Column><Column><Title>Fix</Title><Map>x</Map><Value>K</Value></Column></Columns>"
COURIERS = [
    {"code": "c0", "enabled": 1, "soft_data_template": TEMPLATE},
    {"code": "c1", "enabled": 1, "soft_data_template": TEMPLATE},
    {"code": "c2", "enabled": 0, "soft_data_template": TEMPLATE},
    {"code": "c3", "enabled": 1, "soft_data_template": ""},
]


def rows(first, last):
    return [(n, START + timedelta(minutes=n), None, f"c{n % 4}", int(n % 5 > 0)) for n in range(first, last)]


def wanted(data):
    return [row for row in data if row[4] == 1 and row[3] in ("c0", "c1")]


def expected(data):
    out = {}
    for n, created, _, courier, _ in {row[0]: row for row in wanted(data)}.values():
        start = created - timedelta(minutes=created.minute % 10)
        key = (str(start), courier, f"w{n % 3}")
        out[key] = out.get(key, 0) + 1
    return out


@pytest.fixture()
def tables(make):
    numbers = range(400)
    return make(
        couriers=COURIERS,
        manifest_rtv_sheet_detail=[{"manifest_id": n, "rtv_sheet_id": n} for n in numbers],
        rtv_sheet_detail=[{"id": n, "warehouse_id": n % 3} for n in numbers],
        warehouse=[{"id": n, "name": f"w{n}"} for n in range(3)],
    )


@pytest.fixture()
def feed(spark, tables, tmp_path):
    source, out, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))

    def run(data, option=100):
        if data:
            spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", option).parquet(source)
        run_stream(tables, stream, out, progress).awaitTermination()
        return out

    return run


def counted(df):
    return {(str(r["window_start"]), r["courier_code"], r["warehouse"]): r["manifests"] for r in df.collect()}


def test_each_manifest_is_taken_once_and_late_ones_are_not_lost(spark, feed):
    out = feed(rows(200, 300))
    assert counted(windows_written(spark, out)) == expected(rows(200, 300))
    # hours older ones, some seen before, and repeated rows: all new ones are added
    feed(rows(100, 150) + rows(190, 210) + rows(100, 110), option=1)
    everything = rows(100, 150) + rows(190, 300)
    assert counted(windows_written(spark, out)) == expected(everything)
    cells = cells_written(spark, out)
    assert cells.where("title = 'No'").count() == len(wanted(everything))
    assert {r["value"] for r in cells.where("title = 'Fix'").collect()} == {"K"}
    # nothing new: nothing added
    feed([])
    assert counted(windows_written(spark, out)) == expected(everything)


def test_a_batch_that_runs_again_adds_nothing(spark, tables, tmp_path):
    out = str(tmp_path / "out")
    for number, part in [(0, rows(0, 20)), (1, rows(10, 30)), (1, rows(10, 30))]:
        take_batch(tables, spark.createDataFrame(part, SCHEMA), number, out)
    assert counted(windows_written(spark, out)) == expected(rows(0, 30))


def swapped(make, tables, **changed):
    """The test tables with some of them changed."""
    kept = {name: [row.asDict() for row in getattr(tables, name).collect()] for name in
            ("couriers", "manifest_rtv_sheet_detail", "rtv_sheet_detail", "warehouse")}
    return make(**{**kept, **changed})


def with_courier(code, enabled):
    return [{**courier, "enabled": enabled} if courier["code"] == code else courier for courier in COURIERS]


def ids(df):
    return sorted(row["id"] for row in df.collect())


def test_manifests_wait_until_their_courier_is_due(spark, make, tables, tmp_path):
    source, out, progress, news = (str(tmp_path / name) for name in ("in", "out", "progress", "news"))

    def run(c, data, changed=None):
        for rows_in, schema, folder in ((data, SCHEMA, source), (changed, "code STRING", news)):
            if rows_in:
                spark.createDataFrame(rows_in, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        changes = spark.readStream.schema("code STRING").parquet(news)
        run_stream(c, stream, out, progress, changes).awaitTermination()

    def done():
        return sorted(r["id"] for r in spark.read.parquet(f"{out}/windows").selectExpr("manifest_id AS id").collect())

    of_c2 = [(n, START, None, "c2", 1) for n in (2, 6, 10, 14, 18)]
    spark.createDataFrame([("c2",)], "code STRING").write.parquet(news)
    run(tables, of_c2 + [(4, START, None, "c0", 1), (8, START, None, None, 1), (12, START, None, "", 1)])
    assert done() == [4]
    assert ids(manifests_waiting(spark, out)) == [2, 6, 8, 10, 12, 14, 18]
    enabled = swapped(make, tables, couriers=with_courier("c2", 1))
    run(enabled, [(22, START, None, "c2", 1), (26, START, None, "c2", 1), (2, START, None, "c2", 1)])
    assert done() == [2, 4, 6, 10, 14, 18, 22, 26]
    # off again: new ones wait; a change alone, without a manifest, releases just these
    run(tables, [(30, START, None, "c2", 1), (22, START, None, "c2", 1)])
    run(tables, [(34, START, None, "c2", 1)])
    assert ids(manifests_waiting(spark, out)) == [8, 12, 30, 34]
    run(enabled, [], changed=[("c2",)])
    assert done() == [2, 4, 6, 10, 14, 18, 22, 26, 30, 34]
    assert [r["reason"] for r in manifests_waiting(spark, out).collect()] == ["courier", "courier"]
    run(swapped(make, tables, couriers=[*COURIERS, {"code": "", "enabled": 1, "soft_data_template": TEMPLATE}]), [], [("",)])
    assert 12 in done() and ids(manifests_waiting(spark, out)) == [8]


def test_manifests_wait_for_their_lines(spark, make, tables, tmp_path):
    out = str(tmp_path / "out")
    batch = spark.createDataFrame(rows(0, 20), SCHEMA)
    nothing = batch.limit(0)
    bare = swapped(make, tables, manifest_rtv_sheet_detail=[])
    take_batch(bare, batch, 0, out)
    assert counted(windows_written(spark, out)) == {}
    take_batch(bare, nothing, 1, out)
    disabled = swapped(make, tables, couriers=with_courier("c0", 0), manifest_rtv_sheet_detail=[])
    take_batch(disabled, nothing, 2, out)  # those of c0 move to the parked ones
    take_batch(tables, nothing, 3, out)
    take_batch(tables, nothing, 4, out)
    assert counted(windows_written(spark, out)) == expected(rows(0, 20))
    assert cells_written(spark, out).where("title = 'No'").count() == len(wanted(rows(0, 20)))


def test_a_batch_reads_only_the_buckets_of_its_ids(spark, tables, tmp_path, monkeypatch):
    from retrolane.streaming import on_print

    read = []
    stored = on_print._stored

    def spy(session, schema, path, base=None):
        df = stored(session, schema, path, base)
        if "/seen" in path:
            read.append(sum(len(part) for part in [df.inputFiles()]))
        return df

    monkeypatch.setattr(on_print, "_stored", spy)
    monkeypatch.setattr(on_print, "BUCKET_IDS", 10)
    out = str(tmp_path / "out")
    for number in range(8):
        take_batch(tables, spark.createDataFrame(rows(10 * number, 10 * number + 10), SCHEMA), number, out)
    assert read == [0, 1] * 8  # no file of earlier batches, then the batch's own one
    read.clear()
    take_batch(tables, spark.createDataFrame(rows(35, 45), SCHEMA), 8, out)
    assert read[0] == 2
    monkeypatch.setattr(on_print, "MOST_BUCKETS", 2)
    take_batch(tables, spark.createDataFrame(rows(0, 100), SCHEMA), 9, out)
    assert counted(windows_written(spark, out)) == expected(rows(0, 100))


def test_an_output_folder_belongs_to_one_progress_folder(spark, tables, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(rows(0, 20), SCHEMA).write.parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    run_stream(tables, stream, out, str(tmp_path / "first")).awaitTermination()
    with pytest.raises(Exception, match="another stream"):
        run_stream(tables, stream, out, str(tmp_path / "second")).awaitTermination()
    assert counted(windows_written(spark, out)) == expected(rows(0, 20))


def test_a_cluster_must_name_its_shared_folder():
    class Session:
        class conf:
            @staticmethod
            def get(name, default=None):
                return {"spark.master": "yarn"}.get(name, default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session)
