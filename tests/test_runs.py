import glob
import os

import pytest

from retrolane.clock import Clock
from retrolane.operators.digest import PLAIN, head_html
from retrolane.plans import backfill, cohorts, mails
from retrolane.sinks import titles
from retrolane.sinks.files import overwrite_partitions
from retrolane.sinks.runs import Run, bodies, committed, mail_recipients
from retrolane.sources.schemas import TABLES
from retrolane.sources.star import TEST_SITES, from_star
from tests.conftest import at, dicts

FOLDER = "/root/testdata/sf0.001"
DAY = Clock.at("1998-09-01 12:00:00")


def test_a_run_shows_all_its_outputs_once_it_is_committed(spark, tmp_path):
    c = from_star(spark, FOLDER)
    root = str(tmp_path / "reports")
    assert committed(spark, root).count() == bodies(spark, root).count() == 0
    with Run(spark, root, DAY) as run:
        run.listing("RPI", spark.createDataFrame([(1, None)], "a_b INT, c STRING"))
        run.body("RPI", mails.rpi_body(c, DAY))
        run.recipients("Site Mail", mails.site_recipients(c))
        run.body("Site Mail", mails.site_mail(c, DAY, TEST_SITES))
        assert committed(spark, root).count() == bodies(spark, root).count() == 0
    outputs = dicts(committed(spark, root))
    assert {(row["report"], row["kind"]) for row in outputs} == {
        ("RPI", "listing"), ("RPI", "body"), ("Site Mail", "recipients"), ("Site Mail", "body"),
    }
    listing = next(row["place"] for row in outputs if row["kind"] == "listing")
    assert "run_ts=01_09_1998_12_00_00" in listing
    assert open(glob.glob(f"{listing}/*.csv")[0]).read() == "A B,C\n1,\n"
    assert bodies(spark, root).where("report = 'Site Mail'").select("mail").distinct().count() == 6
    assert mail_recipients(spark, root).where("report = 'Site Mail'").count() == 6


def test_a_run_that_dies_leaves_nothing_visible(spark, tmp_path):
    root = str(tmp_path)
    with Run(spark, root, DAY) as run:
        run.recipients("A", spark.createDataFrame([("x", "a@b")], "mail STRING, to_email STRING"))
    with pytest.raises(RuntimeError), Run(spark, root, DAY) as run:
        run.recipients("A", spark.createDataFrame([("y", "a@b")], "mail STRING, to_email STRING"))
        run.listing("B", spark.range(3))
        raise RuntimeError("executor lost")
    assert [row["mail"] for row in mail_recipients(spark, root).collect()] == ["x"]
    with Run(spark, root, DAY) as run:  # the same time again: a run of its own
        run.recipients("A", spark.createDataFrame([("y", "a@b")], "mail STRING, to_email STRING"))
    assert sorted(row["mail"] for row in mail_recipients(spark, root).collect()) == ["x", "y"]


def test_every_report_has_as_many_titles_as_columns(spark):
    c = from_star(spark, FOLDER)
    from retrolane.operators.readthrough import QUALITY_CHECK
    from retrolane.plans import couriers, funnels, listings, operations, turnaround

    since = at("1997-01-01")
    for rows, heads in [
        (listings.rule_listing(c, listings.ELECTRONICS_RULE, since), titles.RULE_LISTING),
        (listings.liquidation_listing(c, since), titles.LIQUIDATION),
        (listings.putaway_master(c, DAY), titles.PUTAWAY_MASTER),
        (listings.rtv_data(c, DAY), titles.RTV_DATA),
        (operations.full_boxes(c), titles.FULL_BOXES),
        (operations.tracking_numbers_left(c), titles.TRACKING_NUMBERS),
        (funnels.putaway_and_rtv(c, DAY), titles.PUTAWAY_AND_RTV),
        (funnels.rpi_report(c, DAY), titles.RPI),
        (funnels.daily_summary(c, DAY), titles.DAILY_SUMMARY),
        (turnaround.to_dispatch_detail(c, DAY, TEST_SITES, QUALITY_CHECK), titles.to_dispatch_detail("QC Date")),
        (turnaround.to_dispatch_summary(c, DAY, TEST_SITES, QUALITY_CHECK), titles.TO_DISPATCH_SUMMARY),
        (turnaround.rpr_to_qc_summary(c, DAY, TEST_SITES), titles.RPR_TO_QC),
        (cohorts.rpr_cohort_summary(c, DAY), titles.COHORT_SUMMARY),
        (cohorts.warehouse_rpr_summary(c, DAY, TEST_SITES).drop("warehouse"), titles.SITE_SUMMARY),
        (cohorts.warehouse_putaway_returns(c, DAY, TEST_SITES).drop("warehouse"), titles.SITE_FLOW),
        (couriers.courier_wise_rtv(c, DAY), titles.COURIER_DAYS),
    ]:
        assert len(rows.columns) == len(heads), heads


def test_a_mail_shows_the_heads_of_empty_tables(make):
    c = make(reports=[{"name": mails.SITE_REPORT, "to_email": "ops"}],
             report_sites=[{"name": mails.SITE_REPORT, "site": "Bang WH", "to_email": email} for email in ("b", "a")]
             + [{"name": "Other", "site": "Hyd WH", "to_email": "z"}])
    rows = dicts(mails.site_mail(c, DAY, TEST_SITES).orderBy("mail", "section", "part"))
    assert len(rows) == 6 * 4
    bang = "".join(row["body_html"] for row in rows if row["mail"] == "Bang WH")
    assert bang.startswith("<br><h2>Reports from 25-08-1998 to 31-08-1998</h2><br><br><strong>Bang WH Summary Report.</strong><br>")
    assert bang.endswith(
        "<br><br><strong>Courier Wise Dispatch Report of Bang WH.</strong><br>" + head_html(titles.COURIER_DAYS, PLAIN) + "</table>"
    )
    addresses = {row["mail"]: row["to_email"] for row in dicts(mails.site_recipients(c))}
    assert addresses["Bang WH"] == "a,b,ops" and addresses["Hyd WH"] == "ops" and len(addresses) == 6


def test_pages_are_wrapped_once_around_all_parts(spark):
    parts = spark.createDataFrame([("r", 0, 2, "<table>a"), ("r", 1, 2, "b</table>")], "report STRING, part INT, parts INT, body_html STRING")
    text = "".join(row["body_html"] for row in mails.page(parts).orderBy("part").collect())
    assert text == "<html><body><table>ab</table></body></html>"


def test_a_stored_cohort_gives_the_same_reports_and_needs_no_shuffle_by_barcode(spark):
    c = from_star(spark, FOLDER)
    days = 400
    cohort = cohorts.store_cohort(c, DAY, days, buckets=8)
    for report, args in [
        (cohorts.rpr_cohort_qc, ()), (cohorts.rpr_cohort_putaway, ()), (cohorts.rpr_cohort_summary, ()),
        (cohorts.warehouse_rpr_cohort_qc, (TEST_SITES,)), (cohorts.warehouse_rpr_cohort_putaway, (TEST_SITES,)),
        (cohorts.warehouse_rpr_summary, (TEST_SITES,)),
    ]:
        fresh = report(c, DAY, *args, days)
        assert fresh.count() > 0
        assert sorted(map(str, report(c, DAY, *args, days, cohort).collect())) == sorted(map(str, fresh.collect())), report
    plan = cohorts.distinct_keys(cohort, "barcode")._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan


def test_only_touched_partitions_are_written(spark, make, tmp_path):
    c = make(
        inventory=[{"id": 1, "barcode": "B1", "warehouse_id": 1}, {"id": 2, "barcode": "B2", "warehouse_id": 1, "customer_name": "old"},
                   {"id": 3, "barcode": "B3", "warehouse_id": 2, "customer_name": "kept"}, {"id": 4, "barcode": "B4", "warehouse_id": 3},
                   {"id": 5, "barcode": "B1", "warehouse_id": None, "customer_name": "Ann"}, {"id": 6, "barcode": None, "warehouse_id": 3}],
        cri=[{"id": 1, "code": "B1", "crp_id": 1}], crp=[{"id": 1, "pickup_detail_id": 1}], pickup_detail=[{"id": 1, "name": "Ann"}],
    )
    folder = str(tmp_path / "inventory")
    c.inventory.write.partitionBy("warehouse_id").parquet(folder)

    def files():
        return {os.path.relpath(path, folder) for path in glob.glob(f"{folder}/*/*.parquet")}

    stored = c.replacing(inventory=spark.read.schema(TABLES["inventory"]).parquet(folder))
    expected = sorted(map(str, backfill.customer_name_fill(c).collect()))
    before = files()
    overwrite_partitions(backfill.customer_name_partitions(stored, "warehouse_id"), folder, ["warehouse_id"])
    after = files()
    assert {path for path in before if "=1/" not in path} == {path for path in after if "=1/" not in path}
    assert before != after
    again = c.replacing(inventory=spark.read.schema(TABLES["inventory"]).parquet(folder))
    assert sorted(map(str, again.inventory.select(*c.inventory.columns).collect())) == expected
    overwrite_partitions(backfill.customer_name_partitions(again, "warehouse_id"), folder, ["warehouse_id"])
    assert files() == after


def test_the_name_fill_shuffles_no_named_rows(spark, make, tmp_path):
    c = make(
        inventory=[{"id": i, "barcode": f"B{i}", "warehouse_id": i % 2, "customer_name": None if i == 7 else "kept"} for i in range(40)]
        + [{"id": 40, "barcode": "B7", "warehouse_id": 5, "customer_name": "old"}, {"id": 41, "barcode": "B7", "warehouse_id": 6, "customer_name": "Ann"}],
        cri=[{"id": 1, "code": "B7", "crp_id": 1}], crp=[{"id": 1, "pickup_detail_id": 1}], pickup_detail=[{"id": 1, "name": "Ann"}],
    )
    for filled, ids in (
        (backfill.customer_name_fill(c), set(range(42))),
        (backfill.customer_name_partitions(c, "warehouse_id"), {i for i in range(40) if i % 2} | {40}),
    ):
        assert "hashpartitioning" not in filled._jdf.queryExecution().executedPlan().toString()
        names = {row["id"]: row["customer_name"] for row in filled.collect()}
        assert names == {i: "Ann" if i in (7, 40, 41) else "kept" for i in ids}


def test_a_partition_is_written_by_the_tasks_that_hold_its_rows(spark, tmp_path):
    folder = str(tmp_path / "table")
    limit = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    rows = spark.range(0, 400, 1, 4).selectExpr("id", "cast(id % 2 AS INT) AS part")
    overwrite_partitions(rows, folder, ["part"])
    overwrite_partitions(rows.where("part = 1"), folder, ["part"])
    assert sorted(spark.read.parquet(folder).collect()) == sorted(rows.collect())
    assert [len(glob.glob(f"{folder}/part={n}/*.parquet")) for n in (0, 1)] == [4, 4]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == limit
