import random

from pyspark.sql import functions as F

from retrolane.clock import Clock
from retrolane.functions.labels import Sites
from retrolane.functions.metrics import bucket_names, item_buckets
from retrolane.operators.readthrough import QUALITY_CHECK, RECEIPT
from retrolane.operators.totals import per_item_with_total
from retrolane.plans.turnaround import (
    cache_additions,
    rpr_to_qc_summary,
    to_dispatch_detail,
    to_dispatch_summary,
    with_refreshed_cache,
)
from retrolane.sinks.files import append_cache
from retrolane.sources.catalog import from_parquet
from retrolane.sources.schemas import TABLES
from tests.conftest import at, dicts

CLOCK = Clock.at("2014-10-18 12:00")
SITES = Sites(main_at_two=("ann",), delhi_detail=("ann",), qc_second=("sid",))


def tables():
    sent = at("2014-10-16 20:00")
    numbers = (1, 2, 3, 4)
    return dict(
        inventory=[
            {"id": n, "barcode": f"B{n}", "suborder_code": f"S{n}", "status": "RTV", "warehouse_id": 2} for n in numbers
        ]
        + [{"id": 9, "barcode": "B9", "suborder_code": "S9", "status": "IN", "warehouse_id": 2}],
        rtv_sheet_detail=[{"id": 10, "updated": sent, "warehouse_id": 1, "updated_by_id": 1}],
        rtv_sheet_detail_inventory=[
            {"rtv_sheet_detail_id": 10, "product_details_id": n} for n in (*numbers, 9)
        ],
        users=[{"id": 1, "username": "ann"}],
        warehouse=[{"id": 1, "code": None}],
        # B1 cached twice, B2 cached without a date, B3 in history only, B4 nowhere
        qc=[{"barcode": "B1", "qc_date_time": at("2014-10-15")}, {"barcode": "B1", "qc_date_time": at("2014-10-10")},
            {"barcode": "B2", "qc_date_time": None}],
        cri=[{"id": n, "code": f"B{n}", "crp_id": 1, "cc_id": 1} for n in (1, 2, 3)],
        crp=[{"id": 1, "updated_by": "sid"}],
        cc=[{"id": 1}],
        cri_history=[
            {"cri_id": 2, "created": at("2014-10-14"), "previous_status_code": "RPR", "next_status_code": "PDC"},
            {"cri_id": 3, "created": at("2014-10-13"), "previous_status_code": "REJ", "next_status_code": "PDC"},
            {"cri_id": 3, "created": at("2014-10-12"), "previous_status_code": "RPR", "next_status_code": "PDC"},
            {"cri_id": 3, "created": at("2014-10-01"), "previous_status_code": None, "next_status_code": "PDC"},
        ],
        crp_history=[
            {"crp_id": 1, "created": at("2014-10-11"), "previous_status_code": "NEW", "next_status_code": "RPR"}
        ],
    )


def test_detail_reads_cache_then_history_then_nothing(make):
    rows = dicts(to_dispatch_detail(make(**tables()), CLOCK, SITES, QUALITY_CHECK))
    found = sorted((row["suborder_code"], str(row["qc_date_time"]), row["warehouse"]) for row in rows)
    assert found == [
        ("S1", "2014-10-10 00:00:00", "Delhi WH"), ("S1", "2014-10-15 00:00:00", "Delhi WH"),
        ("S2", "2014-10-14 00:00:00", "Delhi WH"), ("S3", "2014-10-12 00:00:00", "Delhi WH"),
        ("S4", "None", "Delhi WH"),
    ]


def test_every_history_row_of_a_missing_barcode_is_added(make):
    rows = dicts(cache_additions(make(**tables()), CLOCK, QUALITY_CHECK))
    assert sorted((row["barcode"], row["qc_date_time"].day) for row in rows) == [("B2", 14), ("B3", 12), ("B3", 13)]


def test_receipt_dates_come_from_the_package(make):
    rows = dicts(to_dispatch_detail(make(**tables()), CLOCK, SITES, RECEIPT))
    dates = {row["suborder_code"]: row["rpr_date_time"] for row in rows}
    assert dates == {"S1": at("2014-10-11"), "S2": at("2014-10-11"), "S3": at("2014-10-11"), "S4": None}


def test_second_run_appends_nothing_and_agrees(spark, make, tmp_path):
    data = tables()
    data["qc"] = [row for row in data["qc"] if row["qc_date_time"]]
    memory = make(**data)
    for name in TABLES:
        getattr(memory, name).write.parquet(f"{tmp_path}/{name}")
    stored = from_parquet(spark, str(tmp_path))
    before = sorted(map(str, dicts(to_dispatch_summary(with_refreshed_cache(stored, CLOCK, QUALITY_CHECK), CLOCK, SITES, QUALITY_CHECK))))
    append_cache(cache_additions(stored, CLOCK, QUALITY_CHECK), f"{tmp_path}/qc")
    again = from_parquet(spark, str(tmp_path))
    assert cache_additions(again, CLOCK, QUALITY_CHECK).count() == 0
    append_cache(cache_additions(again, CLOCK, QUALITY_CHECK), f"{tmp_path}/qc")
    third = from_parquet(spark, str(tmp_path))
    assert third.qc.count() == 5
    assert sorted(map(str, dicts(to_dispatch_summary(third, CLOCK, SITES, QUALITY_CHECK)))) == before


def test_summary_buckets_distinct_items(make):
    c = with_refreshed_cache(make(**tables()), CLOCK, QUALITY_CHECK)
    rows = {row["warehouse"]: row for row in dicts(to_dispatch_summary(c, CLOCK, SITES, QUALITY_CHECK))}
    assert set(rows) == {"Delhi Nuvo WH", "total"}
    # days from check to dispatch: B1 1 and 6, B2 2, B3 4 and 3
    total = rows["total"]
    assert total["total_dispatch"] == 3
    shares = [total[f"pct_{name}"] for name in bucket_names()]
    assert shares == [33.3, 66.7, 100.0, 100.0, 33.3]


def test_summary_keeps_a_total_when_nothing_was_dispatched(make):
    rows = dicts(to_dispatch_summary(make(), CLOCK, SITES, QUALITY_CHECK))
    assert [(row["warehouse"], row["total_dispatch"], row["pct_within_1_day"]) for row in rows] == [("total", 0, None)]


def test_missing_warehouse_code_is_not_the_total(make):
    data = tables() | {"users": []}
    c = make(**data)
    rows = dicts(to_dispatch_summary(c, CLOCK, SITES, QUALITY_CHECK))
    assert sorted((str(row["warehouse"]), row["total_dispatch"]) for row in rows) == [("None", 1), ("total", 1)]


def test_row_summary_has_no_total_when_empty(make):
    assert rpr_to_qc_summary(make(), CLOCK, SITES).count() == 0


def test_row_summary_counts_every_pair(make):
    data = tables()
    for row in data["cri_history"]:
        row["status_date"] = row["created"]
    rows = dicts(rpr_to_qc_summary(make(**data), CLOCK, SITES))
    assert [(row["qc_warehouse"], row["total_qc"], row["within_1_day"], row["pct_within_2_day"]) for row in rows] == [
        ("Delhi SD WH", 3, 1, 66.7), ("Total", 3, 1, 66.7),
    ]


def test_two_stage_buckets_equal_conditional_distinct_counts(spark):
    """Against brute force, with one label and one item holding a third of the rows each."""
    draw = random.Random(7)
    rows = []
    for _ in range(3000):
        label = "hot" if draw.random() < 0.34 else draw.choice(["a", "b", None])
        item = 1 if draw.random() < 0.34 else draw.randrange(400)
        rows.append((label, item, draw.choice([None, *range(-1, 9)])))
    df = spark.createDataFrame(rows, "label STRING, item BIGINT, elapsed INT")
    per_item = per_item_with_total(
        df, "label", ["item"], F.min("elapsed").alias("shortest"), F.max("elapsed").alias("longest")
    )
    result = per_item.groupBy("is_total", "label").agg(F.count("*").alias("n"), *item_buckets("shortest", "longest"))
    found = {(row["is_total"], row["label"]): tuple(row[2:]) for row in result.collect()}

    def brute(chosen):
        def distinct(test):
            return len({item for _, item, gap in chosen if gap is not None and test(gap)})

        everything = len({item for _, item, _ in chosen})
        return (everything, *[distinct(lambda gap, k=k: gap <= k) for k in (1, 2, 3, 5)], distinct(lambda gap: gap > 5))

    expected = {(0, label): brute([row for row in rows if row[0] == label]) for label in ("hot", "a", "b", None)}
    expected[(1, None)] = brute(rows)
    assert found == expected
