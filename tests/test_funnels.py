from datetime import date

from retrolane.clock import Clock
from retrolane.plans.cohorts import rpr_cohort_putaway, rpr_cohort_qc, rpr_cohort_staging, rpr_cohort_summary
from retrolane.plans.funnels import (
    daily_summary,
    putaway_and_rtv,
    rms_daily_funnel,
    rpi_report,
    side_by_side,
    wms_daily_flow,
    wms_daily_flow_to_now,
)
from retrolane.plans.operations import full_boxes, report_recipients, tracking_numbers_left
from tests.conftest import at, dicts

CLOCK = Clock.at("2014-10-18 12:00")
DAY = at("2014-10-17 09:00")


def change(previous, new, when=DAY, **more):
    return {"previous_status_code": previous, "next_status_code": new, "created": when} | more


def test_only_real_status_changes_count(make):
    c = make(
        crp=[{"id": 1, "created": DAY}],
        crp_history=[change("NEW", "RPR", crp_id=1), change("RPR", "RPR", crp_id=1), change(None, "RPR", crp_id=1)],
        cri_history=[change("RPR", "PDC", cri_id=1), change("PDC", "PDC", cri_id=1), change("RPR", "REJ", cri_id=1)],
    )
    assert dicts(rms_daily_funnel(c, CLOCK)) == [
        {"date": date(2014, 10, 17), "total_rpi": 1, "total_rpr": 1, "total_qc": 1}
    ]


def test_days_follow_the_initiated_packages(make):
    c = make(crp=[{"id": 1, "created": DAY}], crp_history=[change("NEW", "RPR", at("2014-10-16 09:00"), crp_id=1)])
    assert [(row["date"].day, row["total_rpr"]) for row in dicts(rms_daily_funnel(c, CLOCK))] == [(17, 0)]


def test_gate_passes_reach_one_day_further_but_need_a_putaway_day(make):
    c = make(
        inventory=[{"id": 1, "status": "RTV", "created": DAY}, {"id": 2, "status": None, "created": DAY}],
        gate_pass=[{"barcode": "B", "created": DAY}, {"barcode": "B", "created": at("2014-10-11")}],
    )
    assert dicts(wms_daily_flow_to_now(c, CLOCK)) == [
        {"date": date(2014, 10, 17), "total_putaway": 2, "total_returns": 1, "total_gatepass": 1,
         "total_liquidation": 0}
    ]


def test_sides_join_on_the_day_not_on_position(spark):
    left = spark.createDataFrame([(date(2014, 10, 1), 1), (date(2014, 10, 3), 3)], "date DATE, a BIGINT")
    right = spark.createDataFrame([(date(2014, 10, 2), 2), (date(2014, 10, 3), 9)], "date DATE, b BIGINT")
    rows = sorted((row["date"].day, row["a"], row["b"]) for row in side_by_side(left, right).collect())
    assert rows == [(1, 1, 0), (3, 3, 9)]


def test_rpi_report_fills_missing_days_with_zero(make):
    rows = dicts(rpi_report(make(crp=[{"id": 1, "created": DAY}]), CLOCK))
    assert rows[0]["total_putaway"] == 0 and rows[0]["total_rpi"] == 1


def stock():
    return dict(
        inventory=[
            {"id": 1, "barcode": "B1", "rule_id": 1, "is_bulk_rule": 0, "status": "RTV", "created": DAY},
            {"id": 2, "barcode": "B2", "rule_id": 1, "is_bulk_rule": 1, "status": "IN", "created": DAY},
            {"id": 3, "barcode": "B3", "rule_id": 1, "is_bulk_rule": None, "status": "IN", "created": DAY},
            {"id": 4, "barcode": "B4", "rule_id": 2, "is_bulk_rule": 0, "status": "RTV", "created": DAY},
        ],
        rules=[{"id": 1, "rule_name": "LIQUIDATE now"}, {"id": 2, "rule_name": "soi - non faulty"}],
        bulk_upload_rules=[{"id": 1, "rule_name": "x courier debit"}],
        rtv_sheet_detail=[{"id": 10, "updated": DAY}, {"id": 11, "updated": DAY}],
        rtv_sheet_detail_inventory=[
            {"rtv_sheet_detail_id": 10, "product_details_id": 1}, {"rtv_sheet_detail_id": 11, "product_details_id": 1},
            {"rtv_sheet_detail_id": 11, "product_details_id": 2}, {"rtv_sheet_detail_id": 99, "product_details_id": 3},
        ],
    )


def test_flow_counts_rules_and_distinct_dispatches(make):
    assert dicts(wms_daily_flow(make(**stock()), CLOCK)) == [
        {"date": date(2014, 10, 17), "total_putaway": 4, "hold_45_days": 1, "soi_non_faulty": 1, "courier_debit": 1,
         "total_dispatch": 1}
    ]


def test_putaway_and_rtv_counts_existing_sheets_only(make):
    assert dicts(putaway_and_rtv(make(**stock()), CLOCK)) == [
        {"putaway_date": date(2014, 10, 17), "total_putaway": 4, "total_rtv_initiated": 2, "total_rtv_completed": 2,
         "pending": 0}
    ]


def test_daily_summary_without_stock(make):
    rows = dicts(daily_summary(make(crp=[{"id": 1, "created": DAY}]), CLOCK))
    assert rows[0]["total_putaway"] == rows[0]["total_dispatch"] == 0


def cohort():
    return stock() | dict(
        crp=[{"id": 1}],
        cri=[{"id": 1, "code": "B1", "crp_id": 1}, {"id": 2, "code": "lost", "crp_id": 1},
             {"id": 3, "code": None, "crp_id": 1}, {"id": 4, "code": "B4", "crp_id": 1}],
        crp_history=[change("NEW", "RPR", crp_id=1)],
        cri_history=[change("RPR", "PDC", cri_id=1, status_date=DAY), change("REJ", "PDC", cri_id=1, status_date=DAY),
                     change("RPR", "PDC", cri_id=2, status_date=None)],
    )


def test_cohort_staging_leaves_out_items_without_code(make):
    assert sorted(row["barcode"] for row in dicts(rpr_cohort_staging(make(**cohort()), CLOCK))) == ["B1", "B4", "lost"]


def test_cohort_qc_counts_rows_and_dated_checks(make):
    assert dicts(rpr_cohort_qc(make(**cohort()), CLOCK)) == [
        {"date": date(2014, 10, 17), "total_rpr": 5, "total_qc": 2, "pct_qc": 40}
    ]


def test_cohort_putaway_counts_items_not_found_in_the_share_only(make):
    assert dicts(rpr_cohort_putaway(make(**cohort()), CLOCK)) == [
        {"date": date(2014, 10, 17), "total_putaway": 2, "hold_45_days": 1, "soi_non_faulty": 1, "courier_debit": 0,
         "total_returns": 2, "pct_rtv": 67}
    ]
    assert rpr_cohort_summary(make(**cohort()), CLOCK).count() == 1


def test_empty_cohort_gives_no_rows(make):
    assert rpr_cohort_putaway(make(), CLOCK).count() == 0


def test_stock_checks(make):
    c = make(
        boxes=[{"box_name": "A-1", "capacity": 5, "used": 5, "warehouse_id": 1},
               {"box_name": "A-2", "capacity": 5, "used": 4, "warehouse_id": 1},
               {"box_name": "A-3", "capacity": 5, "used": 5, "warehouse_id": 9}],
        warehouse=[{"id": 1, "name": "One"}],
        tracking_numbers=[{"courier_code": "x", "tracking_number": str(n), "is_used": n % 2} for n in range(5)]
        + [{"courier_code": "x", "tracking_number": None, "is_used": 0},
           {"courier_code": "y", "tracking_number": "1", "is_used": 0}],
        couriers=[{"code": "x", "enabled": 1}, {"code": "y", "enabled": 0}],
        reports=[{"name": "rpi", "to_email": "a@b.example"}],
    )
    assert [tuple(row) for row in full_boxes(c).collect()] == [("A", "A-1", 5, 5, "One")]
    assert [tuple(row) for row in tracking_numbers_left(c).collect()] == [("x", 3)]
    assert [tuple(row) for row in report_recipients(c, "RPI").collect()] == [("a@b.example",)]
