import csv
import glob
import random

import pytest
from pyspark.sql import functions as F

from retrolane.clock import Clock
from retrolane.operators.digest import ESCAPED, PAGE, PLAIN, html_parts
from retrolane.operators.serial import numbered
from retrolane.operators.template import courier_templates, unknown_fields
from retrolane.plans.backfill import customer_name_fill, rpr_backfill
from retrolane.plans.digests import center_digest, center_items, seller_digest, seller_items
from retrolane.plans.manifests import (
    courier_manifest_export,
    courier_table,
    long_form,
    manifest_flags_after,
    manifest_flags_raised,
    manifest_on_print,
)
from retrolane.sinks.files import run_folder, write_csv, write_version
from tests.conftest import at, dicts

CLOCK = Clock.at("2014-10-18 12:00")


def test_serial_numbers_equal_row_number_with_a_hot_group(spark):
    draw = random.Random(3)
    rows = [("hot" if draw.random() < 0.5 else draw.choice("abc"), draw.randrange(300), n) for n in range(2000)]
    df = spark.createDataFrame(rows, "g STRING, k BIGINT, n BIGINT").repartition(8)
    expected = {}
    for group in {row[0] for row in rows}:
        members = sorted(row[1:] for row in rows if row[0] == group)
        expected |= {(group, *member): (place, len(members)) for place, member in enumerate(members, 1)}
    for slices in (1, 7, 64):
        result = numbered(df, ["g"], ["k", "n"], size="total", slices=slices)
        assert {(r["g"], r["k"], r["n"]): (r["sno"], r["total"]) for r in result.collect()} == expected


def test_serial_numbers_of_nothing(spark):
    df = spark.createDataFrame([], "g STRING, k BIGINT")
    assert numbered(df, ["g"], ["k"]).count() == 0


def body(df, **options):
    parts = html_parts(df, "who", ["who", "what"], ["n"], **options)
    rows = sorted(parts.collect(), key=lambda row: (row["who"], row["part"]))
    texts = {}
    for row in rows:
        texts[row["who"]] = texts.get(row["who"], "") + row["body_html"]
    return rows, texts


def test_html_parts_join_to_one_table(spark):
    df = spark.createDataFrame([("a", f"it's {n}", n) for n in range(7)] + [("b", None, 9)], "who STRING, what STRING, n INT")
    rows, texts = body(df, rows_per_part=3)
    assert [(row["who"], row["part"], row["parts"], row["n_rows"]) for row in rows] == [
        ("a", 0, 3, 3), ("a", 1, 3, 3), ("a", 2, 3, 1), ("b", 0, 1, 1),
    ]
    cell = PLAIN.cell
    lines = "".join(f"<tr>{cell}a</td>{cell}its {n}</td></tr>" for n in range(7))
    head = f"{PLAIN.open_table}{PLAIN.open_head}{cell}Who</td>{cell}What</td></tr>"
    assert texts["a"] == head + lines + "</table>"
    assert texts["b"] == f"{head}<tr>{cell}b</td>{cell}None</td></tr></table>"


def test_html_styles_treat_quotes_differently(spark):
    df = spark.createDataFrame([("a", "it's", 1)], "who STRING, what STRING, n INT")
    assert "it\\'s" in body(df, style=ESCAPED)[1]["a"]
    assert "it's" in body(df, style=PAGE)[1]["a"]
    assert "<td style=\"padding:12px 5px" in body(df, style=PAGE)[1]["a"]


TEMPLATE = (
    "<T><Column><Title>No</Title><Map>sno</Map></Column><Column><Title>Bar</Title><Map>inventory.barcode</Map>"
    "</Column><Column><Title>Odd</Title><Map>inventory.order_code</Map></Column>"
    "<Column><Title>Fix</Title><Map>warehouse.name</Map><Value>K</Value></Column></T>"
)


def manifests():
    return dict(
        couriers=[
            {"code": "c1", "enabled": 1, "primary_email": "p", "secondary_email": "s", "soft_data_header": "a\nb",
             "soft_data_template": TEMPLATE, "soft_data_subject": "Sub"},
            {"code": "c2", "enabled": 0, "soft_data_template": TEMPLATE},
            {"code": "c3", "enabled": 1, "soft_data_template": ""},
            {"code": "c4", "enabled": 1, "primary_email": "q", "soft_data_template": TEMPLATE},
        ],
        manifest=[
            {"id": 1, "created": at("2014-10-18 11:55"), "courier_code": "c1", "is_email_sent": 1},
            {"id": 2, "created": at("2014-10-18 11:55"), "courier_code": "c1", "is_email_sent": 0},
            {"id": 3, "created": at("2014-10-16 11:55"), "courier_code": "c1", "is_email_sent": 1},
            {"id": 4, "created": at("2014-10-18 11:55"), "courier_code": "c2", "is_email_sent": 1},
            {"id": 5, "created": at("2014-10-18 11:55"), "courier_code": "c3", "is_email_sent": 1},
        ],
        manifest_rtv_sheet_detail=[{"manifest_id": n, "rtv_sheet_id": n + 10} for n in (1, 2, 3, 4, 5)]
        + [{"manifest_id": 1, "rtv_sheet_id": 99}],
        rtv_sheet_detail=[{"id": n + 10, "warehouse_id": 1} for n in (1, 2, 3, 4, 5)] + [{"id": 99, "warehouse_id": 8}],
        warehouse=[{"id": 1, "name": "One"}],
        rtv_sheet_detail_inventory=[
            {"rtv_sheet_detail_id": 11, "product_details_id": n} for n in (501, 500)
        ],
        inventory=[{"id": 500, "barcode": "B500"}, {"id": 501, "barcode": "B501"}],
    )


def test_templates_of_enabled_couriers(make):
    rows = {row["courier_code"]: row for row in dicts(courier_templates(make(**manifests()).couriers))}
    assert set(rows) == {"c1", "c4"}
    assert (rows["c1"]["to_email"], rows["c1"]["mail_body"]) == ("p,s", "a<br />b")
    assert rows["c4"]["to_email"] == "q" and rows["c4"]["mail_body"].startswith("Hi<br>")
    assert [column["Value"] for column in rows["c1"]["columns"]] == [None, None, None, "K"]


def test_unknown_template_fields_are_reported_and_stop_the_export(make):
    tables = manifests()
    for row in tables["couriers"]:
        row["soft_data_template"] = row["soft_data_template"].replace("inventory.order_code", "drop table x")
    c = make(**tables)
    assert sorted(map(tuple, unknown_fields(c.couriers).collect())) == [("c1", "Odd", "drop table x"), ("c4", "Odd", "drop table x")]
    with pytest.raises(Exception, match="unknown field: drop table x"):
        long_form(courier_manifest_export(c, CLOCK)).collect()
    assert long_form(manifest_on_print(c, CLOCK)).count() == 8


def test_export_maps_fields(make):
    export = courier_manifest_export(make(**manifests()), CLOCK)
    table = courier_table(export, "c1", ["No", "Bar", "Odd", "Fix"]).orderBy("sno")
    assert [tuple(row) for row in table.collect()] == [
        ("One", 1, "1", None, None, "One"), ("One", 2, "2", "B500", None, "One"), ("One", 3, "3", "B501", None, "One"),
    ]
    assert {row["subject"] for row in dicts(export)} == {"Sub : One"}


def test_long_form_pivots_back_to_the_table(make):
    export = courier_manifest_export(make(**manifests()), CLOCK)
    titles = ["No", "Bar", "Odd", "Fix"]
    pivoted = long_form(export).groupBy("warehouse", "sno").pivot("title", titles).agg(F.first("value"))
    assert sorted(map(str, dicts(pivoted))) == sorted(map(str, dicts(courier_table(export, "c1", titles))))


def test_on_print_takes_flagged_recent_manifests_with_constants(make):
    c = make(**manifests())
    cells = dicts(long_form(manifest_on_print(c, CLOCK)).orderBy("sno", "pos"))
    assert [(row["title"], row["value"]) for row in cells if row["sno"] == 1] == [
        ("No", "1"), ("Bar", ""), ("Odd", ""), ("Fix", "K"),
    ]
    assert len(cells) == 8
    flags = {row["id"]: row["is_email_sent"] for row in dicts(manifest_flags_after(c, CLOCK, minutes=10))}
    assert flags == {1: 0, 2: 0, 3: 1, 4: 1, 5: 1}
    assert {row["id"]: row["is_email_sent"] for row in dicts(manifest_flags_after(c, CLOCK))} == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1}
    assert {row["id"]: row["is_email_sent"] for row in dicts(manifest_flags_raised(c))} == {n: 1 for n in range(1, 6)}


def digest_tables():
    return manifests() | dict(
        rtv_sheet_detail=[
            {"id": 11, "return_warehouse": "1", "receiver_id": 1, "created": at("2014-10-17"), "awb_number": "A",
             "courier_code": "c"},
            {"id": 12, "return_warehouse": "vendor", "receiver_id": 2, "awb_number": "A", "courier_code": None},
            {"id": 30, "return_warehouse": "2", "receiver_id": 3},
        ],
        rtv_sheet_detail_inventory=[
            {"rtv_sheet_detail_id": 11, "product_details_id": 500}, {"rtv_sheet_detail_id": 11, "product_details_id": 501},
            {"rtv_sheet_detail_id": 12, "product_details_id": 502}, {"rtv_sheet_detail_id": 30, "product_details_id": 503},
        ],
        inventory=[{"id": 500, "ticket_id": "T1", "barcode": "B"}, {"id": 501, "ticket_id": "T2"},
                   {"id": 502, "suborder_code": "S", "vendor_code": "V"}, {"id": 503, "ticket_id": "T1"}],
        receiver_detail=[{"id": 1, "name": "Cen", "email": "c1"}, {"id": 2, "name": "Ven", "email": None},
                         {"id": 3, "name": "Top", "email": "c3"}],
        receiver_email=[{"code": "Top", "email": "alt"}, {"code": "Cen", "email": "no"}],
        reports=[{"name": "Email To Center", "to_email": "const"}, {"name": "Email To Seller", "to_email": ""}],
    )


def test_center_digest_addresses_follow_the_first_ticket(make):
    c = make(**digest_tables())
    # ticket T1 was also on sheet 30, whose receiver has the highest number
    assert dicts(center_digest(c, CLOCK)) == [{"soi_center_name": "Cen", "n_items": 2, "to_email": "c3,alt,const"}]
    assert [row["dispatch_date"] for row in dicts(center_items(c, CLOCK))] == ["17-Oct-14", "17-Oct-14"]


def test_seller_digest_without_known_address(make):
    c = make(**digest_tables())
    assert dicts(seller_digest(c, CLOCK)) == [{"vendor_code": "V", "n_items": 1, "to_email": ""}]
    # way-bill text is missing as soon as one of its parts is
    assert [row["awb_no"] for row in dicts(seller_items(c, CLOCK))] == [None]


def test_csv_quotes_and_empty_values(spark, tmp_path):
    df = spark.createDataFrame(
        [("a,b", None, at("2014-10-18 01:02:03")), ('say "x"', 2, None)], "issue_category STRING, n INT, at TIMESTAMP_NTZ"
    ).coalesce(1)
    folder = write_csv(df, str(tmp_path), "RTV Data", CLOCK)
    assert folder == run_folder(str(tmp_path), "RTV Data", CLOCK)
    assert folder.endswith("report=RTV_Data/run_ts=18_10_2014_12_00_00")
    (name,) = glob.glob(f"{folder}/*.csv")
    with open(name) as file:
        assert list(csv.reader(file)) == [
            ["Issue Category", "N", "At"], ["a,b", "", "2014-10-18 01:02:03"], ['say "x"', "2", ""],
        ]


def test_name_fill_goes_by_barcode(spark, make, tmp_path):
    c = make(
        inventory=[
            {"id": 1, "barcode": "B1", "customer_name": None}, {"id": 2, "barcode": "B1", "customer_name": "old"},
            {"id": 3, "barcode": "B2", "customer_name": "kept"}, {"id": 4, "barcode": "B3", "customer_name": None},
            {"id": 5, "barcode": "B4", "customer_name": None}, {"id": 6, "barcode": None, "customer_name": None},
        ],
        cri=[{"id": n, "code": f"B{n}", "crp_id": 1} for n in (1, 2, 4)],
        crp=[{"id": 1, "pickup_detail_id": 1}],
        pickup_detail=[{"id": 1, "name": "O'Neil"}],
    )
    filled = customer_name_fill(c, excluded=["B4"])
    assert filled.columns == c.inventory.columns
    folder = write_version(filled, str(tmp_path), "inventory", CLOCK)
    names = {row["id"]: row["customer_name"] for row in spark.read.parquet(folder).collect()}
    assert names == {1: "O'Neil", 2: "O'Neil", 3: "kept", 4: None, 5: None, 6: None}


def test_backfill_before_the_cut_off(make):
    moved = {"crp_id": 1, "previous_status_code": "NEW", "next_status_code": "RPR"}
    c = make(
        crp=[{"id": 1}],
        cri=[{"id": 1, "code": "B1", "crp_id": 1}],
        crp_history=[moved | {"created": at("2014-09-30 23:59:59")}, moved | {"created": at("2014-10-01")}],
    )
    assert [row["rpr_date_time"] for row in dicts(rpr_backfill(c, at("2014-10-01")))] == [at("2014-09-30 23:59:59")]


def test_a_mail_without_receiver_has_no_address(make):
    tables = digest_tables()
    tables["rtv_sheet_detail"] = [row | {"receiver_id": 77} for row in tables["rtv_sheet_detail"]]
    rows = dicts(seller_digest(make(**tables), CLOCK))
    assert rows and all(row["to_email"] is None for row in rows)
