from fractions import Fraction
from math import floor

from pyspark.sql import functions as F

from retrolane.functions.labels import (
    Sites,
    courier_family,
    detail_warehouse_label,
    is_non_faulty,
    qc_site_label,
    warehouse_label,
)
from retrolane.functions.metrics import percent, percent_floor, percent_one_decimal
from retrolane.functions.text import before_dash, line_breaks, recipients, same_text, text_or_empty, titled, yes_no

SITES = Sites(
    main_at_two=("ann", "Bea"), main_at_seven=("cal",), delhi_detail=("ann",), qc_second=("customer",),
    qc_bang=("dan",), qc_bang_by_center=("eve",), qc_main=("flo",), qc_main_by_center=("eve",), qc_hyd=("gus",),
    qc_mum=("hal",), qc_chn=("ivy",),
)


def one_column(spark, rows, schema, column):
    return [row[0] for row in spark.createDataFrame(rows, schema).select(column).collect()]


def test_percentages_are_exact_half_up(spark):
    pairs = [(n, d) for d in range(0, 60) for n in range(0, d + 1)] + [(1, 0)]
    df = spark.createDataFrame(pairs, "n BIGINT, d BIGINT").select(
        "n", "d", percent("n", "d").alias("p0"), percent_one_decimal("n", "d").alias("p1"),
        percent_floor("n", "d").alias("pf"),
    )
    for n, d, p0, p1, pf in df.collect():
        if d == 0:
            assert (p0, p1, pf) == (None, None, None)
            continue
        ratio = Fraction(100 * n, d)
        assert p0 == floor(ratio + Fraction(1, 2))
        assert p1 == float(Fraction(floor(ratio * 10 + Fraction(1, 2)), 10))
        assert pf == floor(ratio)


def test_known_percentages(spark):
    rows = [(1, 16), (1, 3), (0, 0), (2, 3)]
    assert one_column(spark, rows, "n BIGINT, d BIGINT", percent_one_decimal("n", "d")) == [6.3, 33.3, None, 66.7]


def test_warehouse_label_priority_and_unknown_user(spark):
    rows = [
        ("ann", 2), ("BEA", 2), ("zoe", 2), (None, 2), ("cal", 7), ("zoe", 7), ("ann", 3), (None, 4), ("x", 5),
        ("x", 10), ("x", 6), ("x", None),
    ]
    assert one_column(spark, rows, "u STRING, w BIGINT", warehouse_label("u", "w", SITES)) == [
        "Delhi Nuvo WH", "Delhi Nuvo WH", "Delhi SD WH", None, "Delhi Nuvo WH", None, "Bang WH", "Hyd WH", "Mum WH",
        "Chn WH", None, None,
    ]


def test_detail_label_differs_from_summary_label(spark):
    rows = [("ann", 2), ("Bea", 2), (None, 2), ("x", 10)]
    labels = one_column(spark, rows, "u STRING, w BIGINT", detail_warehouse_label("u", "w", SITES))
    assert labels == ["Delhi WH", "Delhi SD WH", "Delhi SD WH", None]


def test_qc_site_depends_on_centre(spark):
    rows = [
        ("customer", None), ("dan", None), ("eve", "RMS-NUVO-BANG"), ("eve", "RMS-DEL"), ("eve", "RMS-NUVO-DEL"),
        ("eve", "RMS-X"), ("eve", None), ("flo", "RMS-X"), ("gus", ""), ("hal", ""), ("ivy", ""), (None, "RMS-DEL"),
    ]
    assert one_column(spark, rows, "u STRING, c STRING", qc_site_label("u", "c", SITES)) == [
        "Delhi SD WH", "Bang WH", "Bang WH", "Delhi Nuvo WH", "Delhi Nuvo WH", None, None, "Delhi Nuvo WH", "Hyd WH",
        "Mum WH", "Chn WH", None,
    ]


def test_courier_families_ignore_case(spark):
    rows = [("DTDC Air",), ("dtdc",), ("jvx",), ("GATI-KWE",), ("Delhivery",), ("delhidart 2",), ("Ecom",), (None,)]
    families = one_column(spark, rows, "c STRING", courier_family("c"))
    assert families == ["DTDC", "DTDC", "JV", "Gati", "Delhivery", "Delhidart", "Ecom", None]


def test_rule_text_ignores_case(spark):
    rows = [("SOI - non faulty",), ("x",), (None,)]
    assert one_column(spark, rows, "r STRING", is_non_faulty("r")) == [True, False, None]
    assert one_column(spark, rows, "r STRING", same_text(F.col("r"), "soi - NON faulty")) == [True, False, None]


def test_box_group_is_text_before_first_dash(spark):
    rows = [("A-1",), ("A-B-1",), ("AB",), (None,)]
    assert one_column(spark, rows, "b STRING", before_dash("b")) == ["A", "A", "", None]


def test_recipients_skip_missing_and_empty(spark):
    rows = [("p", "a", "k"), ("p", "", "k"), (None, None, "k"), ("p", None, ""), (None, "", "")]
    joined = recipients(F.col("p"), F.col("a"), F.col("k"))
    assert one_column(spark, rows, "p STRING, a STRING, k STRING", joined) == ["p,a,k", "p,k", "k", "p", ""]


def test_small_text_helpers(spark):
    df = spark.createDataFrame([("a\nb", None)], "x STRING, y STRING")
    row = df.select(line_breaks(F.col("x")), yes_no("x"), yes_no("y"), text_or_empty("y")).first()
    assert tuple(row) == ("a<br />b", "Y", "N", "")
    assert titled(spark.range(1).toDF("yest - 1 days")).columns == ["Yest - 1 Days"]
