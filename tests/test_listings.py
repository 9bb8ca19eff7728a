from retrolane.clock import Clock
from retrolane.operators.hotkeys import distinct_keys, fanout_left_join, splittable_join
from retrolane.plans.listings import liquidation_listing, putaway_master, rtv_data, rule_listing
from tests.conftest import at, dicts

RETURNS = {
    "cri": [
        {"id": 7, "code": "B1", "crp_id": 1, "cc_id": 1, "item_price": 70.0},
        {"id": 5, "code": "B1", "crp_id": 1, "cc_id": 1, "item_price": 50.0},
        # lower number, but its complaint does not exist: not a match
        {"id": 3, "code": "B1", "crp_id": 1, "cc_id": 9, "item_price": 30.0},
    ],
    "crp": [{"id": 1, "pickup_detail_id": 1}],
    "cc": [{"id": 1, "ticket_code": "T1"}],
    "pickup_detail": [{"id": 1, "name": "Cus"}],
}


def stock(number, **more):
    return {"id": number, "barcode": f"B{number}", "rule_id": 1, "created_by_id": 1, "warehouse_id": 1,
            "status": "IN", "is_bulk_rule": 0, "created": at("2014-10-17 10:00")} | more


def base(**more):
    tables = {
        "inventory": [stock(1), stock(2), stock(3, rule_id=2)],
        "rules": [{"id": 1, "rule_name": "3pl electronics"}, {"id": 2, "rule_name": "Liquidate"}],
        "bulk_upload_rules": [{"id": 1, "rule_name": "Bulk Courier Debit"}, {"id": 3, "rule_name": "Other"}],
        "users": [{"id": 1, "username": "ann"}],
        "warehouse": [{"id": 1, "code": "W1", "name": "One"}],
        "rtv_sheet_detail": [
            {"id": 10, "created": at("2014-10-19"), "updated": at("2014-10-17 08:00"), "courier_code": "X",
             "warehouse_id": 1, "updated_by_id": 5},
            {"id": 11, "created": at("2014-10-18"), "updated": at("2014-10-18 08:00"), "courier_code": None,
             "warehouse_id": 1},
        ],
        "rtv_sheet_detail_inventory": [
            {"rtv_sheet_detail_id": 10, "product_details_id": number} for number in (1, 2, 3)
        ] + [{"rtv_sheet_detail_id": 11, "product_details_id": 1}],
        "gate_pass": [{"barcode": "B1", "created": at("2014-10-20")}, {"barcode": "B1", "created": at("2014-10-21")}],
    }
    return tables | RETURNS | more


def test_rule_listing_takes_first_match_and_repeats_gate_passes(make):
    rows = dicts(rule_listing(make(**base()), "3PL Electronics", at("2014-10-18")))
    found = sorted((row["barcode"], row["gatepass"], row["gatepass_date"], row["ticket_id"], row["price"]) for row in rows)
    assert found == [
        ("B1", "Y", "2014-10-20 00:00:00", "T1", 50.0),
        ("B1", "Y", "2014-10-21 00:00:00", "T1", 50.0),
        ("B2", "N", "", None, None),
    ]


def test_rule_listing_date_is_exclusive(make):
    assert rule_listing(make(**base()), "3PL Electronics", at("2014-10-19")).count() == 0


def test_rule_listing_needs_a_known_user(make):
    c = make(**base(users=[]))
    assert rule_listing(c, "3PL Electronics", at("2014-10-18")).count() == 0


def test_liquidation_prefers_bulk_rule_and_keeps_undispatched(make):
    inventory = [stock(1), stock(2, rule_id=2), stock(4, rule_id=3), stock(5, rule_id=2, created=at("2014-10-01"))]
    rows = dicts(liquidation_listing(make(**base(inventory=inventory, gate_pass=[])), at("2014-10-10")))
    found = sorted((row["barcode"], row["rule_name"], row["rtv_sheet_detail_id"]) for row in rows)
    assert found == [("B1", "Bulk Courier Debit", 10), ("B1", "Bulk Courier Debit", 11), ("B2", "Liquidate", 10)]


def test_putaway_master_keeps_latest_dispatch_per_barcode(make):
    inventory = [stock(1), stock(8, barcode="B1"), stock(2, is_bulk_rule=1), stock(3, is_bulk_rule=None),
                 stock(4, created=at("2014-10-18 00:00:01"))]
    rows = dicts(putaway_master(make(**base(inventory=inventory)), Clock.at("2014-10-18 12:00")))
    found = [(row["barcode"], row["rule_name"], row["rtv_date"]) for row in rows]
    assert found == [
        ("B1", "3pl electronics", at("2014-10-18 08:00")),
        ("B2", "Bulk Courier Debit", at("2014-10-17 08:00")),
        ("B3", None, at("2014-10-17 08:00")),
    ]


def test_rtv_data_needs_a_courier_but_no_user(make):
    rows = dicts(rtv_data(make(**base()), Clock.at("2014-10-18 12:00")))
    assert [(row["barcode"], row["username"], row["item_price"]) for row in rows] == [
        ("B1", None, 50.0), ("B2", None, None), ("B3", None, None),
    ]


def test_hot_barcode_is_split_and_complete(spark):
    """One key with two thirds of the rows: the join to an aggregated lookup is split, no row is lost."""
    old = {name: spark.conf.get(name, None) for name in SKEW}
    for name, value in SKEW.items():
        spark.conf.set(name, value)
    try:
        left = spark.range(120_000).selectExpr(
            "CASE WHEN id % 3 > 0 THEN 'hot' ELSE concat('k', id) END AS barcode", "id", "uuid() AS filler"
        ).repartition(8)
        right = left.groupBy("barcode").count().where("barcode = 'hot' OR count < 2")
        joined = splittable_join(left, right, "barcode", "left")
        assert joined.where("count IS NOT NULL").count() == 120_000
        joined.write.format("noop").mode("overwrite").save()
        result = joined.collect()
        assert len(result) == 120_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
}


def test_distinct_keys_leave_out_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k STRING")
    assert [row["k"] for row in distinct_keys(df, "k").collect()] == ["a"]


def test_fanout_join_equals_a_left_join_when_keys_are_hot_on_either_side(spark):
    left = spark.createDataFrame([("hot", n) for n in range(5)] + [("a", 9), ("none", 8), (None, 7)], "k STRING, l INT")
    right = spark.createDataFrame([("hot", n) for n in range(40)] + [("a", 1), ("a", 2), (None, 3)], "k STRING, r INT")
    plain = sorted(map(str, left.join(right, "k", "left").collect()))
    for rows_per_salt in (1, 7, 1000):
        joined = fanout_left_join(left, right, "k", rows_per_salt)
        assert joined.columns == ["k", "l", "r"]
        assert sorted(map(str, joined.collect())) == plain
