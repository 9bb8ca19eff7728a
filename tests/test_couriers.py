import random
from datetime import timedelta

from retrolane.clock import Clock
from retrolane.functions.labels import Sites
from retrolane.plans.cohorts import (
    warehouse_putaway_returns,
    warehouse_rpr_cohort_putaway,
    warehouse_rpr_cohort_qc,
    warehouse_rpr_summary,
)
from retrolane.plans.couriers import courier_wise_rtv, day_name, warehouse_courier_rtv
from tests.conftest import at, dicts

CLOCK = Clock.at("2014-10-18 12:00")
SITES = Sites(main_at_two=("ann",), qc_hyd=("gus",), qc_mum=("hal",))


def dispatches(seed):
    draw = random.Random(seed)
    sheets = [
        {
            "id": n,
            "created": CLOCK.midnight(draw.randrange(0, 8)),
            "updated": CLOCK.midnight(draw.randrange(0, 10)) + timedelta(hours=draw.randrange(24)),
            "courier_code": "dtdc x" if draw.random() < 0.4 else draw.choice(["DTDC", "gati", "Ecom", None]),
        }
        for n in range(60)
    ]
    stock = [
        {"id": n, "status": "RTV" if n % 5 else "IN", "warehouse_id": draw.choice([2, 3, 4, 6]),
         "created_by_id": draw.choice([1, 2, 3])} for n in range(40)
    ]
    lines = [
        {"rtv_sheet_detail_id": draw.randrange(60), "product_details_id": 0 if draw.random() < 0.3 else draw.randrange(40)}
        for _ in range(400)
    ]
    stock[0]["status"] = "RTV"
    return dict(rtv_sheet_detail=sheets, inventory=stock, rtv_sheet_detail_inventory=lines,
                users=[{"id": 1, "username": "ann"}, {"id": 2, "username": "bob"}])


def site(item, users):
    user = users.get(item["created_by_id"])
    if item["warehouse_id"] == 2 and user:
        return "Delhi Nuvo WH" if user == "ann" else "Delhi SD WH"
    return {3: "Bang WH", 4: "Hyd WH"}.get(item["warehouse_id"])


def family(code):
    lowered = (code or "").lower()
    return next((name for name in ("DTDC", "Gati") if lowered.startswith(name.lower())), code)


def brute(data, by_site, exact):
    sheets = {row["id"]: row for row in data["rtv_sheet_detail"]}
    stock = {row["id"]: row for row in data["inventory"]}
    users = {row["id"]: row["username"] for row in data["users"]}
    groups = {}
    for line in data["rtv_sheet_detail_inventory"]:
        sheet, item = sheets[line["rtv_sheet_detail_id"]], stock[line["product_details_id"]]
        place = site(item, users) if by_site else ""
        if item["status"] != "RTV" or place is None or not CLOCK.midnight(7) <= sheet["created"] <= CLOCK.midnight():
            continue
        age = (CLOCK.today - sheet["updated"].date()).days
        for label in (family(sheet["courier_code"]), "Total"):
            groups.setdefault((place, label), []).append((age, item["id"]))
    out = {}
    for key, rows in groups.items():
        counts = []
        for day in range(1, 8):
            if exact:
                counts.append(len({item for age, item in rows if age == day}))
            elif by_site and day == 7:
                counts.append(len(rows))
            else:
                counts.append(len({item if age == day else 0 for age, item in rows}))
        out[key] = tuple(counts)
    return out


def found(rows, by_site):
    return {
        (row["warehouse"] if by_site else "", row["courier"]): tuple(row[day_name(day)] for day in range(1, 8))
        for row in rows
    }


def test_courier_days_literal_and_exact(make):
    for seed in (1, 2):
        data = dispatches(seed)
        c = make(**data)
        for exact in (False, True):
            assert found(dicts(courier_wise_rtv(c, CLOCK, exact=exact)), False) == brute(data, False, exact)
            rows = dicts(warehouse_courier_rtv(c, CLOCK, SITES, exact=exact))
            assert found(rows, True) == brute(data, True, exact)


def test_else_zero_adds_one(make):
    day = CLOCK.midnight(1)
    c = make(
        rtv_sheet_detail=[{"id": 1, "created": day, "updated": day, "courier_code": "x"},
                          {"id": 2, "created": day, "updated": CLOCK.midnight(2), "courier_code": "x"}],
        inventory=[{"id": n, "status": "RTV"} for n in (1, 2, 3)],
        rtv_sheet_detail_inventory=[{"rtv_sheet_detail_id": 1, "product_details_id": 1},
                                    {"rtv_sheet_detail_id": 1, "product_details_id": 2},
                                    {"rtv_sheet_detail_id": 2, "product_details_id": 3}],
    )
    literal = {row["courier"]: row["yest"] for row in dicts(courier_wise_rtv(c, CLOCK))}
    exact = {row["courier"]: row["yest"] for row in dicts(courier_wise_rtv(c, CLOCK, exact=True))}
    assert literal == {"x": 3, "Total": 3} and exact == {"x": 2, "Total": 2}


def test_no_dispatches_no_total(make):
    assert courier_wise_rtv(make(), CLOCK).count() == 0


def test_site_cohorts_join_on_site_and_day(make):
    day = at("2014-10-17 09:00")
    received = {"previous_status_code": "NEW", "next_status_code": "RPR", "created": day}
    c = make(
        crp=[{"id": 1, "updated_by": "gus"}, {"id": 2, "updated_by": "hal"}, {"id": 3, "updated_by": "nobody"}],
        crp_history=[received | {"crp_id": n} for n in (1, 2, 3)],
        cri=[{"id": n, "code": f"B{n}", "crp_id": n} for n in (1, 2, 3)],
        cri_history=[{"cri_id": 1, "status_date": day, "previous_status_code": "RPR", "next_status_code": "PDC"}],
        inventory=[{"id": 1, "barcode": "B1", "warehouse_id": 4, "status": "RTV", "created": day},
                   {"id": 2, "barcode": "B2", "warehouse_id": 5, "status": "IN", "created": day},
                   {"id": 3, "barcode": "B3", "warehouse_id": 2, "status": "IN", "created": day}],
    )
    assert {row["warehouse"]: row["pct_qc"] for row in dicts(warehouse_rpr_cohort_qc(c, CLOCK, SITES))} == {
        "Hyd WH": 100, "Mum WH": 0,
    }
    assert {row["warehouse"] for row in dicts(warehouse_rpr_cohort_putaway(c, CLOCK, SITES))} == {"Hyd WH", "Mum WH"}
    ratios = {
        row["warehouse"]: (row["pct_dispatch"], row["pct_putaway_qc"])
        for row in dicts(warehouse_rpr_summary(c, CLOCK, SITES))
    }
    assert ratios == {"Hyd WH": (100, 100), "Mum WH": (0, None)}
    assert warehouse_putaway_returns(c, CLOCK, SITES).count() == 2
