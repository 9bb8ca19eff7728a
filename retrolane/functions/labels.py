"""Labels that group items by site, courier and rule.

Which people stand for which site is configuration: callers pass the user names
in a ``Sites`` value. Labels, warehouse numbers, centre codes and courier
prefixes are fixed values of the reports.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from retrolane.functions.text import same_text

# Labels by warehouse number.
WAREHOUSE_LABELS = {3: "Bang WH", 4: "Hyd WH", 5: "Mum WH", 10: "Chn WH"}
SITE_LABELS = ("Delhi Nuvo WH", "Delhi SD WH", *WAREHOUSE_LABELS.values())
DETAIL_WAREHOUSE_LABELS = {2: "Delhi SD WH", 3: "Bang WH", 4: "Hyd WH", 5: "Mum WH"}

# Courier name prefixes and the family each belongs to.
COURIER_FAMILIES = ("DTDC", "JV", "Gati", "Delhivery", "SAP", "Delhidart")


@dataclass(frozen=True)
class Sites:
    """User names behind each site label."""

    # users who work for the main site from warehouse 2 / from warehouse 7
    main_at_two: Sequence[str] = ()
    main_at_seven: Sequence[str] = ()
    # the one user the detail listings show under the plain Delhi label
    delhi_detail: Sequence[str] = ()
    # quality-check users per site
    qc_second: Sequence[str] = ()
    qc_bang: Sequence[str] = ()
    qc_bang_by_center: Sequence[str] = ()
    qc_main: Sequence[str] = ()
    qc_main_by_center: Sequence[str] = ()
    qc_hyd: Sequence[str] = ()
    qc_mum: Sequence[str] = ()
    qc_chn: Sequence[str] = ()


def warehouse_label(user: str, warehouse: str, sites: Sites) -> Column:
    """Label from user name and warehouse number; NULL when no site applies.

    An unknown user (NULL) is neither inside nor outside the named set.
    """
    name, number = F.col(user), F.col(warehouse)
    at_two = same_text(name, *sites.main_at_two)
    label = F.when(
        (at_two & (number == 2)) | (same_text(name, *sites.main_at_seven) & (number == 7)), "Delhi Nuvo WH"
    ).when(~at_two & (number == 2), "Delhi SD WH")
    for key, text in WAREHOUSE_LABELS.items():
        label = label.when(number == key, text)
    return label


def detail_warehouse_label(user: str, warehouse: str, sites: Sites) -> Column:
    """The simpler labelling of the item listings; NULL when no site applies."""
    number = F.col(warehouse)
    label = F.when(same_text(F.col(user), *sites.delhi_detail) & (number == 2), "Delhi WH")
    for key, text in DETAIL_WAREHOUSE_LABELS.items():
        label = label.when(number == key, text)
    return label


def qc_site_label(user: str, center: str, sites: Sites) -> Column:
    """Quality-check site from the package's last user and returns centre; NULL when no site applies."""
    name, code = F.col(user), F.col(center)
    return (
        F.when(same_text(name, *sites.qc_second), "Delhi SD WH")
        .when(
            same_text(name, *sites.qc_bang)
            | (same_text(name, *sites.qc_bang_by_center) & same_text(code, "RMS-NUVO-BANG")),
            "Bang WH",
        )
        .when(
            same_text(name, *sites.qc_main)
            | (same_text(name, *sites.qc_main_by_center) & same_text(code, "RMS-DEL", "RMS-NUVO-DEL")),
            "Delhi Nuvo WH",
        )
        .when(same_text(name, *sites.qc_hyd), "Hyd WH")
        .when(same_text(name, *sites.qc_mum), "Mum WH")
        .when(same_text(name, *sites.qc_chn), "Chn WH")
    )


def courier_family(column: str, families: Sequence[str] = COURIER_FAMILIES) -> Column:
    code = F.col(column)
    label = F.when(F.lit(False), "")
    for family in families:
        label = label.when(F.lower(code).startswith(family.lower()), family)
    return label.otherwise(code)


def is_hold(rule: str) -> Column:
    return F.col(rule).ilike("Liquidate%")


def is_non_faulty(rule: str) -> Column:
    return F.col(rule).ilike("%Non Faulty%")


def is_courier_debit(rule: str) -> Column:
    return F.col(rule).ilike("%Courier Debit%")
