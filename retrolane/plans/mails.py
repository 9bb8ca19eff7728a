"""Report tables as mail bodies, in parts like every other HTML output."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retrolane.clock import Clock
from retrolane.functions.labels import SITE_LABELS, Sites
from retrolane.functions.text import recipients
from retrolane.operators.digest import PAGE, PAGE_CLOSE, PAGE_OPEN, PLAIN, TableStyle, head_html, html_parts
from retrolane.operators.readthrough import RECEIPT, Milestone
from retrolane.plans.cohorts import (
    rpr_cohort_summary,
    store_cohort,
    warehouse_putaway_returns,
    warehouse_rpr_summary,
)
from retrolane.plans.couriers import courier_wise_rtv, warehouse_courier_rtv
from retrolane.plans.funnels import daily_summary, putaway_and_rtv, rpi_report
from retrolane.plans.operations import report_address, tracking_numbers_left
from retrolane.plans.turnaround import refreshed_summary, rpr_to_qc_summary, to_dispatch_summary
from retrolane.sinks import titles
from retrolane.sources.catalog import Catalog


def heading(clock: Clock) -> str:
    """The line above the tables: the seven closed days they cover."""
    return f"<br><h2>Reports from {clock.day_label(7)} to {clock.day_label(1)}</h2>"


def report_body(
    df: DataFrame,
    heads: Sequence[str],
    rank: Column,
    key: str | None = None,
    style: TableStyle = PLAIN,
) -> DataFrame:
    """A report as one HTML table, or one per value of ``key``; ``rank`` is the row order.

    Reports are already reduced to one row per day, site or courier, so their
    rows are numbered without slicing.
    """
    columns = [name for name in df.columns if name != key]
    if key is None:
        key, df = "report", df.withColumn("report", F.lit("all"))
    ranked = df.withColumn("rank_in_report", rank)
    order = ["rank_in_report", *columns]
    return html_parts(ranked, key, columns, order, titles=heads, style=style, slices=1)


def by_day(column: str = "date") -> Column:
    return F.unix_date(column)


def daily_summary_body(c: Catalog, clock: Clock) -> DataFrame:
    return report_body(daily_summary(c, clock), titles.DAILY_SUMMARY, by_day())


def cohort_summary_body(c: Catalog, clock: Clock, days: int = 7, cohort: DataFrame | None = None) -> DataFrame:
    return report_body(rpr_cohort_summary(c, clock, days, cohort), titles.COHORT_SUMMARY, by_day())


def site_summary_body(
    c: Catalog, clock: Clock, sites: Sites, days: int = 7, cohort: DataFrame | None = None
) -> DataFrame:
    """One table per site."""
    rows = warehouse_rpr_summary(c, clock, sites, days, cohort)
    return report_body(rows, titles.SITE_SUMMARY, by_day(), key="warehouse")


def rpr_to_qc_body(c: Catalog, clock: Clock, sites: Sites, days: int = 7) -> DataFrame:
    return report_body(rpr_to_qc_summary(c, clock, sites, days), titles.RPR_TO_QC, F.col("total_qc"))


def to_dispatch_body(c: Catalog, clock: Clock, sites: Sites, milestone: Milestone, days: int = 7) -> DataFrame:
    """The turnaround table after the listing refreshed its cache."""
    summary = refreshed_summary(c, clock, sites, milestone, days)
    return report_body(summary, titles.TO_DISPATCH_SUMMARY, F.col("total_dispatch"))


def courier_body(c: Catalog, clock: Clock) -> DataFrame:
    """Families by name, the total last."""
    last = F.when(F.col("courier") == "Total", 1).otherwise(0)
    return report_body(courier_wise_rtv(c, clock), titles.COURIER_DAYS, last)


def tracking_numbers_body(c: Catalog) -> DataFrame:
    return report_body(tracking_numbers_left(c), titles.TRACKING_NUMBERS, F.lit(0))


def putaway_and_rtv_body(c: Catalog, clock: Clock) -> DataFrame:
    return report_body(putaway_and_rtv(c, clock), titles.PUTAWAY_AND_RTV, by_day("putaway_date"), style=PAGE)


def rpi_body(c: Catalog, clock: Clock) -> DataFrame:
    return report_body(rpi_report(c, clock), titles.RPI, by_day(), style=PAGE)


@dataclass(frozen=True)
class Section:
    """One table of a mail: a caption (a column over the mail's key) and the table's HTML parts."""

    caption: Column
    heads: Sequence[str]
    parts: DataFrame
    key: str
    style: TableStyle = PLAIN


def caption(text: Column | str) -> Column:
    text = F.lit(text) if isinstance(text, str) else text
    return F.concat(F.lit("<br><br><strong>"), text, F.lit("</strong><br>"))


def assembled(mails: DataFrame, opening: str, sections: Sequence[Section], closing: str = "") -> DataFrame:
    """Several tables as one mail: (mail, section, part, parts, n_rows, body_html).

    ``mails`` has a row for each ``mail`` that is sent. Section 0 is the opening, the last one the
    closing; concatenating a mail's rows by section and part gives its body. A table without rows
    for a mail shows its heads alone, so that every mail has all its sections.
    """

    def text(number: int, html: str) -> DataFrame:
        one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
        return mails.select(
            "mail", F.lit(number).alias("section"), none.alias("part"), one.alias("parts"), none.alias("n_rows"),
            F.lit(html).alias("body_html"),
        )

    out = text(0, opening)
    for number, section in enumerate(sections, 1):
        parts = section.parts.withColumnRenamed(section.key, "mail")
        empty = F.lit(head_html(section.heads, section.style) + "</table>")
        whole = mails.join(parts, "mail", "left").withColumn("part", F.coalesce("part", F.lit(0).cast("bigint")))
        out = out.unionByName(
            whole.select(
                "mail",
                F.lit(number).alias("section"),
                "part",
                F.coalesce("parts", F.lit(1).cast("bigint")).alias("parts"),
                F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows"),
                F.concat(
                    F.when(F.col("part") == 0, section.caption).otherwise(F.lit("")), F.coalesce("body_html", empty)
                ).alias("body_html"),
            )
        )
    return out.unionByName(text(len(sections) + 1, closing)) if closing else out


def page(parts: DataFrame, key: str = "report") -> DataFrame:
    """A table in parts as a whole page: the first part opens it, the last one closes it."""
    opened = F.when(F.col("part") == 0, F.lit(PAGE_OPEN)).otherwise(F.lit(""))
    closed = F.when(F.col("part") == F.col("parts") - 1, F.lit(PAGE_CLOSE)).otherwise(F.lit(""))
    return parts.withColumn("body_html", F.concat(opened, "body_html", closed))


def rpi_page(c: Catalog, clock: Clock) -> DataFrame:
    return page(rpi_body(c, clock))


def summary_mail(c: Catalog, clock: Clock, sites: Sites, days: int = 7, turnaround_days: int = 7) -> DataFrame:
    """The summary mail of all sites: the period, then five captioned tables. The cohort is computed once."""
    cohort = store_cohort(c, clock, days)
    dispatch = to_dispatch_summary(c, clock, sites, RECEIPT, turnaround_days)
    tables = [
        ("Total RPI and RPR and Putaway Report.", titles.DAILY_SUMMARY, daily_summary_body(c, clock)),
        ("Total RPR Report.", titles.COHORT_SUMMARY, cohort_summary_body(c, clock, days, cohort)),
        ("Please find RPR to QC Report.", titles.RPR_TO_QC, rpr_to_qc_body(c, clock, sites, turnaround_days)),
        (
            "Please find RPR To RTS Report.",
            titles.TO_DISPATCH_SUMMARY,
            report_body(dispatch, titles.TO_DISPATCH_SUMMARY, F.col("total_dispatch")),
        ),
        ("Courier Wise RTV Report.", titles.COURIER_DAYS, courier_body(c, clock)),
    ]
    mails = c.spark.range(1).select(F.lit("all").alias("mail"))
    sections = [Section(caption(text), heads, parts, "report") for text, heads, parts in tables]
    return assembled(mails, heading(clock), sections)


SITE_REPORT = "Warehouse Wise Summary Reports"


def site_names(c: Catalog) -> DataFrame:
    """Every site gets a mail, also one with nothing to tell."""
    return c.spark.range(1).select(F.explode(F.array(*[F.lit(site) for site in SITE_LABELS])).alias("mail"))


def site_mail(c: Catalog, clock: Clock, sites: Sites, days: int = 7) -> DataFrame:
    """One mail per site: its cohort, its put-aways and returns, and its dispatches per courier."""
    cohort = store_cohort(c, clock, days)
    summary = site_summary_body(c, clock, sites, days, cohort)
    flow = report_body(warehouse_putaway_returns(c, clock, sites, days), titles.SITE_FLOW, by_day(), key="warehouse")
    last = F.when(F.col("courier") == "Total", 1).otherwise(0)
    couriers = report_body(warehouse_courier_rtv(c, clock, sites), titles.COURIER_DAYS, last, key="warehouse")
    site = F.col("mail")
    sections = [
        Section(caption(F.concat(site, F.lit(" Summary Report."))), titles.SITE_SUMMARY, summary, "warehouse"),
        Section(caption("Total Putaway and Returns."), titles.SITE_FLOW, flow, "warehouse"),
        Section(
            caption(F.concat(F.lit("Courier Wise Dispatch Report of "), site, F.lit("."))),
            titles.COURIER_DAYS, couriers, "warehouse",
        ),
    ]
    return assembled(site_names(c), heading(clock), sections)


def site_recipients(c: Catalog, report: str = SITE_REPORT) -> DataFrame:
    """Addresses of every site's mail: those of the site, if it has some, then the report's own."""
    named = c.report_sites.where(F.col("name") == report).groupBy("site").agg(
        F.array_join(F.array_sort(F.collect_set("to_email")), ",").alias("site_email")
    )
    own = report_address(c, report)
    wanted = site_names(c).join(named, F.col("mail") == F.col("site"), "left")
    return wanted.select("mail", recipients(F.col("site_email"), own).alias("to_email"))
