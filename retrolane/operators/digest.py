"""HTML bodies built from rows, in parts of bounded size."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retrolane.functions.text import title_names
from retrolane.operators.serial import numbered

ROWS_PER_PART = 200


@dataclass(frozen=True)
class TableStyle:
    """Markup around a table; the values below are fixed texts of the reports."""

    open_table: str
    open_head: str
    cell: str
    body_cell: str
    # what replaces a single quote in cell text; None keeps it
    quote: str | None


PLAIN = TableStyle(
    '<table style="border:#dfdfdf solid 1px; border-collapse: collapse;">',
    '<tr bgcolor="#f1f1f1">',
    '<td style="border: #dfdfdf solid 1px;">',
    '<td style="border: #dfdfdf solid 1px;">',
    "",
)
# The markup around a page that is one table.
PAGE_OPEN = "<html><body>"
PAGE_CLOSE = "</body></html>"

ESCAPED = TableStyle(PLAIN.open_table, PLAIN.open_head, PLAIN.cell, PLAIN.body_cell, "\\'")
PAGE = TableStyle(
    '<table width="100%" style="text-align:center;border-top:4px solid #dbd9d9;'
    'border-bottom:4px solid #dbd9db9;border-collapse:collapse;">',
    "<tr>",
    '<td style="padding:7px 5px;border:1px solid #ccc;font-size:12px;font-family:Segoe UI,arial;">',
    '<td style="padding:12px 5px;border:1px solid #ccc;font-size:12px;font-family:Segoe UI,arial;">',
    None,
)


def cell_text(column: str | Column, style: TableStyle) -> Column:
    """Text of one cell; a missing value prints as ``None``."""
    value = F.col(column) if isinstance(column, str) else column
    text = F.coalesce(value.cast("string"), F.lit("None"))
    return text if style.quote is None else F.replace(text, F.lit("'"), F.lit(style.quote))


def row_html(columns: Sequence[str], style: TableStyle) -> Column:
    cells = [part for name in columns for part in (F.lit(style.body_cell), cell_text(name, style), F.lit("</td>"))]
    return F.concat(F.lit("<tr>"), *cells, F.lit("</tr>"))


def head_html(titles: Sequence[str], style: TableStyle) -> str:
    quote = style.quote
    shown = [title if quote is None else title.replace("'", quote) for title in titles]
    return style.open_table + style.open_head + "".join(f"{style.cell}{title}</td>" for title in shown) + "</tr>"


def html_parts(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    order: Sequence[str],
    titles: Sequence[str] | None = None,
    style: TableStyle = PLAIN,
    rows_per_part: int = ROWS_PER_PART,
    slices: int | None = None,
) -> DataFrame:
    """One HTML table per key, split into parts: (key, part, parts, n_rows, body_html).

    Parts hold at most ``rows_per_part`` rows, so a key with very many rows
    becomes many parts instead of one huge row. Concatenating a key's parts in
    order gives its table: the first part opens it, the last one closes it.
    """
    head = head_html(titles or title_names(columns), style)
    placed = numbered(df.where(F.col(key).isNotNull()), [key], order, name="sno", size="key_rows", slices=slices)
    lines = placed.select(
        key,
        F.expr(f"(sno - 1) div {rows_per_part}").alias("part"),
        F.expr(f"(key_rows + {rows_per_part - 1}) div {rows_per_part}").alias("parts"),
        F.struct("sno", row_html(columns, style).alias("html")).alias("line"),
    )
    sorted_lines = F.array_sort(F.collect_list("line"))
    body = F.array_join(F.transform(sorted_lines, lambda line: line["html"]), "")
    parts = lines.groupBy(key, "part", "parts").agg(F.count("*").alias("n_rows"), body.alias("rows_html"))
    return parts.select(
        key,
        "part",
        "parts",
        "n_rows",
        F.concat(
            F.when(F.col("part") == 0, F.lit(head)).otherwise(F.lit("")),
            "rows_html",
            F.when(F.col("part") == F.col("parts") - 1, F.lit("</table>")).otherwise(F.lit("")),
        ).alias("body_html"),
    )
