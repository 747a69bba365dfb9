"""HTML and Markdown tables as rectangular grids."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

MAX_SPAN = 1000


class _Cells(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.rows: list[list[tuple[str, int, int, bool]]] = []
        self.cell: list | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th") and self.rows:
            a = dict(attrs)
            span = [max(1, min(MAX_SPAN, int(a[k]))) if (a.get(k) or "").isdigit() else 1 for k in ("rowspan", "colspan")]
            self.cell = ["", *span, tag == "th"]
        elif tag == "br" and self.cell:
            self.cell[0] += "\n"

    def handle_data(self, data: str) -> None:
        if self.cell:
            self.cell[0] += data

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th") and self.cell:
            self.rows[-1].append((self.cell[0].strip(), *self.cell[1:]))
            self.cell = None


def grid(html: str | None) -> tuple[list[list[str]] | None, int]:
    """Grid with spans filled in and the number of leading header rows; None where spans overlap."""
    parser = _Cells()
    parser.feed(html or "")
    filled: dict[tuple[int, int], str] = {}
    headers = 0
    for y, row in enumerate(parser.rows):
        x = 0
        if row and all(c[3] for c in row) and headers == y:
            headers += 1
        for text, down, right, _ in row:
            while (y, x) in filled:
                x += 1
            for dy in range(down):
                for dx in range(right):
                    if (y + dy, x + dx) in filled:
                        return None, 0
                    filled[y + dy, x + dx] = text
            x += right
    height, width = len(parser.rows), max((x for _, x in filled), default=-1) + 1
    return [[filled.get((y, x), "") for x in range(width)] for y in range(height)], headers


@pandas_udf(StructType([StructField("rows", ArrayType(ArrayType(StringType()))), StructField("header_rows", IntegerType())]))
def html_grid(html: pd.Series) -> pd.DataFrame:
    """Column of HTML tables as struct (rows, header_rows)."""
    out = [grid(h) for h in html]
    return pd.DataFrame({"rows": [g for g, _ in out], "header_rows": [n for _, n in out]})


def markdown_grid(text: Column) -> Column:
    """Pipe table in Markdown as rows of cells, without the rule line."""
    lines = F.filter(F.split(text, "\n"), lambda l: l.rlike(r"^\s*\|.*\|\s*$") & ~l.rlike(r"^\s*\|[\s:|-]+\|\s*$"))  # noqa: E741
    return F.transform(lines, lambda l: F.transform(F.split(F.regexp_replace(l, r"^\s*\||\|\s*$", ""), r"\|"), lambda c: F.trim(c)))  # noqa: E741


def to_markdown(rows: Column) -> Column:
    """Rows of cells as a pipe table."""
    line = lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.array_join(F.transform(rows[0], lambda _: F.lit(" --- ")), "|"), F.lit("|"))
    return F.when(F.size(rows) > 0, F.array_join(F.concat(F.array(line(rows[0]), rule), F.transform(F.slice(rows, 2, F.size(rows)), line)), "\n"))


def markdown_pages(text: Column, chunk: int = 3000) -> Column:
    """Pages of a Markdown text: cut at rule lines, else at first-level headings, else every ``chunk`` characters."""
    by_rule = F.split(text, r"\n\s*(?:-{3,}|\*{3,})\s*\n")
    by_heading = F.split(text, r"\n(?=# )")
    n = F.ceil(F.length(text) / chunk).cast("int")
    by_size = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: text.substr(i * chunk + 1, F.lit(chunk))))
    pages = F.when(F.size(by_rule) > 1, by_rule).when(F.size(by_heading) > 1, by_heading).otherwise(by_size)
    return F.filter(pages, lambda p: F.trim(p) != "")
