"""Rows of tables and lists inside HTML text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import parse_int, plain_text, strip_newline

# The class of the ticker table and the position of its cells.
TICKER_TABLE_CLASS = "wikitable sortable"
TICKER_CELLS = {"ticker": 0, "name": 1, "industry": 3, "subindustry": 4, "hq_location": 5, "cik": 7}
FOUNDED_CELL = 8


def elements(markup: Column, tag: str) -> Column:
    """Inner markup of every ``<tag>`` element, in order."""
    return F.regexp_extract_all(markup, F.lit(rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"), 1)


def first_table(markup: Column, css_class: str) -> Column:
    """Inner markup of the first table of this class; empty text without one."""
    return F.regexp_extract(markup, rf'(?s)<table[^>]*class="{css_class}"[^>]*>(.*?)</table>', 1)


def element_rows(df: DataFrame, markup: str, tag: str, keep: list[str]) -> DataFrame:
    """One row per ``<tag>`` element: its position and its inner markup."""
    return df.select(*keep, F.posexplode(elements(F.col(markup), tag)).alias("pos", "inner"))


def table_rows(df: DataFrame, markup: str, css_class: str, keep: list[str]) -> DataFrame:
    """Data rows of the first table of a class, as arrays of cell texts.

    Header rows have no ``<td>`` cells and drop out.
    """
    rows = element_rows(df.withColumn("_table", first_table(F.col(markup), css_class)), "_table", "tr", keep)
    data = rows.filter(F.col("inner").contains("<td"))
    cells = F.transform(elements(F.col("inner"), "td"), lambda c: strip_newline(plain_text(c)))
    return data.select(*keep, "pos", cells.alias("cells"))


def ticker_rows(df: DataFrame, markup: str = "html") -> DataFrame:
    """The ticker table; the founding year is the cell after the CIK number."""
    rows = table_rows(df, markup, TICKER_TABLE_CLASS, [])
    cells = F.col("cells")
    return rows.select(
        *(F.get(cells, F.lit(i)).alias(name) for name, i in TICKER_CELLS.items()),
        parse_int(F.get(cells, F.lit(FOUNDED_CELL))).alias("founded_year"),
    )


def link_rows(df: DataFrame, markup: str, keep: list[str]) -> DataFrame:
    """List items that hold a link: position, target and text."""
    items = element_rows(df, markup, "li", keep)
    link = r'<a\s(?:[^>]*?\s)?href="([^"]*)"'
    linked = items.filter(F.col("inner").rlike(link))
    target = F.regexp_extract("inner", link, 1)
    return linked.select(*keep, "pos", target.alias("href"), strip_newline(plain_text(F.col("inner"))).alias("label"))
