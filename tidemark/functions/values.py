"""Numbers and texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Character references that text cells of web tables carry.
ENTITIES = {
    "&nbsp;": " ",
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&amp;": "&",
}


def zero_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls of the named numeric columns become 0."""
    return df.fillna(0, subset=list(columns))


def zero_all_numbers(df: DataFrame) -> DataFrame:
    """Nulls of every numeric column become 0; texts and dates stay."""
    return df.na.fill(0)


def parse_double(text: Column) -> Column:
    """Text to double; null for unparsable text and for NaN."""
    value = F.expr("NULL").cast("double")
    number = text.try_cast("double")
    return F.when(F.isnan(number), value).otherwise(number)


def parse_int(text: Column) -> Column:
    """Trimmed text to int; null when it is no integer."""
    return F.trim(text).try_cast("int")


def strip_newline(text: Column) -> Column:
    """Trailing line breaks removed, other blanks kept."""
    return F.rtrim(text, F.lit("\r\n"))


def words(text: Column) -> Column:
    """Split on single blanks."""
    return F.split(text, " ")


def join_texts(texts: Column) -> Column:
    """Non-null texts joined by commas, no trailing comma."""
    return F.array_join(texts, ",")


def thousands(number: Column) -> Column:
    """Integer with thousands separators."""
    return F.format_number(number, 0)


def plain_text(markup: Column) -> Column:
    """Markup to text: tags dropped, character references resolved."""
    text = F.regexp_replace(markup, "<[^>]*>", "")
    for reference, char in ENTITIES.items():
        text = F.replace(text, F.lit(reference), F.lit(char))
    return text
