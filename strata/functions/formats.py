"""Timestamp formats inferred from a column's first value.

Without a format a column is read in the one that its first value has, and a
value in another one becomes null.  The first value is that of the lowest
place in file order; all columns are looked up in one aggregation, of which
each task sends one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Shapes of dates and times (what the text looks like, how to
# parse it).  Where day and month can't be told apart by the text's shape, a
# first number over 12 is a day, else it is the month.
DATE_SHAPES = (
    (r"[0-9]{4}-[0-9]{2}-[0-9]{2}", "yyyy-MM-dd"),
    (r"[0-9]{4}/[0-9]{2}/[0-9]{2}", "yyyy/MM/dd"),
    (r"[0-9]{8}", "yyyyMMdd"),
    (r"(?:1[3-9]|[23][0-9])/[0-9]{2}/[0-9]{4}", "dd/MM/yyyy"),
    (r"[0-9]{2}/[0-9]{2}/[0-9]{4}", "MM/dd/yyyy"),
    (r"(?:1[3-9]|[23][0-9])-[0-9]{2}-[0-9]{4}", "dd-MM-yyyy"),
    (r"[0-9]{2}-[0-9]{2}-[0-9]{4}", "MM-dd-yyyy"),
    (r"(?:1[3-9]|[23][0-9])\.[0-9]{2}\.[0-9]{4}", "dd.MM.yyyy"),
    (r"[0-9]{2}\.[0-9]{2}\.[0-9]{4}", "MM.dd.yyyy"),
)
TIME_SHAPES = (
    (r"", ""),
    (r" [0-9]{2}:[0-9]{2}", " HH:mm"),
    (r" [0-9]{2}:[0-9]{2}:[0-9]{2}", " HH:mm:ss"),
    (r" [0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{1,9}", " HH:mm:ss.SSSSSSSSS"),
    (r"T[0-9]{2}:[0-9]{2}:[0-9]{2}", "'T'HH:mm:ss"),
    (r"T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{1,9}", "'T'HH:mm:ss.SSSSSSSSS"),
)


def format_of(text: Column) -> Column:
    """The format that a value's shape names; null if it has none of the known ones."""
    out = None
    for date, d in DATE_SHAPES:
        for time, t in TIME_SHAPES:
            hit = text.rlike(f"^{date}{time}$")
            out = F.when(hit, d + t) if out is None else out.when(hit, d + t)
    return out


def first_values(df: DataFrame, columns: Sequence[str], place: str) -> DataFrame:
    """(column, first): the non-null value of the lowest place, null for a column without any."""
    found = df.agg(*[F.min_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), F.col(place))).alias(f"v{i}") for i, c in enumerate(columns)])
    return found.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"v{i}").alias("first")) for i, c in enumerate(columns)])))


def inferred_formats(df: DataFrame, columns: Sequence[str], place: str) -> dict[str, str | None]:
    """The format of each column by its first value (None: no value, or one of no known shape)."""
    if not columns:
        return {}
    return {r["column"]: r["format"] for r in first_values(df, columns, place).select("column", format_of(F.col("first")).alias("format")).collect()}
