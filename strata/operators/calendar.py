"""Calendar dimension: a day grain table spanning the whole years of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import calendar_columns


def date_bounds(sources: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row (lo, hi): the min and max over the given date columns of all tables.

    Each table contributes one partial aggregate; nulls are ignored.
    """
    parts = []
    for df, cols in sources:
        cols = [c for c in cols if c in df.columns]
        if not cols:
            continue
        ts = [F.col(f"`{c}`").cast("timestamp_ntz") for c in cols]
        lo = F.least(*ts) if len(ts) > 1 else ts[0]
        hi = F.greatest(*ts) if len(ts) > 1 else ts[0]
        parts.append(df.agg(F.min(lo).alias("lo"), F.max(hi).alias("hi")))
    if not parts:
        raise ValueError("no date columns found for the calendar range")
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def calendar_dim(bounds: DataFrame) -> DataFrame:
    """One row per day from 1 January of the first year to 31 December of the last.

    ``bounds`` is the one-row output of ``date_bounds``; when it holds no date
    the job fails with a clear message instead of producing an empty table.
    """
    lo = F.make_date(F.year("lo"), F.lit(1), F.lit(1))
    hi = F.make_date(F.year("hi"), F.lit(12), F.lit(31))
    checked = F.when(F.col("lo").isNull(), F.raise_error(F.lit("No valid dates found for the calendar")))
    days = bounds.select(
        F.explode(F.sequence(F.coalesce(checked.cast("date"), lo), hi, F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*calendar_columns(F.col("d")))
