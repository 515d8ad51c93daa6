"""Ingest operators: strict date-format detection and the year-window split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.casts import to_timestamp_coerce

# The date formats tried in order (Spark patterns). The first
# covers 'yyyy-MM-dd HH:mm:ss' with or without fractional seconds.
SPLIT_FORMATS = ("yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]", "yyyy-MM-dd", "dd/MM/yyyy")

PARSED_SUFFIX = "_parsed"


def failure_counts(col: str, formats: Sequence[str] = SPLIT_FORMATS) -> list[Column]:
    """Aggregate expressions ``f<i>``: non-null values of ``col`` that format i cannot parse."""
    c = F.col(f"`{col}`")
    return [F.count_if(c.isNotNull() & F.try_to_timestamp(c, F.lit(f)).isNull()).alias(f"f{i}")
            for i, f in enumerate(formats)]


def first_fitting(failures: dict, formats: Sequence[str] = SPLIT_FORMATS) -> str | None:
    """The first format without failures, from a row/dict of ``f<i>`` counts."""
    return next((f for i, f in enumerate(formats) if int(failures[f"f{i}"]) == 0), None)


def format_failures(df: DataFrame, col: str, formats: Sequence[str] = SPLIT_FORMATS) -> dict[str, int]:
    """For each format, how many non-null values it fails to parse (one aggregation)."""
    row = df.agg(*failure_counts(col, formats)).first()
    return {f: int(row[f"f{i}"]) for i, f in enumerate(formats)}


def choose_format(df: DataFrame, col: str, formats: Sequence[str] = SPLIT_FORMATS) -> str | None:
    """The first format that parses every non-null value of ``col`` (all-or-nothing), else None."""
    fails = format_failures(df, col, formats)
    return next((f for f in formats if fails[f] == 0), None)


def parse_first_format(df: DataFrame, col: str, formats: Sequence[str] = SPLIT_FORMATS,
                       suffix: str = PARSED_SUFFIX) -> tuple[DataFrame, str | None]:
    """Add ``<col><suffix>`` parsed with the first fitting format.

    Returns the table unchanged and ``None`` when no single format fits every value.
    """
    if col not in df.columns:
        return df, None
    fmt = choose_format(df, col, formats)
    if fmt is None:
        return df, None
    return df.withColumn(f"{col}{suffix}", to_timestamp_coerce(F.col(f"`{col}`"), fmt)), fmt


def split_by_year(df: DataFrame, col: str, start_year: int, end_year: int,
                  formats: Sequence[str] = SPLIT_FORMATS, on_unparsed: str = "raise",
                  fmt: str | None = None, outside: bool = False) -> DataFrame:
    """Rows whose date in ``col`` falls in [start_year, end_year]; null dates are dropped.

    With ``outside`` it is the other rows, those without a date among them.
    The parsed column ``<col>_parsed`` is kept.  When no format fits, raise
    (default) or, with ``on_unparsed='keep'``, return every row unfiltered.
    A known ``fmt`` skips the detection pass.
    """
    parsed = f"{col}{PARSED_SUFFIX}"
    if fmt is not None and parsed not in df.columns:
        df = df.withColumn(parsed, to_timestamp_coerce(F.col(f"`{col}`"), fmt))
    if parsed not in df.columns:
        df, fmt = parse_first_format(df, col, formats)
        if fmt is None:
            if on_unparsed == "keep":
                return df
            raise ValueError(f"column {col!r}: no date format fits every value")
    ts = F.col(f"`{parsed}`")
    # a timestamp range (rather than year()) keeps the predicate pushable on typed sources
    lo = F.make_timestamp_ntz(F.lit(start_year), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    hi = F.make_timestamp_ntz(F.lit(end_year + 1), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return df.where(ts.isNull() | (ts < lo) | (ts >= hi)) if outside else df.where((ts >= lo) & (ts < hi))
