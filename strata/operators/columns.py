"""Column-level operators: rename, strict select/drop, empty and duplicate columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names absent from ``df`` are ignored (like a dict rename)."""
    present = {k: v for k, v in mapping.items() if k in df.columns and k != v}
    return df.withColumnsRenamed(present) if present else df


def _missing(df: DataFrame, cols: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c not in have]


def select_strict(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Select a fixed column list; a missing name is an error naming all misses."""
    cols = list(cols)
    miss = _missing(df, cols)
    if miss:
        raise KeyError(f"columns not found: {miss}; available: {df.columns}")
    return df.select(*[F.col(f"`{c}`") for c in cols])


def drop_strict(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop named columns; a missing name is an error (Spark's own drop is tolerant)."""
    cols = list(cols)
    miss = _missing(df, cols)
    if miss:
        raise KeyError(f"columns not found: {miss}")
    return df.drop(*cols)


def empty_columns(df: DataFrame) -> list[str]:
    """Names of columns whose every value is null (NaN counts as a value).

    One aggregation over all columns; only the one-row result reaches the driver.
    """
    if not df.columns:
        return []
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return [c for i, c in enumerate(df.columns) if row[f"c{i}"] == 0]


def drop_empty_columns(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Drop columns that are entirely null (except those in ``keep``)."""
    keep = set(keep)
    dead = [c for c in empty_columns(df) if c not in keep]
    return df.drop(*dead) if dead else df


def dedup_columns(df: DataFrame) -> DataFrame:
    """Remove repeated column names, keeping the first occurrence of each."""
    names = df.columns
    if len(set(names)) == len(names):
        return df
    positional = [f"_c{i}" for i in range(len(names))]
    seen: dict[str, int] = {}
    for i, n in enumerate(names):
        seen.setdefault(n, i)
    renamed = df.toDF(*positional)
    return renamed.select(*[F.col(f"_c{i}").alias(n) for n, i in seen.items()])
