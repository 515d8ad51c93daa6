"""Imputation operators and their audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.joins import self_lookup
from strata.operators.quality import is_missing


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls of each named column by a constant."""
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(v)) for c, v in values.items()})


def fill_from_parent_then_mean(df: DataFrame, id_col: str, parent_col: str, value_col: str,
                               mean_digits: int | None = None, shuffled: bool = False) -> DataFrame:
    """Fill ``value_col`` from the parent row's *original* value, then from the column mean.

    One level deep: a parent's own filled value is never used.  The mean is a
    scalar subquery over the original values (no cross join, nothing collected).
    ``shuffled`` as in ``lookup_join``.
    """
    tmp = f"__parent_{value_col}"
    mean = df.agg(F.avg(F.col(f"`{value_col}`"))).scalar()
    if mean_digits is not None:
        mean = F.round(mean, mean_digits)
    with_parent = self_lookup(df, id_col, parent_col, value_col, tmp, shuffled=shuffled)
    return with_parent.withColumn(
        value_col, F.coalesce(F.col(f"`{value_col}`"), F.col(tmp), mean)).drop(tmp)


def impute_report(before: DataFrame, after: DataFrame, cols: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Missing values before and after imputation: (column, nulls_before, nulls_after, pct_before, pct_after).

    ``cols`` lists the audited columns, or maps a column's name before to its
    name after (when the imputation step also renames).  Each side is one
    aggregation: the counts after come back as one struct, so the pipeline
    behind ``after`` runs once whatever the number of columns.
    """
    cmap = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}

    def counts(df: DataFrame, names) -> list:
        return [F.count(F.lit(1)).alias("rows"), *(F.count_if(is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(names))]

    b = before.agg(F.struct(*counts(before, cmap)).alias("b"))
    a = after.agg(F.struct(*counts(after, cmap.values())).alias("a"))
    both = b.withColumn("a", a.scalar())

    def pct(side: str, i: int):
        return F.round(F.try_divide(F.col(f"{side}.n{i}") * 100.0, F.col(f"{side}.rows")), 2)

    return both.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"b.n{i}").alias("nulls_before"), F.col(f"a.n{i}").alias("nulls_after"),
                 pct("b", i).alias("pct_before"), pct("a", i).alias("pct_after"))
        for i, c in enumerate(cmap)])))
