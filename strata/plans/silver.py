"""Bronze -> silver: one generic job driven by a ``TableDef``.

load (all-string CSV, null tokens mapped) -> drop wholly-empty optional
columns -> rename -> typed casts -> drop helper columns -> write Parquet.  The
null-policy counts, the counts of values that have no silver type and the row
count are observed while the Parquet is written, so validation costs no extra
pass.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.casts import cast_failed, nullable_bigint, number_to_text, strict_double, to_timestamp_coerce
from strata.functions.formats import inferred_formats
from strata.operators.columns import empty_columns, rename_columns
from strata.operators.quality import is_missing
from strata.plans.specs import TableDef
from strata.sources.catalog import CatalogTable
from strata.sources.csv import read_bronze
from strata.sources.parquet import write_table


#: Column by which a bronze table's rows are put in file order.
PLACE = "__place"


def _cast(c: Column, kind: str, strict: bool, fmt: str | None = None) -> Column:
    if kind == "bigint":
        return nullable_bigint(c, strict)
    if kind == "double":
        return strict_double(c, strict)
    if kind == "timestamp":
        return to_timestamp_coerce(c, fmt)
    if kind == "number_text":
        return number_to_text(c)
    return c.cast("string")


def clean_silver(bronze: DataFrame, tdef: TableDef, drop_empty: bool = False, strict: bool = True,
                 formats: Mapping[str, str | None] | None = None) -> DataFrame:
    """Typed silver table from a bronze text table, lazily.

    Optional (``empty``) columns are dropped when wholly null; typed columns
    missing from the file are added as typed nulls so the silver schema is
    stable; ``_parsed`` helper columns are dropped when present; columns the
    definition does not know are kept as text.  ``strict`` fails on text that
    is no number in a numeric column; else it becomes null (``cast_failures``
    counts it).  ``formats`` gives the formats of date columns by their bronze
    name; others are ISO.  ``drop_empty`` runs one aggregation to find the empty optional
    columns; ``build_silver`` learns them while it writes instead.
    """
    df = bronze
    optional = [c.bronze for c in tdef.cols if c.kind == "empty" and c.bronze in df.columns]
    if drop_empty and optional:
        dead = set(empty_columns(df.select(*[F.col(f"`{c}`") for c in optional])))
        df = df.drop(*dead)
    helper = [c.bronze for c in tdef.cols if c.kind == "parsed"]
    df = df.drop(*[c for c in helper if c in df.columns])
    df = rename_columns(df, tdef.rename)
    typed = {c.silver: c.kind for c in tdef.cols if c.kind not in ("empty", "parsed")}
    fmt = {c.silver: (formats or {}).get(c.bronze) for c in tdef.cols}
    exprs = []
    for name in df.columns:
        col = F.col(f"`{name}`")
        exprs.append(_cast(col, typed[name], strict, fmt[name]).alias(name) if name in typed else col)
    for name, kind in typed.items():
        if name not in df.columns:
            exprs.append(F.lit(None).cast(_spark_type(kind)).alias(name))
    return df.select(*exprs)


def _spark_type(kind: str) -> str:
    return {"bigint": "bigint", "double": "double", "timestamp": "timestamp_ntz"}.get(kind, "string")


def expected_nulls(tdef: TableDef) -> dict[str, str]:
    """Columns that may hold nulls, with the reason."""
    return dict(tdef.expected_nulls)


def cast_failures(bronze: DataFrame, tdef: TableDef) -> DataFrame:
    """(column, kind, values, failed) of every typed column: values present, and those without a silver value."""
    typed = [c for c in tdef.cols if c.kind in ("bigint", "double", "timestamp", "number_text") and c.bronze in bronze.columns]
    agg = bronze.agg(*[F.count(F.col(f"`{c.bronze}`")).alias(f"v{i}") for i, c in enumerate(typed)],
                     *[F.count_if(cast_failed(F.col(f"`{c.bronze}`"), c.kind)).alias(f"f{i}") for i, c in enumerate(typed)])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(c.silver).alias("column"), F.lit(c.kind).alias("kind"), F.col(f"v{i}").alias("values"), F.col(f"f{i}").alias("failed"))
        for i, c in enumerate(typed)])))


def build_silver(spark: SparkSession, tdef: TableDef, bronze_root: str, silver_root: str,
                 sep: str | None = None, strict: bool = True, target: str | CatalogTable | None = None,
                 infer_dates: bool = False, fail_on_nulls: bool = False) -> tuple[dict, list[tuple]]:
    """Run one silver job; returns (status row dict, null-policy rows).

    The table goes to its folder under ``silver_root``, or to ``target``.  With
    ``infer_dates`` a date column has the format of its first value, which
    takes a pass over these columns before the one that writes.  With
    ``fail_on_nulls`` a table whose required columns hold nulls, or lack, is not
    published and its job failed.

    One pass over the bronze data in the expected case: the optional columns
    (declared as normally empty) are left out of the write while their
    non-null counts are observed together with the row count, the null-policy
    counts and the values that the casts turn into nulls.  Only if an optional
    column turns out to hold data is the table written again with that column
    kept.  The earlier table is replaced once, by a complete new one; an empty
    source leaves it as it is and reports ``skipped_empty``.
    """
    t0 = time.perf_counter()
    src = f"{bronze_root.rstrip('/')}/{tdef.bronze_file}"
    target = target or f"{silver_root.rstrip('/')}/{tdef.output_path}"
    bronze = read_bronze(spark, src, sep=sep, splittable=tdef.splittable)
    formats: dict = {}
    if infer_dates:
        placed = read_bronze(spark, src, sep=sep, splittable=tdef.splittable, place=PLACE)
        formats = inferred_formats(placed, [c.bronze for c in tdef.cols if c.kind == "timestamp" and c.bronze in bronze.columns], PLACE)
    names = {c.bronze: c for c in tdef.cols}
    optional = [c.bronze for c in tdef.cols if c.kind == "empty" and c.bronze in bronze.columns]
    # a strict job stops at text that is no number; what else has no silver value is counted
    counted = ("timestamp", "number_text") if strict else ("bigint", "double", "timestamp", "number_text")
    typed = [c for b, c in names.items() if b in bronze.columns and c.kind in counted]
    flags = {f"__bad_{c.silver}": cast_failed(F.col(f"`{c.bronze}`"), c.kind, formats.get(c.bronze)) for c in typed}
    full = clean_silver(bronze.withColumns(flags) if flags else bronze, tdef, strict=strict, formats=formats)
    exp = expected_nulls(tdef)
    policy = [(c, "expected", r) for c, r in exp.items()] + [(c, "required", None) for c in tdef.required_columns]
    present = sorted({c for c, _, _ in policy if c in full.columns})
    metrics = [F.count_if(is_missing(full, c)).alias(f"null_{c}") for c in present]
    metrics += [F.count(F.col(f"`{c}`")).alias(f"filled_{c}") for c in optional]
    metrics += [F.count_if(F.col(f"`{f}`")).alias(f) for f in flags]

    def filled(m: dict) -> list[str]:
        return [c for c in optional if m[f"filled_{c}"] > 0]

    def broken(m: dict) -> list[str]:
        return [c for c in tdef.required_columns if m.get(f"null_{c}") != 0] if fail_on_nulls else []

    m = write_table(full, target, metrics=metrics, drop=[*optional, *flags], skip_empty=True, publish=lambda m: not filled(m) and not broken(m))
    if not m["rows"]:
        return ({"layer": "silver", "table": tdef.name, "status": "skipped_empty", "rows": 0,
                 "seconds": time.perf_counter() - t0, "error": None}, [])
    if m["rows"] and filled(m) and not broken(m):
        # an optional column holds data after all: keep it (second pass, rare by definition)
        m = write_table(full, target, metrics=metrics, drop=[*(c for c in optional if c not in filled(m)), *flags])
    rows = []
    for c, kind, reason in policy:
        n = m.get(f"null_{c}")
        status = "missing" if n is None else ("expected" if kind == "expected" else ("ok" if n == 0 else "unexpected"))
        rows.append((tdef.name, c, kind, reason, n, status))
    rows += [(tdef.name, c.silver, "cast", f"present in the source, without a {c.kind} value", m[f"__bad_{c.silver}"], "coerced")
             for c in typed if m[f"__bad_{c.silver}"]]
    if broken(m):
        return ({"layer": "silver", "table": tdef.name, "status": "failed", "rows": None, "seconds": time.perf_counter() - t0,
                 "error": f"null policy: required columns with nulls: {', '.join(broken(m))}"}, rows)
    return ({"layer": "silver", "table": tdef.name, "status": "ok", "rows": int(m["rows"]),
             "seconds": time.perf_counter() - t0, "error": None}, rows)


__all__ = ["build_silver", "cast_failures", "clean_silver", "expected_nulls"]
