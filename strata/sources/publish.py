"""Publish a layer: copy every table under a source root to a target URI.

The target is any Hadoop filesystem URI the cluster is configured for (object
store, HDFS, local); credentials are plain Hadoop configuration.  One
table's failure is recorded and does not stop the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.sources.csv import read_csv_text, write_csv
from strata.sources.parquet import write_table
from strata.sources.paths import find_tables, list_entries

STATUS_SCHEMA = "table string, status string, rows bigint, error string"


def publish_tables(spark: SparkSession, src_root: str, dst_root: str, tables: list[str],
                   fmt: str = "parquet") -> DataFrame:
    """Copy ``tables`` (paths relative to ``src_root``) to ``dst_root``; one status row per table."""
    out = []
    for rel in tables:
        src, dst = f"{src_root.rstrip('/')}/{rel}", f"{dst_root.rstrip('/')}/{rel}"
        try:
            if fmt == "csv":
                rows = write_csv(read_csv_text(spark, src), dst)
            else:
                rows = write_table(spark.read.format(fmt).load(src), dst)["rows"]
            out.append((rel, "ok", int(rows), None))
        except Exception as e:  # noqa: BLE001 - isolate per-table failures
            out.append((rel, "failed", None, f"{type(e).__name__}: {e}"))
    return spark.createDataFrame(out, STATUS_SCHEMA)


def publish_layer(spark: SparkSession, src_root: str, dst_root: str, fmt: str = "parquet",
                  domains: list[str] | None = None, recursive: bool = False) -> DataFrame:
    """Publish every table found under ``src_root`` (optionally one level of domain folders).

    A CSV table is an entry named ``*.csv``; a Parquet layer's tables are all its
    entries.  With ``recursive`` tables are found at any depth, by their files.
    A root or domain that cannot be listed is an error.
    """
    suffix = ".csv" if fmt == "csv" else ""
    if recursive:
        tables = sorted(r["table"] for r in find_tables(spark, src_root, suffix).select("table").collect())
    elif domains is None:
        tables = list_entries(spark, src_root, suffix)
    else:
        tables = [f"{d}/{t}" for d in domains for t in list_entries(spark, f"{src_root}/{d}", suffix)]
    return publish_tables(spark, src_root, dst_root, tables, fmt)
