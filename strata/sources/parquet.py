"""Parquet tables of the silver and gold layers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.sources.catalog import CatalogTable
from strata.sources.paths import discard, replace, staging_path

#: Compression of the tables written; a third smaller than the session's default on silver tables.
CODEC = "zstd"


def read_table(spark: SparkSession, path: str | CatalogTable) -> DataFrame:
    """Read a Parquet table; a missing path or entry fails at once with its name in the message."""
    return path.read(spark) if isinstance(path, CatalogTable) else spark.read.parquet(path)


def write_table(df: DataFrame, path: str | CatalogTable, partition_by: Sequence[str] | None = None,
                metrics: Sequence[Column] = (), drop: Sequence[str] = (), skip_empty: bool = False,
                publish: Callable[[dict], bool] | None = None) -> dict:
    """Write ``df`` as Parquet and return observed metrics, at least ``rows``.

    The metrics are computed while the data is written (``DataFrame.observe``),
    so counting the output costs no second pass over the plan.  ``drop`` names
    columns that feed the metrics but are not written.  The table is written
    beside its place and replaces an earlier one only when it is complete, not
    empty (with ``skip_empty``) and accepted by ``publish`` (given the metrics).
    A ``CatalogTable`` gets a new version and is pointed to it instead, so that
    readers of the earlier one aren't disturbed and nothing is renamed.
    """
    spark = df.sparkSession
    entry = isinstance(path, CatalogTable)
    if entry and partition_by:
        raise ValueError(f"{path.name}: versions of a catalog table aren't partitioned")
    staging = path.new_version(spark) if entry else staging_path(path)
    obs = Observation("strata_write")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics)
    if drop:
        observed = observed.drop(*drop)
    w = observed.write.option("compression", CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    try:
        w.parquet(staging)
        found = dict(obs.get)
        if (found["rows"] or not skip_empty) and (publish is None or publish(found)):
            path.point_to(spark, staging) if entry else replace(spark, staging, path)
            return found
    except Exception:
        discard(spark, staging)
        raise
    discard(spark, staging)
    return found


def register_views(spark: SparkSession, root: str, names: Sequence[str], fmt: str = "parquet") -> list[str]:
    """Register each table ``root/<name>`` as a temp view named after its last path segment."""
    views = []
    for name in names:
        view = name.rstrip("/").split("/")[-1].replace(".", "_")
        spark.read.format(fmt).load(f"{root.rstrip('/')}/{name}").createOrReplaceTempView(view)
        views.append(view)
    return views
