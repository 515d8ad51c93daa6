"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back.

    This cuts the lineage: a lost executor costs only the tasks that run, and
    a table that is read several times is computed once.  The shuffle files of
    the write are of no more use; Spark deletes them once the driver's garbage
    collector finds their plan, which else may be long after.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which users size to their data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def hashed_sample(rows: DataFrame, by: str, n: int, total: int, seed: int) -> DataFrame:
    """About ``n`` rows, at most ``n``, chosen by a hash of a column; ``total`` is the number of rows.

    The hash cuts the rows down before they are ordered, so what tasks send to
    the driver is bounded by the sample and not by the number of tasks.
    """
    share = min(1.0, (1.25 * n + 40) / max(1, total))
    near = F.pmod(F.xxhash64(F.lit(seed), F.col(by)), F.lit(1 << 30)) < int(share * (1 << 30))
    return rows.where(near).orderBy(F.xxhash64(F.lit(seed + 1), F.col(by)), F.col(by)).limit(n)
