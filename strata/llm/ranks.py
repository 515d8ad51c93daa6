"""Places of rows within their group, without a task that holds a group.

Rows are range-partitioned by group and order, so a group of any size goes over
as many partitions as it fills.  A row's place is its place in its partition
plus the rows of its group in earlier partitions; only counts of (group,
partition) are shuffled and summed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.store import partitions, written

#: Bits of a row's number that count within its partition (``monotonically_increasing_id``).
ROW_BITS = 33


def placed(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """The rows with ``at``, their place from 0 in their group by ``order`` (nulls first), and ``n``, the group's rows.

    Nulls in a group column are a group.  Tied rows take neighbouring places in
    the order of their input partitions; that also spreads a row that stands a
    million times.  The rows are written once, since places refer to them.
    """
    spark = df.sparkSession
    by = [F.col(c).asc_nulls_first() for c in [*group, *order, "placed_tie"]]
    spread = (df.withColumn("placed_tie", F.monotonically_increasing_id())
              .repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by).drop("placed_tie"))
    stored = written(spread.withColumn("placed_row", F.monotonically_increasing_id()), name)
    part = F.shiftright("placed_row", ROW_BITS)
    runs = stored.groupBy(*group, part.alias("r_part")).agg(F.count(F.lit(1)).alias("r_n"), F.min("placed_row").alias("r_first"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("r_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*[F.col(c).alias(f"r_{c}") for c in group], "r_part",
                       (F.coalesce(F.sum("r_n").over(earlier), F.lit(0)) - F.col("r_first")).alias("r_shift"),
                       F.sum("r_n").over(whole).alias("n"))
    same = [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in group]
    joined = stored.join(runs, [*same, part == F.col("r_part")])
    return joined.select(*df.columns, (F.col("placed_row") + F.col("r_shift")).alias("at"), "n")
