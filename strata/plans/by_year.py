"""Fact tables stored by year, and reads of a calendar period that open only its years.

A fact is written in a folder a year.  A period is a set of days, picked from
the calendar by any of its attributes; joining by year as well as by day lets
Spark find at run time which years the picked days lie in and skip the files of
the others (dynamic partition pruning).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.parquet import read_table, write_table


def year_column(date_col: str) -> str:
    return f"{date_col}_year"


def write_by_year(df: DataFrame, path: str, date_col: str) -> dict:
    """Write a table in folders by the year of a date; rows without one are kept in a folder of their own.

    Rows are rebalanced by year: small years come together in a file, a year
    that holds most rows goes over several.
    """
    year = year_column(date_col)
    spread = df.withColumn(year, F.year(F.col(f"`{date_col}`"))).hint("rebalance", F.col(year))
    return write_table(spread, path, partition_by=[year])


def read_period(spark: SparkSession, path: str, date_col: str, calendar: DataFrame, days: Column | str, day_col: str = "date") -> DataFrame:
    """The rows of a fact whose date is one of the calendar's days that fulfil a condition."""
    fact, year = read_table(spark, path), year_column(date_col)
    picked = calendar.where(days).select(F.col(day_col).cast("date").alias("p_day"), F.year(day_col).alias("p_year")).distinct()
    return fact.join(picked, (F.col(year) == F.col("p_year")) & (F.to_date(F.col(f"`{date_col}`")) == F.col("p_day")), "left_semi").drop(year)
