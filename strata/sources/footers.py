"""Counts and bounds of Parquet tables from their footers.

Row counts, non-null counts, minima and maxima stand in the files' footers, so
Spark's Parquet reader answers these aggregates without reading a row
(``PushedAggregation`` in the plan).  Times are stored as whole microseconds:
they are read as such numbers, of which the footers keep bounds too.  Files
without the statistics asked for are scanned instead.

The reader that pushes aggregates down is chosen by a session setting, so a
session of its own on the same context asks; only results come back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, LongType

from strata.operators.quality import is_missing

#: Types whose bounds footers keep in full (text may be cut there).
BOUNDED = ("boolean", "tinyint", "smallint", "int", "bigint", "date")


def _asking(spark: SparkSession) -> SparkSession:
    """A session whose Parquet reader pushes aggregates down."""
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    other.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return other


def pushed(spark: SparkSession, path: str, aggregates: Sequence, numbers: Sequence[str] = ()) -> DataFrame:
    """A table's aggregates through the reader that pushes them down; ``numbers`` are times to read as microseconds."""
    other = _asking(spark)
    table = other.read.parquet(path)
    if numbers:
        schema = StructType([StructField(f.name, LongType() if f.name in numbers else f.dataType, f.nullable) for f in table.schema.fields])
        table = other.read.schema(schema).parquet(path)
    return table.agg(*aggregates)


def _asked(spark: SparkSession, path: str, aggregates: Sequence, numbers: Sequence[str] = ()) -> dict | None:
    """The aggregates' values from footers; None where the reader can't tell, as in a file whose column is all null.

    What it can't tell is asked by a scan, which raises whatever is really wrong.
    """
    try:
        return pushed(spark, path, aggregates, numbers).first().asDict()
    except Exception:  # noqa: BLE001
        return None


def _q(c: str):
    return F.col(f"`{c}`")


def footer_bounds(spark: SparkSession, path: str, columns: Sequence[str]) -> dict[str, tuple]:
    """(min, max) of date and time columns of a Parquet table; a column without a value, or absent, is left out."""
    table = spark.read.parquet(path)
    schema = table.schema
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields if f.name in columns}
    out = {}
    for c, kind in kinds.items():
        number = kind in ("timestamp", "timestamp_ntz")
        found = None
        if number or kind in BOUNDED:
            if not number or _in_micros(spark, path, c):
                found = _asked(spark, path, [F.min(_q(c)).alias("lo"), F.max(_q(c)).alias("hi")], [c] if number else [])
            if found and number and found["lo"] is not None:
                found = spark.range(1).select(*[_moment(found[k], kind).alias(k) for k in ("lo", "hi")]).first().asDict()
        if found is None:
            found = table.agg(F.min(_q(c)).alias("lo"), F.max(_q(c)).alias("hi")).first().asDict()
        if found["lo"] is not None:
            out[c] = (found["lo"], found["hi"])
    return out


def _in_micros(spark: SparkSession, path: str, c: str) -> bool:
    """Whether a table's times are stored in microseconds, as Spark writes them, by one of its rows."""
    table = spark.read.parquet(path)
    raw = spark.read.schema(StructType([StructField(c, LongType(), True)])).parquet(path)
    try:
        number, time = (x.where(_q(c).isNotNull()).select(_q(c)).limit(1).first() for x in (raw, table))
    except Exception:  # noqa: BLE001 - stored in another way altogether
        return False
    kind = table.schema[c].dataType.simpleString()
    return number is None or spark.range(1).select(_moment(number[0], kind).alias("t")).first()["t"] == time[0]


def _moment(micros: int, kind: str):
    if kind == "timestamp":
        return F.timestamp_micros(F.lit(micros))
    start = F.make_timestamp_ntz(F.lit(1970), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return F.timestamp_add("MICROSECOND", F.lit(micros), start)


def footer_date_bounds(spark: SparkSession, sources: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """The one row (lo, hi) that ``calendar.date_bounds`` gives, of the columns of Parquet tables by path."""
    found = [b for path, columns in sources for b in footer_bounds(spark, path, columns).values()]
    if not found:
        return spark.createDataFrame([(None, None)], "lo timestamp_ntz, hi timestamp_ntz")
    ends = spark.createDataFrame(found, "lo timestamp_ntz, hi timestamp_ntz")
    return ends.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def footer_counts(spark: SparkSession, path: str) -> dict:
    """``rows`` and, by column, how many values are missing (null, or NaN in a floating-point column).

    NaNs stand in no footer: floating-point columns are scanned, and no others.
    """
    table = spark.read.parquet(path)
    floating = [f.name for f in table.schema.fields if f.dataType.simpleString() in ("float", "double")]
    nested = [f.name for f in table.schema.fields if f.dataType.simpleString().startswith(("array", "map", "struct"))]
    plain = [c for c in table.columns if c not in floating and c not in nested]
    counted = _asked(spark, path, [F.count(F.lit(1)).alias("rows"), *[F.count(_q(c)).alias(f"v{i}") for i, c in enumerate(plain)]])
    scanned = floating + nested
    if counted is None:
        counted, scanned, plain = {}, table.columns, []
    out = {c: counted["rows"] - counted[f"v{i}"] for i, c in enumerate(plain)}
    rows = counted.get("rows")
    if scanned or rows is None:
        found = table.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(is_missing(table, c)).alias(f"n{i}") for i, c in enumerate(scanned)]).first()
        rows = found["rows"]
        out |= {c: found[f"n{i}"] for i, c in enumerate(scanned)}
    return {"rows": rows, "missing": out}


def footer_overview(spark: SparkSession, paths: Mapping[str, str], layer: str, sizes: Mapping[str, int] | None = None) -> DataFrame:
    """``quality.layer_overview`` of Parquet tables by path, from their footers."""
    rows = []
    for name in sorted(paths):
        counts = footer_counts(spark, paths[name])
        row = (layer, name, counts["rows"], len(counts["missing"]), sum(counts["missing"].values()))
        rows.append(row if sizes is None else (*row, round(sizes[name] / 1024.0, 1)))
    return spark.createDataFrame(rows, "layer string, table string, rows bigint, cols bigint, nulls bigint" + ("" if sizes is None else ", size_kb double"))
