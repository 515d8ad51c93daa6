"""CSV sources and sinks (bronze layer and raw operational extracts).

Files are read with an explicit all-string schema (no inference pass) so every
column keeps its exact text until the silver casts; the missing-value tokens
are mapped to null in one projection.  A quoted value may hold line breaks: a
file of more than one split is read in parallel by way of ``sources.records``,
which finds out where records begin, a smaller one by a task of its own.
``splittable=True`` saves that pass for tables declared free of quoted line
breaks, and fails if a line with an unclosed quote shows that they aren't.
"""

from __future__ import annotations

import csv
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.casts import null_tokens_to_null
from strata.session import workers_import
from strata.sources.paths import discard, list_entries, replace, staging_path
from strata.sources.records import csv_records, split_maps, worth_splitting

__all__ = ["DEFAULT_DELIMITERS", "detect_delimiter", "header_line", "list_entries", "map_null_tokens", "pick_delimiter",
           "read_bronze", "read_csv_text", "split_header", "write_csv"]

DEFAULT_DELIMITERS = (",", ";")
#: Stands for a field without any text while a file is read, so that a quoted empty text stays one.
#: Drawn anew by every process, so that no file holds it.
NO_VALUE = f"\ue000{uuid.uuid4().hex}"
#: Fields as they are written; a quote within a quoted value is doubled.
FIELD_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
                 "nullValue": NO_VALUE, "maxCharsPerColumn": "-1"}


def header_line(spark: SparkSession, path: str) -> str | None:
    """The first line of the CSV at ``path`` (one row reaches the driver), None if it is empty."""
    row = spark.read.text(path).limit(1).first()
    return row[0] if row else None


def pick_delimiter(header: str | None, delimiters: Sequence[str] = DEFAULT_DELIMITERS) -> str:
    """The delimiter occurring most often in the header; ties and no header -> the first."""
    if not header:
        return delimiters[0]
    counts = [header.count(d) for d in delimiters]
    return delimiters[counts.index(max(counts))]


def detect_delimiter(spark: SparkSession, path: str,
                     delimiters: Sequence[str] = DEFAULT_DELIMITERS) -> str:
    return pick_delimiter(header_line(spark, path), delimiters)


def split_header(header: str, sep: str) -> list[str]:
    """Column names of a header line."""
    return [h.strip() for h in next(csv.reader([header], delimiter=sep))]


def _check_closed_quotes(spark: SparkSession, path: str) -> None:
    quotes = F.length("value") - F.length(F.regexp_replace("value", '"', ""))
    if not spark.read.text(path).where(quotes % 2 == 1).limit(1).isEmpty():
        raise ValueError(f"a quoted value goes over a line end in {path}: read it with splittable=False")


def read_csv_text(spark: SparkSession, path: str, sep: str | None = None,
                  schema: StructType | None = None, splittable: bool = False, place: str | None = None) -> DataFrame:
    """Read CSV with a header as all-string columns.

    Without ``schema`` the column names come from the header line.  Rows with
    too many fields are cut, rows with too few are padded with null.  Blanks,
    quotes, delimiters and line breaks within quoted values are kept.
    ``place`` names a column to add by which rows can be put in the order of
    their file (files in the order of their paths, those read in parallel in
    that of the paths' hashes).
    """
    header = None
    if sep is None or schema is None:
        header = header_line(spark, path)
    if sep is None:
        sep = pick_delimiter(header)
    if schema is None:
        if header is None:
            raise FileNotFoundError(f"no readable CSV header at {path}")
        schema = StructType([StructField(n, StringType(), True) for n in split_header(header, sep)])
    if splittable:
        _check_closed_quotes(spark, path)
    elif worth_splitting(spark, path) and len(sep) == 1 and sep.isascii():
        parallel = _read_in_parallel(spark, path, sep, schema, place)
        if parallel is not None:
            return parallel
    return _read_files(spark, path, sep, schema, {"multiLine": not splittable}, place)


def _read_files(spark: SparkSession, path: str, sep: str, schema: StructType, options: dict, place: str | None = None) -> DataFrame:
    rows = (spark.read.schema(schema).options(**FIELD_OPTIONS).option("header", True).option("sep", sep)
            .option("enforceSchema", True).options(**options).csv(path))
    if place is None:
        return rows
    at = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    return rows.select("*", at.alias(place))


def _read_in_parallel(spark: SparkSession, path: str, sep: str, schema: StructType, place: str | None) -> DataFrame | None:
    """The table with every file read in splits; None if its lines end with a lone CR."""
    row = spark.read.option("lineSep", "\n").text(path).limit(1).first()
    first = row[0] if row else ""
    if "\r" in first[:-1]:
        return None
    workers_import(spark)
    maps = split_maps(spark, path, sep)
    crlf = first.endswith("\r")
    if not crlf and not any(r["opens"] for r in maps) and len(schema) > 1 and not sep.isspace():
        return _read_files(spark, path, sep, schema, {"multiLine": False, "lineSep": "\n"}, place)  # every line is a record
    fields = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(schema.fields))
    parsed = F.from_csv("value", fields, {**FIELD_OPTIONS, "sep": sep, "multiLine": "true"})
    records = csv_records(spark, path, sep, crlf, maps)
    if place is None:
        return records.select(F.inline(F.array(parsed))).toDF(*schema.names)
    at = F.struct("file", "start", F.monotonically_increasing_id())
    return records.select("value", at.alias("at")).select(F.inline(F.array(parsed)), "at").toDF(*schema.names, place)


def map_null_tokens(df: DataFrame) -> DataFrame:
    """Every text column with the missing-value tokens mapped to null (one projection)."""
    return df.select(*[null_tokens_to_null(F.col(f"`{f.name}`")).alias(f.name)
                       if f.dataType.simpleString() == "string" else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def read_bronze(spark: SparkSession, path: str, sep: str | None = None, **kw) -> DataFrame:
    """Bronze CSV as text columns with every missing-value token mapped to null."""
    return map_null_tokens(read_csv_text(spark, path, sep=sep, **kw))


def write_csv(df: DataFrame, path: str, sep: str = ",", skip_empty: bool = False,
              publish: Callable[[], bool] | None = None, compression: str | None = None, rows_per_file: int | None = None) -> int:
    """Write a CSV table (a folder of part files) with a header line; returns the row count.

    With ``rows_per_file`` a task goes on in a new file after so many rows.  Such
    files can be compressed (``gzip`` and the like) and are still read in
    parallel, each whole by one task.

    The count is observed during the write, not computed by a second pass.  The
    folder replaces an earlier one only when it is complete and accepted by
    ``publish``; with ``skip_empty`` an empty result leaves the earlier one as
    it is.
    """
    spark = df.sparkSession
    staging = staging_path(path)
    obs = Observation("strata_csv")
    try:
        options = {k: v for k, v in (("compression", compression), ("maxRecordsPerFile", rows_per_file)) if v is not None}
        (df.observe(obs, F.count(F.lit(1)).alias("rows"))
         .write.options(**options).option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(staging))
        rows = int(obs.get["rows"])
        if (rows or not skip_empty) and (publish is None or publish()):
            replace(spark, staging, path)
            return rows
    except Exception:
        discard(spark, staging)
        raise
    discard(spark, staging)
    return rows
