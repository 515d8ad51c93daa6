"""Incremental bronze -> silver with Structured Streaming.

New bronze CSV files landing in a folder (one batch label per load, e.g. the
``actual`` / ``upcoming`` ingest batches) are picked up by a file stream with
the columns of their header, cleaned by the same ``clean_silver`` as the
batch job, and appended to the silver table.

Exactly-once: every micro-batch is written into its own partition
``ingest_source=<landing>/ingest_batch=<id>`` with dynamic partition
overwrite, so a batch replayed after a failure (same id, same files, per the
checkpoint) replaces its own output instead of duplicating it.  The
checkpoint lies beside the silver tables, under a name made of the table and
its landing folder: a later application that loads the same folder goes on
where the last one stopped, and another folder has its own.

Differences from the batch job, by design: whole-table steps cannot run on
a stream, so optional (expected-empty) columns are kept as text instead of
being dropped when empty, and the silver table gains the two partition
columns.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from strata.plans.silver import clean_silver
from strata.plans.specs import TableDef
from strata.sources.csv import header_line, map_null_tokens, pick_delimiter, split_header
from strata.sources.paths import list_entries

BATCH_COLUMN = "ingest_batch"
SOURCE_COLUMN = "ingest_source"


def source_name(landing_dir: str) -> str:
    """A short name of a landing folder, the same in every application."""
    return hashlib.sha256(landing_dir.rstrip("/").encode()).hexdigest()[:12]


def checkpoint_path(tdef: TableDef, landing_dir: str, silver_root: str) -> str:
    return f"{silver_root.rstrip('/')}/_checkpoints/{tdef.name}-{source_name(landing_dir)}"


def stream_schema(spark: SparkSession, tdef: TableDef, landing_dir: str) -> tuple[StructType, str]:
    """Text schema and delimiter of the landing files, from the header of one that is there.

    Every file's header is checked against it while the stream reads.  An empty
    folder gives the definition's columns and a comma.
    """
    names, sep = [c.bronze for c in tdef.cols if c.kind != "parsed"], ","
    files = [f for f in list_entries(spark, landing_dir) if f.endswith(".csv")]
    header = header_line(spark, f"{landing_dir.rstrip('/')}/{files[0]}") if files else None
    if header:
        sep = pick_delimiter(header)
        found = split_header(header, sep)
        unknown = sorted(set(found) - {c.bronze for c in tdef.cols})
        if unknown:
            raise ValueError(f"columns of {files[0]} that {tdef.name} does not have: {unknown}")
        names = found
    return StructType([StructField(n, StringType(), True) for n in names]), sep


def _writer(target: str, source: str):
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn(SOURCE_COLUMN, F.lit(source)).withColumn(BATCH_COLUMN, F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(SOURCE_COLUMN, BATCH_COLUMN).parquet(target))
    return write_batch


def policy_metrics(tdef: TableDef, columns: list[str]) -> list:
    """Row count and the null count of every policy column present (``null_<column>``)."""
    policy = list(dict.fromkeys(list(tdef.expected_nulls) + tdef.required_columns))
    return [F.count(F.lit(1)).alias("rows")] + [
        F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in policy if c in columns]


def incremental_silver(spark: SparkSession, tdef: TableDef, landing_dir: str, silver_root: str,
                       checkpoint: str | None = None, sep: str | None = None, available_now: bool = True,
                       processing_time: str | None = None, max_files_per_trigger: int | None = None
                       ) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what has landed and stops.

    A file whose header has other columns, another order or another delimiter
    than the first one fails the stream; nothing of it is loaded by position.
    """
    target = f"{silver_root.rstrip('/')}/{tdef.output_path}"
    checkpoint = checkpoint or checkpoint_path(tdef, landing_dir, silver_root)
    schema, found = stream_schema(spark, tdef, landing_dir)
    reader = (spark.readStream.schema(schema)
              .option("header", True).option("sep", sep or found).option("quote", '"').option("escape", '"')
              .option("multiLine", not tdef.splittable).option("enforceSchema", False)
              .option("mode", "PERMISSIVE"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    typed = clean_silver(map_null_tokens(reader.csv(landing_dir)), tdef)
    # per-batch row and null-policy counts, reported in StreamingQueryProgress.observedMetrics
    typed = typed.observe(f"silver_{tdef.name}", *policy_metrics(tdef, typed.columns))
    writer = (typed.writeStream.foreachBatch(_writer(target, source_name(landing_dir)))
              .option("checkpointLocation", checkpoint).queryName(f"silver_{tdef.name}"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
