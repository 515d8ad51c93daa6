"""Whole-warehouse run: every silver job, and every gold job after its inputs.

Each table is one Spark write.  A failing job is recorded and the run goes
on without the jobs that read from it; the result is a status DataFrame (layer,
table, status, rows, seconds, error) instead of log lines.  Tables are folders
or, with a database, versions that catalog entries point to.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.joins import exceeds_broadcast
from strata.operators.quality import JoinGrowth
from strata.plans import gold
from strata.plans.job_graph import Job, run_jobs, status_row
from strata.plans.silver import build_silver
from strata.plans.specs import BY_NAME, TABLES
from strata.sources.catalog import CatalogTable
from strata.sources.footers import footer_date_bounds
from strata.sources.parquet import read_table, write_table
from strata.sources.paths import exists

STATUS_SCHEMA = "layer string, table string, status string, rows bigint, seconds double, error string"
POLICY_SCHEMA = "table string, column string, kind string, reason string, nulls bigint, status string"


def silver_target(name: str, silver_root: str, database: str | None = None) -> str | CatalogTable:
    """Where a silver table lies: its folder, or the entry ``<database>_silver.<table>``."""
    tdef, root = BY_NAME[name], silver_root.rstrip("/")
    return CatalogTable(f"{database}_silver", name, f"{root}/{tdef.domain}") if database else f"{root}/{tdef.output_path}"


def gold_target(name: str, gold_root: str, database: str | None = None) -> str | CatalogTable:
    """Where a gold table lies: its folder, or the entry ``<database>_gold.<table>``."""
    root = gold_root.rstrip("/")
    return CatalogTable(f"{database}_gold", name, root) if database else f"{root}/{name}"


class SilverTables(Mapping):
    """Silver tables by name, each read on first use (a missing one fails with its path)."""

    def __init__(self, spark: SparkSession, silver_root: str, database: str | None = None):
        self._spark, self._root, self._database, self._cache = spark, silver_root, database, {}
        self._rows: dict[str, int] = {}

    def __getitem__(self, key: str) -> DataFrame:
        if key not in self._cache:
            self._cache[key] = read_table(self._spark, silver_target(key, self._root, self._database))
        return self._cache[key]

    def too_large(self, name: str, columns: list[str], named_by: tuple[str, str] | None = None) -> bool:
        """Whether these columns of a table would not fit into a broadcast, by the rows that its footers count.

        ``named_by`` (table, column) asks of the rows only that the column names by the first of ``columns``.
        """
        asked = self[name].select(*dict.fromkeys(columns))
        if named_by:
            table, column = named_by
            named = self[table].select(F.col(f"`{column}`").alias("__named")).distinct()
            return exceeds_broadcast(asked.join(named, F.col(f"`{columns[0]}`") == F.col("__named"), "left_semi"))
        if name not in self._rows:
            self._rows[name] = self[name].count()
        return exceeds_broadcast(asked, self._rows[name])

    def date_bounds(self, sources: Mapping[str, list[str]]) -> DataFrame:
        """``calendar.date_bounds`` of written tables, from their footers."""
        paths = []
        for name, columns in sources.items():
            target = silver_target(name, self._root, self._database)
            path = target.location(self._spark) if isinstance(target, CatalogTable) else target
            if path is None or not exists(self._spark, path):
                raise FileNotFoundError(f"no silver table {name} at {target}")
            paths.append((path, columns))
        return footer_date_bounds(self._spark, paths)

    def __iter__(self):
        return iter(BY_NAME)

    def __len__(self) -> int:
        return len(BY_NAME)


def silver_inputs(spark: SparkSession, silver_root: str, database: str | None = None) -> SilverTables:
    return SilverTables(spark, silver_root, database)


def _gold_job(name: str, tables: Mapping[str, DataFrame], target: str | CatalogTable, growth: dict[str, list] | None = None) -> dict:
    """Build and write a gold table; ``growth`` takes its rows after each join, counted by the write."""
    t0 = time.perf_counter()
    if name not in gold.GOLD_BUILDERS:
        raise KeyError(f"unknown gold job {name!r}")
    trace = JoinGrowth(name) if growth is not None and name in gold.JOINING else None
    if trace is not None:
        df = gold.GOLD_BUILDERS[name](tables, trace=trace)
    elif name == "dim_calendar" and isinstance(tables, SilverTables):
        df = gold.dim_calendar(tables, bounds=tables.date_bounds(gold.CALENDAR_SOURCES))
    else:
        df = gold.GOLD_BUILDERS[name](tables)
    rows = int(write_table(df, target, skip_empty=True)["rows"])
    if trace is not None:
        growth[name] = trace.rows()
    return status_row("gold", name, "ok" if rows else "skipped_empty", rows, time.perf_counter() - t0)


def run_gold(spark: SparkSession, tables: Mapping[str, DataFrame], gold_root: str,
             names: list[str] | None = None, workers: int = 1, growth: dict[str, list] | None = None) -> list[dict]:
    """Build and write each gold table; one failure is recorded and the rest still run.

    An empty result leaves an earlier table as it is and reports ``skipped_empty``.
    ``growth`` takes (step, rows) after each join by job, counted by the writes.
    """
    jobs = [Job("gold", name, lambda name=name: _gold_job(name, tables, gold_target(name, gold_root), growth)) for name in names or gold.GOLD_BUILDERS]
    return run_jobs(jobs, workers)


def run_silver(spark: SparkSession, bronze_root: str, silver_root: str,
               workers: int = 1, strict: bool = True, fail_on_nulls: bool = False) -> tuple[list[dict], list[tuple]]:
    """Every silver job (independent of each other); returns status rows and null-policy rows."""
    policy: dict[str, list] = {}
    return run_jobs(_silver_jobs(spark, bronze_root, silver_root, strict, None, policy, fail_on_nulls), workers), [p for t in TABLES for p in policy.get(t.name, [])]


def _silver_jobs(spark: SparkSession, bronze_root: str, silver_root: str, strict: bool, database: str | None, policy: dict[str, list],
                 fail_on_nulls: bool = False) -> list[Job]:
    """A job a table; its null-policy rows go into ``policy``."""
    def one(tdef) -> dict:
        status, policy[tdef.name] = build_silver(spark, tdef, bronze_root, silver_root, strict=strict, fail_on_nulls=fail_on_nulls,
                                                 target=silver_target(tdef.name, silver_root, database))
        return status

    return [Job("silver", t.name, lambda t=t: one(t)) for t in TABLES]


def _status_df(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame(
        [(r["layer"], r["table"], r["status"], r["rows"], float(r["seconds"]), r["error"]) for r in rows],
        STATUS_SCHEMA)


def run_all(spark: SparkSession, bronze_root: str, silver_root: str, gold_root: str,
            workers: int = 1, database: str | None = None, status_path: str | None = None,
            growth: dict[str, list] | None = None, fail_on_nulls: bool = False) -> tuple[DataFrame, DataFrame]:
    """Every silver job, and every gold job as soon as the silver tables it reads are written.

    Returns (status, null-policy report) DataFrames.  ``workers > 1`` submits
    jobs concurrently.  A gold job whose input failed is ``blocked``.  With
    ``database`` tables are published by catalog entries.  With ``status_path``
    the status is kept there, and a later run goes on from it: jobs that were ok
    are taken over with their rows, the others and what reads from them run.
    A status in which every job was ok starts anew.  ``growth`` as in ``run_gold``;
    with ``fail_on_nulls`` a silver table that breaks its null policy is failed.
    """
    done = {}
    if status_path and exists(spark, status_path):
        done = {(r["layer"], r["table"]): r.asDict() for r in read_table(spark, status_path).collect()}
        if all(r["status"] in ("ok", "skipped_empty") for r in done.values()):
            done = {}
    policy: dict[str, list] = {}
    silver = _silver_jobs(spark, bronze_root, silver_root, True, database, policy, fail_on_nulls)
    tables = silver_inputs(spark, silver_root, database)
    build = [Job("gold", name, lambda name=name: _gold_job(name, tables, gold_target(name, gold_root, database), growth),
                 tuple(("silver", t) for t in gold.GOLD_INPUTS[name])) for name in gold.GOLD_BUILDERS]
    status = _status_df(spark, run_jobs([*silver, *build], workers, done))
    if status_path:
        write_table(status, status_path)
        status = read_table(spark, status_path)
    return status, spark.createDataFrame([p for t in TABLES for p in policy.get(t.name, [])], POLICY_SCHEMA)
