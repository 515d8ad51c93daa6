"""Raw extract -> bronze batches.

* ``split_batch``  - each date-tracked table, filtered to a year window, into
  ``bronze/<label>/<table>.csv`` (the ``<col>_parsed`` column is kept).
* ``pass_through`` - every other raw table copied unfiltered into the same batch.
* ``snapshot``     - unfiltered copies of the date-tracked tables (``upcoming``).

Each table is read once with its detected delimiter and written once: the date
format is guessed from the first rows and verified on all of them during the
write, and an earlier batch is replaced only by a complete, verified, non-empty
one.  Returns a status DataFrame (label, table, status, rows, error).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators.ingest import SPLIT_FORMATS, choose_format, failure_counts, first_fitting, split_by_year
from strata.plans.specs import SPLIT_DATE_COLUMNS
from strata.sources.csv import list_entries, read_csv_text, write_csv

#: Rows from which the date format is guessed; the guess is then verified on all rows.
GUESS_ROWS = 100

STATUS_SCHEMA = "label string, table string, status string, rows bigint, error string"


def _raw_path(raw_dir: str, table: str) -> str:
    return f"{raw_dir.rstrip('/')}/{table}.csv"


def _out_path(bronze_dir: str, label: str, table: str) -> str:
    return f"{bronze_dir.rstrip('/')}/{label}/{table}.csv"


def _err(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"


def split_table(spark: SparkSession, raw_dir: str, bronze_dir: str, table: str, date_col: str,
                start_year: int, end_year: int, label: str, on_unparsed: str = "raise",
                formats: Sequence[str] = SPLIT_FORMATS, outside: bool = False) -> tuple:
    """Split one table, in a single read unless the first rows mislead about its date format.

    With ``outside`` the rows beyond the window are written, as they are.

    The format is guessed from the first rows and every format's failures are
    observed over all rows while the window is written beside its place.  If
    the guess failed on some value, the window is written again with the first
    format that parses every value.  When none does, the job fails and the
    earlier batch stays, or with ``on_unparsed='keep'`` all rows are written
    unfiltered.  An empty window writes nothing.
    """
    df = read_csv_text(spark, _raw_path(raw_dir, table))
    out = _out_path(bronze_dir, label, table)
    if date_col not in df.columns:
        return (label, table, "failed", None, f"date column {date_col!r} not found")
    guess = choose_format(df.limit(GUESS_ROWS), date_col, formats) or formats[0]

    def window(fmt: str, accept: Callable[[dict], bool] | None) -> dict:
        obs = Observation(f"formats_{table}")
        rows = split_by_year(df.observe(obs, *failure_counts(date_col, formats)), date_col, start_year, end_year, fmt=fmt, outside=outside)
        found = write_csv(rows.select(*[F.col(f"`{c}`") for c in df.columns]) if outside else rows, out, skip_empty=True, publish=accept and (lambda: accept(obs.get)))
        return {"rows": found, **obs.get}

    seen = window(guess, lambda m: first_fitting(m, formats) is not None and not m[f"f{formats.index(guess)}"])
    fmt = guess if not seen[f"f{formats.index(guess)}"] else first_fitting(seen, formats)
    if fmt is None:
        if on_unparsed != "keep":
            return (label, table, "failed", None, f"column {date_col!r}: no date format fits every value")
        seen = {"rows": write_csv(df, out, skip_empty=True)}
    elif fmt != guess:
        seen = window(fmt, None)
    return (label, table, "ok" if seen["rows"] else "empty", seen["rows"], None)


def split_batch(spark: SparkSession, raw_dir: str, bronze_dir: str, start_year: int, end_year: int,
                label: str = "actual", tables: Mapping[str, str] | None = None,
                on_unparsed: str = "raise") -> DataFrame:
    """Year-window split of every configured table, then pass-through of the rest."""
    tables = dict(tables or SPLIT_DATE_COLUMNS)
    present = {n[:-4] for n in list_entries(spark, raw_dir, ".csv")}
    out = []
    for table, col in tables.items():
        if table not in present:
            out.append((label, table, "missing", None, "raw file not found"))
            continue
        try:
            out.append(split_table(spark, raw_dir, bronze_dir, table, col, start_year, end_year, label,
                                   on_unparsed))
        except Exception as e:  # noqa: BLE001 - one table's failure does not stop the batch
            out.append((label, table, "failed", None, _err(e)))
    out.extend(pass_through(spark, raw_dir, bronze_dir, label, exclude=set(tables)))
    return spark.createDataFrame(out, STATUS_SCHEMA)


def _copy(spark: SparkSession, raw_dir: str, bronze_dir: str, label: str, table: str) -> tuple:
    try:
        rows = write_csv(read_csv_text(spark, _raw_path(raw_dir, table)), _out_path(bronze_dir, label, table))
        return (label, table, "ok", rows, None)
    except Exception as e:  # noqa: BLE001
        return (label, table, "failed", None, _err(e))


def pass_through(spark: SparkSession, raw_dir: str, bronze_dir: str, label: str,
                 exclude: set[str]) -> list[tuple]:
    """Copy every raw table not in ``exclude`` (a set difference on table names)."""
    names = [n[:-4] for n in list_entries(spark, raw_dir, ".csv")]
    return [_copy(spark, raw_dir, bronze_dir, label, t) for t in names if t not in exclude]


def snapshot(spark: SparkSession, raw_dir: str, bronze_dir: str, label: str = "upcoming",
             tables: Mapping[str, str] | None = None, exclude_years: tuple[int, int] | None = None) -> DataFrame:
    """Unfiltered copies of the date-tracked tables.

    ``exclude_years`` (first, last) leaves out the rows of these years, so that
    the snapshot doesn't repeat a batch that was split by the same window; rows
    without a date stay.
    """
    tables = dict(tables or SPLIT_DATE_COLUMNS)
    present = {n[:-4] for n in list_entries(spark, raw_dir, ".csv")}
    out = []
    for t, col in tables.items():
        if t not in present:
            out.append((label, t, "missing", None, "raw file not found"))
        elif exclude_years is None:
            out.append(_copy(spark, raw_dir, bronze_dir, label, t))
        else:
            try:
                out.append(split_table(spark, raw_dir, bronze_dir, t, col, *exclude_years, label, outside=True))
            except Exception as e:  # noqa: BLE001 - one table's failure does not stop the snapshot
                out.append((label, t, "failed", None, _err(e)))
    return spark.createDataFrame(out, STATUS_SCHEMA)
