"""Data-quality operators.  Each returns a small report DataFrame.

All statistics of one table come from a single aggregation pass (one
``count_if`` per column), unpivoted to long form on the executors; only the
report itself is ever materialised.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.functions.casts import in_range, parse_timestamp
from strata.sources.paths import folder_bytes

# Name fragments that mark a column as holding a date.
DATE_NAME_HINTS = ("date", "when", "time", "from", "to")

POLICY_SCHEMA = "column string, kind string, reason string, nulls bigint, status string"


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def is_missing(df: DataFrame, c: str) -> Column:
    """Null, or NaN in a floating-point column."""
    kind = df.schema[c].dataType.simpleString() if c in df.columns else ""
    return _q(c).isNull() | F.isnan(_q(c)) if kind in ("double", "float") else _q(c).isNull()


def null_counts(df: DataFrame, cols: Sequence[str] | None = None, nonzero: bool = False) -> DataFrame:
    """Long form (column, nulls) of the null count of each column (one pass), or of those that have any."""
    cols = list(cols if cols is not None else df.columns)
    agg = df.agg(*[F.count_if(is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(cols)])
    out = agg.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(cols)])))
    return out.where("nulls > 0") if nonzero else out


def null_policy_rows(df_columns: Sequence[str], expected: Mapping[str, str] | None,
                     required: Sequence[str] | None) -> list[tuple[str, str, str | None]]:
    """(column, kind, reason) of every policy entry, in policy order."""
    rows = [(c, "expected", r) for c, r in (expected or {}).items()]
    rows += [(c, "required", None) for c in (required or [])]
    return rows


def policy_status(kind: str, nulls: Column | None) -> Column:
    if nulls is None:
        return F.lit("missing")
    if kind == "expected":
        return F.lit("expected")
    return F.when(nulls == 0, F.lit("ok")).otherwise(F.lit("unexpected"))


def validate_nulls(df: DataFrame, expected: Mapping[str, str] | None = None,
                   required: Sequence[str] | None = None) -> DataFrame:
    """Null policy report: (column, kind, reason, nulls, status).

    ``expected`` maps columns allowed to hold nulls to a reason; ``required``
    columns must hold none.  status: expected | ok | unexpected | missing.
    The table itself is not changed.
    """
    policy = null_policy_rows(df.columns, expected, required)
    if not policy:
        return df.sparkSession.createDataFrame([], POLICY_SCHEMA)
    present = sorted({c for c, _, _ in policy if c in df.columns})
    idx = {c: i for i, c in enumerate(present)}
    agg = df.agg(*[F.count_if(is_missing(df, c)).alias(f"n{i}") for c, i in idx.items()]) if present \
        else df.limit(1).agg(F.count(F.lit(1)).alias("_"))
    structs = []
    for c, kind, reason in policy:
        n = F.col(f"n{idx[c]}") if c in idx else None
        structs.append(F.struct(
            F.lit(c).alias("column"), F.lit(kind).alias("kind"),
            F.lit(reason).cast("string").alias("reason"),
            (n if n is not None else F.lit(None)).cast("bigint").alias("nulls"),
            policy_status(kind, n).alias("status")))
    return agg.select(F.inline(F.array(*structs)))


def table_profile(df: DataFrame) -> DataFrame:
    """Per column: (column, data_type, nulls, non_nulls) in one pass."""
    cols = df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(cols)])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("data_type"),
                 F.col(f"n{i}").alias("nulls"), (F.col("_rows") - F.col(f"n{i}")).alias("non_nulls"))
        for i, c in enumerate(cols)])))


def missing_ratio(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 2) -> DataFrame:
    """(column, rows, nulls, missing_pct): percentage of missing values, rounded; null for an empty table."""
    cols = list(cols if cols is not None else df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(cols)])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col("_rows").alias("rows"), F.col(f"n{i}").alias("nulls"),
                 F.round(F.try_divide(F.col(f"n{i}") * 100.0, F.col("_rows")), digits).alias("missing_pct")) for i, c in enumerate(cols)])))


def layer_overview(tables: Mapping[str, DataFrame], layer: str, sizes: Mapping[str, int] | None = None) -> DataFrame:
    """One row per table, ordered by name: (layer, table, rows, cols, nulls[, size_kb]).

    Nulls are summed over all columns; ``sizes`` (bytes by table, from
    ``file_sizes``) adds the size in KB rounded to one digit.
    """
    parts = []
    for name, df in tables.items():
        nulls = sum((F.count_if(is_missing(df, c)) for c in df.columns), F.lit(0).cast("bigint"))
        columns = [F.lit(layer).alias("layer"), F.lit(name).alias("table"), F.col("rows"),
                   F.lit(len(df.columns)).cast("bigint").alias("cols"), F.col("nulls")]
        if sizes is not None:
            columns.append(F.round(F.lit(sizes[name]) / 1024.0, 1).alias("size_kb"))
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"), nulls.alias("nulls")).select(*columns))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table")


def file_sizes(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(table, files, bytes) of each table's data files, from their listing; no data is read."""
    return spark.createDataFrame([(name, *folder_bytes(spark, path)) for name, path in paths.items()],
                                 "table string, files bigint, bytes bigint")


def key_check(tables: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """(table, key, rows, null_keys, duplicate_keys) of each table's declared key, ordered by table.

    ``duplicate_keys`` counts key values that occur more than once.
    """
    parts = []
    for name, df in tables.items():
        k = keys[name]
        parts.append(check_key(df, k).select(F.lit(name).alias("table"), F.lit(k).alias("key"), "rows", "null_keys", "duplicate_keys"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table")


#: Bytes of a bitmap, values that it covers, and bytes that a key costs when it is shuffled with its count.
BITMAP_BYTES, BITMAP_VALUES, KEY_BYTES = 4096, 32768, 16


def bitmap_cost(df: DataFrame, key: str) -> dict:
    """``rows``, ``null_keys`` and ``bitmaps``, the bitmaps that the tasks of a scan would send.

    A task sends a bitmap for every run of 32768 values that its keys touch, at
    most those between its smallest and its largest key.
    """
    bucket = F.bitmap_bucket_number(_q(key).cast("bigint"))
    tasks = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"), F.count(_q(key)).alias("keys"), F.min(bucket).alias("lo"), F.max(bucket).alias("hi"))
    row = tasks.agg(F.sum("n").alias("rows"), F.sum("keys").alias("keys"), F.sum(F.least(F.col("hi") - F.col("lo") + 1, F.col("keys"))).alias("bitmaps")).first()
    rows = row["rows"] or 0
    return {"rows": rows, "null_keys": rows - (row["keys"] or 0), "bitmaps": row["bitmaps"] or 0}


def key_bitmaps(df: DataFrame, key: str) -> DataFrame:
    """(bucket, n, different): of each run of 32768 key values how many rows have one, and how many values occur."""
    k = _q(key).cast("bigint")
    return (df.where(_q(key).isNotNull()).groupBy(F.bitmap_bucket_number(k).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"), F.bitmap_construct_agg(F.bitmap_bit_position(k)).alias("bits"))
            .select("bucket", "n", F.bitmap_count("bits").alias("different")))


def check_key(df: DataFrame, key: str, cost: Mapping[str, int] | None = None) -> DataFrame:
    """(rows, null_keys, duplicate_keys) of a table's key, without shuffling the keys where that can be saved.

    Whole-number keys that lie close together in every task, as those written
    in order do, are marked in bitmaps; only the keys of runs in which a value
    occurs more than once are grouped.  Where bitmaps would be larger than the
    keys, and for other types, all keys are grouped.  Runs the scan that tells
    (``bitmap_cost``) at once unless its result is given.
    """
    whole = df.schema[key].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    cost = cost or (bitmap_cost(df, key) if whole else None)
    if cost is None or cost["bitmaps"] * BITMAP_BYTES > cost["rows"] * KEY_BYTES:
        per_key = df.groupBy(_q(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                           F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
                           F.count_if(F.col("k").isNotNull() & (F.col("n") > 1)).alias("duplicate_keys"))
    crowded = key_bitmaps(df, key).where("n > different").select(F.col("bucket").alias("crowded"))
    suspects = df.select(_q(key).alias("k")).join(crowded, F.bitmap_bucket_number(F.col("k").cast("bigint")) == F.col("crowded"), "left_semi")
    return (suspects.groupBy("k").agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("duplicate_keys"))
            .select(F.lit(cost["rows"]).cast("bigint").alias("rows"), F.lit(cost["null_keys"]).cast("bigint").alias("null_keys"), "duplicate_keys"))


def join_growth(steps: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(step, rows): row counts of a job's intermediate tables, in order, to see which join adds or loses rows."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(i).alias("at"), F.lit(label).alias("step"), "rows")
             for i, (label, df) in enumerate(steps)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("at").select("step", "rows")


class JoinGrowth:
    """Row counts after each join, gathered by the run that writes the result.

    ``note`` puts a named observation behind a join; where a plan reads a noted
    table in two branches both see all of its rows, so one count is kept.
    """

    def __init__(self, job: str):
        self.job = job
        self._noted: list[tuple[str, Observation]] = []

    def note(self, label: str, df: DataFrame) -> DataFrame:
        seen = Observation(f"{self.job} {label} {len(self._noted)}")
        self._noted.append((label, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def rows(self) -> list[tuple[str, int]]:
        """(step, rows) in order, once the run is done."""
        return [(f"{self.job}: {label}", self._count(seen)) for label, seen in self._noted]

    @staticmethod
    def _count(seen: Observation) -> int:
        try:
            return int(seen.get["rows"])
        except Py4JJavaError:
            # the part of the plan that held it was found to be empty and did not run
            return 0


def is_date_like_name(name: str, whole_token: bool = False) -> bool:
    low = name.lower()
    if whole_token:
        import re
        toks = re.split(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])", name)
        toks = [t.lower() for t in toks if t]
        return any(t in DATE_NAME_HINTS for t in toks)
    return any(h in low for h in DATE_NAME_HINTS)


def suspicious_dates(tables: Mapping[str, DataFrame], whole_token: bool = False) -> DataFrame | None:
    """String columns whose name suggests a date, with how many values would parse.

    (table, column, data_type, non_nulls, parseable).  Name matching is by
    substring (``to`` also matches ``customer``) unless ``whole_token``.
    """
    parts = []
    for name, df in tables.items():
        cols = [f.name for f in df.schema.fields
                if f.dataType.simpleString() == "string" and is_date_like_name(f.name, whole_token)]
        if not cols:
            continue
        # parsed in a projection of their own, so once a value though the range asks for the result three times
        parsed = df.select(*[F.col(f"`{c}`").alias(f"t{i}") for i, c in enumerate(cols)], *[parse_timestamp(_q(c)).alias(f"d{i}") for i, c in enumerate(cols)])
        agg = parsed.agg(*[F.count(f"t{i}").alias(f"v{i}") for i in range(len(cols))],
                         *[F.count_if(in_range(F.col(f"d{i}"))).alias(f"p{i}") for i in range(len(cols))])
        parts.append(agg.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("table"), F.lit(c).alias("column"),
                     F.lit("string").alias("data_type"),
                     F.col(f"v{i}").alias("non_nulls"), F.col(f"p{i}").alias("parseable"))
            for i, c in enumerate(cols)]))))
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def duplicate_keys(df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Key values occurring more than once: (key..., count).  Map-side partial counts."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*[_q(k) for k in keys]).agg(F.count(F.lit(1)).alias("count")).where("count > 1")


def table_sample(df: DataFrame, n: int = 2, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows by ``order_by`` (deterministic); a top-n, not a full sort."""
    keys = list(order_by or df.columns[:1])
    return df.orderBy(*[_q(k) for k in keys]).limit(n)


def run_summary(status: DataFrame) -> DataFrame:
    """Per layer: jobs, ok, failed (or missing), skipped, blocked by a failed input (from a run status table)."""
    return status.groupBy("layer").agg(
        F.count(F.lit(1)).alias("jobs"),
        F.count_if(F.col("status") == "ok").alias("ok"),
        F.count_if(F.col("status").isin("failed", "missing")).alias("failed"),
        F.count_if(F.col("status") == "skipped_empty").alias("skipped"),
        F.count_if(F.col("status") == "blocked").alias("blocked")).orderBy("layer")
