"""Registered queries: the gold jobs and every operator, run over the test tables.

Each query is a callable ``(spark, sf_dir) -> DataFrame`` reading the
TPC-H-like parquet tables in ``sf_dir`` (through ``strata.harness.tpch`` for the
silver contracts and ``strata.harness.bronze_tpch`` for raw text extracts) and
running the library's own builders and operators over the whole tables.
Queries that exercise writers (CSV round trip, ingest split, publishing,
whole run) write into a fresh folder under the session's checkpoint root.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.casts import null_tokens_to_null, nullable_bigint, number_to_text, strict_double, to_timestamp_coerce, truthy
from strata.operators.columns import dedup_columns, drop_empty_columns, drop_strict, rename_columns, select_strict
from strata.operators.impute import impute_report
from strata.operators.ingest import parse_first_format
from strata.functions.text import contains_or_false
from strata.operators.joins import lookup_join
from strata.operators.quality import (check_key, duplicate_keys, file_sizes, key_check, layer_overview, missing_ratio, null_counts,
                                      run_summary, suspicious_dates, table_profile, table_sample, validate_nulls)
from strata.plans import gold
from strata.plans.by_year import read_period, write_by_year
from strata.harness.bronze_tpch import bronze_order_lines, bronze_orders
from strata.harness.extracts import bronze_extract, write_extract
from strata.plans.ingest_jobs import snapshot, split_batch
from strata.harness.oracle import oracle_queries
from strata.plans.runner import run_all, run_gold, run_silver
from strata.plans.silver import build_silver, cast_failures, expected_nulls
from strata.plans.specs import BY_NAME, TABLES
from strata.harness.tpch import TPCH_TABLES, read_tpch, silver_tables
from strata.session import scratch_dir
from strata.streaming.incremental import BATCH_COLUMN, SOURCE_COLUMN, incremental_silver
from strata.sources.catalog import CatalogTable
from strata.sources.csv import map_null_tokens, read_csv_text, write_csv
from strata.sources.footers import footer_date_bounds, footer_overview
from strata.sources.parquet import read_table, register_views, write_table
from strata.sources.paths import find_files
from strata.sources.publish import publish_layer, publish_tables

Query = Callable[[SparkSession, str], DataFrame]

# the credit-limit mean is rounded so two engines agree on the last digits
MEAN_DIGITS = 6

# tasks a core over splits of a few kilobytes
SPLIT_TASKS = 4

# rows of a landed file, which one task reads
LANDING_ROWS = 500_000

# year window of the ingest split query
SPLIT_YEARS = (1996, 1997)


def _gold(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = silver_tables(spark, sf_dir)
        if name == "dim_customer":
            return gold.dim_customer(tables, mean_digits=MEAN_DIGITS)
        return gold.GOLD_BUILDERS[name](tables)
    run.__name__ = name
    return run


# ---------------------------------------------------------------- silver jobs

def written_silver(spark, sf_dir, name: str, sep: str = ",") -> DataFrame:
    """A table's extract written as CSV, the silver job run on it, and the table it wrote."""
    root = scratch_dir(spark, f"silver-{name}")
    tdef = BY_NAME[name]
    write_extract(bronze_extract(spark, sf_dir, name), f"{root}/bronze/{tdef.bronze_file}", sep=sep)
    status, _ = build_silver(spark, tdef, f"{root}/bronze", f"{root}/silver")
    if status["status"] != "ok":
        raise RuntimeError(f"silver job failed: {status}")
    return read_table(spark, f"{root}/silver/{tdef.output_path}")


def _silver(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return written_silver(spark, sf_dir, name)
    run.__name__ = f"silver_{name}"
    return run


def silver_orders(spark, sf_dir):
    return written_silver(spark, sf_dir, "orders")


def silver_csv_roundtrip(spark, sf_dir):
    """orders extract written as ';'-separated CSV, then the full silver job on it."""
    return written_silver(spark, sf_dir, "orders", sep=";")


def silver_incremental(spark, sf_dir):
    """orders extract landed as CSV part files and loaded by the streaming job in micro-batches."""
    root = scratch_dir(spark, "stream")
    tdef = BY_NAME["orders"]
    orders = read_tpch(spark, sf_dir, "orders")
    files = max(4, -(-orders.count() // LANDING_ROWS))  # the count stands in the footers
    write_csv(bronze_orders(orders).repartition(files), f"{root}/landing", sep=";")
    q = incremental_silver(spark, tdef, f"{root}/landing", f"{root}/silver", max_files_per_trigger=2)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    return read_table(spark, f"{root}/silver/{tdef.output_path}").drop(BATCH_COLUMN, SOURCE_COLUMN)


def null_policy(spark, sf_dir):
    tdef = BY_NAME["orders"]
    return validate_nulls(silver_orders(spark, sf_dir), expected_nulls(tdef), tdef.required_columns)


# ---------------------------------------------------------- scalar functions

def _orders(spark, sf_dir, *cols):
    return read_tpch(spark, sf_dir, "orders").select(*cols) if cols else read_tpch(spark, sf_dir, "orders")


def q_null_tokens(spark, sf_dir):
    k = F.col("o_orderkey")
    raw = (F.when(k % 10 == 0, F.lit("NA")).when(k % 10 == 1, F.lit("NULL")).when(k % 10 == 2, F.lit(""))
           .when(k % 10 == 3, F.lit("n/a")).otherwise(F.col("o_orderpriority")))
    return _orders(spark, sf_dir).select("o_orderkey", null_tokens_to_null(raw).alias("priority"))


def q_to_timestamp_coerce(spark, sf_dir):
    k = F.col("o_orderkey")
    txt = (F.when(k % 11 == 0, F.lit("garbage")).when(k % 13 == 0, F.lit("9999-12-31 23:59:59.9999999"))
           .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")))
    return _orders(spark, sf_dir).select("o_orderkey", to_timestamp_coerce(txt).alias("order_ts"))


def q_parse_first_format(spark, sf_dir):
    df = _orders(spark, sf_dir).select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("d"))
    out, fmt = parse_first_format(df, "d")
    return out.select("o_orderkey", "d_parsed", F.lit(fmt).alias("chosen_format"))


def q_nullable_bigint(spark, sf_dir):
    li = read_tpch(spark, sf_dir, "lineitem")
    txt = F.when(F.col("l_linenumber") == 1, F.lit("NA")).otherwise(F.col("l_quantity").cast("string"))
    return li.select("l_orderkey", "l_linenumber",
                     nullable_bigint(null_tokens_to_null(txt)).alias("quantity"))


def q_number_to_text(spark, sf_dir):
    return _orders(spark, sf_dir).select(
        "o_orderkey", number_to_text(F.round("o_totalprice")).alias("price_text"))


def q_truthy_flag(spark, sf_dir):
    li = read_tpch(spark, sf_dir, "lineitem")
    flag = F.when(F.col("l_linenumber") != 2, F.col("l_quantity") - 1)
    return li.select("l_orderkey", "l_linenumber", truthy(flag).alias("flag"))


# ------------------------------------------------------------ column operators

def q_drop_empty_columns(spark, sf_dir):
    df = _orders(spark, sf_dir).withColumns({"o_comment": F.lit(None).cast("string"),
                                             "o_clerk": F.lit(None).cast("double")})
    return drop_empty_columns(df)


def q_rename_select(spark, sf_dir):
    renamed = rename_columns(_orders(spark, sf_dir), {"o_orderkey": "order_id", "o_custkey": "customer_id",
                                                      "o_clerk": "clerk"})   # absent name: ignored
    return select_strict(renamed, ["order_id", "customer_id", "o_totalprice", "o_orderdate"])


def q_drop_strict(spark, sf_dir):
    return drop_strict(_orders(spark, sf_dir), ["o_orderpriority", "o_orderstatus"])


def q_dedup_columns(spark, sf_dir):
    df = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice",
                                       F.col("o_orderkey").alias("o_custkey"))
    return dedup_columns(df)


# ------------------------------------------------------------ quality reports

def q_table_profile(spark, sf_dir):
    return table_profile(silver_tables(spark, sf_dir)["customers"])


def q_layer_overview(spark, sf_dir):
    return layer_overview(dict(silver_tables(spark, sf_dir)), "silver")


def q_missing_ratio(spark, sf_dir):
    return missing_ratio(silver_tables(spark, sf_dir)["customers"], ["credit_limit", "delivery_city_id", "fax_number", "customer_id"])


def q_nonzero_nulls(spark, sf_dir):
    return null_counts(silver_tables(spark, sf_dir)["customers"], nonzero=True)


def q_layer_sizes(spark, sf_dir):
    """The overview of the supplied tables with their sizes, given as whether the size is that of the listing."""
    paths = {t: f"{sf_dir.rstrip('/')}/{t}.parquet" for t in TPCH_TABLES}
    sizes = {r["table"]: r["bytes"] for r in file_sizes(spark, paths).collect()}
    out = layer_overview({t: read_tpch(spark, sf_dir, t) for t in TPCH_TABLES}, "testdata", sizes)
    listed = {t: find_files(spark, paths[t]).agg(F.sum("bytes")).first()[0] for t in TPCH_TABLES}
    same = F.lit(False)
    for t, size in listed.items():
        same = F.when(F.col("table") == t, F.col("size_kb") == F.round(F.lit(size) / 1024.0, 1)).otherwise(same)
    return out.withColumn("has_size", (F.col("size_kb") > 0) & same).drop("size_kb")


def q_footer_overview(spark, sf_dir):
    """Rows and missing values of the supplied tables, from their footers."""
    return footer_overview(spark, {t: f"{sf_dir.rstrip('/')}/{t}.parquet" for t in TPCH_TABLES}, "testdata")


def q_table_sample(spark, sf_dir):
    return table_sample(read_tpch(spark, sf_dir, "orders"), 5, ["o_custkey", "o_orderkey"])


def q_key_check(spark, sf_dir):
    """The declared keys of all 21 silver tables, over the tables that the silver jobs wrote."""
    root = _whole_run(spark, sf_dir, gold=False)
    tables = {t.name: read_table(spark, f"{root}/silver/{t.output_path}") for t in TABLES}
    return key_check(tables, {t.name: t.silver_key for t in TABLES})


def q_join_growth(spark, sf_dir):
    """Rows after each join of the six joining gold jobs, counted by the runs that write their tables."""
    growth: dict = {}
    status = run_gold(spark, silver_tables(spark, sf_dir), scratch_dir(spark, "growth"), list(gold.JOINING), growth=growth)
    if any(r["status"] != "ok" for r in status):
        raise RuntimeError(f"gold jobs failed: {status}")
    return spark.createDataFrame([row for name in gold.JOINING for row in growth[name]], "step string, rows bigint")


def q_key_bitmaps(spark, sf_dir):
    """Keys of the supplied tables, single and shared ones, with and without nulls."""
    parts = []
    for t, c in (("orders", "o_orderkey"), ("orders", "o_custkey"), ("lineitem", "l_orderkey"), ("part", "p_partkey"), ("customer", "c_name"), ("events", "user_id")):
        df = read_tpch(spark, sf_dir, t) if t in TPCH_TABLES else spark.read.parquet(f"{sf_dir}/{t}.parquet")
        if c == "o_custkey":
            df = df.withColumn(c, F.when(F.col(c) % 10 != 0, F.col(c)))
        parts.append(check_key(df, c).select(F.lit(f"{t}.{c}").alias("key"), "rows", "null_keys", "duplicate_keys"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_calendar_from_footers(spark, sf_dir):
    """The calendar of the written purchase tables, its bounds read from their footers."""
    root = scratch_dir(spark, "footers")
    tables = silver_tables(spark, sf_dir)
    for name in gold.CALENDAR_SOURCES:
        write_table(tables[name], f"{root}/{name}")
    return gold.dim_calendar(tables, bounds=footer_date_bounds(spark, [(f"{root}/{t}", c) for t, c in gold.CALENDAR_SOURCES.items()]))


def q_contains_or_false(spark, sf_dir):
    c = silver_tables(spark, sf_dir)["customers"]
    return c.select("customer_id", contains_or_false("delivery_address_line1", "1").alias("has_one"))


def q_lookup_null_safe(spark, sf_dir):
    """Null keys matched with the null key of the lookup table."""
    c = silver_tables(spark, sf_dir)["customers"].select("customer_id", "delivery_city_id")
    names = c.select(F.col("delivery_city_id").alias("k")).distinct().withColumn("label", F.coalesce(F.concat(F.lit("city "), F.col("k").cast("string")), F.lit("none")))
    return lookup_join(c, names, "delivery_city_id", "k", ["label"], null_safe=True)


def q_register_views(spark, sf_dir):
    views = register_views(spark, sf_dir, ["nation.parquet", "region.parquet"])
    return spark.sql(f"SELECT n_name, r_name FROM {views[0]} JOIN {views[1]} ON n_regionkey = r_regionkey")


def q_suspicious_dates(spark, sf_dir):
    out = suspicious_dates({"sales/orders": bronze_orders(read_tpch(spark, sf_dir, "orders")),
                            "sales/order_lines": bronze_order_lines(read_tpch(spark, sf_dir, "lineitem"))})
    return out


def q_duplicate_keys(spark, sf_dir):
    return duplicate_keys(read_tpch(spark, sf_dir, "orders"), "o_custkey")


def q_impute_audit(spark, sf_dir):
    tables = silver_tables(spark, sf_dir)
    return impute_report(gold.customer_base(tables), gold.dim_customer(tables, mean_digits=MEAN_DIGITS),
                         {"credit_limit": "credit_limit_amount", "full_name": "contact_full_name",
                          "email_address": "contact_email"})


# ------------------------------------------------------- ingest and publishing

def _raw_extract(spark, sf_dir, root):
    """A raw folder: sales.order with dd/MM/yyyy edit dates (';'), plus an unconfigured nation table."""
    orders = bronze_orders(read_tpch(spark, sf_dir, "orders"))
    orders = orders.withColumn("LastEditedWhen", F.date_format(
        F.to_timestamp(F.col("LastEditedWhen"), "yyyy-MM-dd HH:mm:ss"), "dd/MM/yyyy"))
    write_csv(orders, f"{root}/raw/sales.order.csv", sep=";")
    write_csv(read_tpch(spark, sf_dir, "nation"), f"{root}/raw/application.nations.csv")


def q_ingest_split(spark, sf_dir):
    root = scratch_dir(spark, "ingest")
    _raw_extract(spark, sf_dir, root)
    split_batch(spark, f"{root}/raw", f"{root}/bronze", *SPLIT_YEARS, label="actual").collect()
    out = spark.read.option("header", True).option("sep", ",").csv(f"{root}/bronze/actual/sales.order.csv")
    return out.select(F.col("OrderID").cast("bigint").alias("order_id"),
                      F.col("LastEditedWhen").alias("last_edited_when"),
                      to_timestamp_coerce(F.col("LastEditedWhen_parsed")).alias("last_edited_when_parsed"))


def q_ingest_status(spark, sf_dir):
    root = scratch_dir(spark, "ingest-status")
    _raw_extract(spark, sf_dir, root)
    a = split_batch(spark, f"{root}/raw", f"{root}/bronze", *SPLIT_YEARS, label="actual")
    b = snapshot(spark, f"{root}/raw", f"{root}/bronze", label="upcoming")
    return a.unionByName(b).drop("error")


def q_publish_roundtrip(spark, sf_dir):
    dst = scratch_dir(spark, "publish")
    tables = [f"{t}.parquet" for t in TPCH_TABLES]
    status = publish_tables(spark, sf_dir, dst, tables)
    return status.drop("error")


def q_publish_rows(spark, sf_dir):
    """A published copy's contents: line items, copied and read back."""
    dst = scratch_dir(spark, "publish")
    publish_tables(spark, sf_dir, dst, ["lineitem.parquet"])
    return spark.read.parquet(f"{dst}/lineitem.parquet")


def q_publish_nested(spark, sf_dir):
    """Tables at several depths, found by their files and published."""
    root, dst = scratch_dir(spark, "nested"), scratch_dir(spark, "publish")
    for i, t in enumerate(TPCH_TABLES):
        write_table(read_tpch(spark, sf_dir, t), "/".join([root, *(f"level{k}" for k in range(i % 4)), t]))
    return publish_layer(spark, root, dst, recursive=True).drop("error")


def q_published_versions(spark, sf_dir):
    """Line items as read by a reader that came before a second version was published, and by a later one."""
    lines = read_tpch(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    root = scratch_dir(spark, "versions")
    table = CatalogTable("strata_" + root.rsplit("-", 1)[1], "lines", root)
    write_table(lines.where("l_linenumber <= 3"), table)
    early = read_table(spark, table)
    write_table(lines.withColumn("l_quantity", F.col("l_quantity") + 1), table)
    late = read_table(spark, table)
    return early.withColumn("reader", F.lit("early")).unionByName(late.withColumn("reader", F.lit("late")))


#: Text that CSV must keep: line breaks, delimiters, quotes, blanks and both kinds of nothing.
ODD_TEXT = ("plain", "two\nlines", "a;b,c", 'say "hi"', "  lead and trail  ", "", "\ttab\t", "a\r\nb", '"', ",")


def _odd_rows(spark, sf_dir):
    k = F.col("o_orderkey")
    odd = F.element_at(F.array(*[F.lit(t) for t in ODD_TEXT]), (k % len(ODD_TEXT) + 1).cast("int"))
    return _orders(spark, sf_dir).select(k.cast("string").alias("id"), F.when(k % 7 != 0, F.concat(odd, F.when(k % 3 == 0, F.lit("")).otherwise(F.lit("x")))).alias("note"),
                                         F.when(k % 5 != 0, odd).alias("more"))


def q_csv_fidelity(spark, sf_dir):
    """Odd text written as CSV and read back."""
    root = scratch_dir(spark, "fidelity")
    write_csv(_odd_rows(spark, sf_dir), f"{root}/odd.csv", sep=";")
    return read_csv_text(spark, f"{root}/odd.csv")


def q_csv_many_splits(spark, sf_dir):
    """Odd text in files cut into splits of a few kilobytes, read in parallel through the silver reader."""
    root = scratch_dir(spark, "splits")
    write_csv(_odd_rows(spark, sf_dir), f"{root}/odd.csv", sep=";")
    other = spark.newSession()
    other.conf.set("spark.sql.files.maxPartitionBytes", "16KB")
    other.conf.set("spark.sql.files.openCostInBytes", "1KB")
    # splits stay that small, but a task takes many of them: tasks don't grow with the input
    other.conf.set("spark.sql.files.maxPartitionNum", str(SPLIT_TASKS * spark.sparkContext.defaultParallelism))
    rows = read_csv_text(other, f"{root}/odd.csv")
    if rows.rdd.getNumPartitions() < 2:
        raise RuntimeError("the file was not cut")
    write_table(rows, f"{root}/odd.parquet")
    return read_table(spark, f"{root}/odd.parquet")


def q_pass_through_rows(spark, sf_dir):
    """Odd text through the pass-through copy of an ingest batch."""
    root = scratch_dir(spark, "pass")
    write_csv(_odd_rows(spark, sf_dir), f"{root}/raw/odd.table.csv")
    split_batch(spark, f"{root}/raw", f"{root}/bronze", *SPLIT_YEARS, label="actual").collect()
    return read_csv_text(spark, f"{root}/bronze/actual/odd.table.csv")


def q_snapshot_rows(spark, sf_dir):
    """The order extract through the unfiltered snapshot."""
    root = scratch_dir(spark, "snapshot")
    _raw_extract(spark, sf_dir, root)
    snapshot(spark, f"{root}/raw", f"{root}/bronze", label="upcoming").collect()
    return read_csv_text(spark, f"{root}/bronze/upcoming/sales.order.csv").select("OrderID", "CustomerID", "ExpectedDeliveryDate", "LastEditedWhen")


def q_snapshot_rest(spark, sf_dir):
    """The order extract's rows beyond the years of the split batch."""
    root = scratch_dir(spark, "snapshot-rest")
    _raw_extract(spark, sf_dir, root)
    snapshot(spark, f"{root}/raw", f"{root}/bronze", label="upcoming", exclude_years=SPLIT_YEARS).collect()
    return read_csv_text(spark, f"{root}/bronze/upcoming/sales.order.csv").select("OrderID", "CustomerID", "LastEditedWhen")


def q_silver_null_policy_fails(spark, sf_dir):
    """Status of silver jobs that must hold no null in required columns, over an extract of orders that does."""
    root = scratch_dir(spark, "null-fail")
    tdef, out = BY_NAME["orders"], []
    for label, spoilt in (("clean", False), ("spoilt", True)):
        rows = bronze_extract(spark, sf_dir, "orders")
        if spoilt:
            rows = rows.withColumn("CustomerID", F.when(F.col("OrderID").cast("bigint") % 3 == 0, F.lit("NA")).otherwise(F.col("CustomerID")))
        write_extract(rows, f"{root}/{label}/{tdef.bronze_file}")
        status, policy = build_silver(spark, tdef, f"{root}/{label}", f"{root}/silver-{label}", fail_on_nulls=True)
        nulls = {p[1]: p[4] for p in policy if p[2] == "required"}
        out.append((label, status["status"], status["rows"], nulls["customer_id"]))
    return spark.createDataFrame(out, "extract string, status string, rows bigint, customer_nulls bigint")


# ------------------------------------------------------------ exact casts

def _big_numbers(spark, sf_dir):
    k = F.col("o_orderkey")
    big = (k + 9007199254740992).cast("string")
    return _orders(spark, sf_dir).select("o_orderkey", F.when(k % 5 == 0, F.lit("abc")).when(k % 5 == 1, F.concat(big, F.lit(".0"))).when(k % 7 == 0, F.lit("1,234"))
                                         .when(k % 11 == 0, F.lit("12.5")).when(k % 17 == 0, F.concat(big, F.lit("00e-2"))).when(k % 19 == 0, F.lit("1e-11"))
                                         .when(k % 23 == 0, F.lit("1.00000000001e0")).when(k % 29 == 0, F.concat(F.lit("0."), big, F.lit("E+16")))
                                         .when(k % 31 == 0, F.lit("1e19")).when(k % 13 != 0, big).alias("n"))


def q_bigint_exact(spark, sf_dir):
    """Ids beyond the whole numbers of a double, with and without a fraction of zero."""
    return _big_numbers(spark, sf_dir).select("o_orderkey", nullable_bigint("n", strict=False).alias("id"))


def q_cast_failures(spark, sf_dir):
    """Values of an order extract that have no silver value, by column."""
    k = F.col("OrderID").cast("bigint")
    spoilt = bronze_orders(read_tpch(spark, sf_dir, "orders")).withColumn("CustomerID", F.when(k % 10 == 0, F.lit("abc")).when(k % 10 == 1, F.lit("1e-11")).otherwise(F.col("CustomerID")))
    orders = cast_failures(map_null_tokens(spoilt), BY_NAME["orders"]).withColumn("table", F.lit("orders"))
    price = F.col("UnitPrice")
    number = F.col("OrderLineID").cast("bigint") % 8
    lines = bronze_order_lines(read_tpch(spark, sf_dir, "lineitem")).withColumn(
        "UnitPrice", F.when(number == 1, F.concat(price, F.lit("d"))).when(number == 2, F.lit("2f")).when(number == 3, F.lit("0x1p3")).when(number == 4, F.lit("-inf")).otherwise(price))
    return orders.unionByName(cast_failures(map_null_tokens(lines), BY_NAME["order_lines"]).withColumn("table", F.lit("order_lines")))


def q_double_exact(spark, sf_dir):
    """Prices with exponents and signs, and text that only looks like a number."""
    li = read_tpch(spark, sf_dir, "lineitem")
    text = F.col("l_extendedprice").cast("string")
    n = F.col("l_linenumber")
    odd = (F.when(n == 1, F.concat(text, F.lit("d"))).when(n == 2, F.concat(F.lit(" +"), text, F.lit(" "))).when(n == 3, F.lit("2.5e-1"))
           .when(n == 4, F.lit("0x1p3")).when(n == 5, F.lit(".5E+2")).when(n == 6, F.lit("1e")).otherwise(text))
    return li.select("l_orderkey", "l_linenumber", strict_double(odd, strict=False).alias("price"))


def q_inferred_dates(spark, sf_dir):
    """Orders through the silver job with formats by first values: day first, month first, and strays of other forms."""
    root, tdef = scratch_dir(spark, "formats"), BY_NAME["orders"]
    k = F.col("OrderID").cast("bigint")
    day = F.to_timestamp("LastEditedWhen")
    lead = read_tpch(spark, sf_dir, "orders").agg(F.min("o_orderkey")).first()[0]
    rows = bronze_orders(read_tpch(spark, sf_dir, "orders")).withColumns({
        "OrderDate": F.when(k == lead, F.lit("25/12/1995")).when(k % 10 == 3, F.date_format(day, "yyyy-MM-dd")).otherwise(F.date_format(day, "dd/MM/yyyy")),
        "PickingCompletedWhen": F.when(k == lead, F.lit("02/01/1996 10:30")).when(k % 10 == 4, F.lit("13/13/1996 00:00")).otherwise(F.date_format(day, "MM/dd/yyyy HH:mm")),
        "ExpectedDeliveryDate": F.when(k % 4 == 0, F.lit(None)).otherwise(F.date_format(day, "yyyyMMdd"))})
    write_csv(rows.orderBy(k), f"{root}/bronze/{tdef.bronze_file}")
    status, _ = build_silver(spark, tdef, f"{root}/bronze", f"{root}/silver", infer_dates=True)
    if status["status"] != "ok":
        raise RuntimeError(f"silver job failed: {status}")
    return read_table(spark, f"{root}/silver/{tdef.output_path}").select("order_id", "order_date", "picking_completed_when", "expected_delivery_date")


def q_facts_of_a_period(spark, sf_dir):
    """Order lines of the weekends of two years, from a fact table stored by year."""
    tables, root = silver_tables(spark, sf_dir), scratch_dir(spark, "by-year")
    write_by_year(gold.fact_orders(tables), f"{root}/fact_orders", "order_date")
    calendar = gold.dim_calendar(tables)
    out = read_period(spark, f"{root}/fact_orders", "order_date", calendar, f"is_weekend AND year IN ({SPLIT_YEARS[0]}, {SPLIT_YEARS[1]})")
    return out.select("order_id", "order_line_id", "order_date", "quantity")


# ------------------------------------------------------------------ whole run

def _write_extracts(spark, sf_dir, root, but: str | None = None) -> None:
    """The extracts of all tables, ``but`` one; Spark runs what is submitted together."""
    def one(t) -> None:
        write_extract(bronze_extract(spark, sf_dir, t.name), f"{root}/bronze/{t.bronze_file}")

    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(one, [t for t in TABLES if t.name != but]))


def _whole_run(spark, sf_dir, gold: bool = True) -> str:
    """All extracts, silver jobs and (with ``gold``) gold jobs on written tables; returns their root."""
    root = scratch_dir(spark, "whole-run")
    _write_extracts(spark, sf_dir, root)
    if gold:
        status, _ = run_all(spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold", workers=4)
        bad = status.where("status <> 'ok'").collect()
    else:
        bad = [r for r in run_silver(spark, f"{root}/bronze", f"{root}/silver", workers=4)[0] if r["status"] != "ok"]
    if bad:
        raise RuntimeError(f"failed jobs: {bad}")
    return root


def q_run_fact_orders(spark, sf_dir):
    """Bronze extracts to silver to gold, read from the table that the run wrote."""
    return read_table(spark, f"{_whole_run(spark, sf_dir)}/gold/fact_orders")


def q_run_dim_customer(spark, sf_dir):
    out = read_table(spark, f"{_whole_run(spark, sf_dir)}/gold/dim_customer")
    return out.withColumn("credit_limit_amount", F.round("credit_limit_amount", MEAN_DIGITS))


def q_run_summary(spark, sf_dir):
    """Tallies of a run of all silver jobs, a gold job, and one that does not exist."""
    root = scratch_dir(spark, "summary")
    _write_extracts(spark, sf_dir, root)
    silver, _ = run_silver(spark, f"{root}/bronze", f"{root}/silver", workers=4)
    made = run_gold(spark, silver_tables(spark, sf_dir), f"{root}/gold", ["dim_people", "fact_invoices"])
    return run_summary(spark.createDataFrame([(r["layer"], r["status"]) for r in silver + made], "layer string, status string"))


def q_run_resumed(spark, sf_dir):
    """A run that lacks the extract of order lines, and the run that goes on from it once the extract is there."""
    root = scratch_dir(spark, "resumed")
    late = BY_NAME["order_lines"]
    _write_extracts(spark, sf_dir, root, but=late.name)
    roots = (f"{root}/bronze", f"{root}/silver", f"{root}/gold")
    first, _ = run_all(spark, *roots, workers=4, status_path=f"{root}/status")
    out = [(1, r["layer"], r["table"], r["status"], r["rows"]) for r in first.collect()]
    write_extract(bronze_extract(spark, sf_dir, late.name), f"{root}/bronze/{late.bronze_file}")
    second, _ = run_all(spark, *roots, workers=4, status_path=f"{root}/status")
    out += [(2, r["layer"], r["table"], r["status"], r["rows"]) for r in second.collect()]
    return spark.createDataFrame(out, "run int, layer string, table string, status string, rows bigint")


def q_run_catalog(spark, sf_dir):
    """The order facts of a whole run published by catalog entries."""
    root = scratch_dir(spark, "catalog-run")
    _write_extracts(spark, sf_dir, root)
    database = "strata_" + root.rsplit("-", 1)[1]
    status, _ = run_all(spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold", workers=4, database=database)
    bad = status.where("status <> 'ok'").collect()
    if bad:
        raise RuntimeError(f"failed jobs: {bad}")
    return spark.table(f"{database}_gold.fact_orders")


def q_silver_run_status(spark, sf_dir):
    """All 21 silver jobs over their extracts, one of which lacks its file."""
    root = scratch_dir(spark, "silver-run")
    _write_extracts(spark, sf_dir, root, but="transaction_types")
    status, _ = run_silver(spark, f"{root}/bronze", f"{root}/silver", workers=4)
    return spark.createDataFrame([(r["layer"], r["table"], r["status"], r["rows"]) for r in status],
                                 "layer string, table string, status string, rows bigint")


def q_run_all_status(spark, sf_dir):
    dst = scratch_dir(spark, "gold")
    # one deliberately unknown job: its failure is recorded, the others still run
    rows = run_gold(spark, silver_tables(spark, sf_dir), dst, list(gold.GOLD_BUILDERS) + ["fact_invoices"])
    return spark.createDataFrame([(r["layer"], r["table"], r["status"], r["rows"]) for r in rows],
                                 "layer string, table string, status string, rows bigint")


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {name: _gold(name) for name in gold.GOLD_BUILDERS}
    q.update({
        **{f"silver_{t.name}": _silver(t.name) for t in TABLES},
        "silver_csv_roundtrip": silver_csv_roundtrip,
        "silver_incremental": silver_incremental,
        "null_policy": null_policy,
        "null_tokens": q_null_tokens,
        "to_timestamp_coerce": q_to_timestamp_coerce,
        "parse_first_format": q_parse_first_format,
        "nullable_bigint": q_nullable_bigint,
        "number_to_text": q_number_to_text,
        "truthy_flag": q_truthy_flag,
        "drop_empty_columns": q_drop_empty_columns,
        "dedup_columns": q_dedup_columns,
        "rename_select": q_rename_select,
        "drop_strict": q_drop_strict,
        "table_profile": q_table_profile,
        "layer_overview": q_layer_overview,
        "suspicious_dates": q_suspicious_dates,
        "duplicate_keys": q_duplicate_keys,
        "impute_audit": q_impute_audit,
        "ingest_split": q_ingest_split,
        "ingest_status": q_ingest_status,
        "publish_roundtrip": q_publish_roundtrip,
        "silver_run_status": q_silver_run_status,
        "run_all_status": q_run_all_status,
        "run_fact_orders": q_run_fact_orders,
        "run_dim_customer": q_run_dim_customer,
        "run_summary": q_run_summary,
        "bigint_exact": q_bigint_exact,
        "cast_failures": q_cast_failures,
        "csv_fidelity": q_csv_fidelity,
        "pass_through_rows": q_pass_through_rows,
        "snapshot_rows": q_snapshot_rows,
        "publish_rows": q_publish_rows,
        "missing_ratio": q_missing_ratio,
        "nonzero_nulls": q_nonzero_nulls,
        "layer_sizes": q_layer_sizes,
        "table_sample": q_table_sample,
        "key_check": q_key_check,
        "join_growth": q_join_growth,
        "contains_or_false": q_contains_or_false,
        "lookup_null_safe": q_lookup_null_safe,
        "register_views": q_register_views,
        "double_exact": q_double_exact,
        "snapshot_rest": q_snapshot_rest,
        "silver_null_policy_fails": q_silver_null_policy_fails,
        "csv_many_splits": q_csv_many_splits,
        "published_versions": q_published_versions,
        "publish_nested": q_publish_nested,
        "key_bitmaps": q_key_bitmaps,
        "footer_overview": q_footer_overview,
        "calendar_from_footers": q_calendar_from_footers,
        "inferred_dates": q_inferred_dates,
        "facts_of_a_period": q_facts_of_a_period,
        "run_resumed": q_run_resumed,
        "run_catalog": q_run_catalog,
    })
    return q


def oracle() -> dict[str, str]:
    return oracle_queries()
