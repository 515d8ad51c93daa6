"""Publication by pointer, jobs by dependencies, footers, keys by bitmaps, inferred formats, nested listings, years."""

import datetime as dt
import threading
import time

import pytest
from pyspark.sql import functions as F

from fixtures import write_bronze
from strata.functions.casts import cast_failed, nullable_bigint, strict_double
from strata.functions.formats import format_of, inferred_formats
from strata.operators import quality
from strata.operators.joins import header_detail_join
from strata.plans import gold
from strata.plans.by_year import read_period, write_by_year
from strata.plans.job_graph import Job, run_jobs, status_row
from strata.plans.runner import run_all, run_gold, silver_inputs
from strata.sources import footers
from strata.sources.catalog import CatalogTable
from strata.sources.parquet import read_table, write_table
from strata.sources.paths import find_files, find_tables, list_entries
from strata.sources.publish import publish_layer


def plan_of(df):
    return df._jdf.queryExecution().toString()


# ------------------------------------------------------------------- versions

def test_readers_keep_their_version(spark, tmp):
    t = CatalogTable("strata_v1", "numbers", f"{tmp}/it's a root")
    write_table(spark.range(5), t)
    early = read_table(spark, t)
    assert t.location(spark).endswith(t.versions(spark)[0])
    write_table(spark.range(100), t)
    late = read_table(spark, t)
    assert (early.count(), late.count()) == (5, 100)
    assert len(t.versions(spark)) == 2
    # nothing was renamed: both versions lie where they were written, no staging folder is left
    assert list_entries(spark, t.folder) == t.versions(spark)


def test_versions_are_released_but_not_the_published_one(spark, tmp):
    t = CatalogTable("strata_v2", "numbers", tmp)
    for n in range(1, 5):
        write_table(spark.range(n), t)
    assert t.release(spark, keep=2) == t.versions(spark)[:0] or len(t.versions(spark)) == 3
    t.release(spark, keep=0)
    assert len(t.versions(spark)) == 1 and read_table(spark, t).count() == 4


def test_rejected_empty_and_failed_writes_publish_nothing(spark, tmp):
    t = CatalogTable("strata_v3", "numbers", tmp)
    write_table(spark.range(3), t)
    write_table(spark.range(0), t, skip_empty=True)
    write_table(spark.range(9), t, publish=lambda m: False)
    with pytest.raises(Exception):
        write_table(spark.range(4).select(F.raise_error(F.lit("no")).cast("bigint").alias("id")), t)
    assert read_table(spark, t).count() == 3 and len(t.versions(spark)) == 1
    with pytest.raises(ValueError, match="partitioned"):
        write_table(spark.range(3), t, partition_by=["id"])


def test_a_version_with_other_columns(spark, tmp):
    t = CatalogTable("strata_v4", "things", tmp)
    write_table(spark.range(3), t)
    write_table(spark.range(2).select("id", F.lit("x").alias("more")), t)
    assert read_table(spark, t).columns == ["id", "more"] and read_table(spark, t).count() == 2
    assert CatalogTable("strata_v4", "nothing", tmp).location(spark) is None


def test_a_run_published_by_catalog(spark, tmp):
    bronze = write_bronze(f"{tmp}/bronze/actual")
    status, _ = run_all(spark, bronze, f"{tmp}/silver", f"{tmp}/gold", workers=4, database="strata_run")
    assert {r["status"] for r in status.collect()} == {"ok"}
    plain, _ = run_all(spark, bronze, f"{tmp}/silver2", f"{tmp}/gold2", workers=4)
    for name in gold.GOLD_BUILDERS:
        a, b = spark.table(f"strata_run_gold.{name}"), spark.read.parquet(f"{tmp}/gold2/{name}")
        assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


# ------------------------------------------------------------------ job graph

def test_jobs_wait_for_their_inputs_and_run_together():
    done, lock = [], threading.Lock()

    def job(name, wait=0.0):
        def run():
            time.sleep(wait)
            with lock:
                done.append(name)
            return status_row("x", name, "ok", 1)
        return run

    jobs = [Job("x", "c", job("c"), (("x", "a"), ("x", "b"))), Job("x", "a", job("a", 0.2)), Job("x", "b", job("b")), Job("x", "d", job("d"), (("x", "b"), ("other", "known")))]
    rows = run_jobs(jobs, workers=3)
    assert [r["table"] for r in rows] == ["c", "a", "b", "d"]
    assert done.index("c") == 3 and done.index("d") < done.index("a")


def test_failed_inputs_block_and_circles_are_errors():
    ok = lambda t: (lambda: status_row("x", t, "ok", 1))

    def fails():
        raise KeyError("broken")

    jobs = [Job("x", "a", fails), Job("x", "b", ok("b"), (("x", "a"),)), Job("x", "c", ok("c"), (("x", "b"),)), Job("x", "d", ok("d"))]
    for workers in (1, 4):
        rows = {r["table"]: r for r in run_jobs(jobs, workers)}
        assert [rows[t]["status"] for t in "abcd"] == ["failed", "blocked", "blocked", "ok"]
        assert "broken" in rows["a"]["error"] and "x/a is failed" in rows["b"]["error"] and "x/b is blocked" in rows["c"]["error"]
    with pytest.raises(ValueError, match="circle"):
        run_jobs([Job("x", "a", ok("a"), (("x", "b"),)), Job("x", "b", ok("b"), (("x", "a"),))])
    assert run_jobs([]) == []


def test_done_jobs_are_taken_over_unless_an_input_runs_anew():
    ran = []
    job = lambda t, *i: Job("x", t, lambda: ran.append(t) or status_row("x", t, "ok", 2), tuple(("x", n) for n in i))
    earlier = {("x", t): status_row("x", t, s, 1) for t, s in (("a", "ok"), ("b", "failed"), ("c", "ok"), ("d", "ok"), ("e", "skipped_empty"))}
    rows = run_jobs([job("a"), job("b"), job("c", "b"), job("d", "a"), job("e")], done=earlier)
    assert sorted(ran) == ["b", "c"] and [r["rows"] for r in rows] == [1, 2, 2, 1, 1]


def test_a_failed_silver_table_blocks_gold_and_the_run_goes_on(spark, tmp):
    bronze = write_bronze(f"{tmp}/bronze/actual")
    import os
    os.rename(f"{bronze}/sales.orderline.csv", f"{tmp}/kept.csv")
    # an older order_lines table lies in silver: it must not be read
    write_table(spark.range(1).select(F.col("id").alias("order_id")), f"{tmp}/silver/sales/order_lines")
    status, _ = run_all(spark, bronze, f"{tmp}/silver", f"{tmp}/gold", workers=4, status_path=f"{tmp}/status")
    by = {(r.layer, r.table): r for r in status.collect()}
    assert by["silver", "order_lines"].status == "failed" and by["gold", "fact_orders"].status == "blocked"
    assert sorted(k for k, r in by.items() if r.status != "ok") == [("gold", "fact_orders"), ("silver", "order_lines")]
    assert {r.layer: r.blocked for r in quality.run_summary(status).collect()} == {"silver": 0, "gold": 1}
    os.rename(f"{tmp}/kept.csv", f"{bronze}/sales.orderline.csv")
    again, policy = run_all(spark, bronze, f"{tmp}/silver", f"{tmp}/gold", status_path=f"{tmp}/status")
    second = {(r.layer, r.table): r for r in again.collect()}
    assert {r.status for r in second.values()} == {"ok"}
    assert second["silver", "orders"].seconds == by["silver", "orders"].seconds  # taken over
    assert {r["table"] for r in policy.collect()} == {"order_lines"}


# --------------------------------------------------------------------- footers

def test_bounds_and_counts_read_no_row(spark, tmp):
    df = spark.range(1000).select("id", (F.col("id") % 7 == 0).alias("b"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("s"),
                                  F.when(F.col("id") > 0, F.timestamp_add("SECOND", F.col("id"), F.lit("2013-05-01").cast("timestamp_ntz"))).alias("t"),
                                  F.date_add(F.lit("2012-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
                                  F.lit(None).cast("timestamp_ntz").alias("never"), F.when(F.col("id") % 10 == 0, F.lit(float("nan"))).when(F.col("id") % 10 > 1, F.lit(1.0)).alias("x"))
    df.repartition(3).write.parquet(f"{tmp}/t")
    plan = plan_of(footers.pushed(spark, f"{tmp}/t", [F.count(F.lit(1)), F.min("t"), F.max("t")], ["t"]))
    assert "PushedAggregation: [COUNT(*), MIN(t), MAX(t)]" in plan
    assert footers.footer_bounds(spark, f"{tmp}/t", ["t", "day", "never", "absent"]) == {
        "t": (dt.datetime(2013, 5, 1, 0, 0, 1), dt.datetime(2013, 5, 1, 0, 16, 39)), "day": (dt.date(2012, 1, 1), dt.date(2014, 9, 26))}
    got = footers.footer_counts(spark, f"{tmp}/t")
    assert got["rows"] == 1000 and got["missing"] == {"id": 0, "b": 0, "s": 334, "t": 1, "day": 0, "never": 1000, "x": 200}
    row = quality.layer_overview({"t": spark.read.parquet(f"{tmp}/t")}, "l", {"t": 3000}).first()
    assert footers.footer_overview(spark, {"t": f"{tmp}/t"}, "l", {"t": 3000}).first().asDict() == row.asDict()
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_calendar_of_written_tables(spark, tmp):
    t = spark.createDataFrame([(dt.datetime(1999, 12, 31, 23), None), (None, dt.datetime(2001, 3, 1))], "order_date timestamp_ntz, expected_delivery_date timestamp_ntz")
    write_table(t, f"{tmp}/silver/purchasing/purchase_orders")
    write_table(spark.createDataFrame([(None,)], "last_receipt_date timestamp_ntz"), f"{tmp}/silver/purchasing/purchase_order_lines")
    tables = silver_inputs(spark, f"{tmp}/silver")
    a, b = gold.dim_calendar(tables), gold.dim_calendar(tables, bounds=tables.date_bounds(gold.CALENDAR_SOURCES))
    assert a.exceptAll(b).isEmpty() and b.count() == 365 + 366 + 365
    write_table(t.limit(0), f"{tmp}/silver/purchasing/purchase_orders")
    with pytest.raises(Exception, match="No valid dates"):
        gold.dim_calendar(tables, bounds=tables.date_bounds(gold.CALENDAR_SOURCES)).count()
    with pytest.raises(FileNotFoundError):
        silver_inputs(spark, f"{tmp}/none").date_bounds(gold.CALENDAR_SOURCES)


# ------------------------------------------------------------------------ keys

def plain_check(rows):
    from collections import Counter
    n = Counter(r for r in rows if r is not None)
    return len(rows), sum(r is None for r in rows), sum(v > 1 for v in n.values())


@pytest.mark.parametrize("rows", [list(range(5000)), [*range(4000), *range(100, 130), 7, 7, None, None], [-5, -5, -32769, 0, 0, 32768, 2**62, -(2**62)], [None, None], [],
                                  [i * 10**12 for i in range(50)] * 2])
def test_keys_by_bitmaps_equal_counting(spark, rows):
    df = spark.createDataFrame([(r,) for r in rows], "k bigint").repartition(3)
    bitmaps = {"rows": len(rows), "null_keys": sum(r is None for r in rows), "bitmaps": 0}
    for cost in (None, bitmaps):
        assert tuple(quality.check_key(df, "k", cost).first()) == plain_check(rows)
    text = df.select(F.col("k").cast("string").alias("k"))
    assert tuple(quality.check_key(text, "k").first()) == plain_check(rows)


def test_keys_in_order_are_not_shuffled(spark, tmp):
    spark.range(0, 400_000, 1, 4).write.parquet(f"{tmp}/keys")
    df = spark.read.parquet(f"{tmp}/keys")
    cost = quality.bitmap_cost(df, "id")
    assert cost["bitmaps"] * quality.BITMAP_BYTES * 20 < cost["rows"] * quality.KEY_BYTES
    assert "bitmap_construct_agg" in plan_of(quality.check_key(df, "id"))
    apart = df.select((F.xxhash64("id")).alias("id"))
    assert "bitmap_construct_agg" not in plan_of(quality.check_key(apart, "id"))
    assert tuple(quality.check_key(df, "id").first()) == tuple(quality.check_key(apart, "id").first()) == (400_000, 0, 0)
    # what is exchanged for the bitmaps: a row a task and run of values, not one a key
    bitmaps = quality.key_bitmaps(df, "id")
    assert bitmaps.count() == 14 and bitmaps.agg(F.sum("n"), F.sum("different")).first()[:] == (400_000, 400_000)


# ----------------------------------------------------------------- join growth

def test_growth_counted_by_the_run_equals_counting_each_step(spark, tmp):
    bronze = write_bronze(f"{tmp}/bronze/actual")
    growth: dict = {}
    status, _ = run_all(spark, bronze, f"{tmp}/silver", f"{tmp}/gold", growth=growth)
    assert {r["status"] for r in status.collect()} == {"ok"}
    tables = silver_inputs(spark, f"{tmp}/silver")
    for name in gold.JOINING:
        steps: list = []
        want = gold.GOLD_BUILDERS[name](tables, trace=steps)
        assert growth[name] == [(f"{name}: {label}", df.count()) for label, df in steps]
        assert read_table(spark, f"{tmp}/gold/{name}").exceptAll(want).isEmpty()


def test_growth_of_empty_tables(spark, tmp):
    bronze = write_bronze(f"{tmp}/bronze/actual")
    run_all(spark, bronze, f"{tmp}/silver", f"{tmp}/gold")
    tables = dict(silver_inputs(spark, f"{tmp}/silver"))
    for empty in ("orders", "order_lines", "people"):
        some = tables | {empty: spark.createDataFrame([], tables[empty].schema)}
        growth: dict = {}
        run_gold(spark, some, f"{tmp}/gold-{empty}", ["fact_orders"], growth=growth)
        steps: list = []
        gold.fact_orders(some, trace=steps)
        assert growth["fact_orders"] == [(f"fact_orders: {label}", df.count()) for label, df in steps]


def test_observed_fan_out_has_the_same_rows_and_one_header_exchange(spark):
    header = spark.createDataFrame([(i if i % 5 else None, f"h{i}") for i in range(40)], "k bigint, h string")
    detail = spark.createDataFrame([(i % 17 if i % 3 else None, i) for i in range(90)], "k bigint, d bigint")
    plain, observed = (header_detail_join(header, detail, "k", ["d"], observed=o) for o in (False, True))
    assert plain.exceptAll(observed).isEmpty() and observed.exceptAll(plain).isEmpty()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        noted = quality.JoinGrowth("job")
        df = header_detail_join(noted.note("header", header), detail, "k", ["d"], observed=True)
        df.collect()
        assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
        assert noted.rows() == [("job: header", 40)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# --------------------------------------------------------------------- formats

def test_formats_of_shapes(spark):
    want = {"2013-01-02": "yyyy-MM-dd", "2013-01-02 10:11:12": "yyyy-MM-dd HH:mm:ss", "2013-01-02T10:11:12.5": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSSS", "20130102": "yyyyMMdd",
            "13/01/2013": "dd/MM/yyyy", "12/01/2013": "MM/dd/yyyy", "31.12.2013 10:00": "dd.MM.yyyy HH:mm", "garbage": None, "2013-1-2": None}
    df = spark.createDataFrame([(k,) for k in want], "v string")
    assert {r.v: r.f for r in df.select("v", format_of(F.col("v")).alias("f")).collect()} == want


def test_the_first_value_decides(spark):
    rows = [(3, "2013-01-02", None), (1, None, None), (2, "25/12/2013", None), (0, None, None)]
    df = spark.createDataFrame(rows, "at int, a string, b string").repartition(3)
    assert inferred_formats(df, ["a", "b"], "at") == {"a": "dd/MM/yyyy", "b": None}
    assert inferred_formats(df, [], "at") == {}


# -------------------------------------------------------------------- listings

def test_tables_at_any_depth(spark, tmp):
    for rel, n in (("orders", 3), ("sales/lines", 4), ("a/b/c/deep", 5)):
        spark.range(n).repartition(2).write.parquet(f"{tmp}/src/{rel}")
    spark.range(6).select("id", (F.col("id") % 2).alias("part")).write.partitionBy("part").parquet(f"{tmp}/src/x/parted")
    found = {r["table"]: (r["files"], r["bytes"]) for r in find_tables(spark, f"{tmp}/src").collect()}
    assert set(found) == {"orders", "sales/lines", "a/b/c/deep", "x/parted"} and all(b > 0 for _, b in found.values())
    df = find_files(spark, f"{tmp}/src", "part-*")
    assert df.count() == sum(n for n, _ in found.values()) and "content" not in plan_of(df).split("Physical Plan")[1]
    status = {r["table"]: r["rows"] for r in publish_layer(spark, f"{tmp}/src", f"{tmp}/dst", recursive=True).collect()}
    assert status == {"orders": 3, "sales/lines": 4, "a/b/c/deep": 5, "x/parted": 6}
    with pytest.raises(FileNotFoundError):
        find_files(spark, f"{tmp}/none")


def test_csv_tables_at_any_depth(spark, tmp):
    from strata.sources.csv import read_csv_text, write_csv
    write_csv(spark.range(3).select(F.col("id").cast("string")), f"{tmp}/src/a/one.csv")
    with open(f"{tmp}/src/two.csv", "w") as f:
        f.write("x\n1\n2\n")
    with open(f"{tmp}/src/notes.txt", "w") as f:
        f.write("no table")
    status = {r["table"]: r["rows"] for r in publish_layer(spark, f"{tmp}/src", f"{tmp}/dst", fmt="csv", recursive=True).collect()}
    assert status == {"a/one.csv": 3, "two.csv": 2}
    assert read_csv_text(spark, f"{tmp}/dst/two.csv").count() == 2


# ----------------------------------------------------------------------- years

def test_periods_open_their_years_only(spark, tmp):
    fact = spark.range(4000).select("id", F.when(F.col("id") % 50 > 0, F.timestamp_add("HOUR", F.col("id") * 11, F.lit("2010-01-01").cast("timestamp_ntz"))).alias("d"))
    assert write_by_year(fact, f"{tmp}/fact", "d")["rows"] == 4000
    days = spark.sql("SELECT explode(sequence(DATE '2010-01-01', DATE '2016-12-31')) AS date")
    days.select("date", F.quarter("date").alias("quarter"), F.when(F.year("date") == 2012, "leap").otherwise("plain").alias("kind")).write.parquet(f"{tmp}/calendar")
    df = read_period(spark, f"{tmp}/fact", "d", spark.read.parquet(f"{tmp}/calendar"), "quarter = 2 AND kind = 'leap'")
    assert "dynamicpruning" in plan_of(df)
    want = fact.where((F.quarter("d") == 2) & (F.year("d") == 2012))
    assert df.columns == ["id", "d"] and df.exceptAll(want).isEmpty() and want.exceptAll(df).isEmpty()
    # what a condition says of the year itself is known before the run
    early = read_period(spark, f"{tmp}/fact", "d", spark.read.parquet(f"{tmp}/calendar"), "quarter = 2 AND year(date) = 2012")
    assert "(d_year#" in plan_of(early).split("PartitionFilters: [")[1].split("]")[0] and early.exceptAll(want).isEmpty()
    assert spark.read.parquet(f"{tmp}/fact").where("d IS NULL").count() == 80


# ----------------------------------------------------------------------- casts

def test_exponents_and_suffixes(spark):
    want = {"1e-11": None, "1.00000000001e0": None, "12e0": 12, "12.50e1": 125, "1200E-2": 12, "1201e-2": None, "0e99": 0, "-0.0e5": 0, "9.223372036854775807e18": 2**63 - 1,
            "9.223372036854775808e18": None, "-9223372036854775808e0": -(2**63), "1e19": None, "1e999999999": None, "0.00012e4": None, "0.00012e5": 12, "e5": None, ".e1": None, ".5e1": 5, "+7.e0": 7,
            " 12 ": 12, "12.": 12, ".0": 0, "12d": None, "0x10": None}
    df = spark.createDataFrame([(k,) for k in want], "v string")
    got = {r.v: r.n for r in df.select("v", nullable_bigint("v", strict=False).alias("n")).collect()}
    assert got == want
    for bad in ("1e-11", "1.00000000001e0", "12d"):
        with pytest.raises(Exception, match="non-integral"):
            spark.createDataFrame([(bad,)], "v string").select(nullable_bigint("v")).collect()
    doubles = {"1d": None, "2f": None, "1.5D": None, "0x1p3": None, "1e3": 1000.0, "-.5": -0.5, "5.": 5.0, " 7 ": 7.0, "inf": float("inf"), "-Infinity": float("-inf"), "abc": None}
    df = spark.createDataFrame([(k,) for k in doubles], "v string")
    assert {r.v: r.n for r in df.select("v", strict_double("v", strict=False).alias("n")).collect()} == doubles
    assert {r.v for r in df.where(cast_failed("v", "double")).collect()} == {k for k, v in doubles.items() if v is None}
    with pytest.raises(Exception, match="not a number"):
        spark.createDataFrame([("1d",)], "v string").select(strict_double("v")).collect()
