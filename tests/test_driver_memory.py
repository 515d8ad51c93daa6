"""Gold jobs over written tables: what is broadcast stays below Spark's threshold, however small the files are."""

import uuid

import pytest
from pyspark.sql import functions as F

from strata.harness.tpch import SOURCE_OF, silver_tables
from strata.operators.joins import exceeds_broadcast, header_detail_join, lookup_join
from strata.plans import gold
from strata.plans.runner import silver_inputs, silver_target
from strata.sources.parquet import write_table

#: Customers, people and cities: over 10 MB a lookup in memory, some 4 MB of files.
MANY = 500_000
LIMIT = 10 << 20


def sources(spark, sf):
    """Seven TPC-H-like tables of which customer has many rows."""
    n = F.col("id")
    day = F.lit("1996-02-03 00:00:00").cast("timestamp_ntz")
    tables = {
        "region": spark.range(5).select(n.cast("int").alias("r_regionkey"), F.concat(F.lit("REGION "), n.cast("string")).alias("r_name")),
        "nation": spark.range(25).select(n.cast("int").alias("n_nationkey"), F.concat(F.lit("NATION "), n.cast("string")).alias("n_name"), (n % 5).cast("int").alias("n_regionkey")),
        "customer": spark.range(0, MANY, 1, 2).select(n.alias("c_custkey"), F.concat(F.lit("Customer#000"), n.cast("string")).alias("c_name"), (n % 25).cast("int").alias("c_nationkey"),
                                                      (n % 1000 + 0.5).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment")),
        "supplier": spark.range(20).select(n.alias("s_suppkey"), F.lit("Supplier").alias("s_name"), (n % 25).cast("int").alias("s_nationkey"), F.lit(1.5).alias("s_acctbal")),
        "orders": spark.range(0, 4000).select(n.alias("o_orderkey"), (n * 70).alias("o_custkey"), F.when(n % 2 == 0, "F").otherwise("O").alias("o_orderstatus"), F.lit(1.5).alias("o_totalprice"),
                                              day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")),
        "lineitem": spark.range(0, 9000).select((n % 3500).alias("l_orderkey"), (n % 20).alias("l_partkey"), (n % 20).alias("l_suppkey"), (n % 7).cast("int").alias("l_linenumber"), F.lit(3.0).alias("l_quantity"),
                                                (n * 0.25).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"), F.lit(0.2).alias("l_tax"), F.lit("A").alias("l_returnflag"), F.lit("F").alias("l_linestatus"), day.alias("l_shipdate")),
    }
    for name, df in tables.items():
        df.write.parquet(f"{sf}/{name}.parquet")
    views = silver_tables(spark, sf)
    return {name: views[name] for name, source in SOURCE_OF.items() if source in tables}


def written(spark, views, root, database=None):
    for name, df in views.items():
        write_table(df, silver_target(name, root, database))
    return silver_inputs(spark, root, database)


@pytest.fixture(scope="module")
def views(spark, tmp_path_factory):
    return sources(spark, str(tmp_path_factory.mktemp("memory")))


@pytest.fixture(scope="module")
def tables(spark, views, tmp_path_factory):
    return written(spark, views, str(tmp_path_factory.mktemp("silver")))


def parts(plan):
    """All nodes of a plan that ran, with those of its stages."""
    yield plan
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        yield from parts(plan.executedPlan())
    elif name.endswith("QueryStage"):
        yield from parts(plan.plan())
    children = plan.children()
    for i in range(children.size()):
        yield from parts(children.apply(i))


def broadcast_bytes(df):
    """Bytes of each broadcast of a query, which is run."""
    ran = df._jdf.queryExecution()
    ran.toRdd().count()
    return [p.metrics().apply("dataSize").value() for p in parts(ran.executedPlan()) if p.nodeName() == "BroadcastExchange"]


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_lookups_of_order_facts_stay_off_the_driver(views, tables):
    out = gold.fact_orders(tables)
    sizes = broadcast_bytes(out)
    assert sizes and max(sizes) <= LIMIT  # the few salespeople are broadcast, the people and customers aren't
    assert same_rows(out, gold.fact_orders(views))


def test_many_salespeople_are_no_broadcast(spark, views, tmp):
    orders = spark.range(0, MANY, 1, 2).select(*[F.col("id").alias(c) if c in ("order_id", "salesperson_id") else F.lit(None).cast(t).alias(c) for c, t in views["orders"].dtypes])
    few = {**views, "orders": orders, "order_lines": views["order_lines"].where("order_id < 50")}
    out = gold.fact_orders(written(spark, few, tmp))
    assert max([0, *broadcast_bytes(out)]) <= LIMIT
    assert out.count() > MANY and out.where("sales_person IS NULL").isEmpty()


def test_only_what_is_large_in_memory_is_shuffled(spark, tables):
    assert tables.too_large("people", ["person_id", "full_name"]) and tables.too_large("cities", ["state_province_id", "city_id", "city_name"])
    assert not tables.too_large("people", ["person_id", "full_name"], ("orders", "salesperson_id"))
    assert not tables.too_large("delivery_methods", ["delivery_method_id", "delivery_method_name"])
    texts = spark.range(0, 2000).select("id", F.repeat(F.lit("x"), 6000).alias("t"))
    assert exceeds_broadcast(texts) and exceeds_broadcast(texts, 2000) and not exceeds_broadcast(texts.select("id"), 2000)
    assert not exceeds_broadcast(texts.where("false"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not exceeds_broadcast(texts)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_customers_cities_and_contacts_stay_off_the_driver(views, tables):
    out = gold.dim_customer(tables, mean_digits=6)
    assert max([0, *broadcast_bytes(out)]) <= LIMIT
    assert same_rows(out, gold.dim_customer(views, mean_digits=6))


def test_tables_of_a_catalog_stay_off_the_driver(spark, views, tmp):
    database = f"strata_memory_{uuid.uuid4().hex[:8]}"
    tables = written(spark, views, tmp, database)
    for name in ("fact_orders", "dim_geography", "dim_supplier", "fact_purchases"):
        out = gold.GOLD_BUILDERS[name](tables)
        assert max([0, *broadcast_bytes(out)]) <= LIMIT
        assert same_rows(out, gold.GOLD_BUILDERS[name](views))


def test_shuffled_joins_keep_rows_of_null_and_repeated_keys(spark):
    facts = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 9), (5, None), (5, None)], "id bigint, k bigint")
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n"), (3, None)], "k bigint, v string")
    for how in ({}, {"null_safe": True}, {"few_keys": True}):
        plain, shuffled = (lookup_join(facts, dim, "k", attrs=["v"], shuffled=s, **how) for s in (False, True))
        assert sorted(map(str, shuffled.collect())) == sorted(map(str, plain.collect()))
    lines = dim.withColumnRenamed("v", "line")
    plain = sorted(map(str, header_detail_join(facts, lines, "k", ["line"]).collect()))
    for observed in (False, True):
        out = header_detail_join(facts, lines, "k", ["line"], observed=observed, shuffled=True)
        assert sorted(map(str, out.collect())) == plain
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
