"""Skew and size behaviour of the join operators (plans checked, results exact)."""

import contextlib
import io

from pyspark.sql import functions as F

from strata.operators.joins import header_detail_join, lookup_join


def _final_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def _conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_and_null_fact_keys_are_split(spark):
    with _conf(spark, SKEW_CONF):
        n = 300_000
        # a third of the facts point at dimension key 7, another third have no key
        fact = spark.range(0, n).select(
            F.col("id"),
            F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None))
             .otherwise(F.col("id") % 5000).alias("k"))
        dim = spark.range(0, 5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        out = lookup_join(fact, dim, "k", attrs=["v"])
        rows = out.collect()
        assert len(rows) == n
        assert sum(1 for r in rows if r.v is None) == n // 3
        assert "skew=true" in _final_plan(out)


def test_hot_detail_key_is_split(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 300_000
        header = spark.range(0, 1000).select(F.col("id").alias("order_id"), (F.col("id") % 7).alias("h"))
        # one order owns a third of all lines; order 999 has none
        detail = spark.range(0, n).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 998 + 1).alias("order_id"),
            F.col("id").alias("line_id"))
        out = header_detail_join(header, detail, "order_id", ["line_id"])
        rows = out.collect()               # runs this DataFrame's own adaptive plan
        assert len(rows) == n + 1
        assert [r.order_id for r in rows if r.line_id is None] == [999]
        plan = _final_plan(out)
        assert "isFinalPlan=true" in plan and "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_lookup_preserves_rows_with_null_and_hot_keys(spark):
    fact = spark.range(0, 50_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 10).alias("k"))
    dim = spark.range(0, 10).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    out = lookup_join(fact, dim, "k", attrs=["v"])
    assert out.count() == 50_000
    assert out.where("k IS NULL AND v IS NULL").count() == fact.where("k IS NULL").count()


def test_header_of_the_fan_out_is_shuffled_once(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        header = spark.range(0, 2000).select(F.col("id").alias("order_id"), (F.col("id") % 7).alias("h")).withColumn("order_id", F.when(F.col("h") != 3, F.col("order_id")))
        dim = spark.range(0, 7).select(F.col("id").alias("h"), F.col("id").cast("string").alias("name"))
        header = lookup_join(header, dim, "h", attrs=["name"])
        detail = spark.range(0, 5000).select((F.col("id") % 1500).alias("order_id"), F.col("id").alias("line_id"))
        out = header_detail_join(header, detail, "order_id", ["line_id"])
        expected = header.join(detail, "order_id", "left").select(*out.columns)
        assert sorted(map(str, out.collect())) == sorted(map(str, expected.collect()))
        assert "ReusedExchange" in _final_plan(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
