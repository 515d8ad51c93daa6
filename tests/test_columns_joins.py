import pytest
from pyspark.sql import functions as F

from strata.operators.columns import (dedup_columns, drop_empty_columns, drop_strict, rename_columns,
                                      select_strict)
from strata.operators.joins import header_detail_join, lookup_join, self_lookup


def test_rename_ignores_missing(spark):
    df = spark.createDataFrame([(1, "a")], "A int, B string")
    assert rename_columns(df, {"A": "a", "Z": "z"}).columns == ["a", "B"]


def test_select_and_drop_strict(spark):
    df = spark.createDataFrame([(1, "a")], "a int, b string")
    assert select_strict(df, ["b", "a"]).columns == ["b", "a"]
    with pytest.raises(KeyError):
        select_strict(df, ["a", "nope"])
    with pytest.raises(KeyError):
        drop_strict(df, ["nope"])
    assert drop_strict(df, ["b"]).columns == ["a"]


def test_drop_empty_columns(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (2, None, None)], "a int, b string, c double")
    assert drop_empty_columns(df).columns == ["a", "c"]   # NaN is a value
    assert drop_empty_columns(df, keep=["b"]).columns == ["a", "b", "c"]


def test_dedup_columns_keeps_first(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").select("a", "b", F.col("a").alias("b"))
    out = dedup_columns(df)
    assert out.columns == ["a", "b"] and out.first() == (1, 2)


@pytest.fixture()
def people(spark):
    return spark.createDataFrame([(1, "Sys"), (2, "Ann"), (3, "Bob")], "person_id bigint, full_name string")


def test_lookup_join_roles_keep_rows(spark, people):
    orders = spark.createDataFrame([(10, 2, 3), (11, 3, None), (12, 9, 2)],
                                   "order_id bigint, salesperson_id bigint, contact_person_id bigint")
    out = lookup_join(orders, people, "salesperson_id", "person_id", {"full_name": "sales_person"})
    out = lookup_join(out, people, "contact_person_id", "person_id", {"full_name": "contact_person"},
                      few_keys=True)
    rows = {r.order_id: (r.sales_person, r.contact_person) for r in out.collect()}
    assert rows == {10: ("Ann", "Bob"), 11: ("Bob", None), 12: (None, "Ann")}
    assert out.columns == ["order_id", "salesperson_id", "contact_person_id", "sales_person", "contact_person"]


def test_lookup_join_null_safe(spark):
    fact = spark.createDataFrame([(1, None)], "id int, k bigint")
    dim = spark.createDataFrame([(None, "null-row")], "k bigint, v string")
    assert lookup_join(fact, dim, "k", attrs=["v"]).first().v is None
    assert lookup_join(fact, dim, "k", attrs=["v"], null_safe=True).first().v == "null-row"


def test_lookup_rejects_shadowing(spark, people):
    with pytest.raises(ValueError):
        lookup_join(people, people, "person_id", attrs=["full_name"])


def test_header_detail_equals_left_join(spark):
    h = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "order_id bigint, h string")
    d = spark.createDataFrame([(1, 11, 1.0), (1, 12, 2.0), (3, 31, 3.0), (None, 99, 9.0), (7, 71, 7.0)],
                              "order_id bigint, line_id bigint, q double")
    out = header_detail_join(h, d, "order_id", ["line_id", "q"])
    expect = h.join(d, "order_id", "left").select("order_id", "h", "line_id", "q")
    assert sorted(out.collect()) == sorted(expect.collect())
    assert out.count() == 4


def test_self_lookup(spark):
    df = spark.createDataFrame([(1, 1, 100.0), (2, 1, None), (3, 4, None)], "id bigint, parent bigint, v double")
    got = {r.id: r.pv for r in self_lookup(df, "id", "parent", "v", "pv").collect()}
    assert got == {1: 100.0, 2: 100.0, 3: None}
