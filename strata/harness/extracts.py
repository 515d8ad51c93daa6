"""Bronze extracts of all 21 tables from the TPC-H-like tables, and the silver rows they must give.

Four tables have extracts of their own (``bronze_tpch``).  The others follow
one rule per column type over the key of a supplied table: ids written as
integers and floats, decimals, dates, text with blanks and quotes, missing
value tokens on nullable columns, wholly empty optional columns, sentinels
and helper columns.  ``silver_sql`` states the typed result in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.harness.bronze_tpch import SENTINEL, bronze_customers, bronze_order_lines, bronze_orders, bronze_stock_items
from strata.harness.tpch import read_tpch
from strata.plans.specs import BY_NAME, TableDef
from strata.sources.csv import write_csv

OWN: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "orders": ("orders", bronze_orders), "order_lines": ("lineitem", bronze_order_lines),
    "customers": ("customer", bronze_customers), "stock_items": ("part", bronze_stock_items),
}

# table -> (source table, key in SQL, parent key column and its value in SQL)
LINE_KEY = "l_orderkey * 100 + l_linenumber"
SOURCES: dict[str, tuple[str, str, dict[str, str]]] = {
    "cities": ("customer", "c_custkey", {}),
    "colors": ("region", "r_regionkey", {}),
    "countries": ("region", "r_regionkey", {}),
    "delivery_methods": ("region", "r_regionkey", {}),
    "invoices": ("orders", "o_orderkey", {"order_id": "o_orderkey", "customer_id": "o_custkey"}),
    "invoice_lines": ("lineitem", LINE_KEY, {"invoice_id": "l_orderkey", "stock_item_id": "l_partkey"}),
    "package_types": ("nation", "n_nationkey", {}),
    "payment_methods": ("region", "r_regionkey", {}),
    "people": ("customer", "c_custkey", {}),
    "provinces": ("nation", "n_nationkey", {}),
    "purchase_orders": ("orders", "o_orderkey", {"contact_person_id": "o_custkey"}),
    "purchase_order_lines": ("lineitem", LINE_KEY, {"purchase_order_id": "l_orderkey", "stock_item_id": "l_partkey"}),
    "stock_groups": ("region", "r_regionkey", {}),
    "stock_item_holdings": ("part", "p_partkey", {}),
    "suppliers": ("supplier", "s_suppkey", {}),
    "supplier_transactions": ("orders", "o_orderkey", {}),
    "transaction_types": ("region", "r_regionkey", {}),
}
# foreign keys of the derived tables: value is key % number
LINKS = {"country_id": 5, "state_province_id": 25, "supplier_id": 100, "delivery_method_id": 5, "package_type_id": 25,
         "primary_contact_person_id": 150, "alternate_contact_person_id": 150, "delivery_city_id": 150, "postal_city_id": 150}
TOKENS = ("NA", "NULL", "", "nan")

#: Rows of a file of an extract, as exports are cut; a file is read by one task.
FILE_ROWS = 250_000


def _nullable(tdef: TableDef, silver: str) -> bool:
    return silver in tdef.expected_nulls and silver != "valid_to"


def bronze_extract(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The all-text extract of a table."""
    if name in OWN:
        source, make = OWN[name]
        return make(read_tpch(spark, sf_dir, source))
    tdef = BY_NAME[name]
    source, key, parents = SOURCES[name]
    k = F.expr(f"CAST({key} AS BIGINT)")
    out: list[Column] = []
    for i, c in enumerate(tdef.cols):
        number = F.expr(f"CAST({parents[c.silver]} AS BIGINT)") if c.silver in parents else (
            k if c.bronze == tdef.key else k % LINKS[c.silver] if c.silver in LINKS else (k * (i + 2) + i) % 1000)
        if c.kind == "bigint":
            text = F.when(k % 3 == 0, F.concat(number.cast("string"), F.lit(".0"))).otherwise(number.cast("string"))
        elif c.kind == "double":
            text = F.concat(number.cast("string"), F.lit(f".{i % 10}5"))
        elif c.kind == "timestamp":
            day = F.date_add(F.lit("2013-01-01").cast("date"), (k * (i + 1) % 700).cast("int"))
            text = F.lit(SENTINEL) if c.silver == "valid_to" else F.concat(day.cast("string"), F.lit(" 00:00:00"))
        elif c.kind == "number_text":
            text = F.concat((k + 8302039290000).cast("string"), F.lit(".0"))
        elif c.kind == "empty":
            text = F.lit(TOKENS[i % 3])
        elif c.kind == "parsed":
            text = F.lit("2013-01-01 00:00:00")
        else:
            text = F.concat(F.lit(f' {c.silver}, "'), k.cast("string"), F.lit('" '))
        if _nullable(tdef, c.silver):
            text = F.when((k + i) % 4 == 0, F.lit(TOKENS[i % 4])).otherwise(text)
        out.append(text.alias(c.bronze))
    return read_tpch(spark, sf_dir, source).select(*out)


def write_extract(df: DataFrame, path: str, sep: str = ",") -> int:
    """An extract written as exports come: CSV files of bounded length, compressed."""
    return write_csv(df, path, sep=sep, compression="gzip", rows_per_file=FILE_ROWS)


def silver_sql(name: str) -> str:
    """The silver rows of a derived extract, in SQL."""
    tdef = BY_NAME[name]
    source, key, parents = SOURCES[name]
    cols = []
    for i, c in enumerate(tdef.cols):
        number = parents.get(c.silver) or ("k" if c.bronze == tdef.key else f"k % {LINKS[c.silver]}" if c.silver in LINKS else f"(k * {i + 2} + {i}) % 1000")
        if c.kind == "bigint":
            value = f"CAST({number} AS BIGINT)"
        elif c.kind == "double":
            value = f"CAST(CAST(CAST({number} AS BIGINT) AS VARCHAR) || '.{i % 10}5' AS DOUBLE)"
        elif c.kind == "timestamp":
            value = "CAST(NULL AS TIMESTAMP)" if c.silver == "valid_to" else f"CAST(DATE '2013-01-01' + CAST(k * {i + 1} % 700 AS INTEGER) AS TIMESTAMP)"
        elif c.kind == "number_text":
            value = "CAST(k + 8302039290000 AS VARCHAR) || '.0'"
        elif c.kind in ("empty", "parsed"):
            continue
        else:
            value = f"concat(' {c.silver}, \"', CAST(k AS VARCHAR), '\" ')"
        if _nullable(tdef, c.silver):
            value = f"CASE WHEN (k + {i}) % 4 <> 0 THEN {value} END"
        cols.append(f"{value} AS {c.silver}")
    return f"SELECT {', '.join(cols)} FROM (SELECT *, CAST({key} AS BIGINT) AS k FROM {source}) AS src"
