"""Silver-shaped views of the TPC-H-like test tables.

The warehouse's gold jobs read silver tables (customers, people, orders, ...).
The supplied test data is TPC-H-like, so this module maps it onto the silver
contracts the gold builders need.  Attributes TPC-H lacks are derived from
its keys with plain arithmetic (null every k-th key, ids shifted into
another table's key range) so that an independent SQL engine can repeat the
exact same mapping.  Every frame is a lazy projection of one parquet scan:
no rows are invented, and every mapped table grows with the input.

    region   -> countries, delivery_methods, colors
    nation   -> provinces, package_types
    customer -> customers, people, cities
    supplier -> suppliers
    part     -> stock_items
    orders   -> orders, purchase_orders
    lineitem -> order_lines, purchase_order_lines
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TPCH_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

# Declared schemas of the supplied tables: reading with them skips footer
# inference and fails fast if a file does not have the expected types.
TPCH_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
}


def read_tpch(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TPCH_SCHEMAS:
        reader = reader.schema(TPCH_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _c(name: str) -> Column:
    return F.col(name)


def _null_every(key: Column, k: int, value: Column) -> Column:
    """``value`` except on every k-th key, where it is null."""
    return F.when(key % k != 0, value)


def _long(c: Column) -> Column:
    return c.cast("bigint")


class _Sources(Mapping):
    """TPC-H tables by name, opened on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._cache = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = read_tpch(self._spark, self._dir, name)
        return self._cache[name]

    def __iter__(self):
        return iter(TPCH_TABLES)

    def __len__(self) -> int:
        return len(TPCH_TABLES)


# silver table -> the TPC-H table it is projected from
SOURCE_OF = {
    "countries": "region", "delivery_methods": "region", "colors": "region",
    "provinces": "nation", "package_types": "nation",
    "cities": "customer", "people": "customer", "customers": "customer",
    "suppliers": "supplier", "stock_items": "part",
    "orders": "orders", "purchase_orders": "orders",
    "order_lines": "lineitem", "purchase_order_lines": "lineitem",
}


class SilverViews(Mapping):
    """Silver-shaped views by name; each opens only the one TPC-H table it needs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._src = _Sources(spark, sf_dir)
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = _project(name, self._src[SOURCE_OF[name]])
        return self._cache[name]

    def __iter__(self):
        return iter(SOURCE_OF)

    def __len__(self) -> int:
        return len(SOURCE_OF)


def silver_tables(spark: SparkSession, sf_dir: str) -> SilverViews:
    """All silver-shaped views over ``sf_dir``; a view opens its source table on first use."""
    return SilverViews(spark, sf_dir)


def _project(name: str, src: DataFrame) -> DataFrame:
    """The silver view ``name`` as one projection of its source table ``src``."""
    region = nation = customer = supplier = part = orders = lineitem = src  # noqa: F841
    rk, nk, ck, sk = _c("r_regionkey"), _c("n_nationkey"), _c("c_custkey"), _c("s_suppkey")
    pk, ok, lk = _c("p_partkey"), _c("o_orderkey"), _c("l_orderkey")
    s: dict = {}

    s["countries"] = lambda: region.select(
        _long(rk).alias("country_id"), _c("r_name").alias("country_name"),
        F.upper(F.substring("r_name", 1, 3)).alias("iso_alpha3_code"),
        _c("r_name").alias("continent"),
        F.concat(F.lit("R"), rk.cast("string")).alias("region"),
        F.lit(None).cast("string").alias("subregion"))
    s["delivery_methods"] = lambda: region.select(
        _long(rk).alias("delivery_method_id"), _c("r_name").alias("delivery_method_name"))
    s["colors"] = lambda: region.select(_long(rk).alias("color_id"), F.lower("r_name").alias("color_name"))

    s["provinces"] = lambda: nation.select(
        _long(nk).alias("state_province_id"),
        F.concat(F.lit("N"), nk.cast("string")).alias("state_province_code"),
        _c("n_name").alias("state_province_name"),
        _long(_c("n_regionkey")).alias("country_id"),
        F.concat(F.lit("Territory "), _c("n_regionkey").cast("string")).alias("sales_territory"),
        (_long(nk) * 100000).alias("latest_recorded_population"))
    s["package_types"] = lambda: nation.select(
        _long(nk).alias("package_type_id"), _c("n_name").alias("package_type_name"))

    s["cities"] = lambda: customer.select(
        ck.alias("city_id"), F.concat(F.lit("City "), ck.cast("string")).alias("city_name"),
        _long(_c("c_nationkey")).alias("state_province_id"))
    s["people"] = lambda: customer.select(
        ck.alias("person_id"), _c("c_name").alias("full_name"),
        _null_every(ck, 4, F.concat(F.lit("contact"), ck.cast("string"), F.lit("@example.com"))).alias("email_address"),
        F.concat(F.lit("+1 555 "), ck.cast("string")).alias("phone_number"),
        _null_every(ck, 2, F.concat(F.lit("+1 556 "), ck.cast("string"))).alias("fax_number"))
    s["customers"] = lambda: customer.select(
        ck.alias("customer_id"), _c("c_name").alias("customer_name"),
        (ck - ck % 5).alias("bill_to_customer_id"),
        _null_every(ck, 7, _c("c_acctbal")).alias("credit_limit"),
        _long(_c("c_nationkey") % 7).alias("delivery_method_id"),
        _null_every(ck, 11, ck).alias("delivery_city_id"),
        _null_every(ck, 6, ck + 1).alias("primary_contact_person_id"),
        F.concat(F.lit("+1 557 "), ck.cast("string")).alias("phone_number"),
        F.lit(None).cast("string").alias("fax_number"),
        F.concat(F.lit("http://www."), F.lower("c_mktsegment"), F.lit(".example")).alias("website_url"),
        _null_every(ck, 3, F.concat(F.lit("Shop "), ck.cast("string"))).alias("delivery_address_line1"),
        F.concat(ck.cast("string"), F.lit(" Market Street")).alias("delivery_address_line2"),
        (_long(_c("c_nationkey")) + 90000).alias("delivery_postal_code"),
        F.concat(F.lit("PO Box "), ck.cast("string")).alias("postal_address_line1"),
        _c("c_mktsegment").alias("postal_address_line2"),
        (_long(_c("c_nationkey")) + 90000).alias("postal_postal_code"))

    s["suppliers"] = lambda: supplier.select(
        sk.alias("supplier_id"), _c("s_name").alias("supplier_name"),
        _null_every(sk, 3, _long(_c("s_nationkey") % 5)).alias("delivery_method_id"),
        (sk * 7).alias("primary_contact_person_id"),
        (sk * 3).alias("delivery_city_id"),
        (sk * 3 + 1).alias("postal_city_id"),
        F.concat(F.lit("+1 558 "), sk.cast("string")).alias("phone_number"),
        _null_every(sk, 4, F.concat(F.lit("Suite "), sk.cast("string"))).alias("delivery_address_line1"),
        F.concat(sk.cast("string"), F.lit(" Harbour Road")).alias("delivery_address_line2"),
        (_long(_c("s_nationkey")) + 10000).alias("delivery_postal_code"),
        F.concat(F.lit("PO Box "), sk.cast("string")).alias("postal_address_line1"),
        F.concat(sk.cast("string"), F.lit(" Harbour Road")).alias("postal_address_line2"),
        (_long(_c("s_nationkey")) + 10000).alias("postal_postal_code"),
        _null_every(sk, 2, F.lit("Preferred supplier")).alias("internal_comments"),
        F.concat(F.lit("REF"), sk.cast("string")).alias("supplier_reference"),
        _c("s_name").alias("bank_account_name"),
        F.concat(F.lit("Branch "), _c("s_nationkey").cast("string")).alias("bank_account_branch"),
        sk.cast("string").alias("bank_account_code"))

    s["stock_items"] = lambda: part.select(
        pk.alias("stock_item_id"), _c("p_name").alias("stock_item_name"),
        (pk % 100).alias("supplier_id"),
        _null_every(pk, 4, _long(_c("p_size") % 7)).alias("color_id"),
        (pk % 25).alias("unit_package_id"),
        _long(_c("p_size") % 25).alias("outer_package_id"),
        _c("p_brand").alias("brand"), _c("p_type").alias("size"),
        (_c("p_retailprice") / 100).alias("typical_weight_per_unit"),
        _long(_c("p_size")).alias("lead_time_days"),
        _long(_c("p_size") * 2).alias("quantity_per_outer"),
        _long(_c("p_size") % 2).alias("is_chiller_stock"),
        F.lit(15.0).alias("tax_rate"),
        _c("p_retailprice").alias("unit_price"),
        (_c("p_retailprice") * 1.5).alias("recommended_retail_price"),
        F.concat(_c("p_name"), F.lit(" "), _c("p_type")).alias("search_details"))

    week = F.expr("INTERVAL 7 DAYS")
    s["orders"] = lambda: orders.select(
        ok.alias("order_id"), _c("o_custkey").alias("customer_id"),
        (ok % 25).alias("salesperson_id"),
        F.when(_c("o_orderstatus") != "O", ok % 50).alias("picked_by_id"),
        _c("o_custkey").alias("contact_person_id"),
        _c("o_orderdate").alias("order_date"),
        (_c("o_orderdate") + week).alias("expected_delivery_date"),
        (ok + 100000).alias("customer_po_number"))
    s["purchase_orders"] = lambda: orders.select(
        ok.alias("purchase_order_id"), (_c("o_custkey") % 100).alias("supplier_id"),
        _c("o_orderdate").alias("order_date"), (ok % 5).alias("delivery_method_id"),
        _c("o_custkey").alias("contact_person_id"),
        (_c("o_orderdate") + week + week).alias("expected_delivery_date"),
        F.concat(F.lit("PO"), ok.cast("string")).alias("supplier_reference"),
        F.when(_c("o_orderstatus") == "F", F.lit(1).cast("bigint"))
         .when(_c("o_orderstatus") == "O", F.lit(0).cast("bigint")).alias("is_order_finalized"))

    line_id = lk * 100 + _c("l_linenumber")
    s["order_lines"] = lambda: lineitem.select(
        lk.alias("order_id"), line_id.alias("order_line_id"),
        _c("l_partkey").alias("stock_item_id"),
        F.concat(_c("l_returnflag"), F.lit("-"), _c("l_linestatus")).alias("description"),
        (_c("l_suppkey") % 25).alias("package_type_id"),
        _long(_c("l_quantity")).alias("quantity"),
        _c("l_extendedprice").alias("unit_price"),
        _c("l_tax").alias("tax_rate"),
        _long(_c("l_quantity")).alias("picked_quantity"),
        _c("l_shipdate").alias("picking_completed_when"))
    s["purchase_order_lines"] = lambda: lineitem.select(
        lk.alias("purchase_order_id"), line_id.alias("purchase_order_line_id"),
        _c("l_partkey").alias("stock_item_id"),
        _long(_c("l_quantity")).alias("ordered_outers"),
        F.when(_c("l_linestatus") == "F", _long(_c("l_quantity"))).otherwise(F.lit(0).cast("bigint")).alias("received_outers"),
        (_c("l_suppkey") % 25).alias("package_type_id"),
        F.concat(F.lit("Part "), _c("l_partkey").cast("string")).alias("description"),
        _c("l_extendedprice").alias("expected_unit_price_per_outer"),
        F.when(_c("l_linestatus") == "F", _c("l_shipdate")).alias("last_receipt_date"))
    return s[name]()
