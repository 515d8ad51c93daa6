"""Gold layer: the star schema built from silver tables.

Each builder takes ``tables``, a mapping of silver table name -> DataFrame
(the names of ``strata.plans.specs``), and returns one lazy DataFrame with the
gold table's fixed column list.  All joins are left joins on one key; lookups
are resolved before the header -> line fan-out so the wide join carries as
few columns as possible.

``tables`` may tell by a method ``too_large(table, columns, named_by)`` which
tables must not be broadcast, whatever Spark makes of the size of their files.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.casts import truthy
from strata.functions.text import email_from_name
from strata.operators.calendar import calendar_dim, date_bounds
from strata.operators.columns import dedup_columns, rename_columns, select_strict
from strata.operators.impute import fill_constants, fill_from_parent_then_mean
from strata.operators.joins import header_detail_join, lookup_join
from strata.operators.quality import JoinGrowth

Tables = Mapping[str, DataFrame]
Trace = list | JoinGrowth | None


def _step(df: DataFrame, trace: Trace, label: str) -> DataFrame:
    """Note the table after a join when a trace is asked for.

    A list takes (label, table), and the plan is the same: ``quality.join_growth``
    counts the noted tables.  A ``JoinGrowth`` has the rows counted by the run
    that is made anyway.
    """
    if isinstance(trace, JoinGrowth):
        return trace.note(label, df)
    if trace is not None:
        trace.append((label, df))
    return df


def _too_large(tables: Tables, name: str, columns: Iterable[str], named_by: tuple[str, str] | None = None) -> bool:
    tell = getattr(tables, "too_large", None)
    return tell is not None and tell(name, list(columns), named_by)


def _lookup(df: DataFrame, tables: Tables, name: str, key: str, dim_key: str | None = None, *, attrs: Mapping[str, str] | list[str],
            named_by: str | None = None) -> DataFrame:
    """``lookup_join`` of a table by its name.  ``named_by`` is the table whose ``key`` names few of its rows."""
    large = _too_large(tables, name, [dim_key or key, *attrs])
    if large and named_by:
        large = _too_large(tables, name, [dim_key or key, *attrs], (named_by, key))
        return lookup_join(df, tables[name], key, dim_key, attrs, few_keys=not large, shuffled=large)
    return lookup_join(df, tables[name], key, dim_key, attrs, few_keys=named_by is not None, shuffled=large)


def _fan_out(trace: Trace, header: DataFrame, tables: Tables, name: str, key: str, columns: list[str]) -> DataFrame:
    return header_detail_join(header, tables[name], key, columns, observed=isinstance(trace, JoinGrowth),
                              shuffled=_too_large(tables, name, [key, *columns]))


def _keep(df: DataFrame, *columns: str) -> DataFrame:
    """The columns that a job uses; counting rows on the way would keep Spark from leaving out the others."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in columns])

# Gold column lists and renames of the warehouse contract.
CUSTOMER_COLUMNS = [
    "customer_id", "customer_name", "full_name", "email_address", "phone_number",
    "fax_number", "website_url", "bill_to_customer_id", "credit_limit",
    "delivery_method_name", "delivery_address_line1", "delivery_address_line2",
    "delivery_postal_code", "postal_address_line1", "postal_address_line2",
    "postal_postal_code", "city_name", "state_province_code", "state_province_name",
    "sales_territory", "country_name", "iso_alpha3_code", "continent", "region", "subregion",
]
CUSTOMER_RENAME = {
    "bill_to_customer_id": "parent_customer_id",
    "credit_limit": "credit_limit_amount",
    "full_name": "contact_full_name",
    "email_address": "contact_email",
    "phone_number": "contact_phone",
    "fax_number": "contact_fax",
    "website_url": "customer_website",
    "delivery_address_line1": "delivery_address_additional",
    "delivery_address_line2": "delivery_street_address",
    "delivery_method_name": "delivery_method",
    "postal_address_line1": "postal_address_additional",
    "postal_address_line2": "postal_street_address",
    "postal_postal_code": "postal_code",
    "city_name": "city",
    "state_province_code": "state_code",
    "state_province_name": "state_name",
    "country_name": "country",
    "iso_alpha3_code": "country_code_iso3",
}
CUSTOMER_ORDER = [
    "customer_id", "customer_name", "parent_customer_id",
    "contact_full_name", "contact_email", "contact_phone", "contact_fax", "customer_website",
    "credit_limit_amount", "delivery_method",
    "delivery_address_additional", "delivery_street_address", "delivery_postal_code",
    "postal_address_additional", "postal_street_address", "postal_code",
    "city", "state_code", "state_name", "country", "country_code_iso3",
    "continent", "region", "subregion", "sales_territory",
]
CUSTOMER_CONTACT_DEFAULT = "Head Office"

GEOGRAPHY_COLUMNS = [
    "city_id", "city_name", "state_province_id", "state_province_code", "state_province_name",
    "country_id", "country_name", "iso_alpha3_code", "continent", "region", "subregion",
    "sales_territory", "latest_recorded_population",
]
GEOGRAPHY_RENAME = {
    "city_name": "city",
    "state_province_code": "state_code",
    "state_province_name": "state_name",
    "country_name": "country",
    "iso_alpha3_code": "country_code_iso3",
}
GEOGRAPHY_ORDER = [
    "city_id", "city", "state_province_id", "state_code", "state_name", "country_id", "country",
    "country_code_iso3", "continent", "region", "subregion", "sales_territory",
    "latest_recorded_population",
]

PEOPLE_COLUMNS = ["person_id", "full_name", "email_address", "phone_number", "fax_number"]
SYSTEM_PERSON_ID = 1

STOCK_ITEM_COLUMNS = [
    "stock_item_id", "stock_item_name", "color", "unit_package", "outer_package", "supplier_id",
    "brand", "size", "typical_weight_per_unit", "lead_time_days", "quantity_per_outer",
    "is_chiller_stock", "tax_rate", "unit_price", "recommended_retail_price", "search_details",
]
STOCK_ITEM_RENAME = {
    "stock_item_name": "product_name",
    "unit_package": "unit_package_type",
    "outer_package": "outer_package_type",
    "typical_weight_per_unit": "weight_per_unit_kg",
}

SUPPLIER_COLUMNS = [
    "supplier_id", "supplier_name", "full_name", "email_address", "contact_phone",
    "delivery_method_name", "delivery_address_line2", "delivery_address_line1",
    "delivery_postal_code", "delivery_city", "postal_address_line2", "postal_address_line1",
    "postal_postal_code", "postal_city", "internal_comments", "supplier_reference",
    "bank_account_name", "bank_account_branch", "bank_account_code",
]
SUPPLIER_FILL = {
    "internal_comments": "Not available",
    "delivery_address_line1": "No address line",
    "delivery_method_name": "Upon request",
}
SUPPLIER_RENAME = {
    "full_name": "contact_full_name",
    "email_address": "contact_email",
    "delivery_method_name": "delivery_method",
    "delivery_address_line2": "delivery_street_address",
    "delivery_address_line1": "delivery_address_additional",
    "postal_address_line2": "postal_street_address",
    "postal_address_line1": "postal_address_additional",
}

ORDER_LINE_COLUMNS = [
    "order_line_id", "stock_item_id", "description", "package_type_id", "quantity",
    "unit_price", "tax_rate", "picked_quantity",
]
FACT_ORDERS_COLUMNS = [
    "order_id", "order_line_id", "customer_id", "customer_name", "customer_po_number",
    "contact_person", "sales_person", "order_date", "expected_delivery_date", "stock_item_id",
    "description", "package_type_id", "picked_by_id", "quantity", "picked_quantity",
    "unit_price", "tax_rate",
]
# The purchase-order number is published as 'customer_phone_number' (kept for
# compatibility with existing consumers of the fact table).
FACT_ORDERS_RENAME = {"customer_name": "customer", "customer_po_number": "customer_phone_number"}

PURCHASE_LINE_COLUMNS = [
    "purchase_order_line_id", "stock_item_id", "ordered_outers", "received_outers",
    "package_type_id", "description", "package_type_id", "expected_unit_price_per_outer",
    "last_receipt_date",
]
FACT_PURCHASES_COLUMNS = [
    "purchase_order_id", "purchase_order_line_id", "supplier_id", "contact_person",
    "order_date", "expected_delivery_date", "last_receipt_date", "stock_item_id", "description",
    "delivery_method_id", "package_type_id", "ordered_outers", "received_outers",
    "expected_unit_price_per_outer", "is_order_finalized",
]
FACT_PURCHASES_RENAME = {
    "ordered_outers": "quantity_ordered",
    "received_outers": "quantity_received",
    "expected_unit_price_per_outer": "unit_price",
    "is_order_finalized": "is_finalized",
}

CALENDAR_SOURCES = {
    "purchase_orders": ["order_date", "expected_delivery_date"],
    "purchase_order_lines": ["last_receipt_date"],
}


def responsible_market(tables: Tables, trace: Trace = None) -> DataFrame:
    """provinces -> countries, then fan out to cities (provinces without a city kept)."""
    m = _step(_keep(tables["provinces"], *GEOGRAPHY_COLUMNS), trace, "provinces")
    m = _lookup(m, tables, "countries", "country_id",
                    attrs=["country_name", "iso_alpha3_code", "continent", "region", "subregion"])
    m = _step(m, trace, "provinces + countries")
    return _step(_fan_out(trace, m, tables, "cities", "state_province_id", ["city_id", "city_name"]), trace, "provinces + cities")


def dim_geography(tables: Tables, trace: Trace = None) -> DataFrame:
    df = select_strict(responsible_market(tables, trace), GEOGRAPHY_COLUMNS)
    return select_strict(rename_columns(df, GEOGRAPHY_RENAME), GEOGRAPHY_ORDER)


def customer_base(tables: Tables, customers: DataFrame | None = None, trace: Trace = None) -> DataFrame:
    """Customers with delivery method, market and contact attached (the 25 dimension columns)."""
    market = responsible_market(tables, trace)
    df = customers if customers is not None else tables["customers"]
    df = _step(_keep(df, *CUSTOMER_COLUMNS, "delivery_method_id", "delivery_city_id", "primary_contact_person_id"), trace, "customers")
    df = _lookup(df, tables, "delivery_methods", "delivery_method_id", attrs=["delivery_method_name"])
    df = _step(df, trace, "customers + delivery methods")
    df = lookup_join(df, market, "delivery_city_id", "city_id",
                     attrs=["city_name", "country_name", "state_province_code", "state_province_name",
                            "iso_alpha3_code", "continent", "region", "subregion", "sales_territory"])
    df = _step(df, trace, "customers + market")
    df = _lookup(df, tables, "people", "primary_contact_person_id", "person_id",
                     attrs=["full_name", "email_address"])
    df = _step(df, trace, "customers + contacts")
    return select_strict(df, CUSTOMER_COLUMNS)


def dim_customer(tables: Tables, mean_digits: int | None = None, trace: Trace = None) -> DataFrame:
    """Customer dimension with credit limit and contact imputation.

    The credit limit is imputed on the customers table itself, before the
    lookups: the parent is another customer and the mean is over customers'
    own limits, so the self-join and the mean scan only that table (the
    lookups are many-to-one and add no rows, so the result is the same as
    imputing after them).
    """
    customers = fill_from_parent_then_mean(tables["customers"], "customer_id", "bill_to_customer_id",
                                           "credit_limit", mean_digits=mean_digits,
                                           shuffled=_too_large(tables, "customers", ["customer_id", "credit_limit"]))
    df = customer_base(tables, customers, trace)
    df = df.withColumns({
        "full_name": F.coalesce("full_name", F.lit(CUSTOMER_CONTACT_DEFAULT)),
        "email_address": F.coalesce("email_address", email_from_name("customer_name")),
    })
    return select_strict(rename_columns(df, CUSTOMER_RENAME), CUSTOMER_ORDER)


def dim_people(tables: Tables) -> DataFrame:
    df = select_strict(tables["people"], PEOPLE_COLUMNS)
    # a null id is kept (it is not the system person)
    return df.where(~F.col("person_id").eqNullSafe(SYSTEM_PERSON_ID))


def dim_stock_item(tables: Tables, trace: Trace = None) -> DataFrame:
    df = _step(_keep(tables["stock_items"], *STOCK_ITEM_COLUMNS, "color_id", "unit_package_id", "outer_package_id"), trace, "stock items")
    df = _lookup(df, tables, "colors", "color_id", attrs={"color_name": "color"})
    df = _step(df, trace, "stock items + colors")
    df = _lookup(df, tables, "package_types", "unit_package_id", "package_type_id",
                     attrs={"package_type_name": "unit_package"})
    df = _step(df, trace, "stock items + unit packages")
    df = _lookup(df, tables, "package_types", "outer_package_id", "package_type_id",
                     attrs={"package_type_name": "outer_package"})
    df = _step(df, trace, "stock items + outer packages")
    df = select_strict(df, STOCK_ITEM_COLUMNS)
    return rename_columns(df, STOCK_ITEM_RENAME)


def dim_supplier(tables: Tables, trace: Trace = None) -> DataFrame:
    df = _keep(tables["suppliers"], *SUPPLIER_COLUMNS, "delivery_method_id", "primary_contact_person_id", "delivery_city_id", "postal_city_id")
    df = _step(df, trace, "suppliers")
    df = _lookup(df, tables, "delivery_methods", "delivery_method_id", attrs=["delivery_method_name"])
    df = _step(df, trace, "suppliers + delivery methods")
    # the contact's phone, not the supplier's own number
    df = _lookup(df, tables, "people", "primary_contact_person_id", "person_id",
                     attrs={"full_name": "full_name", "email_address": "email_address",
                            "phone_number": "contact_phone"})
    df = _step(df, trace, "suppliers + contacts")
    df = _lookup(df, tables, "cities", "delivery_city_id", "city_id", attrs={"city_name": "delivery_city"})
    df = _step(df, trace, "suppliers + delivery cities")
    df = _lookup(df, tables, "cities", "postal_city_id", "city_id", attrs={"city_name": "postal_city"})
    df = _step(df, trace, "suppliers + postal cities")
    df = fill_constants(select_strict(df, SUPPLIER_COLUMNS), SUPPLIER_FILL)
    return rename_columns(df, SUPPLIER_RENAME)


def fact_orders(tables: Tables, trace: Trace = None) -> DataFrame:
    df = _step(_keep(tables["orders"], *FACT_ORDERS_COLUMNS, "salesperson_id", "contact_person_id"), trace, "orders")
    df = _lookup(df, tables, "customers", "customer_id", attrs=["customer_name"])
    df = _step(df, trace, "orders + customers")
    df = _lookup(df, tables, "people", "salesperson_id", "person_id", attrs={"full_name": "sales_person"}, named_by="orders")
    df = _step(df, trace, "orders + salespeople")
    df = _lookup(df, tables, "people", "contact_person_id", "person_id", attrs={"full_name": "contact_person"})
    df = _step(df, trace, "orders + contacts")
    df = _fan_out(trace, df, tables, "order_lines", "order_id", ORDER_LINE_COLUMNS)
    df = _step(df, trace, "orders + order lines")
    df = select_strict(df, FACT_ORDERS_COLUMNS)
    return rename_columns(df, FACT_ORDERS_RENAME)


def fact_purchases(tables: Tables, trace: Trace = None) -> DataFrame:
    df = _step(_keep(tables["purchase_orders"], *FACT_PURCHASES_COLUMNS, "contact_person_id"), trace, "purchase orders")
    df = _lookup(df, tables, "people", "contact_person_id", "person_id", attrs={"full_name": "contact_person"})
    df = _step(df, trace, "purchase orders + contacts")
    df = _fan_out(trace, df, tables, "purchase_order_lines", "purchase_order_id", PURCHASE_LINE_COLUMNS)
    df = _step(df, trace, "purchase orders + purchase order lines")
    df = select_strict(dedup_columns(df), FACT_PURCHASES_COLUMNS)
    df = df.withColumn("is_order_finalized", truthy("is_order_finalized"))
    return rename_columns(df, FACT_PURCHASES_RENAME)


#: Builders that join, whose steps ``join_growth`` can count.
JOINING = ("dim_customer", "dim_geography", "dim_stock_item", "dim_supplier", "fact_orders", "fact_purchases")


def dim_calendar(tables: Tables, sources: Mapping[str, list[str]] | None = None, bounds: DataFrame | None = None) -> DataFrame:
    """The days of the years of the sources' dates; ``bounds`` if they are known, as from Parquet footers."""
    if bounds is not None:
        return calendar_dim(bounds)
    sources = sources or CALENDAR_SOURCES
    return calendar_dim(date_bounds([(tables[t], cols) for t, cols in sources.items() if t in tables]))


GOLD_BUILDERS = {
    "dim_calendar": dim_calendar,
    "dim_customer": dim_customer,
    "dim_geography": dim_geography,
    "dim_people": dim_people,
    "dim_stock_item": dim_stock_item,
    "dim_supplier": dim_supplier,
    "fact_orders": fact_orders,
    "fact_purchases": fact_purchases,
}

# silver inputs of each gold table
GOLD_INPUTS = {
    "dim_calendar": ["purchase_orders", "purchase_order_lines"],
    "dim_customer": ["customers", "cities", "provinces", "countries", "delivery_methods", "people"],
    "dim_geography": ["cities", "provinces", "countries"],
    "dim_people": ["people"],
    "dim_stock_item": ["stock_items", "colors", "package_types"],
    "dim_supplier": ["suppliers", "cities", "delivery_methods", "people"],
    "fact_orders": ["customers", "people", "orders", "order_lines"],
    "fact_purchases": ["people", "purchase_orders", "purchase_order_lines"],
}
