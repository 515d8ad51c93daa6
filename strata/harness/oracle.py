"""Reference SQL (DuckDB dialect) for the registered queries.

An independent formulation of every query over the same parquet views
(region, nation, customer, supplier, part, orders, lineitem, ...): the
silver mapping of ``strata.harness.tpch`` as CTEs, then plain SQL joins.  Used
by the correctness check; never executed by the library itself.
"""

from __future__ import annotations

import re

from strata.harness.extracts import SOURCES, silver_sql
from strata.plans.specs import TABLES

# silver-shaped CTEs over the TPC-H-like views (mirror of strata.harness.tpch)
SILVER_CTES: dict[str, str] = {
    "s_countries": """SELECT CAST(r_regionkey AS BIGINT) AS country_id, r_name AS country_name,
        upper(substring(r_name, 1, 3)) AS iso_alpha3_code, r_name AS continent,
        concat('R', CAST(r_regionkey AS VARCHAR)) AS region, CAST(NULL AS VARCHAR) AS subregion
        FROM region""",
    "s_delivery_methods": """SELECT CAST(r_regionkey AS BIGINT) AS delivery_method_id,
        r_name AS delivery_method_name FROM region""",
    "s_colors": """SELECT CAST(r_regionkey AS BIGINT) AS color_id, lower(r_name) AS color_name FROM region""",
    "s_provinces": """SELECT CAST(n_nationkey AS BIGINT) AS state_province_id,
        concat('N', CAST(n_nationkey AS VARCHAR)) AS state_province_code, n_name AS state_province_name,
        CAST(n_regionkey AS BIGINT) AS country_id,
        concat('Territory ', CAST(n_regionkey AS VARCHAR)) AS sales_territory,
        CAST(n_nationkey AS BIGINT) * 100000 AS latest_recorded_population FROM nation""",
    "s_package_types": """SELECT CAST(n_nationkey AS BIGINT) AS package_type_id, n_name AS package_type_name
        FROM nation""",
    "s_cities": """SELECT c_custkey AS city_id, concat('City ', CAST(c_custkey AS VARCHAR)) AS city_name,
        CAST(c_nationkey AS BIGINT) AS state_province_id FROM customer""",
    "s_people": """SELECT c_custkey AS person_id, c_name AS full_name,
        CASE WHEN c_custkey % 4 <> 0 THEN concat('contact', CAST(c_custkey AS VARCHAR), '@example.com') END AS email_address,
        concat('+1 555 ', CAST(c_custkey AS VARCHAR)) AS phone_number,
        CASE WHEN c_custkey % 2 <> 0 THEN concat('+1 556 ', CAST(c_custkey AS VARCHAR)) END AS fax_number
        FROM customer""",
    "s_customers": """SELECT c_custkey AS customer_id, c_name AS customer_name,
        c_custkey - c_custkey % 5 AS bill_to_customer_id,
        CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS credit_limit,
        CAST(c_nationkey % 7 AS BIGINT) AS delivery_method_id,
        CASE WHEN c_custkey % 11 <> 0 THEN c_custkey END AS delivery_city_id,
        CASE WHEN c_custkey % 6 <> 0 THEN c_custkey + 1 END AS primary_contact_person_id,
        concat('+1 557 ', CAST(c_custkey AS VARCHAR)) AS phone_number,
        CAST(NULL AS VARCHAR) AS fax_number,
        concat('http://www.', lower(c_mktsegment), '.example') AS website_url,
        CASE WHEN c_custkey % 3 <> 0 THEN concat('Shop ', CAST(c_custkey AS VARCHAR)) END AS delivery_address_line1,
        concat(CAST(c_custkey AS VARCHAR), ' Market Street') AS delivery_address_line2,
        CAST(c_nationkey AS BIGINT) + 90000 AS delivery_postal_code,
        concat('PO Box ', CAST(c_custkey AS VARCHAR)) AS postal_address_line1,
        c_mktsegment AS postal_address_line2,
        CAST(c_nationkey AS BIGINT) + 90000 AS postal_postal_code
        FROM customer""",
    "s_suppliers": """SELECT s_suppkey AS supplier_id, s_name AS supplier_name,
        CASE WHEN s_suppkey % 3 <> 0 THEN CAST(s_nationkey % 5 AS BIGINT) END AS delivery_method_id,
        s_suppkey * 7 AS primary_contact_person_id, s_suppkey * 3 AS delivery_city_id,
        s_suppkey * 3 + 1 AS postal_city_id,
        concat('+1 558 ', CAST(s_suppkey AS VARCHAR)) AS phone_number,
        CASE WHEN s_suppkey % 4 <> 0 THEN concat('Suite ', CAST(s_suppkey AS VARCHAR)) END AS delivery_address_line1,
        concat(CAST(s_suppkey AS VARCHAR), ' Harbour Road') AS delivery_address_line2,
        CAST(s_nationkey AS BIGINT) + 10000 AS delivery_postal_code,
        concat('PO Box ', CAST(s_suppkey AS VARCHAR)) AS postal_address_line1,
        concat(CAST(s_suppkey AS VARCHAR), ' Harbour Road') AS postal_address_line2,
        CAST(s_nationkey AS BIGINT) + 10000 AS postal_postal_code,
        CASE WHEN s_suppkey % 2 <> 0 THEN 'Preferred supplier' END AS internal_comments,
        concat('REF', CAST(s_suppkey AS VARCHAR)) AS supplier_reference,
        s_name AS bank_account_name,
        concat('Branch ', CAST(s_nationkey AS VARCHAR)) AS bank_account_branch,
        CAST(s_suppkey AS VARCHAR) AS bank_account_code
        FROM supplier""",
    "s_stock_items": """SELECT p_partkey AS stock_item_id, p_name AS stock_item_name,
        p_partkey % 100 AS supplier_id,
        CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size % 7 AS BIGINT) END AS color_id,
        p_partkey % 25 AS unit_package_id, CAST(p_size % 25 AS BIGINT) AS outer_package_id,
        p_brand AS brand, p_type AS size, p_retailprice / 100 AS typical_weight_per_unit,
        CAST(p_size AS BIGINT) AS lead_time_days, CAST(p_size * 2 AS BIGINT) AS quantity_per_outer,
        CAST(p_size % 2 AS BIGINT) AS is_chiller_stock, CAST(15.0 AS DOUBLE) AS tax_rate,
        p_retailprice AS unit_price, p_retailprice * CAST(1.5 AS DOUBLE) AS recommended_retail_price,
        concat(p_name, ' ', p_type) AS search_details
        FROM part""",
    "s_orders": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderkey % 25 AS salesperson_id,
        CASE WHEN o_orderstatus <> 'O' THEN o_orderkey % 50 END AS picked_by_id,
        o_custkey AS contact_person_id, o_orderdate AS order_date,
        o_orderdate + INTERVAL 7 DAY AS expected_delivery_date,
        o_orderkey + 100000 AS customer_po_number
        FROM orders""",
    "s_purchase_orders": """SELECT o_orderkey AS purchase_order_id, o_custkey % 100 AS supplier_id,
        o_orderdate AS order_date, o_orderkey % 5 AS delivery_method_id, o_custkey AS contact_person_id,
        o_orderdate + INTERVAL 14 DAY AS expected_delivery_date,
        concat('PO', CAST(o_orderkey AS VARCHAR)) AS supplier_reference,
        CASE WHEN o_orderstatus = 'F' THEN CAST(1 AS BIGINT) WHEN o_orderstatus = 'O' THEN CAST(0 AS BIGINT) END
            AS is_order_finalized
        FROM orders""",
    "s_order_lines": """SELECT l_orderkey AS order_id, l_orderkey * 100 + l_linenumber AS order_line_id,
        l_partkey AS stock_item_id, concat(l_returnflag, '-', l_linestatus) AS description,
        l_suppkey % 25 AS package_type_id, CAST(l_quantity AS BIGINT) AS quantity,
        l_extendedprice AS unit_price, l_tax AS tax_rate, CAST(l_quantity AS BIGINT) AS picked_quantity,
        l_shipdate AS picking_completed_when
        FROM lineitem""",
    "s_purchase_order_lines": """SELECT l_orderkey AS purchase_order_id,
        l_orderkey * 100 + l_linenumber AS purchase_order_line_id, l_partkey AS stock_item_id,
        CAST(l_quantity AS BIGINT) AS ordered_outers,
        CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) ELSE CAST(0 AS BIGINT) END AS received_outers,
        l_suppkey % 25 AS package_type_id, concat('Part ', CAST(l_partkey AS VARCHAR)) AS description,
        l_extendedprice AS expected_unit_price_per_outer,
        CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS last_receipt_date
        FROM lineitem""",
}

MARKET = """SELECT p.*, co.country_name, co.iso_alpha3_code, co.continent, co.region, co.subregion,
        ci.city_id, ci.city_name
    FROM s_provinces p
    LEFT JOIN s_countries co ON p.country_id = co.country_id
    LEFT JOIN s_cities ci ON p.state_province_id = ci.state_province_id"""

CUSTOMER_BASE = f"""
        SELECT c.*, dm.delivery_method_name, m.city_name, m.country_name, m.state_province_code,
            m.state_province_name, m.iso_alpha3_code, m.continent, m.region, m.subregion,
            m.sales_territory, pe.full_name, pe.email_address
        FROM s_customers c
        LEFT JOIN s_delivery_methods dm ON c.delivery_method_id = dm.delivery_method_id
        LEFT JOIN ({MARKET}) m ON c.delivery_city_id = m.city_id
        LEFT JOIN s_people pe ON c.primary_contact_person_id = pe.person_id"""

CUSTOMER_FINAL = """
    SELECT b.customer_id, b.customer_name, b.bill_to_customer_id AS parent_customer_id,
        COALESCE(b.full_name, 'Head Office') AS contact_full_name,
        COALESCE(b.email_address,
                 'info@' || lower(replace(replace(b.customer_name, ' (Head Office)', ''), ' ', '')) || '.com')
            AS contact_email,
        b.phone_number AS contact_phone, b.fax_number AS contact_fax, b.website_url AS customer_website,
        COALESCE(b.credit_limit, par.credit_limit, (SELECT round(avg(credit_limit), 6) FROM base))
            AS credit_limit_amount,
        b.delivery_method_name AS delivery_method,
        b.delivery_address_line1 AS delivery_address_additional,
        b.delivery_address_line2 AS delivery_street_address, b.delivery_postal_code,
        b.postal_address_line1 AS postal_address_additional,
        b.postal_address_line2 AS postal_street_address, b.postal_postal_code AS postal_code,
        b.city_name AS city, b.state_province_code AS state_code, b.state_province_name AS state_name,
        b.country_name AS country, b.iso_alpha3_code AS country_code_iso3, b.continent, b.region,
        b.subregion, b.sales_territory
    FROM base b LEFT JOIN base par ON b.bill_to_customer_id = par.customer_id"""

GOLD_SQL: dict[str, str] = {
    "dim_geography": f"""
    SELECT m.city_id, m.city_name AS city, m.state_province_id, m.state_province_code AS state_code,
        m.state_province_name AS state_name, m.country_id, m.country_name AS country,
        m.iso_alpha3_code AS country_code_iso3, m.continent, m.region, m.subregion, m.sales_territory,
        m.latest_recorded_population
    FROM ({MARKET}) m""",
    "dim_customer": f""", base AS ({CUSTOMER_BASE})
    {CUSTOMER_FINAL}""",
    "dim_people": """
    SELECT person_id, full_name, email_address, phone_number, fax_number
    FROM s_people WHERE person_id IS DISTINCT FROM 1""",
    "dim_stock_item": """
    SELECT si.stock_item_id, si.stock_item_name AS product_name, co.color_name AS color,
        up.package_type_name AS unit_package_type, op.package_type_name AS outer_package_type,
        si.supplier_id, si.brand, si.size, si.typical_weight_per_unit AS weight_per_unit_kg,
        si.lead_time_days, si.quantity_per_outer, si.is_chiller_stock, si.tax_rate, si.unit_price,
        si.recommended_retail_price, si.search_details
    FROM s_stock_items si
    LEFT JOIN s_colors co ON si.color_id = co.color_id
    LEFT JOIN s_package_types up ON si.unit_package_id = up.package_type_id
    LEFT JOIN s_package_types op ON si.outer_package_id = op.package_type_id""",
    "dim_supplier": """
    SELECT s.supplier_id, s.supplier_name, pe.full_name AS contact_full_name,
        pe.email_address AS contact_email, pe.phone_number AS contact_phone,
        COALESCE(dm.delivery_method_name, 'Upon request') AS delivery_method,
        s.delivery_address_line2 AS delivery_street_address,
        COALESCE(s.delivery_address_line1, 'No address line') AS delivery_address_additional,
        s.delivery_postal_code, dc.city_name AS delivery_city,
        s.postal_address_line2 AS postal_street_address,
        s.postal_address_line1 AS postal_address_additional, s.postal_postal_code,
        pc.city_name AS postal_city, COALESCE(s.internal_comments, 'Not available') AS internal_comments,
        s.supplier_reference, s.bank_account_name, s.bank_account_branch, s.bank_account_code
    FROM s_suppliers s
    LEFT JOIN s_delivery_methods dm ON s.delivery_method_id = dm.delivery_method_id
    LEFT JOIN s_people pe ON s.primary_contact_person_id = pe.person_id
    LEFT JOIN s_cities dc ON s.delivery_city_id = dc.city_id
    LEFT JOIN s_cities pc ON s.postal_city_id = pc.city_id""",
    "fact_orders": """
    SELECT o.order_id, l.order_line_id, o.customer_id, c.customer_name AS customer,
        o.customer_po_number AS customer_phone_number, pc.full_name AS contact_person,
        ps.full_name AS sales_person, o.order_date, o.expected_delivery_date, l.stock_item_id,
        l.description, l.package_type_id, o.picked_by_id, l.quantity, l.picked_quantity,
        l.unit_price, l.tax_rate
    FROM s_orders o
    LEFT JOIN s_customers c ON o.customer_id = c.customer_id
    LEFT JOIN s_people ps ON o.salesperson_id = ps.person_id
    LEFT JOIN s_people pc ON o.contact_person_id = pc.person_id
    LEFT JOIN s_order_lines l ON o.order_id = l.order_id""",
    "fact_purchases": """
    SELECT po.purchase_order_id, l.purchase_order_line_id, po.supplier_id, pe.full_name AS contact_person,
        po.order_date, po.expected_delivery_date, l.last_receipt_date, l.stock_item_id, l.description,
        po.delivery_method_id, l.package_type_id, l.ordered_outers AS quantity_ordered,
        l.received_outers AS quantity_received, l.expected_unit_price_per_outer AS unit_price,
        COALESCE(po.is_order_finalized <> 0, true) AS is_finalized
    FROM s_purchase_orders po
    LEFT JOIN s_people pe ON po.contact_person_id = pe.person_id
    LEFT JOIN s_purchase_order_lines l ON po.purchase_order_id = l.purchase_order_id""",
    "dim_calendar": """
    , b AS (
        SELECT min(lo) AS lo, max(hi) AS hi FROM (
            SELECT min(least(order_date, expected_delivery_date)) AS lo,
                   max(greatest(order_date, expected_delivery_date)) AS hi FROM s_purchase_orders
            UNION ALL
            SELECT min(last_receipt_date), max(last_receipt_date) FROM s_purchase_order_lines)),
    days AS (
        SELECT CAST(g.d AS DATE) AS d FROM b,
            generate_series(CAST(make_date(CAST(year(lo) AS INTEGER), 1, 1) AS TIMESTAMP),
                            CAST(make_date(CAST(year(hi) AS INTEGER), 12, 31) AS TIMESTAMP),
                            INTERVAL 1 DAY) AS g(d))
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS TIMESTAMP) AS "date",
        CAST(year(d) AS INTEGER) AS "year", CAST(quarter(d) AS INTEGER) AS quarter,
        CAST(month(d) AS INTEGER) AS "month", monthname(d) AS month_name,
        strftime(d, '%b') AS month_name_short, CAST(day(d) AS INTEGER) AS "day",
        CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
        CAST(weekofyear(d) AS INTEGER) AS week_of_year, isodow(d) IN (6, 7) AS is_weekend,
        day(d) = 1 AS is_month_start, d = last_day(d) AS is_month_end,
        d = CAST(date_trunc('quarter', d) AS DATE) AS is_quarter_start,
        d = last_day(CAST(date_trunc('quarter', d) AS DATE) + INTERVAL 2 MONTH) AS is_quarter_end,
        month(d) = 1 AND day(d) = 1 AS is_year_start, month(d) = 12 AND day(d) = 31 AS is_year_end
    FROM days""",
}


def with_ctes(body: str, silver: dict[str, str] = SILVER_CTES) -> str:
    """Prefix ``body`` with the silver CTEs it mentions.

    A body starting with ``,`` continues the WITH list with its own CTEs.
    """
    used = [n for n in silver if re.search(rf"\b{n}\b", body)]
    ctes = ",\n".join(f"{n} AS ({silver[n]})" for n in used)
    body = body.strip()
    if body.startswith(","):
        return f"WITH {ctes}\n{body}" if ctes else f"WITH {body[1:]}"
    return f"WITH {ctes}\n{body}" if ctes else body


# ------------------------------------------------------------ silver / operators

SILVER_ORDERS = """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderkey % 25 AS salesperson_id,
        CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderkey % 50 END AS picked_by_id,
        o_custkey AS contact_person_id,
        CASE WHEN o_orderkey % 9 = 0 THEN o_orderkey + 1 END AS backorder_order_id,
        o_orderdate AS order_date,
        CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 11 = 0 THEN NULL
             ELSE o_orderdate + INTERVAL 7 DAY END AS expected_delivery_date,
        o_orderkey + 100000 AS customer_po_number,
        CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS is_undersupply_backordered,
        CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY END AS picking_completed_when,
        o_custkey % 10 AS last_edited_by, o_orderdate AS last_edited_when
    FROM orders"""

SILVER_ORDER_LINES = """
    SELECT l_orderkey * 100 + l_linenumber AS order_line_id, l_orderkey AS order_id,
        l_partkey AS stock_item_id, concat(l_returnflag, '-', l_linestatus) AS description,
        l_suppkey % 25 AS package_type_id, CAST(l_quantity AS BIGINT) AS quantity,
        l_extendedprice AS unit_price, l_tax AS tax_rate,
        CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) ELSE CAST(0 AS BIGINT) END AS picked_quantity,
        CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS picking_completed_when,
        l_suppkey % 10 AS last_edited_by, l_shipdate AS last_edited_when
    FROM lineitem"""

SILVER_STOCK_ITEMS = """
    SELECT p_partkey AS stock_item_id, p_name AS stock_item_name, p_partkey % 100 AS supplier_id,
        CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size % 7 AS BIGINT) END AS color_id,
        p_partkey % 25 AS unit_package_id, CAST(p_size % 25 AS BIGINT) AS outer_package_id,
        CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_brand END AS brand, p_type AS size,
        CAST(p_size AS BIGINT) AS lead_time_days, CAST(p_size * 2 AS BIGINT) AS quantity_per_outer,
        CAST(p_size % 2 AS BIGINT) AS is_chiller_stock,
        CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_partkey + 8302039290000 AS VARCHAR) || '.0' END AS barcode,
        CAST(15.0 AS DOUBLE) AS tax_rate, p_retailprice AS unit_price,
        p_retailprice * CAST(1.5 AS DOUBLE) AS recommended_retail_price,
        p_retailprice / 100 AS typical_weight_per_unit,
        CASE WHEN p_partkey % 3 <> 0 THEN 'Great ' || p_name END AS marketing_comments,
        '{}' AS custom_fields, '[]' AS tags, concat(p_name, ' ', p_type) AS search_details,
        CAST(1 AS BIGINT) AS last_edited_by, TIMESTAMP '2013-01-01 00:00:00' AS valid_from,
        CAST(NULL AS TIMESTAMP) AS valid_to
    FROM part"""

SILVER_CUSTOMERS = """
    SELECT c_custkey AS customer_id, c_name AS customer_name, c_custkey - c_custkey % 5 AS bill_to_customer_id,
        CAST(c_nationkey % 3 + 1 AS BIGINT) AS customer_category_id,
        CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE CAST(1 AS BIGINT) END AS buying_group_id,
        c_custkey + 1 AS primary_contact_person_id,
        CASE WHEN c_custkey % 3 = 0 THEN c_custkey + 2 END AS alternate_contact_person_id,
        CAST(c_nationkey % 7 AS BIGINT) AS delivery_method_id, c_custkey AS delivery_city_id,
        c_custkey AS postal_city_id,
        CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS credit_limit,
        CAST(DATE '2013-01-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP) AS account_opened_date,
        CAST(0.0 AS DOUBLE) AS standard_discount_percentage, CAST(0 AS BIGINT) AS is_statement_sent,
        c_custkey % 2 AS is_on_credit_hold, CAST(7 AS BIGINT) AS payment_days,
        concat('(', CAST(c_nationkey AS VARCHAR), ') 555-0', CAST(c_custkey AS VARCHAR)) AS phone_number,
        concat('(', CAST(c_nationkey AS VARCHAR), ') 556-0', CAST(c_custkey AS VARCHAR)) AS fax_number,
        concat('http://www.', lower(c_mktsegment), '.example') AS website_url,
        concat('Shop ', CAST(c_custkey AS VARCHAR)) AS delivery_address_line1,
        concat(CAST(c_custkey AS VARCHAR), ' Market Street') AS delivery_address_line2,
        CAST(c_nationkey + 90000 AS BIGINT) AS delivery_postal_code, 'POINT (0 0)' AS delivery_location,
        concat('PO Box ', CAST(c_custkey AS VARCHAR)) AS postal_address_line1,
        c_mktsegment AS postal_address_line2, CAST(c_nationkey + 90000 AS BIGINT) AS postal_postal_code,
        CAST(1 AS BIGINT) AS last_edited_by, TIMESTAMP '2013-01-01 00:00:00' AS valid_from,
        CAST(NULL AS TIMESTAMP) AS valid_to
    FROM customer"""

# null policy of the orders table (same policy as strata.plans.specs)
ORDERS_EXPECTED = {"picked_by_id": "nobody has picked the order yet", "backorder_order_id": "no backorder followed",
                   "picking_completed_when": "picking not finished"}
ORDERS_REQUIRED = ["order_id", "customer_id", "order_date", "salesperson_id"]

# the supplied tables' columns (for the overview and profile oracles)
TPCH_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
}
ORDERS_TYPES = ["bigint", "bigint", "string", "double", "timestamp_ntz", "string"]

SPLIT_TABLES = ["purchase.order", "purchase.orderline", "sales.incvoiceslines", "sales.invoices",
                "sales.order", "sales.orderline", "application.people", "sales.customer"]


def _null_policy_sql() -> str:
    parts = [f"""SELECT '{c}' AS "column", 'expected' AS kind, '{why}' AS reason,
        count(*) FILTER (WHERE {c} IS NULL) AS nulls, 'expected' AS status FROM s""" for c, why in ORDERS_EXPECTED.items()]
    parts += [f"""SELECT '{c}', 'required', CAST(NULL AS VARCHAR), count(*) FILTER (WHERE {c} IS NULL),
        CASE WHEN count(*) FILTER (WHERE {c} IS NULL) = 0 THEN 'ok' ELSE 'unexpected' END FROM s"""
              for c in ORDERS_REQUIRED]
    return f"WITH s AS ({SILVER_ORDERS})\n" + "\nUNION ALL\n".join(parts)


CUSTOMER_TYPES = {
    "customer_id": "bigint", "customer_name": "string", "bill_to_customer_id": "bigint", "credit_limit": "double",
    "delivery_method_id": "bigint", "delivery_city_id": "bigint", "primary_contact_person_id": "bigint", "phone_number": "string",
    "fax_number": "string", "website_url": "string", "delivery_address_line1": "string", "delivery_address_line2": "string",
    "delivery_postal_code": "bigint", "postal_address_line1": "string", "postal_address_line2": "string", "postal_postal_code": "bigint",
}


def _profile_sql() -> str:
    return with_ctes("\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", '{t}' AS data_type, count(*) FILTER (WHERE {c} IS NULL) AS nulls,
            count({c}) AS non_nulls FROM s_customers""" for c, t in CUSTOMER_TYPES.items()))


def _columns(sql: str) -> list[str]:
    """Output names of a silver CTE, in order."""
    flat = re.sub(r"\([^()]*\)", "", re.sub(r"\([^()]*\)", "", re.sub(r"\([^()]*\)", "", sql)))
    return re.findall(r"\bAS\s+(\w+)", flat)


def _nulls_of(cols) -> str:
    return " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in cols)


def _overview_sql() -> str:
    parts = [f"""SELECT 'silver' AS layer, '{n[2:]}' AS "table", count(*) AS "rows", CAST({len(_columns(q))} AS BIGINT) AS cols,
            CAST({_nulls_of(_columns(q))} AS BIGINT) AS nulls FROM {n}""" for n, q in SILVER_CTES.items()]
    return with_ctes("\nUNION ALL\n".join(parts))


def _sizes_sql() -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT 'testdata' AS layer, '{t}' AS "table", count(*) AS "rows",
            CAST({len(cols)} AS BIGINT) AS cols, CAST({_nulls_of(cols)} AS BIGINT) AS nulls, true AS has_size FROM {t}""" for t, cols in TPCH_COLUMNS.items())


def _ratio_sql() -> str:
    return with_ctes("\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", count(*) AS "rows", count(*) FILTER (WHERE {c} IS NULL) AS nulls,
            round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 2) AS missing_pct FROM s_customers"""
        for c in ("credit_limit", "delivery_city_id", "fax_number", "customer_id")))


def _suspicious_sql() -> str:
    """Every value of these columns is present; which ones read as a timestamp is stated by column."""
    late = "count(*) FILTER (WHERE o_orderkey % 13 <> 0 AND o_orderkey % 11 <> 0)"
    flagged = {
        "sales/orders": ("orders", {"CustomerID": "count(*) FILTER (WHERE o_custkey BETWEEN 1678 AND 2262)", "OrderDate": "count(*)", "ExpectedDeliveryDate": late,
                                    "CustomerPurchaseOrderNumber": "count(*) FILTER (WHERE length(CAST(o_orderkey + 100000 AS VARCHAR)) = 4)",
                                    "PickingCompletedWhen": "count(*) FILTER (WHERE o_orderstatus = 'F')", "LastEditedWhen": "count(*)"}),
        "sales/order_lines": ("lineitem", {"StockItemID": "count(*) FILTER (WHERE l_partkey BETWEEN 1678 AND 2262)",
                                           "PickingCompletedWhen": "count(*) FILTER (WHERE l_linestatus = 'F')", "LastEditedWhen": "count(*)"})}
    return "\nUNION ALL\n".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", 'string' AS data_type, count(*) AS non_nulls, {n} AS parseable FROM {src}"""
        for t, (src, cols) in flagged.items() for c, n in cols.items())


def _impute_audit_sql() -> str:
    pairs = [("credit_limit", "credit_limit_amount"), ("full_name", "contact_full_name"),
             ("email_address", "contact_email")]

    def pct(c: str, t: str) -> str:
        return f"(SELECT round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 2) FROM {t})"

    body = "\nUNION ALL\n".join(
        f"""SELECT '{b}' AS "column", (SELECT count(*) FILTER (WHERE {b} IS NULL) FROM base) AS nulls_before,
            (SELECT count(*) FILTER (WHERE {a} IS NULL) FROM fin) AS nulls_after, {pct(b, 'base')} AS pct_before, {pct(a, 'fin')} AS pct_after""" for b, a in pairs)
    return with_ctes(f", base AS ({CUSTOMER_BASE}), fin AS ({CUSTOMER_FINAL})\n{body}")


def _ingest_status_sql() -> str:
    win = "(SELECT count(*) FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1997)"
    rows = []
    for t in SPLIT_TABLES:
        rows.append(f"('actual', '{t}', 'ok', {win})" if t == "sales.order"
                    else f"('actual', '{t}', 'missing', NULL)")
    rows.append("('actual', 'application.nations', 'ok', (SELECT count(*) FROM nation))")
    for t in SPLIT_TABLES:
        rows.append("('upcoming', 'sales.order', 'ok', (SELECT count(*) FROM orders))" if t == "sales.order"
                    else f"('upcoming', '{t}', 'missing', NULL)")
    return ('SELECT label, "table", status, CAST("rows" AS BIGINT) AS "rows" FROM (VALUES '
            + ", ".join(rows) + ') AS v(label, "table", status, "rows")')


def _publish_sql() -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{t}.parquet' AS "table", 'ok' AS status, count(*) AS "rows" FROM {t}""" for t in TPCH_COLUMNS)


def _run_all_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT 'gold' AS layer, '{n}' AS \"table\", 'ok' AS status, "
        f"(SELECT count(*) FROM ({with_ctes(GOLD_SQL[n])}) AS g) AS \"rows\""
        for n in ["dim_calendar", "dim_customer", "dim_geography", "dim_people", "dim_stock_item",
                  "dim_supplier", "fact_orders", "fact_purchases"]) + (
        "\nUNION ALL\nSELECT 'gold', 'fact_invoices', 'failed', CAST(NULL AS BIGINT)")


SILVER_TABLE_ORDER = ["cities", "colors", "countries", "customers", "delivery_methods", "invoices",
                      "invoice_lines", "package_types", "payment_methods", "people", "provinces",
                      "purchase_orders", "purchase_order_lines", "orders", "order_lines", "stock_groups",
                      "stock_item_holdings", "stock_items", "suppliers", "supplier_transactions",
                      "transaction_types"]


RUN_SILVER = {**{n: silver_sql(n) for n in SOURCES}, "orders": SILVER_ORDERS, "order_lines": SILVER_ORDER_LINES,
              "customers": SILVER_CUSTOMERS, "stock_items": SILVER_STOCK_ITEMS}
# the silver tables that a whole run writes, under the names of the gold SQL
RUN_CTES = {f"s_{n}": q for n, q in RUN_SILVER.items()}


def _silver_run_sql() -> str:
    rows = [f"('silver', '{t}', 'failed', NULL)" if t == "transaction_types"
            else f"('silver', '{t}', 'ok', (SELECT count(*) FROM ({RUN_SILVER[t]}) AS s))" for t in SILVER_TABLE_ORDER]
    return ('SELECT layer, "table", status, CAST("rows" AS BIGINT) AS "rows" FROM (VALUES '
            + ", ".join(rows) + ') AS v(layer, "table", status, "rows")')


def _key_check_sql() -> str:
    parts = []
    for t in TABLES:
        k = t.silver_key
        parts.append(f"""SELECT '{t.name}' AS "table", '{k}' AS "key", count(*) AS "rows", count(*) FILTER (WHERE {k} IS NULL) AS null_keys,
            (SELECT count(*) FROM (SELECT {k} FROM ({RUN_SILVER[t.name]}) AS a WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > 1) AS d) AS duplicate_keys
            FROM ({RUN_SILVER[t.name]}) AS s""")
    return "\nUNION ALL\n".join(parts)


def _join_growth_sql() -> str:
    """Lookups keep the rows; the fan-outs give a row a detail and one for each header without any."""
    market = "(SELECT count(*) FROM s_provinces p LEFT JOIN s_cities c ON p.state_province_id = c.state_province_id)"
    cities = {"provinces": "(SELECT count(*) FROM s_provinces)", "provinces + countries": "(SELECT count(*) FROM s_provinces)", "provinces + cities": market}
    steps = {
        "dim_customer": cities | {"customers" + x: "(SELECT count(*) FROM s_customers)" for x in ("", " + delivery methods", " + market", " + contacts")},
        "dim_geography": cities,
        "dim_stock_item": {"stock items" + x: "(SELECT count(*) FROM s_stock_items)" for x in ("", " + colors", " + unit packages", " + outer packages")},
        "dim_supplier": {"suppliers" + x: "(SELECT count(*) FROM s_suppliers)" for x in ("", " + delivery methods", " + contacts", " + delivery cities", " + postal cities")},
        "fact_orders": {"orders" + x: "(SELECT count(*) FROM s_orders)" for x in ("", " + customers", " + salespeople", " + contacts")} | {
            "orders + order lines": "(SELECT count(*) FROM s_orders o LEFT JOIN s_order_lines l ON o.order_id = l.order_id)"},
        "fact_purchases": {"purchase orders" + x: "(SELECT count(*) FROM s_purchase_orders)" for x in ("", " + contacts")} | {
            "purchase orders + purchase order lines": "(SELECT count(*) FROM s_purchase_orders o LEFT JOIN s_purchase_order_lines l ON o.purchase_order_id = l.purchase_order_id)"},
    }
    return with_ctes("\nUNION ALL\n".join(f"SELECT '{job}: {step}' AS step, {n} AS \"rows\"" for job, of in steps.items() for step, n in of.items()))


ODD_SQL = """list_extract(['plain', 'two' || chr(10) || 'lines', 'a;b,c', 'say "hi"', '  lead and trail  ', '',
    chr(9) || 'tab' || chr(9), 'a' || chr(13) || chr(10) || 'b', '"', ','], CAST(o_orderkey % 10 + 1 AS INTEGER))"""
ODD_ROWS = f"""SELECT CAST(o_orderkey AS VARCHAR) AS id,
    CASE WHEN o_orderkey % 7 <> 0 THEN {ODD_SQL} || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'x' END END AS note,
    CASE WHEN o_orderkey % 5 <> 0 THEN {ODD_SQL} END AS more FROM orders"""

_BIG = "o_orderkey + 9007199254740992"


def _cast_failures_sql() -> str:
    n, none = "count(*)", "CAST(0 AS BIGINT)"
    back = "count(*) FILTER (WHERE o_orderkey % 9 = 0)"
    rows = [("order_id", "bigint", n, none), ("customer_id", "bigint", n, "count(*) FILTER (WHERE o_orderkey % 10 IN (0, 1))"), ("salesperson_id", "bigint", n, none),
            ("picked_by_id", "bigint", "count(*) FILTER (WHERE o_orderstatus <> 'O')", none), ("contact_person_id", "bigint", n, none),
            ("backorder_order_id", "bigint", back, none), ("order_date", "timestamp", n, none),
            ("expected_delivery_date", "timestamp", n, "count(*) FILTER (WHERE o_orderkey % 13 = 0 OR o_orderkey % 11 = 0)"),
            ("customer_po_number", "bigint", n, none), ("is_undersupply_backordered", "bigint", n, none),
            ("picking_completed_when", "timestamp", "count(*) FILTER (WHERE o_orderstatus = 'F')", none),
            ("last_edited_by", "bigint", n, none), ("last_edited_when", "timestamp", n, none)]
    lines = [(c, "bigint", n, none) for c in ("order_line_id", "order_id", "stock_item_id", "package_type_id", "quantity")]
    lines += [("unit_price", "double", n, "count(*) FILTER (WHERE (l_orderkey * 100 + l_linenumber) % 8 IN (1, 2, 3))"), ("tax_rate", "double", n, none), ("picked_quantity", "bigint", n, none),
              ("picking_completed_when", "timestamp", "count(*) FILTER (WHERE l_linestatus = 'F')", none), ("last_edited_by", "bigint", n, none), ("last_edited_when", "timestamp", n, none)]
    return "\nUNION ALL\n".join(f"""SELECT '{c}' AS "column", '{k}' AS kind, {v} AS "values", {f} AS failed, '{name}' AS "table" FROM {source}"""
                                for of, name, source in ((rows, "orders", "orders"), (lines, "order_lines", "lineitem")) for c, k, v, f in of)


def _key_bitmaps_sql() -> str:
    parts = []
    for t, c, v in (("orders", "o_orderkey", "o_orderkey"), ("orders", "o_custkey", "CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END"), ("lineitem", "l_orderkey", "l_orderkey"),
                    ("part", "p_partkey", "p_partkey"), ("customer", "c_name", "c_name"), ("events", "user_id", "user_id")):
        parts.append(f"""SELECT '{t}.{c}' AS "key", count(*) AS "rows", count(*) FILTER (WHERE {v} IS NULL) AS null_keys,
            (SELECT count(*) FROM (SELECT {v} AS k FROM {t} WHERE {v} IS NOT NULL GROUP BY 1 HAVING count(*) > 1) AS d) AS duplicate_keys FROM {t}""")
    return "\nUNION ALL\n".join(parts)


def _footer_overview_sql() -> str:
    parts = []
    for t, columns in TPCH_COLUMNS.items():
        nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in columns)
        parts.append(f"""SELECT 'testdata' AS layer, '{t}' AS "table", count(*) AS "rows", CAST({len(columns)} AS BIGINT) AS cols, {nulls} AS nulls FROM {t}""")
    return "\nUNION ALL\n".join(parts)


def _run_resumed_sql() -> str:
    parts = []
    for run in (1, 2):
        for t in SILVER_TABLE_ORDER:
            late = run == 1 and t == "order_lines"
            rows = "CAST(NULL AS BIGINT)" if late else f"(SELECT count(*) FROM ({RUN_SILVER[t]}) AS s)"
            parts.append(f"SELECT CAST({run} AS INTEGER) AS run, 'silver' AS layer, '{t}' AS \"table\", '{'failed' if late else 'ok'}' AS status, {rows} AS \"rows\"")
        for g, sql in GOLD_SQL.items():
            late = run == 1 and g == "fact_orders"
            parts.append(f"""SELECT {run}, 'gold', '{g}', '{'blocked' if late else 'ok'}', {'NULL' if late else f'(SELECT count(*) FROM ({with_ctes(sql, RUN_CTES)}) AS g)'}""")
    return "\nUNION ALL\n".join(parts)


def oracle_queries() -> dict[str, str]:
    q = {name: with_ctes(sql) for name, sql in GOLD_SQL.items()}
    q.update({
        **{f"silver_{n}": q for n, q in RUN_SILVER.items()},
        "silver_csv_roundtrip": SILVER_ORDERS,
        "silver_incremental": f"""SELECT *, CAST(NULL AS VARCHAR) AS "Comments",
            CAST(NULL AS VARCHAR) AS "DeliveryInstructions", CAST(NULL AS VARCHAR) AS "InternalComments"
            FROM ({SILVER_ORDERS}) AS s""",
        "null_policy": _null_policy_sql(),
        "null_tokens": """SELECT o_orderkey,
            CASE WHEN o_orderkey % 10 IN (0, 1, 2, 3) THEN NULL ELSE o_orderpriority END AS priority FROM orders""",
        "to_timestamp_coerce": """SELECT o_orderkey,
            CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END AS order_ts
            FROM orders""",
        "parse_first_format": """SELECT o_orderkey, o_orderdate AS d_parsed, 'dd/MM/yyyy' AS chosen_format
            FROM orders""",
        "nullable_bigint": """SELECT l_orderkey, l_linenumber,
            CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS quantity FROM lineitem""",
        "number_to_text": """SELECT o_orderkey,
            CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR) || '.0' AS price_text FROM orders""",
        "truthy_flag": """SELECT l_orderkey, l_linenumber,
            COALESCE(CASE WHEN l_linenumber <> 2 THEN l_quantity - 1 END <> 0, true) AS flag FROM lineitem""",
        "drop_empty_columns": "SELECT * FROM orders",
        "dedup_columns": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
        "rename_select": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice, o_orderdate
            FROM orders""",
        "drop_strict": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders",
        "table_profile": _profile_sql(),
        "layer_overview": _overview_sql(),
        "suspicious_dates": _suspicious_sql(),
        "duplicate_keys": """SELECT o_custkey, count(*) AS "count" FROM orders
            GROUP BY o_custkey HAVING count(*) > 1""",
        "impute_audit": _impute_audit_sql(),
        "ingest_split": """SELECT o_orderkey AS order_id, strftime(o_orderdate, '%d/%m/%Y') AS last_edited_when,
            o_orderdate AS last_edited_when_parsed FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1997""",
        "ingest_status": _ingest_status_sql(),
        "publish_roundtrip": _publish_sql(),
        "silver_run_status": _silver_run_sql(),
        "run_all_status": _run_all_sql(),
        "run_fact_orders": with_ctes(GOLD_SQL["fact_orders"], RUN_CTES),
        "run_dim_customer": with_ctes(GOLD_SQL["dim_customer"], RUN_CTES),
        "run_summary": """SELECT 'gold' AS layer, CAST(2 AS BIGINT) AS jobs, CAST(1 AS BIGINT) AS ok, CAST(1 AS BIGINT) AS failed, CAST(0 AS BIGINT) AS skipped, CAST(0 AS BIGINT) AS blocked
            UNION ALL SELECT 'silver', 21, 21, 0, 0, 0""",
        "bigint_exact": f"""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN {_BIG}
            WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN {_BIG} WHEN o_orderkey % 19 = 0 OR o_orderkey % 23 = 0 THEN NULL
            WHEN o_orderkey % 29 = 0 THEN {_BIG} WHEN o_orderkey % 31 = 0 OR o_orderkey % 13 = 0 THEN NULL ELSE {_BIG} END AS id FROM orders""",
        "cast_failures": _cast_failures_sql(),
        "csv_fidelity": ODD_ROWS,
        "pass_through_rows": ODD_ROWS,
        "snapshot_rows": """SELECT CAST(o_orderkey AS VARCHAR) AS "OrderID", CAST(o_custkey AS VARCHAR) AS "CustomerID",
            CASE WHEN o_orderkey % 13 = 0 THEN '9999-12-31 23:59:59.9999999' WHEN o_orderkey % 11 = 0 THEN 'garbage'
                 ELSE strftime(o_orderdate + INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') END AS "ExpectedDeliveryDate",
            strftime(o_orderdate, '%d/%m/%Y') AS "LastEditedWhen" FROM orders""",
        "publish_rows": "SELECT * FROM lineitem",
        "missing_ratio": _ratio_sql(),
        "nonzero_nulls": with_ctes("SELECT * FROM (" + "\nUNION ALL\n".join(
            f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM s_customers""" for c in CUSTOMER_TYPES) + ") AS n WHERE nulls > 0"),
        "layer_sizes": _sizes_sql(),
        "table_sample": "SELECT * FROM orders ORDER BY o_custkey, o_orderkey LIMIT 5",
        "key_check": _key_check_sql(),
        "join_growth": _join_growth_sql(),
        "contains_or_false": with_ctes("SELECT customer_id, COALESCE(contains(delivery_address_line1, '1'), false) AS has_one FROM s_customers"),
        "lookup_null_safe": with_ctes("""SELECT customer_id, delivery_city_id, COALESCE('city ' || CAST(delivery_city_id AS VARCHAR), 'none') AS label FROM s_customers"""),
        "double_exact": """SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN NULL WHEN 3 THEN CAST(0.25 AS DOUBLE) WHEN 4 THEN NULL WHEN 5 THEN CAST(50 AS DOUBLE)
            WHEN 6 THEN NULL ELSE l_extendedprice END AS price FROM lineitem""",
        "csv_many_splits": ODD_ROWS,
        "snapshot_rest": """SELECT CAST(o_orderkey AS VARCHAR) AS "OrderID", CAST(o_custkey AS VARCHAR) AS "CustomerID", strftime(o_orderdate, '%d/%m/%Y') AS "LastEditedWhen"
            FROM orders WHERE year(o_orderdate) NOT IN (1996, 1997)""",
        "silver_null_policy_fails": """SELECT 'clean' AS extract, 'ok' AS status, count(*) AS "rows", CAST(0 AS BIGINT) AS customer_nulls FROM orders
            UNION ALL SELECT 'spoilt', 'failed', NULL, count(*) FILTER (WHERE o_orderkey % 3 = 0) FROM orders""",
        "published_versions": """SELECT l_orderkey, l_linenumber, l_quantity, 'early' AS reader FROM lineitem WHERE l_linenumber <= 3
            UNION ALL SELECT l_orderkey, l_linenumber, l_quantity + 1, 'late' FROM lineitem""",
        "publish_nested": "\nUNION ALL\n".join(
            f"""SELECT '{''.join(f'level{k}/' for k in range(i % 4))}{t}' AS "table", 'ok' AS status, count(*) AS "rows" FROM {t}""" for i, t in enumerate(TPCH_COLUMNS)),
        "key_bitmaps": _key_bitmaps_sql(),
        "footer_overview": _footer_overview_sql(),
        "calendar_from_footers": with_ctes(GOLD_SQL["dim_calendar"]),
        "inferred_dates": """SELECT o_orderkey AS order_id,
            CASE WHEN o_orderkey = lead THEN TIMESTAMP '1995-12-25 00:00:00' WHEN o_orderkey % 10 <> 3 THEN o_orderdate END AS order_date,
            CASE WHEN o_orderkey = lead THEN TIMESTAMP '1996-02-01 10:30:00' WHEN o_orderkey % 10 <> 4 THEN o_orderdate END AS picking_completed_when,
            CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate END AS expected_delivery_date FROM (SELECT *, min(o_orderkey) OVER () AS lead FROM orders) AS o""",
        "facts_of_a_period": with_ctes(f"""SELECT order_id, order_line_id, order_date, quantity FROM ({GOLD_SQL["fact_orders"]}) AS f
            WHERE year(order_date) IN (1996, 1997) AND isodow(order_date) IN (6, 7)"""),
        "run_resumed": _run_resumed_sql(),
        "run_catalog": with_ctes(GOLD_SQL["fact_orders"], RUN_CTES),
        "register_views": "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
    })
    return q
