"""End to end on bronze CSV fixtures: silver jobs, gold jobs, edge rows."""

import datetime as dt
import os

import pytest

from fixtures import write_bronze
from strata.operators.quality import join_growth
from strata.plans import gold
from strata.plans.runner import run_all, silver_inputs


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("wh"))
    bronze = write_bronze(os.path.join(root, "bronze", "actual"))
    status, policy = run_all(spark, bronze, f"{root}/silver", f"{root}/gold", workers=4)
    return {"root": root, "status": {(r.layer, r.table): r for r in status.collect()},
            "policy": policy.collect(), "tables": silver_inputs(spark, f"{root}/silver")}


def test_every_job_ok(warehouse):
    bad = {k: (r.status, r.error) for k, r in warehouse["status"].items() if r.status != "ok"}
    assert not bad
    assert len(warehouse["status"]) == 29


def test_silver_types_and_nulls(warehouse):
    orders = warehouse["tables"]["orders"]
    types = dict(orders.dtypes)
    assert types["picked_by_id"] == "bigint" and types["order_date"] == "timestamp_ntz"
    assert "Comments" not in orders.columns and "last_edited_when_parsed" not in orders.columns
    got = {r.order_id: (r.picked_by_id, r.backorder_order_id) for r in orders.collect()}
    assert got == {1: (12, None), 2: (None, None), 3: (None, 45)}
    cities = warehouse["tables"]["cities"].collect()
    assert all(r.valid_to is None for r in cities)          # end-of-time sentinel -> null
    items = {r.stock_item_id: r.barcode for r in warehouse["tables"]["stock_items"].collect()}
    assert items == {1: "8302039293929.0", 2: None}
    lines = {r.purchase_order_line_id: r.last_receipt_date for r in warehouse["tables"]["purchase_order_lines"].collect()}
    assert lines[12] is None and lines[11] == dt.datetime(2012, 3, 10)


def test_null_policy_report(warehouse):
    rows = {(r.table, r.column): r for r in warehouse["policy"]}
    assert rows[("orders", "picked_by_id")].status == "expected"
    assert rows[("orders", "picked_by_id")].nulls == 2
    assert rows[("orders", "order_id")].status == "ok"
    assert rows[("customers", "customer_id")].status == "ok"
    assert rows[("people", "full_name")].status == "ok"


def test_dim_customer_edges(spark, warehouse):
    out = {r.customer_id: r for r in gold.dim_customer(warehouse["tables"]).collect()}
    assert out[1].contact_full_name == "Head Office" and out[1].contact_email == "info@acmetoys.com"
    assert out[2].credit_limit_amount == 1000.0            # parent's original limit
    assert out[4].credit_limit_amount == 3000.0
    assert out[5].credit_limit_amount == pytest.approx(2000.0)   # mean of known limits
    assert out[2].contact_full_name == "Ann Lee" and out[2].contact_email == "ann@x.com"
    assert out[3].city is None and out[4].city is None     # null and unknown delivery city
    assert out[1].city == "Ely" and out[1].state_name == "Alpha" and out[1].country == "Utopia"
    assert out[4].delivery_method is None
    assert list(gold.dim_customer(warehouse["tables"]).columns) == gold.CUSTOMER_ORDER


def test_dim_geography_fanout(spark, warehouse):
    rows = gold.dim_geography(warehouse["tables"]).collect()
    assert len(rows) == 4                                    # 2 + 1 cities + 1 city-less province
    by_city = {r.city_id: r for r in rows}
    assert by_city[100].latest_recorded_population == by_city[101].latest_recorded_population == 1000
    assert by_city[None].state_province_id == 30


def test_dim_people_excludes_system_person(warehouse):
    ids = sorted(r.person_id for r in gold.dim_people(warehouse["tables"]).collect())
    assert ids == [2, 3]


def test_dim_stock_item_roles(warehouse):
    out = {r.stock_item_id: r for r in gold.dim_stock_item(warehouse["tables"]).collect()}
    assert (out[1].color, out[1].unit_package_type, out[1].outer_package_type) == ("Red", "Each", "Carton")
    assert out[2].color is None and out[2].outer_package_type == "Each"


def test_dim_supplier_fills_and_contact_phone(warehouse):
    out = {r.supplier_id: r for r in gold.dim_supplier(warehouse["tables"]).collect()}
    assert out[1].delivery_method == "Upon request"
    assert out[1].delivery_address_additional == "No address line"
    assert out[1].internal_comments == "Not available"
    assert out[1].contact_phone == "(222)"                   # the contact's phone, not the supplier's
    assert out[2].postal_city is None and out[2].delivery_city == "Bow"


def test_fact_orders(warehouse):
    rows = gold.fact_orders(warehouse["tables"]).collect()
    assert len(rows) == 4                                    # 2 + 1 lines + order 3 without lines
    by = {(r.order_id, r.order_line_id): r for r in rows}
    assert by[(3, None)].customer is None and by[(3, None)].sales_person == "Ann Lee"
    assert by[(1, 11)].customer == "Acme Toys (Head Office)" and by[(1, 11)].contact_person == "Bob Ray"
    assert rows[0].__fields__ == gold.FACT_ORDERS_COLUMNS[:3] + [
        "customer", "customer_phone_number"] + gold.FACT_ORDERS_COLUMNS[5:]


def test_fact_purchases_flags(warehouse):
    rows = gold.fact_purchases(warehouse["tables"]).collect()
    assert len(rows) == 4
    flags = {r.purchase_order_id: r.is_finalized for r in rows}
    assert flags == {1: False, 2: True, 3: True}             # 0, 1, missing -> true
    assert len(rows[0]) == 15


def test_dim_calendar_range(warehouse):
    cal = gold.dim_calendar(warehouse["tables"])
    rows = cal.collect()
    assert len(rows) == 366 + 365 + 365
    first = rows[0] if rows[0].date_key == 20120101 else min(rows, key=lambda r: r.date_key)
    assert first.date_key == 20120101
    d = {r.date_key: r for r in rows}
    assert d[20121231].week_of_year == 1 and d[20121231].day_of_week == 0


def test_calendar_without_dates_fails(spark):
    empty = spark.createDataFrame([], "order_date timestamp_ntz, expected_delivery_date timestamp_ntz")
    with pytest.raises(Exception, match="No valid dates"):
        gold.dim_calendar({"purchase_orders": empty}).collect()


def test_command_line_run(spark, tmp_path):
    from strata.__main__ import main
    root = str(tmp_path)
    bronze = write_bronze(os.path.join(root, "bronze"))
    assert main(["run", bronze, f"{root}/silver", f"{root}/gold", "--workers", "2"]) == 0
    assert spark.read.parquet(f"{root}/gold/fact_orders").count() == 4
    assert main(["publish", f"{root}/gold", f"{root}/pub"]) == 0
    assert spark.read.parquet(f"{root}/pub/dim_people").count() == 2


def test_join_growth_audit(spark, warehouse):
    steps = []
    gold.fact_orders(warehouse["tables"], trace=steps)
    counts = {r.step: r.rows for r in join_growth(steps).collect()}
    assert counts == {"orders": 3, "orders + customers": 3, "orders + salespeople": 3, "orders + contacts": 3,
                      "orders + order lines": 4}


def test_empty_source_and_result_keep_the_earlier_tables(spark, tmp_path):
    from strata.plans.runner import run_gold
    from strata.plans.silver import build_silver
    from strata.plans.specs import BY_NAME
    root = str(tmp_path)
    bronze = write_bronze(os.path.join(root, "bronze"))
    tdef = BY_NAME["people"]
    build_silver(spark, tdef, bronze, f"{root}/silver")
    path = f"{root}/silver/{tdef.output_path}"
    rows = spark.read.parquet(path).count()
    people = spark.read.parquet(path)
    assert run_gold(spark, {"people": people}, f"{root}/gold", ["dim_people"])[0]["status"] == "ok"
    kept = spark.read.parquet(f"{root}/gold/dim_people").count()
    assert run_gold(spark, {"people": people.limit(0)}, f"{root}/gold", ["dim_people"])[0]["status"] == "skipped_empty"
    assert spark.read.parquet(f"{root}/gold/dim_people").count() == kept
    with open(f"{bronze}/{tdef.bronze_file}") as f:
        header = f.readline()
    with open(f"{bronze}/{tdef.bronze_file}", "w") as f:
        f.write(header)
    assert build_silver(spark, tdef, bronze, f"{root}/silver")[0]["status"] == "skipped_empty"
    assert spark.read.parquet(path).count() == rows


def test_junk_in_a_numeric_column_is_an_error_or_counted(spark, tmp_path):
    from strata.plans.silver import build_silver
    from strata.plans.specs import BY_NAME
    root = str(tmp_path)
    bronze = write_bronze(os.path.join(root, "bronze"))
    tdef = BY_NAME["orders"]
    file = f"{bronze}/{tdef.bronze_file}"
    lines = open(file).read().split("\n")
    at = lines[0].split(",").index("CustomerID")
    cells = lines[1].split(",")
    cells[at] = "abc"
    lines[1] = ",".join(cells)
    open(file, "w").write("\n".join(lines))
    with pytest.raises(Exception, match="abc"):
        build_silver(spark, tdef, bronze, f"{root}/silver")
    assert not os.path.exists(f"{root}/silver/{tdef.output_path}")
    status, policy = build_silver(spark, tdef, bronze, f"{root}/silver", strict=False)
    assert status["status"] == "ok"
    assert [(r[1], r[4]) for r in policy if r[2] == "cast" and r[1] == "customer_id"] == [("customer_id", 1)]
