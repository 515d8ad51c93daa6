"""Bronze-shaped (all text, source column names) views of the TPC-H-like tables.

They let the silver jobs run on the supplied data exactly as on an
operational CSV extract: ids as text, nullable ids written as floats
(``'12.0'``), missing-value tokens, whole-null columns, unparseable and
end-of-time dates.  Which rows get which oddity is decided by key arithmetic
only, so an independent SQL engine can state the expected silver result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SENTINEL = "9999-12-31 23:59:59.9999999"


def _s(c: Column) -> Column:
    return c.cast("string")


def _ts_text(c: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(c, fmt)


def bronze_orders(orders: DataFrame, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """``sales.order`` extract from TPC-H orders (columns of the orders table definition)."""
    k, st, d = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderdate")
    day = F.expr("INTERVAL 1 DAY")
    return orders.select(
        _s(k).alias("OrderID"),
        _s(F.col("o_custkey")).alias("CustomerID"),
        _s(k % 25).alias("SalespersonPersonID"),
        F.when(st == "O", F.lit("NA")).otherwise(F.concat(_s(k % 50), F.lit(".0"))).alias("PickedByPersonID"),
        _s(F.col("o_custkey")).alias("ContactPersonID"),
        F.when(k % 9 == 0, F.concat(_s(k + 1), F.lit(".0"))).otherwise(F.lit("")).alias("BackorderOrderID"),
        _ts_text(d, date_format).alias("OrderDate"),
        F.when(k % 13 == 0, F.lit(SENTINEL)).when(k % 11 == 0, F.lit("garbage"))
         .otherwise(_ts_text(d + F.expr("INTERVAL 7 DAYS"))).alias("ExpectedDeliveryDate"),
        _s(k + 100000).alias("CustomerPurchaseOrderNumber"),
        F.when(st == "F", F.lit("1")).otherwise(F.lit("0")).alias("IsUndersupplyBackordered"),
        F.lit(None).cast("string").alias("Comments"),
        F.lit("NULL").alias("DeliveryInstructions"),
        F.lit("").alias("InternalComments"),
        F.when(st == "F", F.concat(_ts_text(d + day), F.lit(".0000000"))).otherwise(F.lit("NULL"))
         .alias("PickingCompletedWhen"),
        _s(F.col("o_custkey") % 10).alias("LastEditedBy"),
        _ts_text(d).alias("LastEditedWhen"))


def bronze_order_lines(lineitem: DataFrame) -> DataFrame:
    """``sales.orderline`` extract from TPC-H lineitem."""
    q = F.col("l_quantity").cast("bigint")
    fin = F.col("l_linestatus") == "F"
    return lineitem.select(
        _s(F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("OrderLineID"),
        _s(F.col("l_orderkey")).alias("OrderID"),
        _s(F.col("l_partkey")).alias("StockItemID"),
        F.concat(F.col("l_returnflag"), F.lit("-"), F.col("l_linestatus")).alias("Description"),
        _s(F.col("l_suppkey") % 25).alias("PackageTypeID"),
        _s(q).alias("Quantity"),
        _s(F.col("l_extendedprice")).alias("UnitPrice"),
        _s(F.col("l_tax")).alias("TaxRate"),
        F.when(fin, _s(q)).otherwise(F.lit("0")).alias("PickedQuantity"),
        F.when(fin, _ts_text(F.col("l_shipdate"))).otherwise(F.lit("NULL")).alias("PickingCompletedWhen"),
        _s(F.col("l_suppkey") % 10).alias("LastEditedBy"),
        _ts_text(F.col("l_shipdate"), "yyyy-MM-dd").alias("LastEditedWhen"))


VALID_FROM = "2013-01-01 00:00:00.0000000"


def bronze_stock_items(part: DataFrame) -> DataFrame:
    """``warehouse.stockitems`` extract from TPC-H part (float-written colour ids, barcodes)."""
    k, size, price = F.col("p_partkey"), F.col("p_size"), F.col("p_retailprice")
    return part.select(
        _s(k).alias("StockItemID"),
        F.col("p_name").alias("StockItemName"),
        _s(k % 100).alias("SupplierID"),
        F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(_s(size % 7), F.lit(".0"))).alias("ColorID"),
        _s(k % 25).alias("UnitPackageID"),
        _s(size % 25).alias("OuterPackageID"),
        F.when(k % 6 == 0, F.lit("NA")).otherwise(F.col("p_brand")).alias("Brand"),
        F.col("p_type").alias("Size"),
        _s(size).alias("LeadTimeDays"),
        _s(size * 2).alias("QuantityPerOuter"),
        _s(size % 2).alias("IsChillerStock"),
        F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(_s(k + 8302039290000), F.lit(".0"))).alias("Barcode"),
        F.lit("15.0").alias("TaxRate"),
        _s(price).alias("UnitPrice"),
        _s(price * 1.5).alias("RecommendedRetailPrice"),
        _s(price / 100).alias("TypicalWeightPerUnit"),
        F.when(k % 3 != 0, F.concat(F.lit("Great "), F.col("p_name"))).alias("MarketingComments"),
        F.lit("").alias("InternalComments"),
        F.lit("NULL").alias("Photo"),
        F.lit("{}").alias("CustomFields"),
        F.lit("[]").alias("Tags"),
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_type")).alias("SearchDetails"),
        F.lit("1").alias("LastEditedBy"),
        F.lit(VALID_FROM).alias("ValidFrom"),
        F.lit(SENTINEL).alias("ValidTo"))


def bronze_customers(customer: DataFrame) -> DataFrame:
    """``sales.customer`` extract from TPC-H customer (a year-split file: has ``ValidFrom_parsed``)."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    opened = F.date_add(F.lit("2013-01-01").cast("date"), (k % 365).cast("int"))
    return customer.select(
        _s(k).alias("CustomerID"),
        F.col("c_name").alias("CustomerName"),
        _s(k - k % 5).alias("BillToCustomerID"),
        _s(n % 3 + 1).alias("CustomerCategoryID"),
        F.when(k % 2 == 0, F.lit("NULL")).otherwise(F.lit("1")).alias("BuyingGroupID"),
        _s(k + 1).alias("PrimaryContactPersonID"),
        F.when(k % 3 == 0, F.concat(_s(k + 2), F.lit(".0"))).otherwise(F.lit("")).alias("AlternateContactPersonID"),
        _s(n % 7).alias("DeliveryMethodID"),
        _s(k).alias("DeliveryCityID"),
        _s(k).alias("PostalCityID"),
        F.when(k % 7 == 0, F.lit("NA")).otherwise(_s(F.col("c_acctbal"))).alias("CreditLimit"),
        F.date_format(opened, "yyyy-MM-dd").alias("AccountOpenedDate"),
        F.lit("0.000").alias("StandardDiscountPercentage"),
        F.lit("0").alias("IsStatementSent"),
        _s(k % 2).alias("IsOnCreditHold"),
        F.lit("7").alias("PaymentDays"),
        F.concat(F.lit("("), _s(n), F.lit(") 555-0"), _s(k)).alias("PhoneNumber"),
        F.concat(F.lit("("), _s(n), F.lit(") 556-0"), _s(k)).alias("FaxNumber"),
        F.lit("").alias("DeliveryRun"),
        F.lit("").alias("RunPosition"),
        F.concat(F.lit("http://www."), F.lower("c_mktsegment"), F.lit(".example")).alias("WebsiteURL"),
        F.concat(F.lit("Shop "), _s(k)).alias("DeliveryAddressLine1"),
        F.concat(_s(k), F.lit(" Market Street")).alias("DeliveryAddressLine2"),
        _s(n + 90000).alias("DeliveryPostalCode"),
        F.lit("POINT (0 0)").alias("DeliveryLocation"),
        F.concat(F.lit("PO Box "), _s(k)).alias("PostalAddressLine1"),
        F.col("c_mktsegment").alias("PostalAddressLine2"),
        _s(n + 90000).alias("PostalPostalCode"),
        F.lit("1").alias("LastEditedBy"),
        F.lit(VALID_FROM).alias("ValidFrom"),
        F.lit(SENTINEL).alias("ValidTo"),
        F.lit("2013-01-01T00:00:00.000").alias("ValidFrom_parsed"))
