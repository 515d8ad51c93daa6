"""Small bronze CSV fixtures with the documented edge rows (see FIXTURES.md)."""

import os

from strata.plans.specs import BY_NAME

SENTINEL = "9999-12-31 23:59:59.9999999"
VF = "2013-01-01 00:00:00.0000000"


def csv_text(header, rows, sep=","):
    def cell(v):
        if v is None:
            return ""
        s = str(v)
        return f'"{s}"' if (sep in s or '"' in s) else s
    return "\n".join([sep.join(header)] + [sep.join(cell(v) for v in r) for r in rows]) + "\n"


def table_csv(name, rows_by_col, n):
    """CSV text for silver table ``name``: every bronze column, values from rows_by_col or a default."""
    tdef = BY_NAME[name]
    header = [c.bronze for c in tdef.cols if c.kind != "parsed"]
    rows = []
    for i in range(n):
        row = []
        for c in tdef.cols:
            if c.kind == "parsed":
                continue
            if c.bronze in rows_by_col:
                v = rows_by_col[c.bronze]
                row.append(v[i] if isinstance(v, list) else v)
            elif c.kind == "empty":
                row.append("")
            elif c.kind == "bigint":
                row.append(i + 1)
            elif c.kind == "double":
                row.append(f"{i + 1}.5")
            elif c.kind == "timestamp":
                row.append(SENTINEL if c.silver == "valid_to" else VF)
            else:
                row.append(f"{c.silver}-{i + 1}")
        rows.append(row)
    return csv_text(header, rows)


def write_bronze(root):
    """All 21 bronze tables with the edge rows the gold jobs depend on."""
    t = {}
    t["countries"] = table_csv("countries", {"CountryID": [1, 2], "CountryName": ["Utopia", "Erewhon"],
                                             "IsoAlpha3Code": ["UTO", "ERE"], "Continent": "Europe",
                                             "Region": "West", "Subregion": "North"}, 2)
    t["provinces"] = table_csv("provinces", {"StateProvinceID": [10, 20, 30], "StateProvinceCode": ["AA", "BB", "CC"],
                                             "StateProvinceName": ["Alpha", "Beta", "Gamma"],
                                             "CountryID": [1, 1, 2], "SalesTerritory": ["T1", "T1", "T2"],
                                             "LatestRecordedPopulation": [1000, 2000, 3000],
                                             "Border": ""}, 3)
    # province 30 has no city; province 10 has two
    t["cities"] = table_csv("cities", {"CityID": [100, 101, 200], "CityName": ["Ely", "Ash", "Bow"],
                                       "StateProvinceID": [10, 10, 20],
                                       "LatestRecordedPopulation": ["", "5.0", "7"]}, 3)
    t["delivery_methods"] = table_csv("delivery_methods", {"DeliveryMethodID": [1, 2],
                                                           "DeliveryMethodName": ["Post", "Van"]}, 2)
    t["people"] = table_csv("people", {"PersonID": [1, 2, 3], "FullName": ["Data Conversion Only", "Ann Lee", "Bob Ray"],
                                       "PhoneNumber": ["(000)", "(222)", "(333)"],
                                       "EmailAddress": ["", "ann@x.com", "bob@x.com"],
                                       "FaxNumber": ["", "(229)", ""],
                                       "IsEmployee": [1, 1, 0], "IsSalesperson": [0, 1, 0]}, 3)
    t["customers"] = table_csv("customers", {
        "CustomerID": [1, 2, 3, 4, 5],
        "CustomerName": ["Acme Toys (Head Office)", "Acme (Ely, UK)", "Tail Spin", "Wing Tip", "Lone"],
        "BillToCustomerID": [1, 1, 3, 3, 5],
        "CreditLimit": ["1000.0", "NULL", "3000", "NA", ""],
        "DeliveryMethodID": [1, 2, 1, 3, 1],
        "DeliveryCityID": [100, 200, "", 999, 101],
        "PrimaryContactPersonID": [9, 2, 3, 2, 3],
        "BuyingGroupID": ["NULL", "NA", "", "1", "2"],
        "ValidFrom_parsed": VF}, 5)
    t["colors"] = table_csv("colors", {"ColorID": [1, 2], "ColorName": ["Red", "Blue"]}, 2)
    t["package_types"] = table_csv("package_types", {"PackageTypeID": [1, 2], "PackageTypeName": ["Each", "Carton"]}, 2)
    t["stock_items"] = table_csv("stock_items", {"StockItemID": [1, 2], "StockItemName": ["Mug", "Car"],
                                                 "ColorID": ["1.0", ""], "UnitPackageID": [1, 1],
                                                 "OuterPackageID": [2, 1], "Barcode": ["8302039293929.0", ""],
                                                 "Brand": ["", "Northwind"], "Size": ["", "L"],
                                                 "MarketingComments": ["", "x"]}, 2)
    t["suppliers"] = table_csv("suppliers", {"SupplierID": [1, 2], "SupplierName": ["Fab", "Lit"],
                                             "DeliveryMethodID": ["", "2.0"], "PrimaryContactPersonID": [2, 3],
                                             "DeliveryCityID": [100, 200], "PostalCityID": [200, 999],
                                             "PhoneNumber": ["(111) own", "(444) own"],
                                             "DeliveryAddressLine1": ["", "Unit 1"],
                                             "InternalComments": ["", "vip"]}, 2)
    t["orders"] = table_csv("orders", {"OrderID": [1, 2, 3], "CustomerID": [1, 2, 9],
                                       "SalespersonPersonID": [2, 3, 2], "PickedByPersonID": ["12.0", "", "NA"],
                                       "ContactPersonID": [3, 2, 4], "BackorderOrderID": ["", "", "45.0"],
                                       "OrderDate": ["2013-01-01", "2013-02-02", "2014-03-03"],
                                       "PickingCompletedWhen": ["2013-01-02 11:00:00.0000000", "", ""],
                                       "LastEditedWhen_parsed": "2013-01-01T00:00:00.000"}, 3)
    t["order_lines"] = table_csv("order_lines", {"OrderLineID": [11, 12, 21], "OrderID": [1, 1, 2],
                                                 "PickingCompletedWhen": ["", "2013-01-02", ""]}, 3)
    t["purchase_orders"] = table_csv("purchase_orders", {
        "PurchaseOrderID": [1, 2, 3], "OrderDate": ["2012-03-01", "2013-06-01", "2014-07-01"],
        "ExpectedDeliveryDate": ["2012-03-09", "2013-06-09", "2014-07-09"],
        "ContactPersonID": [2, 3, 9], "IsOrderFinalized": ["0", "1", ""]}, 3)
    t["purchase_order_lines"] = table_csv("purchase_order_lines", {
        "PurchaseOrderLineID": [11, 12, 21], "PurchaseOrderID": [1, 1, 2],
        "LastReceiptDate": ["2012-03-10", "garbage", ""]}, 3)
    for name in BY_NAME:
        t.setdefault(name, table_csv(name, {}, 2))
    for name, text in t.items():
        path = os.path.join(root, BY_NAME[name].bronze_file)
        os.makedirs(root, exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
    return root
