"""Silver table definitions: the 21 bronze CSV extracts and how each becomes typed Parquet.

Each ``TableDef`` is data: bronze file name, silver folder (``domain``),
primary key, and columns (bronze name, silver name, type).  Types:

* ``bigint`` / ``double`` / ``string`` - typed silver column
* ``timestamp``   - text parsed to ``timestamp_ntz`` (bad or out-of-range -> null)
* ``number_text`` - float column rendered as text (``8302039293929.0``)
* ``empty``       - expected to be wholly null: dropped when empty, else kept as text
* ``parsed``      - helper column of year-split files, dropped when present

Null policy: ``expected_nulls`` may hold nulls, each for the reason given; ``required`` must not
(``"*"`` = every column except ``valid_to``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StringType, StructField, StructType


@dataclass(frozen=True)
class Column:
    bronze: str
    silver: str
    kind: str


@dataclass(frozen=True)
class TableDef:
    name: str
    domain: str
    bronze_file: str
    key: str
    columns: tuple
    expected_nulls: dict = field(default_factory=dict)
    required: object = field(default_factory=list)

    #: quoted values hold no line breaks, so that large files can be split (checked on reading)
    splittable: bool = False

    @property
    def cols(self) -> list[Column]:
        return [Column(*c) for c in self.columns]

    @property
    def bronze_schema(self) -> StructType:
        """All-string schema of the bronze CSV (types are applied in silver)."""
        return StructType([StructField(c.bronze, StringType(), True) for c in self.cols])

    @property
    def rename(self) -> dict[str, str]:
        return {c.bronze: c.silver for c in self.cols if c.bronze != c.silver}

    @property
    def silver_key(self) -> str:
        return next(c.silver for c in self.cols if c.bronze == self.key)

    @property
    def required_columns(self) -> list[str]:
        if self.required == "*":
            return [c.silver for c in self.cols if c.kind not in ("empty", "parsed") and c.silver != "valid_to"]
        return list(self.required)

    @property
    def output_path(self) -> str:
        return f"{self.domain}/{self.name}"


# The warehouse's bronze extracts, column names and silver names.
TABLES: list[TableDef] = [
    TableDef(
        name="cities", domain="dimensions", bronze_file="application.cities.csv", key="CityID",
        expected_nulls={"latest_recorded_population": "no census figure for the place", "valid_to": "record without an end date is the current one"},
        required=['city_id', 'city_name', 'state_province_id'],
        columns=(
            ("CityID", "city_id", "bigint"),
            ("CityName", "city_name", "string"),
            ("StateProvinceID", "state_province_id", "bigint"),
            ("Location", "location", "string"),
            ("LatestRecordedPopulation", "latest_recorded_population", "bigint"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("ValidFrom", "valid_from", "timestamp"),
            ("ValidTo", "valid_to", "timestamp"),
        )),
    TableDef(
        name="colors", domain="dimensions", bronze_file="warehouse.colors.csv", key="ColorID",
        expected_nulls={"valid_to": "record without an end date is the current one"},
        required="*",
        columns=(
            ("ColorID", "color_id", "bigint"),
            ("ColorName", "color_name", "string"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("ValidFrom", "valid_from", "timestamp"),
            ("ValidTo", "valid_to", "timestamp"),
        )),
    TableDef(
        name="countries", domain="dimensions", bronze_file="application.countries.csv", key="CountryID",
        expected_nulls={"valid_to": "record without an end date is the current one"},
        required="*",
        columns=(
            ("CountryID", "country_id", "bigint"),
            ("CountryName", "country_name", "string"),
            ("FormalName", "formal_name", "string"),
            ("IsoAlpha3Code", "iso_alpha3_code", "string"),
            ("IsoNumericCode", "iso_numeric_code", "bigint"),
            ("CountryType", "country_type", "string"),
            ("LatestRecordedPopulation", "latest_recorded_population", "bigint"),
            ("Continent", "continent", "string"),
            ("Region", "region", "string"),
            ("Subregion", "subregion", "string"),
            ("Border", "border", "string"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("ValidFrom", "valid_from", "timestamp"),
            ("ValidTo", "valid_to", "timestamp"),
        )),
    TableDef(
        name="customers", domain="sales", bronze_file="sales.customer.csv", key="CustomerID",
        expected_nulls={"buying_group_id": "shop belongs to no buying group", "alternate_contact_person_id": "no second contact named", "credit_limit": "no limit agreed"},
        required=['customer_id', 'customer_name', 'customer_category_id', 'delivery_method_id', 'account_opened_date'],
        columns=(
            ("CustomerID", "customer_id", "bigint"),
            ("CustomerName", "customer_name", "string"),
            ("BillToCustomerID", "bill_to_customer_id", "bigint"),
            ("CustomerCategoryID", "customer_category_id", "bigint"),
            ("BuyingGroupID", "buying_group_id", "bigint"),
            ("PrimaryContactPersonID", "primary_contact_person_id", "bigint"),
            ("AlternateContactPersonID", "alternate_contact_person_id", "bigint"),
            ("DeliveryMethodID", "delivery_method_id", "bigint"),
            ("DeliveryCityID", "delivery_city_id", "bigint"),
            ("PostalCityID", "postal_city_id", "bigint"),
            ("CreditLimit", "credit_limit", "double"),
            ("AccountOpenedDate", "account_opened_date", "timestamp"),
            ("StandardDiscountPercentage", "standard_discount_percentage", "double"),
            ("IsStatementSent", "is_statement_sent", "bigint"),
            ("IsOnCreditHold", "is_on_credit_hold", "bigint"),
            ("PaymentDays", "payment_days", "bigint"),
            ("PhoneNumber", "phone_number", "string"),
            ("FaxNumber", "fax_number", "string"),
            ("DeliveryRun", "DeliveryRun", "empty"),
            ("RunPosition", "RunPosition", "empty"),
            ("WebsiteURL", "website_url", "string"),
            ("DeliveryAddressLine1", "delivery_address_line1", "string"),
            ("DeliveryAddressLine2", "delivery_address_line2", "string"),
            ("DeliveryPostalCode", "delivery_postal_code", "bigint"),
            ("DeliveryLocation", "delivery_location", "string"),
            ("PostalAddressLine1", "postal_address_line1", "string"),
            ("PostalAddressLine2", "postal_address_line2", "string"),
            ("PostalPostalCode", "postal_postal_code", "bigint"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("ValidFrom", "valid_from", "timestamp"),
            ("ValidTo", "valid_to", "timestamp"),
            ("ValidFrom_parsed", "valid_from_parsed", "parsed"),
        )),
    TableDef(
        name="delivery_methods", domain="dimensions", bronze_file="application.deliverymethods.csv", key="DeliveryMethodID",
        expected_nulls={"valid_to": "record without an end date is the current one"},
        required="*",
        columns=(
            ("DeliveryMethodID", "delivery_method_id", "bigint"),
            ("DeliveryMethodName", "delivery_method_name", "string"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("ValidFrom", "valid_from", "timestamp"),
            ("ValidTo", "valid_to", "timestamp"),
        )),
    TableDef(
        name="invoices", domain="sales", bronze_file="sales.invoices.csv", key="InvoiceID",
        expected_nulls={},
        required=['invoice_id', 'customer_id', 'order_id', 'invoice_date', 'salesperson_id'],
        columns=(
            ("InvoiceID", "invoice_id", "bigint"),
            ("CustomerID", "customer_id", "bigint"),
            ("BillToCustomerID", "bill_to_customer_id", "bigint"),
            ("OrderID", "order_id", "bigint"),
            ("DeliveryMethodID", "delivery_method_id", "bigint"),
            ("ContactPersonID", "contact_person_id", "bigint"),
            ("AccountsPersonID", "accounts_person_id", "bigint"),
            ("SalespersonPersonID", "salesperson_id", "bigint"),
            ("PackedByPersonID", "packed_by_id", "bigint"),
            ("InvoiceDate", "invoice_date", "timestamp"),
            ("CustomerPurchaseOrderNumber", "customer_po_number", "bigint"),
            ("IsCreditNote", "is_credit_note", "bigint"),
            ("CreditNoteReason", "CreditNoteReason", "empty"),
            ("Comments", "Comments", "empty"),
            ("DeliveryInstructions", "delivery_instructions", "string"),
            ("InternalComments", "InternalComments", "empty"),
            ("TotalDryItems", "total_dry_items", "bigint"),
            ("TotalChillerItems", "total_chiller_items", "bigint"),
            ("DeliveryRun", "DeliveryRun", "empty"),
            ("RunPosition", "RunPosition", "empty"),
            ("ReturnedDeliveryData", "returned_delivery_data", "string"),
            ("ConfirmedDeliveryTime", "confirmed_delivery_time", "timestamp"),
            ("ConfirmedReceivedBy", "confirmed_received_by", "string"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("LastEditedWhen", "last_edited_when", "timestamp"),
            ("LastEditedWhen_parsed", "last_edited_when_parsed", "parsed"),
        )),
    TableDef(
        name="invoice_lines", domain="sales", bronze_file="sales.incvoiceslines.csv", key="InvoiceLineID",
        expected_nulls={},
        required=['invoice_line_id', 'invoice_id', 'stock_item_id', 'quantity', 'unit_price', 'extended_price'],
        columns=(
            ("InvoiceLineID", "invoice_line_id", "bigint"),
            ("InvoiceID", "invoice_id", "bigint"),
            ("StockItemID", "stock_item_id", "bigint"),
            ("Description", "description", "string"),
            ("PackageTypeID", "package_type_id", "bigint"),
            ("Quantity", "quantity", "bigint"),
            ("UnitPrice", "unit_price", "double"),
            ("TaxRate", "tax_rate", "double"),
            ("TaxAmount", "tax_amount", "double"),
            ("LineProfit", "line_profit", "double"),
            ("ExtendedPrice", "extended_price", "double"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("LastEditedWhen", "last_edited_when", "timestamp"),
            ("LastEditedWhen_parsed", "last_edited_when_parsed", "parsed"),
        )),
    TableDef(
        name="package_types", domain="dimensions", bronze_file="warehouse.packagetypes.csv", key="PackageTypeID",
        expected_nulls={"valid_to": "record without an end date is the current one"},
        required="*",
        columns=(
            ("PackageTypeID", "package_type_id", "bigint"),
            ("PackageTypeName", "package_type_name", "string"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("ValidFrom", "valid_from", "timestamp"),
            ("ValidTo", "valid_to", "timestamp"),
        )),
    TableDef(
        name="payment_methods", domain="dimensions", bronze_file="application.paymentmethod.csv", key="PaymentMethodID",
        expected_nulls={"valid_to": "record without an end date is the current one"},
        required="*",
        columns=(
            ("PaymentMethodID", "payment_method_id", "bigint"),
            ("PaymentMethodName", "payment_method_name", "string"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("ValidFrom", "valid_from", "timestamp"),
            ("ValidTo", "valid_to", "timestamp"),
        )),
    TableDef(
        name="people", domain="dimensions", bronze_file="application.people.csv", key="PersonID",
        expected_nulls={"valid_to": "record without an end date is the current one"},
        required=['person_id', 'full_name', 'is_employee', 'is_salesperson'],
        columns=(
            ("PersonID", "person_id", "bigint"),
            ("FullName", "full_name", "string"),
            ("PreferredName", "preferred_name", "string"),
            ("SearchName", "search_name", "string"),
            ("IsPermittedToLogon", "is_permitted_to_logon", "bigint"),
            ("LogonName", "logon_name", "string"),
            ("IsExternalLogonProvider", "is_external_logon_provider", "bigint"),
            ("HashedPassword", "HashedPassword", "empty"),
            ("IsSystemUser", "is_system_user", "bigint"),
            ("IsEmployee", "is_employee", "bigint"),
            ("IsSalesperson", "is_salesperson", "bigint"),
            ("UserPreferences", "UserPreferences", "empty"),
            ("PhoneNumber", "phone_number", "string"),
            ("FaxNumber", "fax_number", "string"),
            ("EmailAddress", "email_address", "string"),
            ("Photo", "Photo", "empty"),
            ("CustomFields", "CustomFields", "empty"),
            ("OtherLanguages", "OtherLanguages", "empty"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("ValidFrom", "valid_from", "timestamp"),
            ("ValidTo", "valid_to", "timestamp"),
            ("ValidFrom_parsed", "valid_from_parsed", "parsed"),
        )),
    TableDef(
        name="provinces", domain="dimensions", bronze_file="application.province.csv", key="StateProvinceID",
        expected_nulls={"border": "outline not recorded", "valid_to": "record without an end date is the current one"},
        required=['state_province_id', 'state_province_name', 'country_id'],
        columns=(
            ("StateProvinceID", "state_province_id", "bigint"),
            ("StateProvinceCode", "state_province_code", "string"),
            ("StateProvinceName", "state_province_name", "string"),
            ("CountryID", "country_id", "bigint"),
            ("SalesTerritory", "sales_territory", "string"),
            ("Border", "border", "string"),
            ("LatestRecordedPopulation", "latest_recorded_population", "bigint"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("ValidFrom", "valid_from", "timestamp"),
            ("ValidTo", "valid_to", "timestamp"),
        )),
    TableDef(
        name="purchase_orders", domain="purchasing", bronze_file="purchase.order.csv", key="PurchaseOrderID",
        expected_nulls={},
        required=['purchase_order_id', 'supplier_id', 'order_date', 'delivery_method_id'],
        columns=(
            ("PurchaseOrderID", "purchase_order_id", "bigint"),
            ("SupplierID", "supplier_id", "bigint"),
            ("OrderDate", "order_date", "timestamp"),
            ("DeliveryMethodID", "delivery_method_id", "bigint"),
            ("ContactPersonID", "contact_person_id", "bigint"),
            ("ExpectedDeliveryDate", "expected_delivery_date", "timestamp"),
            ("SupplierReference", "supplier_reference", "string"),
            ("IsOrderFinalized", "is_order_finalized", "bigint"),
            ("Comments", "Comments", "empty"),
            ("InternalComments", "InternalComments", "empty"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("LastEditedWhen", "last_edited_when", "timestamp"),
            ("LastEditedWhen_parsed", "last_edited_when_parsed", "parsed"),
        )),
    TableDef(
        name="purchase_order_lines", domain="purchasing", bronze_file="purchase.orderline.csv", key="PurchaseOrderLineID",
        expected_nulls={},
        required=['purchase_order_line_id', 'purchase_order_id', 'stock_item_id', 'ordered_outers', 'expected_unit_price_per_outer'],
        columns=(
            ("PurchaseOrderLineID", "purchase_order_line_id", "bigint"),
            ("PurchaseOrderID", "purchase_order_id", "bigint"),
            ("StockItemID", "stock_item_id", "bigint"),
            ("OrderedOuters", "ordered_outers", "bigint"),
            ("Description", "description", "string"),
            ("ReceivedOuters", "received_outers", "bigint"),
            ("PackageTypeID", "package_type_id", "bigint"),
            ("ExpectedUnitPricePerOuter", "expected_unit_price_per_outer", "double"),
            ("LastReceiptDate", "last_receipt_date", "timestamp"),
            ("IsOrderLineFinalized", "is_order_line_finalized", "bigint"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("LastEditedWhen", "last_edited_when", "timestamp"),
            ("LastEditedWhen_parsed", "last_edited_when_parsed", "parsed"),
        )),
    TableDef(
        name="orders", domain="sales", bronze_file="sales.order.csv", key="OrderID",
        expected_nulls={"picked_by_id": "nobody has picked the order yet", "backorder_order_id": "no backorder followed", "picking_completed_when": "picking not finished"},
        required=['order_id', 'customer_id', 'order_date', 'salesperson_id'],
        columns=(
            ("OrderID", "order_id", "bigint"),
            ("CustomerID", "customer_id", "bigint"),
            ("SalespersonPersonID", "salesperson_id", "bigint"),
            ("PickedByPersonID", "picked_by_id", "bigint"),
            ("ContactPersonID", "contact_person_id", "bigint"),
            ("BackorderOrderID", "backorder_order_id", "bigint"),
            ("OrderDate", "order_date", "timestamp"),
            ("ExpectedDeliveryDate", "expected_delivery_date", "timestamp"),
            ("CustomerPurchaseOrderNumber", "customer_po_number", "bigint"),
            ("IsUndersupplyBackordered", "is_undersupply_backordered", "bigint"),
            ("Comments", "Comments", "empty"),
            ("DeliveryInstructions", "DeliveryInstructions", "empty"),
            ("InternalComments", "InternalComments", "empty"),
            ("PickingCompletedWhen", "picking_completed_when", "timestamp"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("LastEditedWhen", "last_edited_when", "timestamp"),
            ("LastEditedWhen_parsed", "last_edited_when_parsed", "parsed"),
        )),
    TableDef(
        name="order_lines", domain="sales", bronze_file="sales.orderline.csv", key="OrderLineID",
        expected_nulls={"picking_completed_when": "picking not finished"},
        required=['order_line_id', 'order_id', 'stock_item_id', 'quantity', 'unit_price'],
        columns=(
            ("OrderLineID", "order_line_id", "bigint"),
            ("OrderID", "order_id", "bigint"),
            ("StockItemID", "stock_item_id", "bigint"),
            ("Description", "description", "string"),
            ("PackageTypeID", "package_type_id", "bigint"),
            ("Quantity", "quantity", "bigint"),
            ("UnitPrice", "unit_price", "double"),
            ("TaxRate", "tax_rate", "double"),
            ("PickedQuantity", "picked_quantity", "bigint"),
            ("PickingCompletedWhen", "picking_completed_when", "timestamp"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("LastEditedWhen", "last_edited_when", "timestamp"),
            ("LastEditedWhen_parsed", "last_edited_when_parsed", "parsed"),
        )),
    TableDef(
        name="stock_groups", domain="dimensions", bronze_file="warehouse.stockgroups.csv", key="StockGroupID",
        expected_nulls={"valid_to": "record without an end date is the current one"},
        required="*",
        columns=(
            ("StockGroupID", "stock_group_id", "bigint"),
            ("StockGroupName", "stock_group_name", "string"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("ValidFrom", "valid_from", "timestamp"),
            ("ValidTo", "valid_to", "timestamp"),
        )),
    TableDef(
        name="stock_item_holdings", domain="dimensions", bronze_file="warehouse.stockitemholdings.csv", key="StockItemID",
        expected_nulls={},
        required=['stock_item_id', 'quantity_on_hand', 'reorder_level', 'target_stock_level', 'last_cost_price'],
        columns=(
            ("StockItemID", "stock_item_id", "bigint"),
            ("QuantityOnHand", "quantity_on_hand", "bigint"),
            ("BinLocation", "bin_location", "string"),
            ("LastStocktakeQuantity", "last_stocktake_quantity", "bigint"),
            ("LastCostPrice", "last_cost_price", "double"),
            ("ReorderLevel", "reorder_level", "bigint"),
            ("TargetStockLevel", "target_stock_level", "bigint"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("LastEditedWhen", "last_edited_when", "timestamp"),
        )),
    TableDef(
        name="stock_items", domain="dimensions", bronze_file="warehouse.stockitems.csv", key="StockItemID",
        expected_nulls={"color_id": "item has no colour", "brand": "unbranded item", "size": "item comes in one size", "barcode": "item carries no barcode", "marketing_comments": "no marketing text written", "valid_to": "record without an end date is the current one"},
        required=['stock_item_id', 'stock_item_name', 'supplier_id', 'unit_price', 'tax_rate'],
        columns=(
            ("StockItemID", "stock_item_id", "bigint"),
            ("StockItemName", "stock_item_name", "string"),
            ("SupplierID", "supplier_id", "bigint"),
            ("ColorID", "color_id", "bigint"),
            ("UnitPackageID", "unit_package_id", "bigint"),
            ("OuterPackageID", "outer_package_id", "bigint"),
            ("Brand", "brand", "string"),
            ("Size", "size", "string"),
            ("LeadTimeDays", "lead_time_days", "bigint"),
            ("QuantityPerOuter", "quantity_per_outer", "bigint"),
            ("IsChillerStock", "is_chiller_stock", "bigint"),
            ("Barcode", "barcode", "number_text"),
            ("TaxRate", "tax_rate", "double"),
            ("UnitPrice", "unit_price", "double"),
            ("RecommendedRetailPrice", "recommended_retail_price", "double"),
            ("TypicalWeightPerUnit", "typical_weight_per_unit", "double"),
            ("MarketingComments", "marketing_comments", "string"),
            ("InternalComments", "InternalComments", "empty"),
            ("Photo", "Photo", "empty"),
            ("CustomFields", "custom_fields", "string"),
            ("Tags", "tags", "string"),
            ("SearchDetails", "search_details", "string"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("ValidFrom", "valid_from", "timestamp"),
            ("ValidTo", "valid_to", "timestamp"),
        )),
    TableDef(
        name="suppliers", domain="purchasing", bronze_file="purchasing.suppliers.csv", key="SupplierID",
        expected_nulls={"delivery_method_id": "supplier has no fixed delivery method", "delivery_address_line1": "address has no suite or unit", "internal_comments": "no internal remarks"},
        required=['supplier_id', 'supplier_name', 'supplier_category_id'],
        columns=(
            ("SupplierID", "supplier_id", "bigint"),
            ("SupplierName", "supplier_name", "string"),
            ("SupplierCategoryID", "supplier_category_id", "bigint"),
            ("PrimaryContactPersonID", "primary_contact_person_id", "bigint"),
            ("AlternateContactPersonID", "alternate_contact_person_id", "bigint"),
            ("DeliveryMethodID", "delivery_method_id", "bigint"),
            ("DeliveryCityID", "delivery_city_id", "bigint"),
            ("PostalCityID", "postal_city_id", "bigint"),
            ("SupplierReference", "supplier_reference", "string"),
            ("BankAccountName", "bank_account_name", "string"),
            ("BankAccountBranch", "bank_account_branch", "string"),
            ("BankAccountCode", "bank_account_code", "bigint"),
            ("BankAccountNumber", "bank_account_number", "bigint"),
            ("BankInternationalCode", "bank_international_code", "bigint"),
            ("PaymentDays", "payment_days", "bigint"),
            ("InternalComments", "internal_comments", "string"),
            ("PhoneNumber", "phone_number", "string"),
            ("FaxNumber", "fax_number", "string"),
            ("WebsiteURL", "website_url", "string"),
            ("DeliveryAddressLine1", "delivery_address_line1", "string"),
            ("DeliveryAddressLine2", "delivery_address_line2", "string"),
            ("DeliveryPostalCode", "delivery_postal_code", "bigint"),
            ("DeliveryLocation", "delivery_location", "string"),
            ("PostalAddressLine1", "postal_address_line1", "string"),
            ("PostalAddressLine2", "postal_address_line2", "string"),
            ("PostalPostalCode", "postal_postal_code", "bigint"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("ValidFrom", "valid_from", "timestamp"),
            ("ValidTo", "valid_to", "timestamp"),
        )),
    TableDef(
        name="supplier_transactions", domain="purchasing", bronze_file="purchasing.supplierstransactions.csv", key="SupplierTransactionID",
        expected_nulls={"purchase_order_id": "payment not tied to a purchase order", "supplier_invoice_number": "payments carry no invoice number", "finalization_date": "transaction still open"},
        required=['supplier_transaction_id', 'supplier_id', 'transaction_date', 'transaction_amount'],
        columns=(
            ("SupplierTransactionID", "supplier_transaction_id", "bigint"),
            ("SupplierID", "supplier_id", "bigint"),
            ("TransactionTypeID", "transaction_type_id", "bigint"),
            ("PurchaseOrderID", "purchase_order_id", "bigint"),
            ("PaymentMethodID", "payment_method_id", "bigint"),
            ("SupplierInvoiceNumber", "supplier_invoice_number", "bigint"),
            ("TransactionDate", "transaction_date", "timestamp"),
            ("AmountExcludingTax", "amount_excluding_tax", "double"),
            ("TaxAmount", "tax_amount", "double"),
            ("TransactionAmount", "transaction_amount", "double"),
            ("OutstandingBalance", "outstanding_balance", "double"),
            ("FinalizationDate", "finalization_date", "timestamp"),
            ("IsFinalized", "is_finalized", "bigint"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("LastEditedWhen", "last_edited_when", "timestamp"),
        )),
    TableDef(
        name="transaction_types", domain="dimensions", bronze_file="application.transactiontypes.csv", key="TransactionTypeID",
        expected_nulls={"valid_to": "record without an end date is the current one"},
        required="*",
        columns=(
            ("TransactionTypeID", "transaction_type_id", "bigint"),
            ("TransactionTypeName", "transaction_type_name", "string"),
            ("LastEditedBy", "last_edited_by", "bigint"),
            ("ValidFrom", "valid_from", "timestamp"),
            ("ValidTo", "valid_to", "timestamp"),
        )),
]

BY_NAME: dict[str, TableDef] = {t.name: t for t in TABLES}
BY_FILE: dict[str, TableDef] = {t.bronze_file: t for t in TABLES}

# Date column of each table the ingest splits by year (keyed by raw file stem).
SPLIT_DATE_COLUMNS = {
    "purchase.order": "LastEditedWhen",
    "purchase.orderline": "LastEditedWhen",
    "sales.incvoiceslines": "LastEditedWhen",
    "sales.invoices": "LastEditedWhen",
    "sales.order": "LastEditedWhen",
    "sales.orderline": "LastEditedWhen",
    "application.people": "ValidFrom",
    "sales.customer": "ValidFrom",
}
