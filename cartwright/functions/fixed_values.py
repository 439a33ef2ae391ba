"""Codes and names the shop's data uses. Results depend on them as they stand."""

# Shipment status codes; any other code, or none, reads as SHIPMENT_DEFAULT.
SHIPMENT_STATUS = {
    1: "Packed",
    2: "Ready_to_ship",
    3: "Canceled",
    4: "Shipped",
    5: "Delivered",
    6: "Failed_Delivery",
    7: "Returned",
    8: "Lost_Delivery",
    9: "Complete",
    10: "Under_Investigation",
    11: "Invoiced",
    12: "Collected",
    13: "Lost_Collected",
    14: "Picked",
    15: "Dispatched",
    16: "Received_at_WH",
    17: "In_Process",
    18: "RECEIVED_AT_SORTING_CENTER",
    19: "FAILED_TO_PICK",
    20: "RETURN_TO_SELLER",
    21: "RETURNED_TO_SELLER",
    22: "FAILED_TO_RETURN",
    23: "DRAWING REQUEST",
    24: "DRAWING RECEIVED",
    25: "BUY MATERIAL",
    26: "DESIGN IMPLEMENTING",
    27: "DONE IMPLEMENTATION",
    28: "PACKING READY FOR SHIP",
    404: "DUPLICATE_ERROR",
}
SHIPMENT_DEFAULT = "pending"
SHIPMENT_DONE = "Complete"

# Product status and visibility codes; any other code reads as UNKNOWN_LABEL.
PRODUCT_STATUS = {1: "Enabled", 2: "Disabled"}
PRODUCT_VISIBILITY = {
    1: "Not Visible Individually",
    2: "Catalog",
    3: "Search",
    4: "Catalog, Search",
}
UNKNOWN_LABEL = "Unknown"

# Payment methods, and the order column that holds each method's fee.
CASH_ON_DELIVERY = "cashondelivery"
FREE_METHOD = "Free"
PAYMENT_FEE_COLUMN = {
    "cashondelivery": "paymentfees",
    "ocean_NBEGate_installments": "nbeinstallmentfees",
    "ocean_MisrGate_installments": "misrinstallmentfees",
    "ocean_QNBGate_installments": "qnbinstallmentfees",
}
PAY_LATER_METHODS = ["aman", "souhoola", "premium", "contact", "forsa", "valu"]

# Rule cart types that carry a shipping subsidy, and the product type priced by its sibling.
COMMERCIAL_RULE = "commercial"
MARKETING_RULE = "marketing"
CONFIGURABLE = "configurable"
APPROVED = "approved"
SHIPPING_ADDRESS = "shipping"

# Category tree: root ids that never show in a breadcrumb, and the separators.
TREE_ROOTS = [1, 2]
LEVEL_SEPARATOR = " > "
ENTRY_SEPARATOR = " | "

# Entity types in the attribute dictionary.
CATEGORY_ENTITY = 3
PRODUCT_ENTITY = 4

# Hours added to stored times: order times, and the time of the last status.
ORDER_SHIFT_HOURS = 2
STATUS_SHIFT_HOURS = 3

# Shipping subsidies count from this moment on; rollups start at this one.
SUBSIDY_SINCE = "2025-04-30 23:59:59"
ROLLUP_SINCE = "2026-01-01 00:00:01"

# Attribute ids of the catalogue, by value type.
VARCHAR_ATTRIBUTES = {73: "product_name", 87: "image", 864: "barcode", 959: "other_language_name"}
DECIMAL_ATTRIBUTES = {77: "price", 81: "cost", 82: "weight"}
OPTION_ATTRIBUTES = {139: "brand", 900: "warranty", 1009: "sold_by"}
DECODED_ATTRIBUTES = {97: "status", 99: "visibility"}
SPECIAL_PRICE_ATTRIBUTES = {"special_price": 78, "special_from": 79, "special_to": 80}
RETURN_REASON_ATTRIBUTE = 1470

# Stock locations: location id -> (quantity column, salable flag column).
STOCK_COLUMNS = {2: ("online_qty", "is_salable_online"), 6: ("smart_qty", "is_salable_smart")}

# Declared columns of the product report.
PRODUCT_REPORT_DDL = (
    "Id INT, SKU VARCHAR(255), Type VARCHAR(50), Barcode VARCHAR(255), `Attribute Set` VARCHAR(255), "
    "Brand VARCHAR(255), Warranty VARCHAR(100), `Product Name` STRING, `Other Language Name` STRING, "
    "`Sold By` VARCHAR(255), Weight VARCHAR(100), Status VARCHAR(100), Visibility VARCHAR(100), "
    "Price DECIMAL(25,2), special_price DECIMAL(25,2), special_from TIMESTAMP_NTZ, special_to TIMESTAMP_NTZ, "
    "cost DECIMAL(15,2), Qty DECIMAL(10,2), `Online Qty` DECIMAL(10,2), `is salable online` BOOLEAN, "
    "`Smart Store Qty` DECIMAL(10,2), `is salable smart` BOOLEAN, created_at TIMESTAMP_NTZ, "
    "updated_at TIMESTAMP_NTZ, Image STRING, `Online Url Key` STRING, `rstore Url key` STRING"
)
