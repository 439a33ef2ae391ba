"""A small shop with a known answer for every rule."""

from __future__ import annotations

TS = "TIMESTAMP_NTZ"
M = "DECIMAL(20,4)"

ORDERS = (
    f"entity_id BIGINT, increment_id STRING, created_at {TS}, updated_at {TS}, customer_id BIGINT, "
    "customer_firstname STRING, customer_lastname STRING, customer_email STRING, status STRING, store_id INT, "
    f"coupon_code STRING, base_currency_code STRING, base_discount_amount {M}, base_shipping_amount {M}, "
    f"base_tax_amount {M}, base_grand_total {M}, base_customer_balance_amount {M}, paymentfees {M}, "
    f"nbeinstallmentfees {M}, misrinstallmentfees {M}, qnbinstallmentfees {M}, amount_to_collect {M}, "
    "checkout_from STRING"
)
ITEMS = (
    "item_id BIGINT, order_id BIGINT, parent_item_id BIGINT, product_id BIGINT, sku STRING, name STRING, "
    "product_type STRING, marketplace_seller STRING, main_category STRING, sub_category STRING, "
    "applied_rule_ids STRING, qty_ordered DECIMAL(12,4), qty_refunded DECIMAL(12,4), qty_shipped DECIMAL(12,4), "
    f"base_price {M}, base_cost {M}, base_row_total {M}, base_discount_amount {M}, marketing_discount {M}, "
    f"commercial_discount {M}, base_tax_amount {M}, original_shipping_amount {M}, paid_shipping_amount {M}, "
    f"marketplace_commission DECIMAL(12,4), created_at {TS}"
)
PAYMENTS = "parent_id BIGINT, method STRING"
ADDRESSES = "parent_id BIGINT, address_type STRING, city STRING, region STRING"
HISTORY = f"parent_id BIGINT, status STRING, created_at {TS}"
SHIPMENT_ITEMS = "order_item_id BIGINT, parent_id BIGINT"
SHIPMENTS = f"entity_id BIGINT, increment_id STRING, shipment_status INT, created_at {TS}"
TRACKS = "entity_id BIGINT, parent_id BIGINT, title STRING"
RULES = f"rule_id INT, name STRING, rule_cart_type STRING, discount_amount {M}"
COUPONS = "rule_id INT, code STRING"
BALANCES = f"customer_id BIGINT, amount {M}"
CUSTOMERS = "entity_id BIGINT, firstname STRING, lastname STRING, email STRING, created_in STRING"
RETURN_ITEMS = "entity_id BIGINT, rma_entity_id BIGINT, order_item_id BIGINT, qty_approved DECIMAL(12,4), status STRING"
RETURN_HEADS = f"entity_id BIGINT, date_requested {TS}, status STRING"
RETURN_CODES = "entity_id BIGINT, attribute_id INT, value INT"
OPTIONS = "option_id INT, store_id INT, value STRING"
ATTRIBUTES = "attribute_id INT, attribute_code STRING, entity_type_id INT"
PRODUCTS = (f"entity_id BIGINT, row_id BIGINT, sku STRING, type_id STRING, attribute_set_id INT, created_at {TS}, "
            f"updated_at {TS}")
CODES = "row_id BIGINT, attribute_id INT, store_id INT, value INT"
TEXTS = "row_id BIGINT, attribute_id INT, store_id INT, value STRING"
DECIMALS = "row_id BIGINT, attribute_id INT, store_id INT, value DECIMAL(20,6)"
DATETIMES = f"row_id BIGINT, attribute_id INT, store_id INT, value {TS}"
SETS = "attribute_set_id INT, attribute_set_name STRING"
STOCK = "sku STRING, quantity DECIMAL(10,4), is_salable BOOLEAN"
REWRITES = "entity_id BIGINT, entity_type STRING, request_path STRING"
NODES = "entity_id BIGINT, row_id BIGINT, parent_id BIGINT, path STRING"
LINKS = "product_id BIGINT, category_id BIGINT"


def order(entity_id, **over):
    row = dict(
        entity_id=entity_id, increment_id=f"O{entity_id}", created_at="2026-01-05 23:30:00",
        updated_at="2026-01-06 10:00:00", customer_id=entity_id * 10, customer_firstname="Ann",
        customer_lastname="Lee", customer_email="a@example.com", status="complete", store_id=1, coupon_code=None,
        base_currency_code="EUR", base_discount_amount=1, base_shipping_amount=2, base_tax_amount=3,
        base_grand_total=100, base_customer_balance_amount=5, paymentfees=11, nbeinstallmentfees=12,
        misrinstallmentfees=13, qnbinstallmentfees=14, amount_to_collect=15, checkout_from="web",
    )
    return tuple((row | over).values())


def item(item_id, order_id, **over):
    row = dict(
        item_id=item_id, order_id=order_id, parent_item_id=None, product_id=item_id * 100, sku=f"S{item_id}",
        name=f"N{item_id}", product_type="simple", marketplace_seller=None, main_category="Home",
        sub_category="Lamps", applied_rule_ids=None, qty_ordered=2, qty_refunded=0, qty_shipped=2, base_price=10,
        base_cost=6, base_row_total=20, base_discount_amount=1, marketing_discount=1, commercial_discount=2,
        base_tax_amount=1, original_shipping_amount=30, paid_shipping_amount=0, marketplace_commission=12.5,
        created_at="2025-06-01 00:00:00",
    )
    return tuple((row | over).values())


# The tables of the wide item table; item 1 matches several rows on every side.
WIDE = {
    "orders": (ORDERS, [order(1, coupon_code="Gift"), order(2, customer_lastname=None), order(3)]),
    "items": (ITEMS, [
        item(1, 1, applied_rule_ids="1,2", qty_refunded=1, product_id=100, sku="A", product_type="configurable"),
        item(2, 1, product_id=101, sku="A", base_cost=4),
        item(3, 1, product_id=102, sku="A", product_type="virtual", base_cost=5, marketplace_seller="Shop X"),
        item(4, 1, parent_item_id=1),
        item(5, 2, marketplace_seller="Shop Y", commercial_discount=None),
        item(6, 99),
    ]),
    "payments": (PAYMENTS, [(1, "valu"), (1, "cashondelivery"), (2, "Free")]),
    "addresses": (ADDRESSES, [(1, "shipping", "Zed", "R1"), (1, "Shipping", "Abe", "R2"), (1, "billing", "Aaa", "R0")]),
    "status_history": (HISTORY, [
        (1, "pending", "2026-01-01 00:00:00"), (1, "complete", "2026-01-03 00:00:00"),
        (1, "pending", "2026-01-02 00:00:00"), (2, None, "2026-01-02 00:00:00"),
    ]),
    "shipment_items": (SHIPMENT_ITEMS, [(1, 10), (1, 11), (2, 10), (5, 77)]),
    "shipments": (SHIPMENTS, [(10, "H10", 4, "2026-01-02 00:00:00"), (11, "H11", 9, "2026-01-03 00:00:00")]),
    "shipment_tracks": (TRACKS, [(1, 11, "Old courier"), (2, 11, "New courier"), (3, 10, "Other")]),
    "rules": (RULES, [(1, "R1", "commercial", 0), (2, "R2", "Marketing", 0), (3, "R3", "other", 5)]),
    "coupons": (COUPONS, [(2, "GIFT"), (1, "X"), (1, "Y")]),
    "return_items": (RETURN_ITEMS, [
        (1, 1, 1, 1, "approved"), (2, 2, 1, 2, "Approved"), (3, 2, 2, 1, "pending"), (4, 9, 5, 3, "approved"),
        (5, 1, 6, 1, "approved"),
    ]),
    "return_heads": (RETURN_HEADS, [(1, "2026-02-01 00:00:00", "open"), (2, "2026-02-02 00:00:00", "closed")]),
    "return_codes": (RETURN_CODES, [(2, 1470, 50), (1, 1470, 51), (4, 1471, 50)]),
    "options": (OPTIONS, [(50, 0, "Broken"), (50, 1, "Kaputt"), (60, 0, "Brand A"), (61, 0, "Red"), (61, 1, "Rot")]),
    "attributes": (ATTRIBUTES, [(139, "brand", 4), (93, "color", 4), (45, "name", 3), (46, "name", 4)]),
    "products": (PRODUCTS, [
        (100, 1000, "A", "configurable", 4, "2024-01-01 00:00:00", "2024-01-01 00:00:00"),
        (100, 1001, "A", "configurable", 4, "2024-01-01 00:00:00", "2024-01-02 00:00:00"),
    ]),
    "product_codes": (CODES, [(1001, 139, 0, 60), (1001, 93, 0, 61), (1001, 139, 1, 50), (1000, 139, 0, 50)]),
    "category_nodes": (NODES, [
        (1, 1, 0, "1"), (2, 2, 1, "1/2"), (3, 3, 2, "1/2/3"), (4, 4, 3, "1/2/3/4"), (5, 5, 4, "1/2/3/4/5"),
        (20, 20, 2, "1/2/20"), (21, 21, 20, "1/2/20/21"), (30, 30, 2, "1/2/30"), (31, 31, 30, "1/2/30/31"),
        (40, 40, 2, "1/2/40"),
    ]),
    "category_names": (TEXTS, [
        (1, 45, 0, "Root"), (2, 45, 0, "Default"), (3, 45, 0, "Home"), (3, 45, 1, "House"), (4, 45, 0, "Lamps"),
        (5, 45, 0, "Desk"), (20, 45, 0, "Offers"), (21, 45, 0, "Hot"), (30, 45, 0, "Installment"), (31, 45, 0, "Ten"),
        (4, 46, 0, "not a name"),
    ]),
    "category_links": (LINKS, [
        (100, 5), (100, 3), (100, 21), (101, 21), (101, 31), (102, 40), (103, 2), (500, 3), (104, 999),
    ]),
}


def wide_tables(frame, shuffle=None):
    out = {}
    for name, (ddl, data) in WIDE.items():
        data = list(data)
        if shuffle is not None:
            shuffle.shuffle(data)
        out[name] = frame(ddl, data)
    return out
