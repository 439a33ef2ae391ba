"""Shop-shaped tables derived from the supplied ones.

Each table is one or more SELECTs in expressions that Spark and DuckDB both read, so the same text feeds the
Spark frame and the check query. Only the shape is shared: the operators and their checks are written apart.
``{ts}`` stands for the zone-less timestamp type of the engine.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

# A line has no key of its own in the supplied data.
LINE_ID = "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey"
MONEY = "DECIMAL(20,4)"


# Lazy frames by session, folder and table: schema inference and analysis happen once, not for every use.
_FRAMES: dict[tuple, DataFrame] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, id(spark), sf_dir, name)
    if key not in _FRAMES:
        _FRAMES[key] = build()
    return _FRAMES[key]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A supplied table."""
    return _once(spark, sf_dir, table, lambda: spark.read.parquet(f"{sf_dir}/{table}.parquet"))


Part = tuple[str, dict[str, str], str]

SHOP: dict[str, list[Part]] = {
    "s_orders": [("orders", {
        "entity_id": "o_orderkey",
        "increment_id": "'ORD-' || o_orderkey",
        "created_at": "o_orderdate",
        "updated_at": "o_orderdate + INTERVAL 1 DAY",
        "customer_id": "o_custkey",
        "customer_firstname": "o_orderpriority",
        "customer_lastname": "NULLIF(o_orderstatus, 'P')",
        "customer_email": "'c' || o_custkey || '@example.com'",
        "status": "o_orderstatus",
        "store_id": "CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END",
        "coupon_code": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'C-' || o_custkey END",
        "base_currency_code": "'EUR'",
        "base_discount_amount": f"CAST(o_custkey AS {MONEY})",
        "base_shipping_amount": f"NULLIF(CAST(o_custkey AS {MONEY}), 7)",
        "base_tax_amount": f"CAST(o_totalprice AS {MONEY})",
        "base_grand_total": f"CASE WHEN o_orderstatus <> 'O' THEN CAST(o_totalprice AS {MONEY}) END",
        "base_customer_balance_amount": f"CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS {MONEY}) END",
        "paymentfees": f"CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS {MONEY}) END",
        "nbeinstallmentfees": f"CAST(o_totalprice AS {MONEY})",
        "misrinstallmentfees": f"CAST(o_custkey AS {MONEY})",
        "qnbinstallmentfees": f"CAST(o_orderkey AS {MONEY})",
        "amount_to_collect": f"CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS {MONEY}) END",
        "checkout_from": "o_orderpriority",
    }, "")],
    "s_payments": [("orders", {
        "parent_id": "o_orderkey",
        "method": "CASE o_orderpriority WHEN '1-URGENT' THEN 'CashOnDelivery' WHEN '2-HIGH' THEN 'Free' "
                  "WHEN '3-MEDIUM' THEN 'valu' WHEN '4-NOT SPECIFIED' THEN 'ocean_NBEGate_installments' END",
    }, "o_orderstatus <> 'P' OR o_orderpriority <> '2-HIGH'"), ("lineitem", {
        "parent_id": "l_orderkey",
        "method": "CASE l_returnflag WHEN 'A' THEN 'free' ELSE 'souhoola' END",
    }, "l_quantity = 50")],
    "s_addresses": [("orders", {
        "parent_id": "o_orderkey",
        "address_type": "CASE o_orderstatus WHEN 'F' THEN 'billing' ELSE 'shipping' END",
        "city": "NULLIF(o_orderpriority, '5-LOW')",
        "region": "CAST(o_custkey AS STRING)",
    }, ""), ("lineitem", {
        "parent_id": "l_orderkey",
        "address_type": "'shipping'",
        "city": "'A' || l_linestatus",
        "region": "l_returnflag",
    }, "l_linenumber = 7")],
    "s_history": [("lineitem", {
        "parent_id": "l_orderkey",
        "status": "NULLIF(l_returnflag || l_linestatus, 'AF')",
        "created_at": "l_shipdate",
    }, "")],
    "s_items": [("lineitem", {
        "item_id": LINE_ID,
        "order_id": "l_orderkey",
        "parent_item_id": "CASE WHEN l_linenumber = 6 THEN l_orderkey END",
        "product_id": "l_partkey",
        "sku": "'SKU-' || l_linenumber",
        "name": "'Part ' || l_partkey",
        "product_type": "CASE l_returnflag WHEN 'R' THEN 'configurable' WHEN 'A' THEN 'simple' ELSE 'virtual' END",
        "marketplace_seller": "CASE WHEN l_linestatus = 'F' THEN 'Seller ' || l_suppkey END",
        "main_category": "l_returnflag",
        "sub_category": "NULLIF(l_linestatus, 'F')",
        "qty_ordered": "CAST(l_quantity AS DECIMAL(12,4))",
        "qty_refunded": "CASE l_returnflag WHEN 'R' THEN CAST(l_quantity AS DECIMAL(12,4)) "
                        "WHEN 'A' THEN CAST(0 AS DECIMAL(12,4)) END",
        "qty_shipped": "CAST(l_quantity AS DECIMAL(12,4))",
        "base_price": f"CASE WHEN l_discount > 0.085 THEN CAST(0 AS {MONEY}) ELSE CAST(l_extendedprice AS {MONEY}) END",
        "base_cost": f"CAST(l_tax AS {MONEY})",
        "base_row_total": f"CAST(l_extendedprice AS {MONEY})",
        "base_discount_amount": f"CAST(l_discount AS {MONEY})",
        "marketing_discount": f"CAST(l_discount AS {MONEY})",
        "commercial_discount": f"NULLIF(CAST(l_tax AS {MONEY}), 0)",
        "marketplace_commission": "CAST(l_discount * 100 AS DECIMAL(12,4))",
        "base_tax_amount": f"CAST(l_tax AS {MONEY})",
        "original_shipping_amount": f"CAST(l_quantity AS {MONEY})",
        "paid_shipping_amount": f"CASE l_returnflag WHEN 'R' THEN CAST(0 AS {MONEY}) "
                                f"WHEN 'A' THEN CAST(l_quantity AS {MONEY}) END",
        "applied_rule_ids": "CASE WHEN l_linenumber = 5 THEN '' WHEN l_linenumber = 4 THEN l_suppkey || ',,x' "
                            "WHEN l_linenumber < 4 THEN l_partkey || ', ' || l_suppkey END",
        "created_at": "l_shipdate",
    }, "")],
    "s_shipment_items": [
        ("lineitem", {"order_item_id": LINE_ID, "parent_id": "l_orderkey"}, ""),
        ("lineitem", {"order_item_id": LINE_ID, "parent_id": "l_suppkey"}, "l_returnflag = 'R'"),
    ],
    "s_shipments": [("orders", {
        "entity_id": "o_orderkey",
        "increment_id": "'SHP-' || o_orderkey",
        "shipment_status": "CASE o_orderpriority WHEN '1-URGENT' THEN 9 WHEN '2-HIGH' THEN 404 "
                           "WHEN '3-MEDIUM' THEN 5 WHEN '4-NOT SPECIFIED' THEN 99 END",
        "created_at": "o_orderdate",
    }, "o_orderstatus <> 'P'")],
    "s_tracks": [
        ("orders", {"entity_id": "o_custkey", "parent_id": "o_orderkey", "title": "o_orderpriority"}, ""),
        ("lineitem", {"entity_id": "l_partkey", "parent_id": "l_orderkey", "title": "'courier ' || l_partkey"},
         "l_linenumber = 1"),
    ],
    "s_rules": [("part", {
        "rule_id": "CAST(p_partkey AS INT)",
        "name": "p_name",
        "rule_cart_type": "CASE p_type WHEN 'PROMO' THEN 'Marketing' WHEN 'ECONOMY' THEN 'commercial' "
                          "WHEN 'SMALL' THEN NULL ELSE 'other' END",
        "discount_amount": f"CASE WHEN p_size > 10 THEN CAST(0 AS {MONEY}) ELSE CAST(p_size AS {MONEY}) END",
    }, "")],
    "s_coupons": [
        ("part", {"rule_id": "CAST(p_partkey AS INT)", "code": "'c-' || p_partkey"}, ""),
        ("part", {"rule_id": "CAST(p_partkey AS INT)", "code": "'c-' || p_size"}, "p_type = 'PROMO'"),
    ],
    "s_balances": [("customer", {"customer_id": "c_custkey", "amount": f"CAST(c_acctbal AS {MONEY})"}, "")],
    "s_customers": [("orders", {
        "entity_id": "o_orderkey",
        "firstname": "o_orderpriority",
        "lastname": "NULLIF(o_orderstatus, 'P')",
        "email": "'c' || o_orderkey || '@example.com'",
        "created_in": "o_orderstatus",
    }, "o_orderpriority <> '5-LOW'")],
    "s_return_items": [("lineitem", {
        "entity_id": LINE_ID,
        "rma_entity_id": "l_orderkey",
        "order_item_id": LINE_ID,
        "qty_approved": "CAST(l_quantity AS DECIMAL(12,4))",
        "status": "CASE l_linestatus WHEN 'F' THEN 'Approved' ELSE 'pending' END",
    }, "l_returnflag = 'R'"), ("lineitem", {
        "entity_id": f"'again ' || {LINE_ID}",
        "rma_entity_id": "l_partkey",
        "order_item_id": LINE_ID,
        "qty_approved": "CAST(l_linenumber AS DECIMAL(12,4))",
        "status": "'approved'",
    }, "l_quantity > 45")],
    "s_return_heads": [("orders", {
        "entity_id": "o_orderkey", "date_requested": "o_orderdate", "status": "o_orderstatus",
    }, "o_orderstatus <> 'P'")],
    "s_return_codes": [("lineitem", {
        "entity_id": LINE_ID,
        "attribute_id": "CASE WHEN l_linenumber < 6 THEN 1470 ELSE 1471 END",
        "value": "CAST(l_suppkey AS INT)",
    }, "l_returnflag = 'R'")],
    "s_options": [
        ("part", {"option_id": "CAST(p_partkey AS INT)", "store_id": "0", "value": "p_name"}, "p_type <> 'LARGE'"),
        ("part", {"option_id": "CAST(p_partkey AS INT)", "store_id": "1", "value": "p_brand"}, ""),
    ],
    "s_attributes": [
        ("region", {"attribute_id": "CAST(r_regionkey AS INT) + 900", "entity_type_id": "4",
                    "attribute_code": "CASE r_regionkey WHEN 0 THEN 'brand' WHEN 1 THEN 'color' ELSE r_name END"}, ""),
        ("nation", {"attribute_id": "CAST(n_nationkey AS INT) + 45", "entity_type_id": "3",
                    "attribute_code": "CASE n_nationkey WHEN 0 THEN 'name' ELSE n_name END"}, ""),
    ],
    "s_products": [("part", {
        "entity_id": "p_partkey",
        "row_id": "p_partkey * 2 + 1",
        "sku": "'SKU-' || p_partkey",
        "type_id": "p_type",
        "attribute_set_id": "p_size",
        "created_at": "CAST('2024-01-01 00:00:00' AS {ts}) + p_size * INTERVAL 1 DAY",
        "updated_at": "CAST('2025-01-01 00:00:00' AS {ts}) + p_size * INTERVAL 1 DAY",
    }, ""), ("part", {
        "entity_id": "p_partkey",
        "row_id": "p_partkey * 2",
        "sku": "'OLD-' || p_partkey",
        "type_id": "p_type",
        "attribute_set_id": "p_size",
        "created_at": "CAST('2023-01-01 00:00:00' AS {ts})",
        "updated_at": "CAST('2025-01-20 00:00:00' AS {ts})",
    }, "p_type = 'PROMO' OR p_type = 'LARGE'")],
    "s_product_codes": [
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "900", "store_id": "0",
                  "value": "CAST(p_size AS INT)"}, ""),
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "901", "store_id": "0",
                  "value": "CAST(p_partkey AS INT)"}, "p_size > 5"),
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "139", "store_id": "0",
                  "value": "CAST(p_partkey AS INT)"}, "p_size > 20"),
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "97", "store_id": "0",
                  "value": "CASE p_type WHEN 'PROMO' THEN 1 WHEN 'LARGE' THEN 2 ELSE 3 END"}, ""),
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "99", "store_id": "0",
                  "value": "CAST(p_size AS INT)"}, "p_type <> 'SMALL'"),
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "1009", "store_id": "1",
                  "value": "CAST(p_size AS INT)"}, ""),
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "1009", "store_id": "0",
                  "value": "CAST(p_size AS INT)"}, "p_type = 'PROMO' OR p_type = 'SMALL'"),
        ("part", {"row_id": "p_partkey * 2", "attribute_id": "139", "store_id": "1",
                  "value": "CAST(p_size AS INT)"}, "p_type = 'PROMO'"),
    ],
    "s_product_texts": [
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "73", "store_id": "0", "value": "p_name"}, ""),
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "73", "store_id": "1", "value": "p_brand"}, ""),
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "87", "store_id": "0",
                  "value": "'/' || p_partkey || '.jpg'"}, "p_size < 40"),
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "864", "store_id": "0",
                  "value": "CAST(p_partkey AS STRING)"}, "p_type <> 'SMALL'"),
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "959", "store_id": "0", "value": "p_brand"},
         "p_size > 35"),
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "5", "store_id": "0", "value": "p_type"}, ""),
        ("part", {"row_id": "p_partkey * 2", "attribute_id": "5", "store_id": "0", "value": "p_type"},
         "p_type = 'PROMO'"),
    ],
    "s_product_decimals": [
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "77", "store_id": "0",
                  "value": "CAST(p_retailprice AS DECIMAL(20,6))"}, ""),
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "81", "store_id": "0",
                  "value": "CAST(p_size AS DECIMAL(20,6))"}, "p_type <> 'LARGE'"),
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "82", "store_id": "0",
                  "value": "CAST(p_size AS DECIMAL(20,6))"}, "p_size > 10"),
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "78", "store_id": "0",
                  "value": "CAST(p_retailprice AS DECIMAL(20,6))"}, "p_size > 30"),
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "78", "store_id": "1",
                  "value": "CAST(p_size AS DECIMAL(20,6))"}, ""),
    ],
    "s_product_datetimes": [
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "79", "store_id": "0",
                  "value": "CAST('2025-02-01 00:00:00' AS {ts}) + p_size * INTERVAL 1 DAY"}, "p_size > 25"),
        ("part", {"row_id": "p_partkey * 2 + 1", "attribute_id": "80", "store_id": "0",
                  "value": "CAST('2025-03-01 00:00:00' AS {ts}) + p_size * INTERVAL 1 DAY"}, "p_size < 35"),
    ],
    "s_attribute_sets": [("part", {
        "attribute_set_id": "CAST(p_partkey AS INT)", "attribute_set_name": "p_name || ' set'",
    }, "p_type <> 'ECONOMY'")],
    "s_stock_2": [("lineitem", {
        "sku": "'SKU-' || l_partkey", "quantity": "CAST(l_quantity AS DECIMAL(10,4))",
        "is_salable": "l_linestatus = 'O'",
    }, "l_returnflag = 'A'")],
    "s_stock_6": [("lineitem", {
        "sku": "'SKU-' || l_suppkey", "quantity": "CAST(l_linenumber AS DECIMAL(10,4))",
        "is_salable": "l_linestatus = 'F'",
    }, "l_returnflag <> 'A'")],
    "s_url_rewrites": [("pages", {
        "entity_id": "page_id",
        "entity_type": "CASE WHEN url LIKE 'https%' THEN 'product' ELSE 'category' END",
        "request_path": "url",
    }, ""), ("part", {
        "entity_id": "p_partkey", "entity_type": "'product'", "request_path": "'p/' || p_brand",
    }, "p_size > 15"), ("part", {
        "entity_id": "p_partkey", "entity_type": "'product'", "request_path": "'p/' || p_name",
    }, "p_size > 25")],
    "s_nodes": [
        ("region", {"entity_id": "CAST(r_regionkey AS BIGINT) + 10", "row_id": "CAST(r_regionkey AS BIGINT) + 510",
                    "parent_id": "CAST(2 AS BIGINT)", "path": "'1/2/' || (r_regionkey + 10)"}, ""),
        ("nation", {"entity_id": "CAST(n_nationkey AS BIGINT) + 100", "row_id": "CAST(n_nationkey AS BIGINT) + 600",
                    "parent_id": "CAST(n_regionkey AS BIGINT) + 10",
                    "path": "'1/2/' || (n_regionkey + 10) || '/' || (n_nationkey + 100)"}, ""),
        ("customer", {"entity_id": "c_custkey + 1000", "row_id": "c_custkey + 1500",
                      "parent_id": "CAST(c_nationkey AS BIGINT) + 100",
                      "path": "'1/2/' || (c_nationkey + 100) || '/' || (c_custkey + 1000)"},
         "c_acctbal > 0"),
    ],
    "s_names": [
        ("region", {"row_id": "CAST(r_regionkey AS BIGINT) + 510", "attribute_id": "45", "store_id": "0",
                    "value": "r_name"}, ""),
        ("region", {"row_id": "CAST(r_regionkey AS BIGINT) + 510", "attribute_id": "45", "store_id": "1",
                    "value": "CASE r_regionkey WHEN 1 THEN 'Store ' || r_name END"}, ""),
        ("nation", {"row_id": "CAST(n_nationkey AS BIGINT) + 600", "attribute_id": "45", "store_id": "0",
                    "value": "n_name"}, "n_nationkey <> 3"),
        ("nation", {"row_id": "CAST(n_nationkey AS BIGINT) + 600", "attribute_id": "46", "store_id": "0",
                    "value": "'not a name'"}, ""),
        ("customer", {"row_id": "c_custkey + 1500", "attribute_id": "45", "store_id": "0",
                      "value": "c_mktsegment"}, "c_mktsegment <> 'BUILDING'"),
    ],
    "s_links": [
        ("supplier", {"product_id": "s_suppkey", "category_id": "CAST(s_nationkey AS BIGINT) + 100"}, ""),
        ("customer", {"product_id": "c_custkey", "category_id": "CAST(c_nationkey AS BIGINT) + 100"}, ""),
        ("customer", {"product_id": "c_custkey", "category_id": "c_custkey + 1000"}, ""),
    ],
}

# Subtrees left out of the breadcrumbs in the registered queries.
PREFIXES, NODE_IDS, PARENT_IDS, BAD_NAMES = ["1/2/14"], [110, 14], [112], ["nation_7", "AUTOMOBILE"]
NAME_ATTRIBUTE = 45
HOUSE_SELLER = "House"
SUBSIDY_START = "1997-06-01 00:00:00"


def _select(parts: list[Part], ts: str) -> list[str]:
    out = []
    for source, columns, where in parts:
        exprs = ", ".join(f"{expr.replace('{ts}', ts)} AS {name}" for name, expr in columns.items())
        out.append(f"SELECT {exprs} FROM {source}" + (f" WHERE {where}" if where else ""))
    return out


def shop(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shop-shaped table."""
    return _once(spark, sf_dir, name, lambda: _shop(spark, sf_dir, name))


def _shop(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    frame = None
    for source, columns, where in SHOP[name]:
        part = read(spark, sf_dir, source)
        if where:
            part = part.where(where)
        exprs = [f"{expr.replace('{ts}', 'TIMESTAMP_NTZ')} AS {c}" for c, expr in columns.items()]
        part = part.selectExpr(*exprs)
        frame = part if frame is None else frame.unionByName(part)
    return frame


def with_shop(tables: Iterable[str], body: str, more: str = "") -> str:
    """Check query: the shop tables as named sub-queries, then ``more`` sub-queries, then the body."""
    ctes = [f"{name} AS ({' UNION ALL '.join(_select(SHOP[name], 'TIMESTAMP'))})" for name in tables]
    if more:
        ctes.append(more.strip())
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()
