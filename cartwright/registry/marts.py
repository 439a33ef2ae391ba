"""The marts over the supplied tables, each with its SQL check."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.functions import fixed_values as V
from cartwright.functions.columns import decode, percent_of, shift_hours, since
from cartwright.operators import eav, tree
from cartwright.operators.joins import lookup_join
from cartwright.plans import catalog, rollup, sales
from cartwright.plans.settings import Settings
from cartwright.registry import adapters as A
from cartwright.registry.portable import portable
from cartwright.session import shared_folder
from cartwright.sources.export import export_csv
from cartwright.sources.tables import ordered, publish

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None):
    """Register a query under its function name, with the SQL that must give the same rows."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
        if check:
            CHECKS[fn.__name__] = check
        return fn

    return add


def _case(code: str, labels: dict[int, str], default: str) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in labels.items())
    return f"CASE {code} {whens} ELSE '{default}' END"


def _dbl(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


# ---- rollup ---------------------------------------------------------------------------------------

ROLLUP_START = "1996-01-01 00:00:01"


def rollup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide columns a rollup needs, from orders, lines and parts."""
    # The shifted time is compared later; this bound on the stored time reaches the scan.
    early = since(ROLLUP_START) - F.expr(f"INTERVAL {V.ORDER_SHIFT_HOURS} HOURS")
    orders = A.read(spark, sf_dir, "orders").where(F.col("o_orderdate") >= early).select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.concat(F.lit("ORD-"), F.col("o_orderkey")).alias("order_number"),
        shift_hours(F.col("o_orderdate"), V.ORDER_SHIFT_HOURS).alias("transaction_date"),
    )
    parts = A.read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("main_category"),
        F.col("p_brand").alias("sub_category"),
    )
    price, pct = F.col("l_extendedprice").cast("decimal(20,4)"), (F.col("l_discount") * 100).cast("decimal(12,4)")
    stored = A.read(spark, sf_dir, "lineitem")
    lines = stored.select(
        "l_orderkey", "l_partkey",
        F.when(F.col("l_linestatus") == "F", F.concat(F.lit("Seller "), F.col("l_suppkey")))
        .otherwise(A.HOUSE_SELLER).alias("seller_name"),
        F.col("l_quantity").cast("decimal(12,4)").alias("quantity"),
        price.alias("total_price"),
        F.col("l_discount").cast("decimal(20,4)").alias("item_discount"),
        (price * F.col("l_tax").cast("decimal(12,4)")).alias("retail_margin"),
        percent_of(price, pct).alias("marketplace_commission_amount"),
    )
    dated = lookup_join(lines, orders, "l_orderkey", "inner", stored.select("l_orderkey"))
    return lookup_join(dated, parts, "l_partkey", "inner", stored.select("l_partkey"))


_ROLLUP_ROWS = f"""
rows_ AS (
  SELECT 'ORD-' || o_orderkey AS order_number, o_orderdate + INTERVAL 2 HOUR AS transaction_date,
         p_type AS main_category, p_brand AS sub_category,
         CASE WHEN l_linestatus = 'F' THEN 'Seller ' || l_suppkey ELSE '{A.HOUSE_SELLER}' END AS seller_name,
         CASE WHEN l_linestatus = 'F' THEN 'MarketPlace' ELSE 'House store' END AS seller_class,
         CAST(l_quantity AS DECIMAL(12,4)) AS quantity, CAST(l_extendedprice AS DECIMAL(20,4)) AS total_price,
         CAST(l_discount AS DECIMAL(20,4)) AS item_discount,
         CASE WHEN l_linestatus = 'F'
              THEN ROUND(CAST(l_extendedprice AS DECIMAL(20,4)) * CAST(l_discount * 100 AS DECIMAL(12,4))
                         * CAST(0.01 AS DECIMAL(3,2)), 2)
              ELSE CAST(l_extendedprice AS DECIMAL(20,4)) * CAST(l_tax AS DECIMAL(12,4)) END AS margin
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
)"""


def _rollup_sql(keys: str) -> str:
    return f"""WITH {_ROLLUP_ROWS}
SELECT strftime(CAST(transaction_date AS DATE), '%Y-%m-%d') AS trx_date, {keys},
       COUNT(*) AS items_cnt, COUNT(DISTINCT order_number) AS orders_cnt,
       CAST(SUM(quantity) AS DOUBLE) AS qty_sum, CAST(SUM(total_price) AS DOUBLE) AS revenue_sum,
       CAST(SUM(item_discount) AS DOUBLE) AS discount_sum, CAST(SUM(margin) AS DOUBLE) AS margin_sum
FROM rows_ WHERE transaction_date >= TIMESTAMP '{ROLLUP_START}'
GROUP BY trx_date, {keys}"""


@query(_rollup_sql("main_category, sub_category, seller_class, seller_name"))
def sales_rollup_by_seller(spark, sf_dir):
    frame = rollup.sales_rollup(rollup_rows(spark, sf_dir), A.HOUSE_SELLER.upper(), "House store", start=ROLLUP_START)
    return ordered(frame, ["trx_date"])


@query(_rollup_sql("main_category, sub_category, seller_class"))
def sales_rollup_by_class(spark, sf_dir):
    return rollup.sales_rollup(
        rollup_rows(spark, sf_dir), A.HOUSE_SELLER.upper(), "House store", start=ROLLUP_START, by="class"
    )


# ---- shipments, statuses --------------------------------------------------------------------------

_SHIPPED = f"""
track_ AS (
  SELECT parent_id, title FROM s_tracks
  QUALIFY ROW_NUMBER() OVER (PARTITION BY parent_id ORDER BY entity_id DESC, title DESC) = 1
),
ship_ AS (
  SELECT i.order_item_id, s.increment_id AS shipment_ids, t.title AS courier_names,
         {_case('s.shipment_status', V.SHIPMENT_STATUS, V.SHIPMENT_DEFAULT)} AS shipment_statuses
  FROM s_shipment_items i LEFT JOIN s_shipments s ON s.entity_id = i.parent_id
       LEFT JOIN track_ t ON t.parent_id = s.entity_id
  QUALIFY ROW_NUMBER() OVER (PARTITION BY i.order_item_id
                             ORDER BY s.created_at DESC NULLS LAST, i.parent_id DESC) = 1
)"""


def _latest_shipment(spark, sf_dir):
    return sales.latest_shipment(*[A.shop(spark, sf_dir, n) for n in ("s_shipment_items", "s_shipments", "s_tracks")])


@query(A.with_shop(["s_shipment_items", "s_shipments", "s_tracks"], "SELECT * FROM ship_", _SHIPPED))
def latest_shipment(spark, sf_dir):
    return _latest_shipment(spark, sf_dir)


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Shipped' WHEN o_orderstatus = 'O' THEN 'Packed'
          ELSE 'pending' END AS status_text FROM orders""")
def decode_status(spark, sf_dir):
    codes = F.when(F.col("o_orderstatus") == "F", 4).when(F.col("o_orderstatus") == "O", 1).otherwise(77)
    text = decode(codes, V.SHIPMENT_STATUS, V.SHIPMENT_DEFAULT)
    return A.read(spark, sf_dir, "orders").select("o_orderkey", text.alias("status_text"))


_TRAIL = """
step_ AS (SELECT {key} AS parent_id, {value} AS status, MIN({ts}) AS first_at, MAX({ts}) AS last_at
          FROM {source} GROUP BY 1, 2),
trail_ AS (SELECT parent_id, STRING_AGG(status, ' | ' ORDER BY first_at, status) AS order_status,
                  MAX(last_at) + INTERVAL 3 HOUR AS status_changed_at
           FROM step_ GROUP BY parent_id)"""


@query("WITH" + _TRAIL.format(key="user_id", value="event_type", ts="ts", source="events") + " SELECT * FROM trail_")
def status_trail(spark, sf_dir):
    events = A.read(spark, sf_dir, "events").selectExpr("user_id AS parent_id", "event_type AS status",
                                                        "ts AS created_at")
    return sales.status_trail(events)


# ---- categories -----------------------------------------------------------------------------------

_TREE = f"""
step_nodes AS (SELECT n.entity_id, n.parent_id, n.path, CAST(u.anc AS BIGINT) AS ancestor_id, u.pos
               FROM s_nodes n, UNNEST(string_split(n.path, '/')) WITH ORDINALITY AS u(anc, pos)),
name_ AS (SELECT n.entity_id, v.value AS name FROM s_nodes n JOIN s_names v ON v.row_id = n.row_id
          WHERE v.attribute_id = {A.NAME_ATTRIBUTE} AND v.store_id IN (0, 1) AND v.value IS NOT NULL
          QUALIFY ROW_NUMBER() OVER (PARTITION BY n.entity_id ORDER BY v.store_id DESC) = 1),
bad_ AS (
  SELECT entity_id FROM s_nodes
  WHERE path LIKE '{A.PREFIXES[0]}/%' OR entity_id IN ({', '.join(map(str, A.NODE_IDS))})
        OR parent_id IN ({', '.join(map(str, A.PARENT_IDS))})
  UNION
  SELECT s.entity_id FROM step_nodes s JOIN s_nodes a ON a.entity_id = s.ancestor_id
         JOIN s_names v ON v.row_id = a.row_id
  WHERE v.attribute_id = {A.NAME_ATTRIBUTE} AND LOWER(v.value) IN ({', '.join(f"'{n.lower()}'" for n in A.BAD_NAMES)})
),
crumb_ AS (SELECT s.entity_id, STRING_AGG(m.name, ' > ' ORDER BY s.pos) AS crumb
           FROM step_nodes s JOIN name_ m ON m.entity_id = s.ancestor_id
           WHERE s.ancestor_id NOT IN (1, 2) GROUP BY s.entity_id),
path_ AS (SELECT l.product_id, STRING_AGG(c.crumb, ' | ' ORDER BY l.category_id) AS category_path
          FROM (SELECT DISTINCT product_id, category_id FROM s_links) l
          JOIN s_nodes n ON n.entity_id = l.category_id LEFT JOIN crumb_ c ON c.entity_id = l.category_id
          WHERE l.category_id NOT IN (SELECT entity_id FROM bad_) GROUP BY l.product_id)"""


def _excluded(nodes, names):
    return tree.excluded_subtrees(nodes, names, A.NAME_ATTRIBUTE, A.PREFIXES, A.NODE_IDS, A.PARENT_IDS, A.BAD_NAMES)


@query(A.with_shop(["s_nodes", "s_names"], "SELECT entity_id FROM bad_",
                   _TREE.split(",\ncrumb_")[0]))
def excluded_subtrees(spark, sf_dir):
    return _excluded(A.shop(spark, sf_dir, "s_nodes"), A.shop(spark, sf_dir, "s_names"))


@query(A.with_shop(["s_nodes", "s_names", "s_links"], "SELECT * FROM path_", _TREE))
def category_paths(spark, sf_dir):
    links, nodes, names = [A.shop(spark, sf_dir, n) for n in ("s_links", "s_nodes", "s_names")]
    return tree.category_paths(links, nodes, names, A.NAME_ATTRIBUTE, _excluded(nodes, names))


# ---- margins, refunds, subsidies ------------------------------------------------------------------

_MARGIN = """
sib_ AS (
  SELECT m.item_id, s.base_price AS sib_price, s.base_cost AS sib_cost, s.qty_ordered AS sib_qty
  FROM s_items m JOIN s_items s ON s.order_id = m.order_id AND s.sku = m.sku
       AND s.product_id <> m.product_id AND s.product_type <> m.product_type
  QUALIFY ROW_NUMBER() OVER (PARTITION BY m.item_id
            ORDER BY s.item_id, s.base_price NULLS FIRST, s.base_cost NULLS FIRST, s.qty_ordered) = 1
),
margin_ AS (
  SELECT m.item_id,
         CASE WHEN m.product_type = 'configurable' THEN (m.base_price - b.sib_cost) * m.qty_ordered
              WHEN m.base_price = 0 AND b.sib_price > 0 THEN (b.sib_price - m.base_cost) * b.sib_qty
              ELSE (m.base_price - m.base_cost) * m.qty_ordered END AS margin
  FROM s_items m LEFT JOIN sib_ b ON b.item_id = m.item_id
  WHERE m.marketplace_seller IS NULL
)"""


@query(A.with_shop(["s_items"], "SELECT item_id, CAST(margin AS DOUBLE) AS margin FROM margin_", _MARGIN))
def item_margin(spark, sf_dir):
    return sales.item_margin(A.shop(spark, sf_dir, "s_items"))


_PAY = """
pay_ AS (SELECT parent_id, MIN(method) AS method, COUNT(*) AS n FROM s_payments GROUP BY parent_id)"""


def _refund_case(qty: str, method: str, status: str) -> str:
    return (f"CASE WHEN {qty} > 0 AND (LOWER({method}) <> 'cashondelivery' OR {status} = 'Complete') "
            "THEN 'True' ELSE 'False' END")


@query(A.with_shop(["s_items", "s_payments", "s_shipment_items", "s_shipments", "s_tracks"], f"""
SELECT i.item_id AS order_item_id, {_refund_case('i.qty_refunded', 'p.method', 's.shipment_statuses')} AS is_refunded
FROM s_items i LEFT JOIN pay_ p ON p.parent_id = i.order_id LEFT JOIN ship_ s ON s.order_item_id = i.item_id
WHERE i.parent_item_id IS NULL""", _SHIPPED + "," + _PAY))
def refund_flag(spark, sf_dir):
    return sales.refund_flag(
        A.shop(spark, sf_dir, "s_items"), _latest_shipment(spark, sf_dir), A.shop(spark, sf_dir, "s_payments")
    )


_SUBSIDY = f"""
rule_hit AS (
  SELECT i.item_id, i.order_id, i.created_at, i.original_shipping_amount, i.paid_shipping_amount,
         TRY_CAST(TRIM(u.e) AS BIGINT) AS rule_id
  FROM s_items i, UNNEST(string_split(i.applied_rule_ids, ',')) AS u(e)
  WHERE i.parent_item_id IS NULL AND i.created_at >= TIMESTAMP '{A.SUBSIDY_START}'
        AND COALESCE(i.paid_shipping_amount, 0) = 0
),
subsidy_ AS (
  SELECT h.item_id, h.order_id, h.created_at, h.rule_id AS applied_rule_id, r.name AS rule_name, r.rule_cart_type,
         r.discount_amount, h.original_shipping_amount, h.paid_shipping_amount,
         CASE WHEN LOWER(r.rule_cart_type) = 'commercial' THEN h.original_shipping_amount ELSE 0 END
           AS commercial_shipping,
         CASE WHEN LOWER(r.rule_cart_type) = 'marketing' THEN h.original_shipping_amount ELSE 0 END
           AS marketing_shipping
  FROM rule_hit h JOIN s_rules r ON r.rule_id = h.rule_id WHERE r.discount_amount = 0
)"""
_SUBSIDY_MONEY = _dbl("discount_amount", "original_shipping_amount", "paid_shipping_amount", "commercial_shipping",
                      "marketing_shipping")


@query(A.with_shop(["s_items", "s_rules"], f"""
SELECT item_id, order_id, created_at, applied_rule_id, rule_name, rule_cart_type, {_SUBSIDY_MONEY}
FROM subsidy_""", _SUBSIDY))
def shipping_subsidy(spark, sf_dir):
    return sales.shipping_subsidy(A.shop(spark, sf_dir, "s_items"), A.shop(spark, sf_dir, "s_rules"),
                                  start=A.SUBSIDY_START)


@query(A.with_shop(["s_items", "s_rules", "s_coupons"], f"""
SELECT item_id, order_id, created_at, applied_rule_id, rule_name, rule_cart_type, {_SUBSIDY_MONEY}
FROM subsidy_ s LEFT JOIN s_coupons c ON c.rule_id = s.applied_rule_id""", _SUBSIDY))
def shipping_subsidy_per_coupon(spark, sf_dir):
    items, rules, coupons = [A.shop(spark, sf_dir, n) for n in ("s_items", "s_rules", "s_coupons")]
    return sales.shipping_subsidy(items, rules, coupons, start=A.SUBSIDY_START, per_coupon=True)


# ---- order money ----------------------------------------------------------------------------------

_PAY_LATER = ", ".join(f"'{m}'" for m in V.PAY_LATER_METHODS)


def _fee_case(method: str, o: str = "o") -> str:
    columns = " ".join(f"WHEN LOWER({method}) = '{m.lower()}' THEN {o}.{c}" for m, c in V.PAYMENT_FEE_COLUMN.items())
    return (f"CASE {columns} WHEN LOWER({method}) IN ({_PAY_LATER}) THEN COALESCE({o}.amount_to_collect, 0) "
            "ELSE 0 END")


def _total_case(method: str, o: str = "o") -> str:
    balance = f"COALESCE({o}.base_customer_balance_amount, 0)"
    return (f"CASE WHEN {method} IS NULL THEN 0 WHEN LOWER({method}) = 'free' THEN {balance} "
            f"ELSE COALESCE({o}.base_grand_total, 0) + {balance} END")


@query(A.with_shop(["s_orders", "s_payments"], f"""
SELECT o.entity_id, o.created_at, o.increment_id, p.method, CAST({_fee_case('p.method')} AS DOUBLE) AS payment_fees
FROM s_orders o JOIN s_payments p ON p.parent_id = o.entity_id"""))
def payment_fee(spark, sf_dir):
    return sales.payment_fee(A.shop(spark, sf_dir, "s_orders"), A.shop(spark, sf_dir, "s_payments"))


@query(A.with_shop(["s_orders", "s_payments"], f"""
SELECT o.entity_id, CAST({_total_case('p.method')} AS DOUBLE) AS order_total
FROM s_orders o LEFT JOIN pay_ p ON p.parent_id = o.entity_id""", _PAY))
def order_total(spark, sf_dir):
    return sales.order_total(A.shop(spark, sf_dir, "s_orders"), A.shop(spark, sf_dir, "s_payments"))


@query(A.with_shop(["s_balances", "s_customers"], """
SELECT b.customer_id AS user_id, CAST(b.amount AS DOUBLE) AS balance_amount,
       c.firstname || ' ' || c.lastname AS customer_name, c.email AS user_email, c.created_in AS website
FROM s_balances b LEFT JOIN s_customers c ON c.entity_id = b.customer_id WHERE b.amount > 0"""))
def customer_balance(spark, sf_dir):
    return sales.customer_balance(A.shop(spark, sf_dir, "s_balances"), A.shop(spark, sf_dir, "s_customers"))


# ---- returns --------------------------------------------------------------------------------------

_RETURN_TABLES = ["s_shipment_items", "s_return_items", "s_return_heads", "s_return_codes", "s_options"]
_RETURNS = f"""
option_ AS (SELECT option_id, MAX(value) AS value FROM s_options WHERE store_id = 0 GROUP BY option_id),
return_ AS (
  SELECT r.order_item_id, r.entity_id AS return_item_id, r.qty_approved AS quantity_returned,
         h.date_requested AS rma_created_at, r.status AS item_status, h.status AS rma_status,
         COALESCE(x.value, '') AS return_reason, s.n AS shipment_lines
  FROM s_return_items r
  JOIN (SELECT order_item_id, COUNT(*) AS n FROM s_shipment_items GROUP BY order_item_id) s
       ON s.order_item_id = r.order_item_id
  LEFT JOIN s_return_heads h ON h.entity_id = r.rma_entity_id
  LEFT JOIN s_return_codes c ON c.entity_id = r.entity_id AND c.attribute_id = {V.RETURN_REASON_ATTRIBUTE}
  LEFT JOIN option_ x ON x.option_id = c.value
  WHERE LOWER(r.status) = 'approved'
)"""


@query(A.with_shop(_RETURN_TABLES, f"SELECT * EXCLUDE (quantity_returned), {_dbl('quantity_returned')} FROM return_",
                   _RETURNS))
def returns(spark, sf_dir):
    return sales.returns(*[A.shop(spark, sf_dir, n) for n in _RETURN_TABLES])


@query(A.with_shop(_RETURN_TABLES, """
SELECT r.* EXCLUDE (quantity_returned), CAST(quantity_returned AS DOUBLE) AS quantity_returned
FROM return_ r JOIN s_shipment_items s ON s.order_item_id = r.order_item_id""", _RETURNS))
def returns_per_shipment_line(spark, sf_dir):
    return sales.returns(*[A.shop(spark, sf_dir, n) for n in _RETURN_TABLES], per_shipment_line=True)


# ---- the wide item table --------------------------------------------------------------------------

WIDE_TABLES = {
    "orders": "s_orders", "items": "s_items", "payments": "s_payments", "addresses": "s_addresses",
    "status_history": "s_history", "shipment_items": "s_shipment_items", "shipments": "s_shipments",
    "shipment_tracks": "s_tracks", "rules": "s_rules", "coupons": "s_coupons", "return_items": "s_return_items",
    "return_heads": "s_return_heads", "return_codes": "s_return_codes", "options": "s_options",
    "attributes": "s_attributes", "products": "s_products", "product_codes": "s_product_codes",
    "category_nodes": "s_nodes", "category_names": "s_names", "category_links": "s_links",
}

_WIDE = ",".join([
    _SHIPPED, _TREE, _MARGIN, _PAY, _SUBSIDY, _RETURNS,
    _TRAIL.format(key="parent_id", value="status", ts="created_at", source="s_history"),
]) + """,
back_ AS (SELECT * FROM return_ QUALIFY ROW_NUMBER() OVER (PARTITION BY order_item_id
            ORDER BY rma_created_at DESC NULLS LAST, return_item_id DESC, return_reason) = 1),
paid_ AS (SELECT item_id, MAX(commercial_shipping) AS commercial_shipping, MAX(marketing_shipping) AS marketing_shipping
          FROM subsidy_ GROUP BY item_id),
addr_ AS (SELECT parent_id, city, region FROM s_addresses WHERE address_type = 'shipping'
          QUALIFY ROW_NUMBER() OVER (PARTITION BY parent_id ORDER BY city NULLS FIRST, region NULLS FIRST) = 1),
code_ AS (SELECT LOWER(c.code) AS code_key, r.rule_cart_type FROM s_coupons c LEFT JOIN s_rules r USING (rule_id)
          QUALIFY ROW_NUMBER() OVER (PARTITION BY LOWER(c.code) ORDER BY c.rule_id) = 1),
prod_ AS (SELECT entity_id, MAX(row_id) AS row_id FROM s_products GROUP BY entity_id),
text_ AS (SELECT p.entity_id, a.attribute_code, MAX(x.value) AS value
          FROM prod_ p JOIN s_product_codes v ON v.row_id = p.row_id AND v.store_id = 0
          JOIN s_attributes a ON a.attribute_id = v.attribute_id AND a.entity_type_id = 4
          JOIN option_ x ON x.option_id = v.value GROUP BY 1, 2)"""

_WIDE_BODY = f"""
SELECT o.increment_id AS order_number, o.created_at + INTERVAL 2 HOUR AS transaction_date, o.customer_id AS user_id,
  o.customer_firstname || ' ' || o.customer_lastname AS customer_name, o.customer_email AS user_email,
  h.order_status, h.status_changed_at, o.status AS current_status, o.updated_at + INTERVAL 2 HOUR AS updated_at,
  o.store_id AS site_language, o.coupon_code AS promo_code, k.rule_cart_type AS coupon_type,
  o.base_currency_code AS currency, CAST({_total_case('p.method')} AS DOUBLE) AS order_total,
  CAST(o.base_discount_amount AS DOUBLE) AS discount_amount, CAST(o.base_shipping_amount AS DOUBLE) AS shipping_fee,
  CAST(o.base_tax_amount AS DOUBLE) AS tax_amount,
  CASE WHEN p.n IS NOT NULL THEN CAST({_fee_case('p.method')} AS DOUBLE) END AS order_fees, o.checkout_from,
  i.item_id, i.sku, i.name AS product_name, i.product_id, CAST(i.qty_ordered AS DOUBLE) AS quantity,
  CAST(i.qty_refunded AS DOUBLE) AS quantity_refunded, CAST(i.qty_shipped AS DOUBLE) AS quantity_shipped,
  CAST(i.base_price AS DOUBLE) AS unit_price, CAST(i.base_row_total AS DOUBLE) AS total_price,
  CAST(i.base_discount_amount AS DOUBLE) AS item_discount, CAST(i.marketing_discount AS DOUBLE) AS Marketing_Discount,
  CAST(i.commercial_discount AS DOUBLE) AS Commercial_Discount,
  CAST(i.marketplace_commission AS DOUBLE) AS marketplace_commission_percentage,
  CAST(ROUND(i.base_row_total * i.marketplace_commission * CAST(0.01 AS DECIMAL(3,2)), 2) AS DOUBLE)
    AS marketplace_commission_amount,
  CAST(m.margin AS DOUBLE) AS retail_margin,
  CAST(m.margin - i.commercial_discount AS DOUBLE) AS retail_margin_after_discount,
  CAST(i.base_tax_amount AS DOUBLE) AS item_tax, CAST(i.original_shipping_amount AS DOUBLE) AS original_shipping_fee,
  CAST(i.paid_shipping_amount AS DOUBLE) AS paid_shipping_amount,
  {_refund_case('i.qty_refunded', 'p.method', 's.shipment_statuses')} AS is_refunded,
  CAST(f.commercial_shipping AS DOUBLE) AS commercial_shipping_fee,
  CAST(f.marketing_shipping AS DOUBLE) AS marketing_shipping_fee, tb.value AS brand_name, tc.value AS variant_id,
  COALESCE(i.marketplace_seller, '{A.HOUSE_SELLER}') AS seller_name, c.category_path AS product_category_name,
  i.main_category, i.sub_category, p.method AS payment_method, a.city AS area, a.region AS city,
  s.shipment_ids, s.courier_names, s.shipment_statuses, CAST(b.quantity_returned AS DOUBLE) AS quantity_returned,
  b.rma_created_at, b.item_status AS rma_item_status, b.rma_status, b.return_reason AS rma_return_reason
FROM s_orders o JOIN s_items i ON i.order_id = o.entity_id
LEFT JOIN pay_ p ON p.parent_id = o.entity_id
LEFT JOIN trail_ h ON h.parent_id = o.entity_id
LEFT JOIN addr_ a ON a.parent_id = o.entity_id
LEFT JOIN code_ k ON k.code_key = LOWER(o.coupon_code)
LEFT JOIN margin_ m ON m.item_id = i.item_id
LEFT JOIN paid_ f ON f.item_id = i.item_id
LEFT JOIN ship_ s ON s.order_item_id = i.item_id
LEFT JOIN back_ b ON b.order_item_id = i.item_id
LEFT JOIN path_ c ON c.product_id = i.product_id
LEFT JOIN text_ tb ON tb.entity_id = i.product_id AND tb.attribute_code = 'brand'
LEFT JOIN text_ tc ON tc.entity_id = i.product_id AND tc.attribute_code = 'color'
WHERE i.parent_item_id IS NULL"""


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: A.shop(spark, sf_dir, source) for name, source in WIDE_TABLES.items()}
    left_out = sales.Subtrees(A.PREFIXES, A.NODE_IDS, A.PARENT_IDS, A.BAD_NAMES)
    made = sales.pieces(tables, left_out, Settings(subsidy_since=A.SUBSIDY_START), one_plan=True)
    return sales.orders_items_wide(tables, made, A.HOUSE_SELLER)


@query(A.with_shop(sorted(set(WIDE_TABLES.values())), _WIDE_BODY, _WIDE))
def orders_items_wide(spark, sf_dir):
    return wide(spark, sf_dir)


@query(A.with_shop(sorted(set(WIDE_TABLES.values())), f"""
SELECT strftime(CAST(transaction_date AS DATE), '%Y-%m-%d') AS trx_date, main_category, sub_category,
       CASE WHEN seller_name = '{A.HOUSE_SELLER}' THEN 'House store' ELSE 'MarketPlace' END AS seller_class,
       COUNT(*) AS items_cnt, COUNT(DISTINCT order_number) AS orders_cnt,
       SUM(quantity) AS qty_sum, CAST(SUM(CAST(total_price AS DECIMAL(20,4))) AS DOUBLE) AS revenue_sum,
       CAST(SUM(CAST(item_discount AS DECIMAL(20,4))) AS DOUBLE) AS discount_sum,
       CAST(SUM(CASE WHEN seller_name = '{A.HOUSE_SELLER}' THEN CAST(retail_margin AS DECIMAL(34,8))
            ELSE CAST(marketplace_commission_amount AS DECIMAL(34,8)) END) AS DOUBLE) AS margin_sum
FROM wide_ WHERE transaction_date >= TIMESTAMP '{ROLLUP_START}'
GROUP BY ALL""", _WIDE + f",\nwide_ AS ({_WIDE_BODY})"))
def rollup_of_wide(spark, sf_dir):
    return rollup.sales_rollup(
        wide(spark, sf_dir), A.HOUSE_SELLER, "House store", start=ROLLUP_START, by="class", few_groups=True
    )


# ---- catalogue ------------------------------------------------------------------------------------


def _pivot_sql(columns: dict[int, str], source: str, cast: bool = False) -> str:
    picks = [f"MAX(value) FILTER (attribute_id = {k})" for k in columns]
    if cast:
        picks = [f"CAST({p} AS DOUBLE)" for p in picks]
    named = ", ".join(f"{p} AS {n}" for p, n in zip(picks, columns.values()))
    return f"SELECT row_id, {named} FROM {source} WHERE store_id = 0 GROUP BY row_id"


@query(A.with_shop(["s_product_texts"], _pivot_sql(V.VARCHAR_ATTRIBUTES, "s_product_texts")))
def eav_pivot(spark, sf_dir):
    return eav.eav_pivot(A.shop(spark, sf_dir, "s_product_texts"), V.VARCHAR_ATTRIBUTES)


@query(A.with_shop(["s_product_decimals"], _pivot_sql(V.DECIMAL_ATTRIBUTES, "s_product_decimals", cast=True)))
def eav_pivot_decimals(spark, sf_dir):
    return eav.eav_pivot(A.shop(spark, sf_dir, "s_product_decimals"), V.DECIMAL_ATTRIBUTES)


_CODED = f"""
option_ AS (SELECT option_id, MAX(value) AS value FROM s_options WHERE store_id = 0 GROUP BY option_id),
coded_ AS (
  SELECT v.row_id,
    MAX(CASE WHEN v.attribute_id = 97 THEN {_case('v.value', V.PRODUCT_STATUS, 'Unknown')} END) AS status,
    MAX(CASE WHEN v.attribute_id = 99 THEN {_case('v.value', V.PRODUCT_VISIBILITY, 'Unknown')} END) AS visibility,
    MAX(x.value) FILTER (v.attribute_id = 139) AS brand, MAX(x.value) FILTER (v.attribute_id = 900) AS warranty,
    MAX(x.value) FILTER (v.attribute_id = 1009) AS sold_by
  FROM s_product_codes v LEFT JOIN option_ x ON x.option_id = v.value WHERE v.store_id = 0 GROUP BY v.row_id
)"""


@query(A.with_shop(["s_product_codes", "s_options"], "SELECT * FROM coded_", _CODED))
def eav_pivot_options(spark, sf_dir):
    codes, options = A.shop(spark, sf_dir, "s_product_codes"), A.shop(spark, sf_dir, "s_options")
    return eav.eav_pivot_options(codes, options, V.OPTION_ATTRIBUTES, Settings().decoded)


_SPECIAL = """
special_ AS (
  SELECT COALESCE(p.row_id, d.row_id) AS row_id, p.special_price, d.special_from, d.special_to
  FROM (SELECT row_id, MAX(value) AS special_price FROM s_product_decimals
        WHERE store_id = 0 AND attribute_id = 78 GROUP BY row_id) p
  FULL JOIN (SELECT row_id, MAX(value) FILTER (attribute_id = 79) AS special_from,
                    MAX(value) FILTER (attribute_id = 80) AS special_to
             FROM s_product_datetimes WHERE store_id = 0 GROUP BY row_id) d ON d.row_id = p.row_id
)"""


@query(A.with_shop(["s_product_decimals", "s_product_datetimes"],
                   f"SELECT row_id, {_dbl('special_price')}, special_from, special_to FROM special_", _SPECIAL))
def special_prices(spark, sf_dir):
    tables = [A.shop(spark, sf_dir, n) for n in ("s_product_decimals", "s_product_datetimes")]
    return eav.special_prices(*tables, V.SPECIAL_PRICE_ATTRIBUTES)


_STOCK = """
stock_ AS (
  SELECT COALESCE(a.sku, b.sku) AS sku, a.quantity AS online_qty, a.is_salable AS is_salable_online,
         b.quantity AS smart_qty, b.is_salable AS is_salable_smart
  FROM (SELECT sku, MAX(quantity) AS quantity, BOOL_OR(is_salable) AS is_salable FROM s_stock_2 GROUP BY sku) a
  FULL JOIN (SELECT sku, MAX(quantity) AS quantity, BOOL_OR(is_salable) AS is_salable FROM s_stock_6 GROUP BY sku) b
       ON b.sku = a.sku
)"""


def _stocks(spark, sf_dir):
    return {k: A.shop(spark, sf_dir, f"s_stock_{k}") for k in V.STOCK_COLUMNS}


@query(A.with_shop(["s_stock_2", "s_stock_6"],
                   f"SELECT sku, {_dbl('online_qty', 'smart_qty')}, is_salable_online, is_salable_smart FROM stock_",
                   _STOCK))
def stock_by_location(spark, sf_dir):
    return eav.stock_by_location(_stocks(spark, sf_dir), V.STOCK_COLUMNS)


@query("SELECT page_id AS entity_id, url AS request_path FROM pages WHERE url LIKE 'https%' "
       "UNION ALL SELECT p_partkey, 'p/' || p_brand FROM part WHERE p_size > 15 "
       "UNION ALL SELECT p_partkey, 'p/' || p_name FROM part WHERE p_size > 25")
def product_urls(spark, sf_dir):
    return catalog.product_urls(A.shop(spark, sf_dir, "s_url_rewrites"))


PREFIXES = catalog.Prefixes("https://shop.example.com/media", "https://shop.example.com/", "https://store.example.com/")
REPORT_TABLES = {
    "products": "s_products", "product_texts": "s_product_texts", "product_decimals": "s_product_decimals",
    "product_codes": "s_product_codes", "product_datetimes": "s_product_datetimes", "options": "s_options",
    "attribute_sets": "s_attribute_sets", "stock_2": "s_stock_2", "stock_6": "s_stock_6",
    "url_rewrites": "s_url_rewrites",
}


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {k: A.shop(spark, sf_dir, v) for k, v in REPORT_TABLES.items()}
    return catalog.product_report(catalog.pieces(tables), PREFIXES)


@query(A.with_shop(REPORT_TABLES.values(), f"""
SELECT CAST(b.entity_id AS INTEGER) AS Id, b.sku AS SKU, b.type_id AS "Type", COALESCE(t.barcode, '') AS Barcode,
  e.attribute_set_name AS "Attribute Set", COALESCE(c.brand, '') AS Brand, COALESCE(c.warranty, '') AS Warranty,
  t.product_name AS "Product Name", COALESCE(t.other_language_name, '') AS "Other Language Name",
  COALESCE(c.sold_by, '') AS "Sold By", COALESCE(CAST(d.weight AS VARCHAR), '') AS Weight, c.status AS Status,
  c.visibility AS Visibility, CAST(ROUND(d.price, 2) AS DOUBLE) AS Price,
  CAST(ROUND(x.special_price, 2) AS DOUBLE) AS special_price, x.special_from, x.special_to,
  CAST(ROUND(d.cost, 2) AS DOUBLE) AS cost, CAST(k.online_qty AS DOUBLE) AS Qty,
  CAST(k.online_qty AS DOUBLE) AS "Online Qty", k.is_salable_online AS "is salable online",
  CAST(k.smart_qty AS DOUBLE) AS "Smart Store Qty", k.is_salable_smart AS "is salable smart",
  b.created_at, b.updated_at, '{PREFIXES.image}' || t.image AS Image,
  '{PREFIXES.online}' || u.request_path AS "Online Url Key", '{PREFIXES.store}' || u.request_path AS "rstore Url key"
FROM newest_ b LEFT JOIN texts_ t USING (row_id) LEFT JOIN decimals_ d USING (row_id) LEFT JOIN coded_ c USING (row_id)
LEFT JOIN special_ x USING (row_id) LEFT JOIN stock_ k ON k.sku = b.sku
LEFT JOIN s_attribute_sets e ON e.attribute_set_id = b.attribute_set_id
LEFT JOIN url_ u ON u.entity_id = b.entity_id""", f"""
newest_ AS (SELECT * FROM s_products
            QUALIFY ROW_NUMBER() OVER (PARTITION BY entity_id ORDER BY updated_at DESC, row_id DESC) = 1),
texts_ AS ({_pivot_sql(V.VARCHAR_ATTRIBUTES, "s_product_texts")}),
decimals_ AS ({_pivot_sql(V.DECIMAL_ATTRIBUTES, "s_product_decimals")}),
{_CODED}, {_SPECIAL}, {_STOCK},
url_ AS (SELECT entity_id, request_path FROM s_url_rewrites WHERE entity_type = 'product'
         QUALIFY ROW_NUMBER() OVER (PARTITION BY entity_id ORDER BY LENGTH(request_path), request_path) = 1)"""))
def product_report(spark, sf_dir):
    return report(spark, sf_dir)


# ---- small pieces and sinks -----------------------------------------------------------------------


@query("SELECT event_id, ts + INTERVAL 2 HOUR AS shifted, CAST(ts + INTERVAL 2 HOUR AS DATE) <> CAST(ts AS DATE) "
       "AS next_day FROM events")
def time_shift(spark, sf_dir):
    shifted = shift_hours(F.col("ts"), 2)
    return A.read(spark, sf_dir, "events").select(
        "event_id", shifted.alias("shifted"), (F.to_date(shifted) != F.to_date("ts")).alias("next_day")
    )


@query(f"""SELECT {A.LINE_ID} AS item_id, CAST(ROUND(CAST(l_extendedprice AS DECIMAL(20,4))
           * CAST(l_discount * 100 AS DECIMAL(12,4)) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DOUBLE) AS commission
           FROM lineitem""")
def commission_round(spark, sf_dir):
    return A.shop(spark, sf_dir, "s_items").select(
        "item_id", percent_of(F.col("base_row_total"), F.col("marketplace_commission")).alias("commission")
    )


def _report_text() -> str:
    """The report's columns as the text a CSV reader finds: flags 1 and 0, decimals at their scale, empty text as NULL."""
    columns = []
    for plain, kind in re.findall(r"`?([^`,()]+?)`? ([A-Z_]+(?:\(\d+(?:,\d+)?\))?)(?:, |$)", V.PRODUCT_REPORT_DDL):
        name = f'"{plain}"'
        if kind == "BOOLEAN":
            text = f"CAST(CAST({name} AS INTEGER) AS VARCHAR)"
        elif kind == "TIMESTAMP_NTZ":
            text = f"strftime({name}, '%Y-%m-%d %H:%M:%S')"
        elif kind.startswith("DECIMAL"):
            text = f"CAST(CAST({name} AS {kind}) AS VARCHAR)"
        else:
            text = f"NULLIF(CAST({name} AS VARCHAR), '')"
        columns.append(f"{text} AS {name}")
    return f"SELECT {', '.join(columns)} FROM ({CHECKS['product_report']})"


@query(_report_text())
def csv_export(spark, sf_dir):
    """The product report published, written as CSV from the table, and read back."""
    path = shared_folder(spark, "report")
    frame = publish(report(spark, sf_dir), "cartwright_product_report", root=shared_folder(spark, "tables"))
    export_csv(frame, path, ["Id"])
    schema = ", ".join(f"`{c}` STRING" for c in frame.columns)
    return spark.read.options(header=True, escape='"', multiLine=True).schema(schema).csv(path)


@query(CHECKS["sales_rollup_by_class"])
def publish_table(spark, sf_dir):
    """The class rollup published as a table and read back."""
    frame = rollup.sales_rollup(
        rollup_rows(spark, sf_dir), A.HOUSE_SELLER, "House store", start=ROLLUP_START, by="class"
    )
    return publish(frame, "cartwright_rollup_by_class", root=shared_folder(spark, "tables"))
