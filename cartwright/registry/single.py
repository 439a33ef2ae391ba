"""One query per single operator over the supplied tables, each with its SQL check."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwright.functions import columns as C
from cartwright.functions import fixed_values as V
from cartwright.operators import eav, tree
from cartwright.operators.dedupe import distinct_ordered_concat, latest_per_key
from cartwright.operators.joins import lookup_join
from cartwright.operators.lists import explode_ids, list_elements
from cartwright.operators.siblings import with_first_differing
from cartwright.registry import adapters as A
from cartwright.registry.marts import query
from cartwright.sources.tables import conform, ordered

LINE = A.LINE_ID


def _line_id():
    return F.expr(LINE).alias("item_id")


# ---- projections and predicates ----------------------------------------------------------------


@query("SELECT p_partkey AS id, p_name AS name, p_retailprice AS price FROM part")
def op_select_rename(spark, sf_dir):
    return A.read(spark, sf_dir, "part").selectExpr("p_partkey AS id", "p_name AS name", "p_retailprice AS price")


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT'
          AND o_totalprice > 100000 AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:01'""")
def op_filter_compare(spark, sf_dir):
    return A.read(spark, sf_dir, "orders").where(
        (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "1-URGENT")
        & (F.col("o_totalprice") > 100000) & (F.col("o_orderdate") >= C.since("1996-01-01 00:00:01"))
    ).select("o_orderkey", "o_totalprice")


@query("""SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
          WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') AND o_orderstatus NOT IN ('P')""")
def op_in_not_in(spark, sf_dir):
    return A.read(spark, sf_dir, "orders").where(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW") & ~F.col("o_orderstatus").isin("P")
    ).select("o_orderkey", "o_orderpriority", "o_orderstatus")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def op_anti_join(spark, sf_dir):
    orders = A.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    used = A.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return orders.join(used, "o_orderkey", "left_anti")


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red %'")
def op_prefix_like(spark, sf_dir):
    return A.read(spark, sf_dir, "part").where(F.col("p_name").startswith("red ")).select("p_partkey", "p_name")


@query("""SELECT o_orderkey, status, status IS NULL AS is_null FROM
          (SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS status, CASE o_orderpriority WHEN '5-LOW' THEN ''
           WHEN '2-HIGH' THEN NULL ELSE o_orderpriority END AS prio FROM orders) x
          WHERE prio IS NOT NULL AND prio <> ''""")
def op_null_tests(spark, sf_dir):
    prio = F.col("o_orderpriority")
    rows = A.read(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(prio == "5-LOW", "").when(prio != "2-HIGH", prio).alias("prio"),
    )
    kept = rows.where(F.col("prio").isNotNull() & (F.col("prio") != ""))
    return kept.select("o_orderkey", "status", F.col("status").isNull().alias("is_null"))


@query("""SELECT o_orderkey, (a = 'F' OR b = '5-LOW') AS either, (a = 'F' AND b = '5-LOW') AS both FROM
          (SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS a, NULLIF(o_orderpriority, '2-HIGH') AS b FROM orders)""")
def op_three_valued(spark, sf_dir):
    rows = A.read(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("a"),
        F.nullif("o_orderpriority", F.lit("2-HIGH")).alias("b"),
    )
    a, b = F.col("a") == "F", F.col("b") == "5-LOW"
    return rows.select("o_orderkey", (a | b).alias("either"), (a & b).alias("both"))


_NODE_POS = "CAST(LIST_POSITION(string_split(path, '/'), CAST(parent_id AS VARCHAR)) AS BIGINT)"


@query(A.with_shop(["s_nodes"], f"""SELECT entity_id, {_NODE_POS} AS place,
       list_contains(string_split(REPLACE(path, '/', ','), ','), '101') AS under_101 FROM s_nodes
       WHERE list_contains(string_split(path, '/'), CAST(parent_id AS VARCHAR))"""))
def op_list_member(spark, sf_dir):
    listed = A.shop(spark, sf_dir, "s_nodes").withColumn("ids", F.replace("path", F.lit("/"), F.lit(",")))
    parent, ids = F.col("parent_id"), F.col("ids")
    return listed.where(C.in_list(parent, ids)).select(
        "entity_id", C.list_position(parent, ids).alias("place"), C.in_list(F.lit(101), ids).alias("under_101")
    )


@query("""SELECT s_suppkey, s_name, (SELECT MIN(n_nationkey) FROM nation WHERE n_regionkey = 2) AS first_asian
          FROM supplier""")
def op_scalar_lookup(spark, sf_dir):
    nations = A.read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("attribute_id"), F.lit("nation").alias("attribute_code"), F.col("n_regionkey").alias("entity_type_id"))
    first = eav.attribute_lookup(nations, "nation", 2)
    return A.read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", first.alias("first_asian"))


# ---- joins -------------------------------------------------------------------------------------


def _orders(spark, sf_dir):
    return A.read(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")


@query(f"SELECT {LINE} AS item_id, o_custkey, l_quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def op_inner_join(spark, sf_dir):
    lines = A.read(spark, sf_dir, "lineitem").select("l_orderkey", _line_id(), "l_quantity")
    orders = _orders(spark, sf_dir).select("l_orderkey", "o_custkey")
    return lookup_join(lines, orders, "l_orderkey", "inner").drop("l_orderkey")


@query("SELECT c_custkey, c_name, s_name FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def op_left_join(spark, sf_dir):
    customers = A.read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    suppliers = A.read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), "s_name")
    return lookup_join(customers, suppliers, "c_custkey", "left")


@query(f"""SELECT {LINE} AS item_id, o_orderpriority FROM lineitem
           LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'F'""")
def op_left_join_on_filter(spark, sf_dir):
    lines = A.read(spark, sf_dir, "lineitem").select("l_orderkey", _line_id())
    orders = _orders(spark, sf_dir).where("o_orderstatus = 'F'").select("l_orderkey", "o_orderpriority")
    return lookup_join(lines, orders, "l_orderkey", "left").drop("l_orderkey")


@query(f"""SELECT {LINE} AS item_id, l_returnflag, p_name FROM lineitem
           LEFT JOIN part ON p_partkey = l_partkey AND l_returnflag = 'R'""")
def op_left_join_left_pred(spark, sf_dir):
    key = F.when(F.col("l_returnflag") == "R", F.col("l_partkey")).alias("p_partkey")
    lines = A.read(spark, sf_dir, "lineitem").select(_line_id(), "l_returnflag", key)
    return lookup_join(lines, A.read(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey", "left").drop(
        "p_partkey"
    )


@query(A.with_shop(["s_product_texts", "s_product_decimals"], """
SELECT t.row_id, t.attribute_id, t.store_id, t.value AS text_value, CAST(d.value AS DOUBLE) AS number_value
FROM s_product_texts t LEFT JOIN s_product_decimals d
ON d.row_id = t.row_id AND d.store_id = t.store_id AND d.attribute_id = t.attribute_id + 4"""))
def op_multi_key_join(spark, sf_dir):
    texts = A.shop(spark, sf_dir, "s_product_texts").withColumn("number_id", F.col("attribute_id") + 4)
    numbers = A.shop(spark, sf_dir, "s_product_decimals").select(
        "row_id", "store_id", F.col("attribute_id").alias("number_id"), F.col("value").alias("number_value")
    )
    return texts.withColumnRenamed("value", "text_value").join(
        numbers, ["row_id", "store_id", "number_id"], "left"
    ).drop("number_id")


@query(A.with_shop(["s_items"], """
SELECT m.item_id, b.sibling_id, CAST(b.sibling_cost AS DOUBLE) AS sibling_cost
FROM s_items m LEFT JOIN sib_ b ON b.item_id = m.item_id""", """
sib_ AS (
  SELECT m.item_id, s.item_id AS sibling_id, s.base_cost AS sibling_cost
  FROM s_items m JOIN s_items s ON s.order_id = m.order_id AND s.sku = m.sku
       AND s.product_id <> m.product_id AND s.product_type <> m.product_type
  QUALIFY ROW_NUMBER() OVER (PARTITION BY m.item_id ORDER BY s.item_id, s.base_cost) = 1
)"""))
def op_self_join_residual(spark, sf_dir):
    items = A.shop(spark, sf_dir, "s_items").select(
        "item_id", "order_id", "sku", "product_id", "product_type", "base_cost"
    )
    paired = with_first_differing(
        items, ["order_id", "sku"], "product_type", "product_id", "item_id", ["base_cost"], "sibling"
    )
    return paired.select(
        "item_id", F.col("sibling.item_id").alias("sibling_id"), F.col("sibling.base_cost").alias("sibling_cost")
    )


@query(A.with_shop(["s_nodes"], """
SELECT c.entity_id, p.entity_id AS ancestor_id, LIST_POSITION(string_split(c.path, '/'), CAST(p.entity_id AS VARCHAR)) AS place
FROM s_nodes c, s_nodes p WHERE list_contains(string_split(c.path, '/'), CAST(p.entity_id AS VARCHAR))"""))
def op_ancestors(spark, sf_dir):
    nodes = A.shop(spark, sf_dir, "s_nodes")
    known = nodes.select(F.col("entity_id").alias("ancestor_id"))
    pairs = lookup_join(tree.ancestors(nodes), known, "ancestor_id", "left_semi")
    return pairs.select("entity_id", "ancestor_id", (F.col("pos") + 1).alias("place"))


@query(A.with_shop(["s_items"], """
SELECT item_id, TRY_CAST(TRIM(u.e) AS BIGINT) AS rule_id
FROM s_items, UNNEST(string_split(applied_rule_ids, ',')) AS u(e) WHERE TRY_CAST(TRIM(u.e) AS BIGINT) IS NOT NULL"""))
def op_list_explode(spark, sf_dir):
    items = A.shop(spark, sf_dir, "s_items").select("item_id", "applied_rule_ids")
    return explode_ids(items, "applied_rule_ids", "rule_id").drop("applied_rule_ids")


@query(A.with_shop(["s_items"], """
SELECT sku, COUNT(*) FILTER (TRY_CAST(TRIM(u.e) AS BIGINT) IS NULL) AS bad_ids
FROM s_items, UNNEST(string_split(applied_rule_ids, ',')) AS u(e) WHERE TRIM(applied_rule_ids) <> ''
GROUP BY sku"""))
def bad_list_elements(spark, sf_dir):
    """How many list elements the explode leaves out, per sku."""
    items = A.shop(spark, sf_dir, "s_items").select("sku", "applied_rule_ids")
    elements = list_elements(items, "applied_rule_ids", "rule_id")
    return elements.groupBy("sku").agg(F.count_if(F.col("rule_id").isNull()).alias("bad_ids"))


@query("""SELECT o_orderkey, o_orderstatus, m.last_ship FROM orders
          LEFT JOIN (SELECT l_orderkey, MAX(l_shipdate) AS last_ship FROM lineitem GROUP BY 1) m
          ON m.l_orderkey = o_orderkey""")
def op_join_aggregated(spark, sf_dir):
    last = A.read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("last_ship")
    )
    return A.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").join(last, "o_orderkey", "left")


@query(A.with_shop(["s_rules", "s_coupons"], """
SELECT r.rule_id, COUNT(DISTINCT r.rule_id) AS plain_rows, COUNT(*) AS coupon_rows
FROM s_rules r LEFT JOIN s_coupons c ON c.rule_id = r.rule_id GROUP BY r.rule_id"""))
def op_fanout_join(spark, sf_dir):
    """Rows a rule has without and with its coupons, from counts alone."""
    rules, coupons = A.shop(spark, sf_dir, "s_rules"), A.shop(spark, sf_dir, "s_coupons")
    counts = coupons.groupBy("rule_id").agg(F.count("*").alias("n"))
    plain = rules.groupBy("rule_id").agg(F.count("*").alias("plain_rows"))
    return plain.join(counts, "rule_id", "left").select(
        "rule_id", "plain_rows", (F.col("plain_rows") * F.coalesce("n", F.lit(1))).alias("coupon_rows")
    )


# ---- aggregates --------------------------------------------------------------------------------


@query("""SELECT l_orderkey, STRING_AGG(CAST(l_linenumber AS VARCHAR), ' > ' ORDER BY l_linenumber) AS line_numbers
          FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) GROUP BY l_orderkey""")
def op_ordered_concat(spark, sf_dir):
    lines = A.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    text = C.ordered_concat("cast(l_linenumber as string)", "l_linenumber", V.LEVEL_SEPARATOR)
    return lines.groupBy("l_orderkey").agg(text.alias("line_numbers"))


@query("""SELECT user_id, STRING_AGG(event_type, ' | ' ORDER BY first_at, event_type) AS kinds FROM
          (SELECT user_id, event_type, MIN(ts) AS first_at FROM events GROUP BY 1, 2) GROUP BY user_id""")
def op_distinct_ordered_concat(spark, sf_dir):
    events = A.read(spark, sf_dir, "events")
    return distinct_ordered_concat(events, ["user_id"], "event_type", "ts", V.ENTRY_SEPARATOR, "kinds")


@query("""SELECT p_name, STRING_AGG(p_brand, ' | ' ORDER BY p_brand) AS brands
          FROM (SELECT DISTINCT p_name, NULLIF(p_brand, 'Brand#2') AS p_brand FROM part) GROUP BY p_name""")
def op_concat_groups(spark, sf_dir):
    brand = F.nullif("p_brand", F.lit("Brand#2")).alias("p_brand")
    pairs = A.read(spark, sf_dir, "part").select("p_name", brand).distinct()
    return pairs.groupBy("p_name").agg(C.ordered_concat("p_brand", "p_brand", V.ENTRY_SEPARATOR).alias("brands"))


@query("""SELECT user_id, MAX(value) FILTER (event_type = 'click') AS click, MAX(value) FILTER (event_type = 'view')
          AS "view", MAX(value) FILTER (event_type = 'purchase') AS purchase FROM events GROUP BY user_id""")
def op_conditional_pivot(spark, sf_dir):
    events = A.read(spark, sf_dir, "events").withColumn("store_id", F.lit(0))
    return eav.eav_pivot(events, {k: k for k in ("click", "view", "purchase")}, attribute="event_type", keys=("user_id",))


@query("""SELECT l_returnflag, l_linestatus, COUNT(*) AS lines, COUNT(DISTINCT l_orderkey) AS orders_cnt,
          CAST(SUM(CAST(l_extendedprice AS DECIMAL(20,4))) AS DOUBLE) AS revenue FROM lineitem GROUP BY 1, 2""")
def op_count_sum_distinct(spark, sf_dir):
    return A.read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("lines"), F.countDistinct("l_orderkey").alias("orders_cnt"),
        F.sum(F.col("l_extendedprice").cast("decimal(20,4)")).alias("revenue"),
    )


@query("""SELECT l_returnflag, CASE WHEN l_returnflag = 'R' THEN CAST(SUM(CAST(l_tax AS DECIMAL(12,4))) AS DOUBLE)
          WHEN l_returnflag <> 'R' THEN CAST(SUM(CAST(l_discount AS DECIMAL(12,4))) AS DOUBLE) END AS chosen
          FROM lineitem GROUP BY l_returnflag""")
def op_sum_choice(spark, sf_dir):
    flag = F.col("l_returnflag")
    tax, discount = (F.sum(F.col(c).cast("decimal(12,4)")) for c in ("l_tax", "l_discount"))
    return A.read(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.when(flag == "R", tax).when(flag != "R", discount).alias("chosen")
    )


@query("SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def op_distinct(spark, sf_dir):
    return A.read(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey").distinct()


# ---- top 1 per key, order ----------------------------------------------------------------------


@query("""SELECT * FROM lineitem QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC,
          l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
          l_linestatus) = 1""")
def op_top1_latest(spark, sf_dir):
    ties = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus"]
    return latest_per_key(A.read(spark, sf_dir, "lineitem"), ["l_orderkey"], [F.col("l_shipdate").desc()], ties)


@query("SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey")
def op_order_output(spark, sf_dir):
    return ordered(A.read(spark, sf_dir, "part").select("p_partkey", "p_name"), ["p_name", "p_partkey"])


# ---- set operations ----------------------------------------------------------------------------


@query("SELECT l_partkey AS id FROM lineitem UNION SELECT l_suppkey FROM lineitem")
def op_union_distinct(spark, sf_dir):
    lines = A.read(spark, sf_dir, "lineitem")
    return lines.select(F.col("l_partkey").alias("id")).union(lines.select("l_suppkey")).distinct()


@query("""SELECT l_partkey AS item, l_quantity AS quantity, 2 AS stock_id FROM lineitem WHERE l_returnflag = 'A'
          UNION ALL SELECT l_suppkey, l_quantity, 6 FROM lineitem WHERE l_returnflag = 'R'""")
def op_union_all_tagged(spark, sf_dir):
    lines = A.read(spark, sf_dir, "lineitem")
    two = lines.where("l_returnflag = 'A'").select(F.col("l_partkey").alias("item"), F.col("l_quantity").alias(
        "quantity"), F.lit(2).alias("stock_id"))
    six = lines.where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("item"), F.col("l_quantity").alias(
        "quantity"), F.lit(6).alias("stock_id"))
    return two.unionByName(six)


@query("""SELECT o_orderkey AS id, CAST(CAST(o_totalprice AS DECIMAL(20,4)) AS DOUBLE) AS amount,
          CAST(NULL AS TIMESTAMP) AS at FROM orders UNION ALL SELECT o_orderkey, NULL, o_orderdate FROM orders""")
def op_union_mixed(spark, sf_dir):
    """Two value types in one result: each keeps its own typed column."""
    orders = A.read(spark, sf_dir, "orders")
    amounts = orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("decimal(20,4)").alias(
        "amount"), F.lit(None).cast("timestamp_ntz").alias("at"))
    dates = orders.select(F.col("o_orderkey").alias("id"), F.lit(None).cast("decimal(20,4)").alias("amount"),
                          F.col("o_orderdate").alias("at"))
    return amounts.unionByName(dates)


# ---- scalar functions --------------------------------------------------------------------------


@query("SELECT o_orderkey, o_orderpriority || ' ' || NULLIF(o_orderstatus, 'P') AS joined FROM orders")
def op_concat_null(spark, sf_dir):
    joined = F.concat("o_orderpriority", F.lit(" "), F.nullif("o_orderstatus", F.lit("P")))
    return A.read(spark, sf_dir, "orders").select("o_orderkey", joined.alias("joined"))


@query("""SELECT p_partkey, COALESCE(CAST(NULLIF(CAST(p_size AS DECIMAL(12,4)), 7) AS VARCHAR), '') AS size_text
          FROM part""")
def op_coalesce_text(spark, sf_dir):
    size = F.nullif(F.col("p_size").cast("decimal(12,4)"), F.lit(7).cast("decimal(12,4)"))
    return A.read(spark, sf_dir, "part").select("p_partkey", C.text_or_empty(size).alias("size_text"))


@query("SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, COUNT(*) AS events_cnt FROM events GROUP BY 1")
def op_date_trunc(spark, sf_dir):
    return A.read(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("events_cnt"))


_LABELS = " ".join(f"WHEN {k} THEN '{v}'" for k, v in V.SHIPMENT_STATUS.items())


@query(f"SELECT p_partkey, CASE p_size {_LABELS} ELSE 'pending' END AS label FROM part")
def op_case_decode(spark, sf_dir):
    label = C.decode(F.col("p_size").cast("string"), V.SHIPMENT_STATUS, V.SHIPMENT_DEFAULT)
    return A.read(spark, sf_dir, "part").select("p_partkey", label.alias("label"))


@query("""SELECT p_partkey, CASE WHEN p_retailprice < 950 THEN 'low' WHEN p_retailprice < 1000 AND p_size > 25
          THEN 'middle' ELSE 'high' END AS band FROM part""")
def op_case_searched(spark, sf_dir):
    price = F.col("p_retailprice")
    band = F.when(price < 950, "low").when((price < 1000) & (F.col("p_size") > 25), "middle").otherwise("high")
    return A.read(spark, sf_dir, "part").select("p_partkey", band.alias("band"))


@query("""SELECT CAST(p_partkey AS INTEGER) AS "Part Id", p_name AS "Name", CAST(ROUND(CAST(p_retailprice * 10 AS
          DECIMAL(20,4)) * CAST(0.125 AS DECIMAL(4,3)), 2) AS DOUBLE) AS price, p_size > 0 AS "is sold" FROM part""")
def op_conform(spark, sf_dir):
    price = (F.col("p_retailprice") * 10).cast("decimal(20,4)") * F.lit("0.125").cast("decimal(4,3)")
    rows = A.read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("Part Id"), F.col("p_name").alias("Name"), price.alias("price"),
        F.when(F.col("p_size") > 0, 1).otherwise(0).alias("is sold"),
    )
    return conform(rows, "`Part Id` INT, Name VARCHAR(40), price DECIMAL(15,2), `is sold` BOOLEAN")
