"""Shapes of the physical plans that matter at scale."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver
from cartwright.operators.siblings import by_candidates
from cartwright.registry import adapters, marts
from cartwright.session import shared_folder

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(marts.QUERIES.keys() - {"csv_export", "publish_table"}))
def test_no_pairing_and_no_python(spark, name):
    seen = [node.nodeName() for node in nodes(marts.QUERIES[name](spark, SF_DIR))]
    bad = re.compile("NestedLoop|CartesianProduct|Python|Pandas|Arrow|ExistingRDD")
    assert not [n for n in seen if bad.search(n)]


def test_top_one_is_limited_before_the_shuffle(spark):
    text = plan(driver.queries()["op_top1_latest"](spark, SF_DIR))
    assert re.search(r"WindowGroupLimit.*Final[\s\S]*Exchange[\s\S]*WindowGroupLimit.*Partial", text)


def test_siblings_take_one_scan_and_one_shuffle(spark, conf):
    """Were two scans and four shuffles."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = driver.queries()["item_margin"](spark, SF_DIR)
    assert shuffles(df) == ["order_id, sku"] and scans(df) == ["lineitem"]


def test_sibling_candidates_are_limited_before_the_shuffle(spark):
    items = adapters.shop(spark, SF_DIR, "s_items")
    text = plan(by_candidates(items, ["order_id", "sku"], "product_type", "product_id", "item_id", ["base_cost"], "sibling"))
    assert re.search(r"WindowGroupLimit.*2, Final[\s\S]*Exchange[\s\S]*WindowGroupLimit.*2, Partial", text)


def test_filters_and_columns_reach_the_scan(spark, conf):
    conf("spark.sql.maxMetadataStringLength", "2000")
    text = plan(driver.queries()["op_filter_compare"](spark, SF_DIR))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "EqualTo(o_orderstatus,F)" in pushed and "GreaterThanOrEqual(o_orderdate" in pushed
    assert "o_custkey" not in text


def test_rollup_bounds_the_order_scan(spark, conf):
    conf("spark.sql.maxMetadataStringLength", "2000")
    assert "GreaterThanOrEqual(o_orderdate" in plan(driver.entry(spark))


def nodes(df) -> list:
    """Every operator of the plan, whatever branch it is on."""
    seen, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        seen.append(node)
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return seen


def shuffles(df) -> list[str]:
    """The keys of every shuffle."""
    texts = [n.simpleString(500) for n in nodes(df) if n.nodeName() == "Exchange"]
    return [re.sub(r"#\d+L?", "", re.search(r"partitioning\((.*), \d+\)", t).group(1)) for t in texts]


def scans(df) -> list[str]:
    """The files read, once for every scan."""
    texts = [n.simpleString(500) for n in nodes(df) if n.nodeName().startswith("Scan")]
    return [re.search(r"Location: \w+(?:\(.*?\))? ?\[.*/(\w+?)(?:\.parquet)?\]", t).group(1) for t in texts]


def fact_side(df) -> list[str]:
    """Operators from the root down the left side: what happens to the fact's rows."""
    node = df._jdf.queryExecution().executedPlan()
    seen = []
    while True:
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        seen.append(node.simpleString(200))
        if node.children().isEmpty():
            return seen
        node = node.children().head()


def test_wide_shuffles_the_items_once_per_key(spark, conf):
    """Without any broadcast: the items move for the order, item and product joins, and not in between."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    steps = fact_side(driver.queries()["orders_items_wide"](spark, SF_DIR))
    keys = [re.search(r"hashpartitioning\((\w+)#", s).group(1) for s in steps if s.startswith("Exchange")]
    assert keys == ["product_id", "item_id", "order_id"]
    assert sum(s.startswith("SortMergeJoin") for s in steps) == 5 and sum(s.startswith("Window ") for s in steps) == 3


def test_the_whole_wide_plan(spark, conf, monkeypatch):
    """The items are read once for their row, their siblings and their order, and once, narrow, for the subsidies. With
    siblings joined back and item ids gathered first it was five times; the whole plan had 60 shuffles."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    files = dict.fromkeys(marts.WIDE_TABLES.values())
    for name in files:  # a file per shop table tells its scans apart
        files[name] = f"{shared_folder(spark, 'shop')}/{name}"
        adapters.shop(spark, SF_DIR, name).write.parquet(files[name])
    monkeypatch.setattr(marts.A, "shop", lambda spark, _, name: spark.read.parquet(files[name]))
    df = marts.wide(spark, SF_DIR)
    read, moved = scans(df), shuffles(df)
    assert read.count("s_items") == 2 and read.count("s_orders") == 1 and read.count("s_history") == 1
    assert moved.count("order_id") == 1 and not [m for m in moved if m.startswith("order_id, ")]
    assert len(moved) < 60


def test_report_shuffles_products_once_per_key(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    steps = fact_side(driver.queries()["product_report"](spark, SF_DIR))
    keys = [re.search(r"hashpartitioning\((\w+)#", s).group(1) for s in steps if s.startswith("Exchange")]
    assert keys == ["attribute_set_id", "sku", "row_id", "entity_id"]


def test_the_whole_report_plan(spark, conf):
    """Every value table is read once and all attributes are grouped in one shuffle; five pivots took thirteen shuffles."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    moved = shuffles(driver.queries()["product_report"](spark, SF_DIR))
    assert sorted(moved) == ["attribute_set_id"] * 2 + ["entity_id"] * 2 + ["option_id"] + ["row_id"] * 2 + ["sku"] * 2 + ["value"]


def test_distinct_count_is_two_level(spark):
    text = plan(driver.queries()["op_count_sum_distinct"](spark, SF_DIR))
    assert text.count("Exchange hashpartitioning") == 2 and "Expand" not in text


def carried(df, column: str) -> int:
    """How many shuffles carry a column."""
    outputs = [n.output() for n in nodes(df) if n.nodeName() == "Exchange"]
    return sum(column in [out.apply(i).name() for i in range(out.size())] for out in outputs)


def test_wide_columns_of_large_tables_move_once(spark, conf):
    """Were three moves of an item's columns and four of an order's, two of them once per item."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.cartwright.skewMinBytes", "1")
    df = driver.queries()["orders_items_wide"](spark, SF_DIR)
    assert {c: carried(df, c) for c in ("main_category", "sub_category", "checkout_from", "promo_code")} == {
        "main_category": 1, "sub_category": 1, "checkout_from": 1, "promo_code": 0}
    assert shuffles(df).count("order_id") == 1 and scans(df)
    rolled = driver.queries()["rollup_of_wide"](spark, SF_DIR)
    assert carried(rolled, "base_row_total") == 1 and carried(rolled, "total_price") == 0


def test_large_trails_move_once(spark, conf):
    """Were two shuffles, by key and status and then by key."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.cartwright.skewMinBytes", "1")
    assert shuffles(driver.queries()["status_trail"](spark, SF_DIR)) == ["parent_id"]


def test_large_wide_rows_move_narrow(spark, conf):
    """Were 24 bytes and more for each money column; product texts moved twice, by item and by order."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.cartwright.skewMinBytes", "1")
    df = driver.queries()["orders_items_wide"](spark, SF_DIR)
    assert {c: carried(df, c) for c in ("base_tax_amount", "customer_email", "base_cost", "courier_names")} == {
        "base_tax_amount": 0, "customer_email": 0, "base_cost": 0, "courier_names": 0}
    moved = [(n.simpleString(500), n.output()) for n in nodes(df) if n.nodeName() == "Exchange"]
    by_item = [out for text, out in moved if "partitioning(item_id" in text]
    assert by_item and not [out for out in by_item if "category_path" in [out.apply(i).name() for i in range(out.size())]]


def test_shipment_lines_are_counted_where_the_newest_shipments_are(spark, conf):
    """Were a shuffle by item of all shipment lines for their number, and one for the newest of them."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")  # shows the shuffles that are used again before anything runs
    df = driver.queries()["orders_items_wide"](spark, SF_DIR)
    assert shuffles(df).count("order_item_id") == 2  # the lines, and the returns


def test_orders_are_counted_without_the_sums(spark, conf):
    """Were decimal sums beside every order of a group; now a row that moves for an order holds none."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    keys = [k for k in shuffles(driver.queries()["rollup_of_wide"](spark, SF_DIR)) if k.startswith("trx_date")]
    group = "trx_date, main_category, sub_category, seller_class"
    assert keys == [group, f"{group}, _orders, order_number"]


def test_the_rollup_of_the_wide_table_reads_all_its_tables(spark, conf):
    """Sides of which the rollup shows nothing are still found: products with their categories, shipments and returns."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.cartwright.skewMinBytes", "1")
    df = driver.queries()["rollup_of_wide"](spark, SF_DIR)
    assert set(scans(df)) >= {"lineitem", "orders", "part", "customer", "supplier", "nation", "region"}
    assert {"product_id", "item_id", "order_item_id", "rma_entity_id", "return_item_id"} <= set(shuffles(df))
