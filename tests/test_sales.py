from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cartwright.operators import siblings
from cartwright.plans import jobs, rollup, sales
from cartwright.plans.settings import Settings
from tests import shop as S
from tests.rows import as_map, rows


def test_latest_shipment_takes_newest_header_and_last_track(frame):
    lines = frame(S.SHIPMENT_ITEMS, [(1, 10), (1, 11), (2, 12), (3, 99), (4, 13), (5, 14), (6, 15), (7, 15), (7, 16)])
    heads = frame(S.SHIPMENTS, [
        (10, "H10", 5, "2026-01-01 00:00:00"), (11, "H11", 4, "2026-01-02 00:00:00"),
        (12, "H12", None, "2026-01-01 00:00:00"), (13, "H13", 77, "2026-01-01 00:00:00"),
        (14, "H14", 404, "2026-01-01 00:00:00"), (15, "H15", 1, "2026-01-01 00:00:00"),
        (16, "H16", 2, "2026-01-01 00:00:00"),
    ])
    tracks = frame(S.TRACKS, [(1, 11, "b"), (2, 11, "a"), (3, 12, "c")])
    assert as_map(sales.latest_shipment(lines, heads, tracks), "order_item_id", "shipment_ids", "courier_names",
                  "shipment_statuses") == {
        1: ("H11", "a", "Shipped"), 2: ("H12", "c", "pending"), 3: (None, None, "pending"),
        4: ("H13", None, "pending"), 5: ("H14", None, "DUPLICATE_ERROR"), 6: ("H15", None, "Packed"),
        7: ("H16", None, "Ready_to_ship"),
    }


MARGIN_ITEMS = [
    S.item(1, 1, sku="A", product_id=1),
    S.item(2, 2, sku="A", product_id=1, product_type="configurable"),
    S.item(3, 3, sku="A", product_id=1, product_type="configurable", base_price=50),
    S.item(4, 3, sku="A", product_id=2, base_cost=7),
    S.item(5, 3, sku="A", product_id=3, base_cost=8),
    S.item(6, 4, sku="A", product_id=1, base_price=0, base_cost=1),
    S.item(7, 4, sku="A", product_id=2, product_type="configurable", base_price=9, qty_ordered=3),
    S.item(8, 5, sku="A", product_id=1, marketplace_seller="X"),
    S.item(9, 6, sku="A", product_id=1, product_type="configurable"),
    S.item(10, 6, sku="A", product_id=1),
    S.item(11, 7, sku=None, product_id=1, product_type="configurable"),
    S.item(12, 7, sku=None, product_id=2),
]


def test_item_margin_rules(frame):
    margins = as_map(sales.item_margin(frame(S.ITEMS, MARGIN_ITEMS)), "item_id", "margin")
    assert margins == {
        1: "8",  # (10 - 6) * 2
        2: None,  # configurable without sibling
        3: "86",  # (50 - 7) * 2, the lowest of two siblings
        4: "6", 5: "4",
        6: "24",  # price 0, dearer sibling: (9 - 1) * 3
        7: "24",  # configurable: (9 - 1) * 3
        9: None, 10: "8",  # same product is no sibling
        11: None, 12: "8",  # NULL skus match nothing
    }


@pytest.mark.parametrize("way", [
    lambda df, *rest: siblings.with_first_differing(df, *rest),
    lambda df, *rest: siblings.by_windows(df, *rest, ["o"]),
    lambda df, *rest: siblings.by_candidates(df, *rest),
], ids=["chosen", "windows", "candidates"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sibling_equals_brute_force(frame, seed, way):
    rng = random.Random(seed)
    data = [(i, rng.choice([1, 2, 3, None]), rng.choice("AB"), rng.choice([1, 2, 3, 4, None]), rng.choice(["s", "c", "v", None]), i * 10)
            for i in rng.sample(range(1000), 160)]
    df = frame("id INT, o INT, sku STRING, p INT, t STRING, cost INT", data)
    got = as_map(way(df, ["o", "sku"], "t", "p", "id", ["cost"], "s").select("id", F.col("s.id").alias("sid"), F.col("s.cost").alias("c")),
                 "id", "sid", "c")
    want = {}
    for a in data:
        others = [b[0] for b in data if a[4] and b[4] and a[3] and b[3] and a[1] and a[1:3] == b[1:3] and a[3] != b[3] and a[4] != b[4]]
        least = min(others, default=None)
        want[a[0]] = (least, None if least is None else least * 10)
    assert got == want


def test_siblings_in_hot_groups(spark, frame, skew_path, monkeypatch):
    """A third of the rows in one order: its groups are reduced before they move, the others are not; both are right."""
    rng = random.Random(7)
    data = [(i, 1 if i % 3 else rng.randrange(2, 90), rng.choice("AB"), rng.randrange(40), rng.choice("scv"), i) for i in range(900)]
    df = frame("id INT, o INT, sku STRING, p INT, t STRING, cost INT", data)
    rest = (["o", "sku"], "t", "p", "id", ["cost"], "s")
    took = []
    plain = siblings.by_candidates
    monkeypatch.setattr(siblings, "by_candidates", lambda df, *a: (took.append(df.count()), plain(df, *a))[1])
    got = siblings.with_first_differing(df, *rest, ["o"])
    assert took == [600]
    shown = lambda d: as_map(d.select("id", F.col("s.id").alias("sid")), "id", "sid")
    assert shown(got) == shown(siblings.by_windows(df, *rest, ["o"]))


def test_refund_flag(frame):
    items = frame(S.ITEMS, [
        S.item(1, 1, qty_refunded=1), S.item(2, 2, qty_refunded=1), S.item(3, 3, qty_refunded=1),
        S.item(4, 4, qty_refunded=1), S.item(5, 1, qty_refunded=0), S.item(6, 4, qty_refunded=None),
        S.item(7, 1, qty_refunded=1, parent_item_id=1), S.item(8, 5, qty_refunded=1),
    ])
    payments = frame(S.PAYMENTS, [(1, "valu"), (2, "CashOnDelivery"), (3, "cashondelivery"), (5, None)])
    shipments = frame("order_item_id BIGINT, shipment_statuses STRING", [(2, "Complete"), (3, "Shipped"), (8, "Complete")])
    flags = as_map(sales.refund_flag(items, shipments, payments), "order_item_id", "is_refunded")
    assert flags == {1: "True", 2: "True", 3: "False", 4: "False", 5: "False", 6: "False", 8: "True"}
    typed = as_map(sales.refund_flag(items, shipments, payments, as_text=False), "order_item_id", "is_refunded")
    assert typed == {k: v == "True" for k, v in flags.items()}


def test_shipping_subsidy(frame):
    items = frame(S.ITEMS, [
        S.item(1, 1, applied_rule_ids="1"), S.item(2, 1, applied_rule_ids="1, 2"),
        S.item(3, 1, applied_rule_ids="1,,2x"), S.item(4, 1, applied_rule_ids=""), S.item(5, 1),
        S.item(6, 1, applied_rule_ids="3,4,5"), S.item(7, 1, applied_rule_ids="1", paid_shipping_amount=1),
        S.item(8, 1, applied_rule_ids="2", paid_shipping_amount=None),
        S.item(9, 1, applied_rule_ids="1", created_at="2025-04-30 23:59:59"),
        S.item(10, 1, applied_rule_ids="1", created_at="2025-04-30 23:59:58"),
        S.item(11, 1, applied_rule_ids="1", parent_item_id=1),
    ])
    rules = frame(S.RULES, [(1, "C", "Commercial", 0), (2, "M", "marketing", 0), (3, "O", "other", 0),
                            (4, "N", None, 0), (5, "D", "commercial", 5)])
    coupons = frame(S.COUPONS, [(1, "a"), (1, "b")])
    plain = sales.shipping_subsidy(items, rules)
    assert rows(plain, "item_id", "applied_rule_id", "commercial_shipping", "marketing_shipping") == sorted([
        (1, 1, "30", "0"), (2, 1, "30", "0"), (2, 2, "0", "30"), (3, 1, "30", "0"), (6, 3, "0", "0"),
        (6, 4, "0", "0"), (8, 2, "0", "30"), (9, 1, "30", "0"),
    ], key=repr)
    doubled = sales.shipping_subsidy(items, rules, coupons, per_coupon=True)
    assert [r[0] for r in rows(doubled, "item_id", "applied_rule_id")] == [1, 1, 2, 2, 2, 3, 3, 6, 6, 8, 9, 9]
    assert as_map(sales.subsidy_per_item(plain), "item_id", "commercial_shipping", "marketing_shipping")[2] == ("30", "30")


def test_payment_fee(frame):
    methods = ["cashondelivery", "ocean_NBEGate_installments", "ocean_MisrGate_installments",
               "ocean_QNBGate_installments", "AMAN", "checkmo", None]
    orders = frame(S.ORDERS, [S.order(i) for i in range(1, 8)] + [
        S.order(8, paymentfees=None), S.order(9, amount_to_collect=None), S.order(10)])
    payments = frame(S.PAYMENTS, [(i + 1, m) for i, m in enumerate(methods)] + [(8, "cashondelivery"), (9, "valu")])
    assert as_map(sales.payment_fee(orders, payments), "entity_id", "payment_fees") == {
        1: "11", 2: "12", 3: "13", 4: "14", 5: "15", 6: "0", 7: "0", 8: None, 9: "0",
    }


def test_payment_fee_of_other_methods(frame):
    orders = frame(S.ORDERS, [S.order(i) for i in range(1, 4)])
    payments = frame(S.PAYMENTS, [(1, "Till"), (2, "later"), (3, "cashondelivery")])
    settings = Settings(fee_columns={"till": "nbeinstallmentfees"}, pay_later=["LATER"])
    assert as_map(sales.payment_fee(orders, payments, settings), "entity_id", "payment_fees") == {1: "12", 2: "15", 3: "0"}


def test_order_total(frame):
    orders = frame(S.ORDERS, [S.order(1), S.order(2), S.order(3), S.order(4), S.order(5, base_grand_total=None),
                              S.order(6, base_customer_balance_amount=None), S.order(7)])
    payments = frame(S.PAYMENTS, [(1, "Free"), (2, "free"), (3, "valu"), (5, "valu"), (6, "FREE"), (7, None)])
    assert as_map(sales.order_total(orders, payments), "entity_id", "order_total") == {
        1: "5", 2: "5", 3: "105", 4: "0", 5: "5", 6: "0", 7: "0",
    }


def test_customer_balance(frame):
    balances = frame(S.BALANCES, [(1, 5), (2, 0), (3, -1), (4, 7), (5, 8)])
    customers = frame(S.CUSTOMERS, [(1, "Ann", "Lee", "a@x", "Main"), (5, "Bob", None, "b@x", "Main")])
    out = sales.customer_balance(balances, customers)
    assert out.columns == ["user_id", "balance_amount", "customer_name", "user_email", "website"]
    assert rows(out) == [(1, "5", "Ann Lee", "a@x", "Main"), (4, "7", None, None, None), (5, "8", None, "b@x", "Main")]


def test_returns(frame):
    t = S.wide_tables(frame)
    args = [t[k] for k in ("shipment_items", "return_items", "return_heads", "return_codes", "options")]
    out = sales.returns(*args)
    assert rows(out, "order_item_id", "return_item_id", "quantity_returned", "rma_created_at", "rma_status",
                "return_reason", "shipment_lines") == [
        (1, 1, "1", "2026-02-01 00:00:00", "open", "", 2),
        (1, 2, "2", "2026-02-02 00:00:00", "closed", "Broken", 2),
        (5, 4, "3", None, None, "", 1),
    ]
    assert [r[0] for r in rows(sales.returns(*args, per_shipment_line=True), "return_item_id")] == [1, 1, 2, 2, 4]


def test_status_trail(frame):
    history = frame(S.HISTORY, [
        (1, "new", "2026-01-01 00:00:00"), (1, "paid", "2026-01-02 00:00:00"), (1, "new", "2026-01-03 22:00:00"),
        (2, "b", "2026-01-01 00:00:00"), (2, "a", "2026-01-01 00:00:00"), (3, None, "2026-01-01 00:00:00"),
    ])
    assert rows(sales.status_trail(history)) == [
        (1, "new | paid", "2026-01-04 01:00:00"), (2, "a | b", "2026-01-01 03:00:00"),
        (3, None, "2026-01-01 03:00:00"),
    ]


LEFT_OUT = sales.Subtrees(prefixes=["1/2/20"], ids=[20], parent_ids=[20], names=["installment"])


def wide(t):
    return sales.orders_items_wide(t, sales.pieces(t, LEFT_OUT), "House")


def test_wide_has_one_row_per_top_item_of_a_known_order(frame):
    out = wide(S.wide_tables(frame))
    assert out.columns == sales.WIDE_COLUMNS and len(out.columns) == 58
    assert [r[0] for r in rows(out, "item_id")] == [1, 2, 3, 5]


def test_wide_values(frame):
    out = wide(S.wide_tables(frame))
    first = out.where("item_id = 1").collect()[0].asDict()
    want = {
        "order_number": "O1", "transaction_date": "2026-01-06 01:30:00", "updated_at": "2026-01-06 12:00:00",
        "customer_name": "Ann Lee", "order_status": "pending | complete", "status_changed_at": "2026-01-03 03:00:00",
        "promo_code": "Gift", "coupon_type": "Marketing", "order_total": "105", "order_fees": "11",
        "retail_margin": "12", "retail_margin_after_discount": "10", "marketplace_commission_amount": "2.5",
        "is_refunded": "True", "commercial_shipping_fee": "30", "marketing_shipping_fee": "30",
        "brand_name": "Brand A", "variant_id": "Red", "seller_name": "House",
        "product_category_name": "House | House > Lamps > Desk", "payment_method": "cashondelivery", "area": "Abe",
        "city": "R2", "shipment_ids": "H11", "courier_names": "New courier", "shipment_statuses": "Complete",
        "quantity_returned": "2", "rma_created_at": "2026-02-02 00:00:00", "rma_item_status": "Approved",
        "rma_status": "closed", "rma_return_reason": "Broken",
    }
    from tests.rows import tidy

    assert {k: tidy(first[k]) for k in want} == want
    others = as_map(out, "item_id", "seller_name", "retail_margin", "order_fees", "order_total", "customer_name",
                    "shipment_statuses", "product_category_name", "retail_margin_after_discount")
    assert others[2][:2] == ("House", "12") and others[2][6] is None
    assert others[3][:2] == ("Shop X", None)
    assert others[5] == ("Shop Y", None, "0", "5", None, "pending", "House", None)


@pytest.mark.parametrize("seed", [11, 12])
def test_wide_does_not_depend_on_row_order(frame, seed):
    assert rows(wide(S.wide_tables(frame, random.Random(seed)))) == rows(wide(S.wide_tables(frame)))


def test_wide_is_the_same_when_hot_keys_are_spread(frame, skew_path, conf):
    conf("spark.sql.shuffle.partitions", "16")
    spread = rows(wide(S.wide_tables(frame)))
    conf("spark.cartwright.skewMinBytes", str(1 << 40))
    assert rows(wide(S.wide_tables(frame))) == spread


def test_wide_is_the_same_by_keys_when_ids_repeat_or_are_null(frame, conf):
    t = S.wide_tables(frame)
    more = [(None, *S.item(9, 1, product_id=100)[1:]), S.item(1, 1, product_id=None), S.item(1, 2, product_id=100), S.item(7, None),
            S.item(2, 1, product_id=101), S.item(2, 1, product_id=101), (None, *S.item(9, 2, product_id=None)[1:])]
    t["items"] = t["items"].unionByName(frame(S.ITEMS, more))
    t["orders"] = t["orders"].unionByName(frame(S.ORDERS, [S.order(2, coupon_code="gift"), (None, *S.order(9, coupon_code="X")[1:])]))
    conf("spark.cartwright.skewMinBytes", str(1 << 40))
    plain = rows(wide(t))
    conf("spark.sql.shuffle.partitions", "16")
    conf("spark.cartwright.skewMinBytes", "0")
    assert rows(wide(t)) == plain
    assert (len(plain), sum(r[11] == "Marketing" for r in plain)) == (13, 10)


def test_rollup(frame):
    ddl = ("order_number STRING, transaction_date TIMESTAMP_NTZ, main_category STRING, sub_category STRING, "
           "seller_name STRING, quantity DECIMAL(12,4), total_price DECIMAL(20,4), item_discount DECIMAL(20,4), "
           "retail_margin DECIMAL(34,8), marketplace_commission_amount DECIMAL(36,2)")
    data = [
        ("O1", "2026-01-01 00:00:01", "H", "L", "house", 1, 10, 1, 4, 9),
        ("O1", "2026-01-01 10:00:00", "H", "L", "House", 1, 20, 1, 5, 9),
        ("O2", "2026-01-01 10:00:00", "H", "L", "Shop X", 1, 30, 1, 5, 7),
        ("O3", "2026-01-01 10:00:00", "H", "L", "Shop Y", 2, 40, 1, 5, 8),
        ("O4", "2026-01-01 00:00:00", "H", "L", "House", 1, 99, 1, 5, 8),
        ("O5", "2026-01-02 00:00:00", None, "L", None, 1, 50, 1, 5, 8),
    ]
    by_class = rollup.sales_rollup(frame(ddl, data), "house", "House store", by="class")
    got = as_map(by_class, "seller_class", "items_cnt", "orders_cnt", "qty_sum", "revenue_sum", "margin_sum")
    assert got == {
        "House store": (2, 1, "2", "30", "9"), "MarketPlace": (2, 2, "3", "70", "15"), None: (1, 1, "1", "50", None),
    }
    by_seller = rollup.sales_rollup(frame(ddl, data), "house", "House store")
    assert [r for r in rows(by_seller, "seller_class", "seller_name", "revenue_sum") if r[0] == "MarketPlace"] == [
        ("MarketPlace", "Shop X", "30"), ("MarketPlace", "Shop Y", "40")]
    with pytest.raises(ValueError):
        rollup.sales_rollup(frame(ddl, data), "house", "House store", by="day")


def test_rollup_totals_equal_the_wide_tables(frame):
    out = wide(S.wide_tables(frame))
    total = rollup.sales_rollup(out, "house", "House store", start="2000-01-01 00:00:00").agg(
        F.sum("items_cnt"), F.sum("qty_sum"), F.sum("revenue_sum"), F.sum("discount_sum"))
    direct = out.agg(F.count("*"), F.sum("quantity"), F.sum("total_price"), F.sum("item_discount"))
    assert rows(total) == rows(direct)


@pytest.mark.parametrize("buckets", [None, 4])
def test_sales_job_publishes_its_ten_tables(spark, frame, tmp_path, buckets):
    t = S.wide_tables(frame) | {"balances": frame(S.BALANCES, [(1, 5)]), "customers": frame(S.CUSTOMERS, [])}
    assert set(t) == set(jobs.SALES_SOURCES)
    mart = jobs.Mart(spark, "sales_mart", str(tmp_path), buckets)
    done = jobs.run_sales(t, mart, "House", LEFT_OUT)
    assert len(done) == 11
    assert done["bad_list_elements"].columns == ["item_id", "bad_ids"]
    assert rows(spark.table("sales_mart.orders_items_denorm")) == rows(wide(t))
    assert rows(done["sales_refunded"]) == [(1, "True"), (2, "False"), (3, "False"), (5, "False"), (6, "False")]
    assert done["customer_balance"].count() == 1 and done["order_total"].count() == 3


def test_source_names():
    assert jobs.source_names(jobs.SALES_SOURCES, "x")["return_heads"] == "x_rma"
    assert jobs.source_names(jobs.SALES_SOURCES, "")["orders"] == "sales_order"


def test_ids_beyond_32_bits_keep_their_subsidy(frame):
    items = frame("item_id BIGINT, order_id BIGINT, parent_item_id BIGINT, created_at TIMESTAMP_NTZ, applied_rule_ids STRING, "
                  "original_shipping_amount DECIMAL(20,4), paid_shipping_amount DECIMAL(20,4)",
                  [(1, 1, None, "2030-01-01 00:00:00", "3000000000,5,x", "9.0000", None)])
    rules = frame("rule_id BIGINT, name STRING, rule_cart_type STRING, discount_amount DECIMAL(20,4)",
                  [(3000000000, "big", "Commercial", "0.0000"), (5, "small", "Commercial", "0.0000")])
    assert rows(sales.shipping_subsidy(items, rules), "applied_rule_id") == [(3000000000,), (5,)]
    assert rows(sales.bad_list_elements(items)) == [(1, 1)]


def test_codes_that_are_no_numbers_take_the_default(frame):
    from pyspark.sql import functions as F

    from cartwright.functions.columns import decode

    codes = frame("c STRING", [("1",), ("x",), ("01",), (None,), ("7",), ("",)])
    got = [r[0] for r in codes.select(decode(F.col("c"), {1: "one"}, "pending")).collect()]
    assert got == ["one", "pending", "one", "pending", "pending", "pending"]


def test_sellers_are_one_whatever_their_case(frame):
    from cartwright.plans.rollup import sales_rollup

    wide = frame("transaction_date TIMESTAMP_NTZ, main_category STRING, sub_category STRING, seller_name STRING, order_number STRING, "
                 "quantity INT, total_price INT, item_discount INT, retail_margin INT, marketplace_commission_amount INT",
                 [("2030-01-01 00:00:00", "m", "s", name, "o1", 1, 2, 0, 1, 1) for name in ("House", "HOUSE", "Other", "other")])
    got = rows(sales_rollup(wide, "house", "House store"), "seller_class", "seller_name", "items_cnt", "orders_cnt")
    assert got == [("House store", "HOUSE", 2, 1), ("MarketPlace", "Other", 2, 1)]


def test_source_names_given_by_the_caller():
    plain = jobs.source_names(jobs.SALES_SOURCES)
    assert plain["balances"] == "customerbalance" and plain["orders"] == "sales_order"
    named = jobs.source_names(jobs.SALES_SOURCES, "shop", {"orders": "dw.orders"})
    assert named["balances"] == "shop_customerbalance" and named["orders"] == "dw.orders" and named["items"] == "sales_order_item"
    with pytest.raises(ValueError, match="odrers"):
        jobs.source_names(jobs.SALES_SOURCES, names={"odrers": "x"})


@pytest.mark.parametrize("by", ["class", "seller"])
def test_rollup_is_the_same_when_sums_move_apart(frame, by):
    ddl = ("order_number STRING, transaction_date TIMESTAMP_NTZ, main_category STRING, sub_category STRING, seller_name STRING, "
           "quantity DECIMAL(12,4), total_price DECIMAL(20,4), item_discount DECIMAL(20,4), retail_margin DECIMAL(34,8), "
           "marketplace_commission_amount DECIMAL(36,2)")
    rng = random.Random(5)
    data = [(rng.choice(["O1", "O2", "O3", None]), f"2026-01-0{rng.randrange(1, 3)} 10:00:00", rng.choice(["H", None]), "L",
             rng.choice(["House", "Shop X", "shop x", None]), *[rng.choice([None, i, 1]) for _ in range(5)]) for i in range(200)]
    data.append((None, "2026-01-09 10:00:00", "H", "L", None, None, None, None, None, None))
    plain = rollup.sales_rollup(frame(ddl, data), "house", "House store", by=by)
    apart = rollup.sales_rollup(frame(ddl, data), "house", "House store", by=by, few_groups=True)
    assert apart.dtypes == plain.dtypes and rows(apart) == rows(plain)
