from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartwright.functions.columns import folded, folded_key, same_text, text_in, with_folded_keys
from cartwright.plans import rollup, sales
from tests import shop as S
from tests.rows import rows

ALIKE = [("GIFT", "gift"), ("ÉTÉ", "été"), ("İzmir", "i̇zmir"), ("ΟΔΟΣ", "οδος"), ("ΟΔΟΣ", "οδοσ"), ("οδος", "οδοσ"), ("ẞ", "ß"), ("Straße", "STRAẞE"), ("", "")]
APART = [("Straße", "STRASSE"), ("été", "ete"), ("İ", "i"), ("ı", "I"), ("é", "e\u0301"), ("gift", "gift "), ("ﬁ", "fi"), ("K", "k ")]


def test_the_rule(frame):
    pairs = frame("a STRING, b STRING, alike BOOLEAN", [(*p, True) for p in ALIKE] + [(*p, False) for p in APART])
    found = pairs.select("a", "b", "alike", (folded(F.col("a")) == folded(F.col("b"))).alias("same"),
                         (F.collate("a", "UTF8_LCASE") == F.collate("b", "UTF8_LCASE")).alias("collated"))
    assert [(r.a, r.b) for r in found.collect() if not (r.same == r.collated == r.alike)] == []


def test_folded_texts_are_equal_where_collated_ones_are(spark):
    """Every code point with its upper and lower case, alone and at the end of a word."""
    points = spark.range(0x20, 0x1F000).where("id NOT BETWEEN 55296 AND 57343").select(
        F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    others = F.explode(F.array(F.lower("c"), F.upper("c"), F.upper(F.lower("c")), F.lower(F.upper("c"))))
    pairs = points.select("c", others.alias("o")).select(F.inline(F.array(
        F.struct(F.col("c").alias("a"), F.col("o").alias("b")),
        F.struct(F.concat(F.lit("ab"), "c").alias("a"), F.concat(F.lit("AB"), "o").alias("b")))))
    wrong = pairs.where((folded(F.col("a")) == folded(F.col("b"))) != (F.collate("a", "UTF8_LCASE") == F.collate("b", "UTF8_LCASE")))
    assert pairs.count() > 800_000 and wrong.take(5) == []


@pytest.mark.parametrize("text,value,same", [("ΟΔΟΣ", "οδος", True), ("Café", "CAFÉ", True), ("Café", "cafe", False), ("x", None, None)])
def test_literals_follow_the_rule(frame, text, value, same):
    one = frame("v STRING", [(value,)])
    assert one.select(same_text(F.col("v"), text), text_in(F.col("v"), ["other", text])).first() == (same, same)


def test_coupons_and_sellers_follow_the_rule(frame):
    coupons = frame(S.COUPONS, [(2, "ΟΔΟΣ"), (1, "οδος"), (3, "été"), (4, "ETE"), (5, None)])
    rules = frame("rule_id BIGINT, rule_cart_type STRING", [(i, f"t{i}") for i in range(1, 6)])
    assert rows(sales.coupon_types(coupons, rules)) == [("ete", "t4"), ("été", "t3"), ("οδοσ", "t1")]
    wide = frame("transaction_date TIMESTAMP, main_category STRING, sub_category STRING, seller_name STRING, order_number STRING, "
                 "quantity INT, total_price DECIMAL(20,4), item_discount DECIMAL(20,4), retail_margin DECIMAL(20,4), marketplace_commission_amount DECIMAL(20,4)",
                 [("2030-01-01", "m", "s", n, str(i), 1, 1, 0, 0, 0) for i, n in enumerate(["ΟΔΟΣ", "οδος", "Été", "ÉTÉ", "Ete"])])
    found = rollup.sales_rollup(wide, "Our shop", "Our shop", by="seller")
    assert rows(found, "seller_name", "items_cnt") == [("Ete", 1), ("ÉTÉ", 2), ("ΟΔΟΣ", 2)]


def test_a_stored_key_is_filtered_in_the_scan_and_joined_as_it_is(spark, frame, tmp_path, capsys):
    coupons = frame(S.COUPONS, [(1, "Gift"), (2, "GIFT"), (3, "ΟΔΟΣ"), (4, None)])
    rules = frame("rule_id BIGINT, rule_cart_type STRING", [(i, f"t{i}") for i in range(1, 5)])
    with_folded_keys(coupons, "code").write.parquet(str(tmp_path / "coupons"))
    stored = spark.read.parquet(str(tmp_path / "coupons"))
    types = sales.coupon_types(stored, rules)
    assert rows(types) == rows(sales.coupon_types(coupons, rules)) == [("gift", "t1"), ("οδοσ", "t3")]
    types.explain("formatted")
    plan = capsys.readouterr().out
    assert "lower(" not in plan and "IsNotNull(code_key)" in plan
    stored.where(folded_key(stored, "code") == folded(F.lit("ΟΔΟΣ"))).explain("formatted")
    assert "EqualTo(code_key,οδοσ)" in capsys.readouterr().out
