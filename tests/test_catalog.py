from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cartwright.functions import fixed_values as V
from cartwright.operators import eav
from cartwright.plans import catalog, jobs
from cartwright.plans.settings import Settings
from tests import shop as S
from tests.rows import as_map, rows

T1, T2 = "2025-01-01 00:00:00", "2025-02-01 00:00:00"
PREFIXES = catalog.Prefixes("https://i.example.com", "https://o.example.com/", "https://s.example.com/")

CATALOG = {
    "products": (S.PRODUCTS, [
        (1, 10, "A", "simple", 4, T1, T1), (1, 11, "A2", "simple", 4, T1, T2), (2, 20, "B", "simple", 9, T1, T1),
        (3, 30, "C", "simple", None, T1, None), (1, 12, "A3", "simple", 4, T1, T2),
    ]),
    "product_texts": (S.TEXTS, [
        (12, 73, 0, "Lamp"), (12, 73, 1, "Lampe"), (12, 87, 0, "/a.jpg"), (12, 864, 0, "123"), (20, 5, 0, "x"),
        (30, 73, 1, "only other store"),
    ]),
    "product_decimals": (S.DECIMALS, [
        (12, 77, 0, "1.235500"), (12, 81, 0, "0.005"), (12, 82, 0, "1.5"), (12, 78, 0, "1.1"), (20, 78, 0, "9"),
    ]),
    "product_codes": (S.CODES, [
        (12, 97, 0, 1), (12, 99, 0, 4), (12, 139, 0, 60), (12, 900, 0, 404), (20, 97, 0, 7), (20, 139, 0, 61),
    ]),
    "product_datetimes": (S.DATETIMES, [(12, 79, 0, T1), (30, 80, 0, T2), (30, 79, 1, T1), (20, 11, 0, T1)]),
    "options": (S.OPTIONS, [(60, 0, "Brand A"), (60, 1, "Marke A"), (61, 1, "no default")]),
    "attribute_sets": (S.SETS, [(4, "Default")]),
    "stock_2": (S.STOCK, [("A3", 5, True), ("A3", 7, False), ("B", 1, None)]),
    "stock_6": (S.STOCK, [("A3", 2, False), ("Z", 3, True)]),
    "url_rewrites": (S.REWRITES, [
        (1, "product", "b/long"), (1, "product", "zz"), (1, "product", "aa"), (1, "category", "a"), (2, "cms", "p"),
        (2, "product", None),
    ]),
}


def tables(frame, shuffle=None, **over):
    out = {}
    for name, (ddl, data) in (CATALOG | over).items():
        data = list(data)
        if shuffle:
            shuffle.shuffle(data)
        out[name] = frame(ddl, data)
    return out


def test_pivot_keeps_rows_without_listed_attributes(frame):
    out = eav.eav_pivot(tables(frame)["product_texts"], V.VARCHAR_ATTRIBUTES)
    assert as_map(out, "row_id", "product_name", "image", "barcode", "other_language_name") == {
        12: ("Lamp", "/a.jpg", "123", None), 20: (None, None, None, None),
    }


def test_pivot_options(frame):
    t = tables(frame)
    out = eav.eav_pivot_options(t["product_codes"], t["options"], V.OPTION_ATTRIBUTES, Settings().decoded)
    assert as_map(out, "row_id", "status", "visibility", "brand", "warranty", "sold_by") == {
        12: ("Enabled", "Catalog, Search", "Brand A", None, None), 20: ("Unknown", None, None, None, None),
    }


def test_special_prices(frame):
    t = tables(frame)
    out = eav.special_prices(t["product_decimals"], t["product_datetimes"], V.SPECIAL_PRICE_ATTRIBUTES)
    assert as_map(out, "row_id", "special_price", "special_from", "special_to") == {
        12: ("1.1", T1, None), 20: ("9", None, None), 30: (None, None, T2),
    }


def test_stock(frame):
    t = tables(frame)
    out = eav.stock_by_location({2: t["stock_2"], 6: t["stock_6"]}, V.STOCK_COLUMNS)
    assert as_map(out, "sku", "online_qty", "is_salable_online", "smart_qty", "is_salable_smart") == {
        "A3": ("7", True, "2", False), "B": ("1", None, None, None), "Z": (None, None, "3", True),
    }


def test_report(frame):
    out = catalog.product_report(catalog.pieces(tables(frame)), PREFIXES)
    assert len(out.columns) == 28
    assert dict(out.dtypes)["Price"] == "decimal(25,2)" and dict(out.dtypes)["is salable smart"] == "boolean"
    got = {r["Id"]: r.asDict() for r in out.collect()}
    assert sorted(got) == [1, 2, 3]
    one = got[1]
    assert (one["SKU"], one["Weight"], str(one["Price"]), str(one["cost"])) == ("A3", "1.500000", "1.24", "0.01")
    assert one["Online Url Key"] == "https://o.example.com/aa" and one["Image"] == "https://i.example.com/a.jpg"
    assert one["Qty"] == one["Online Qty"] == 7 and one["Attribute Set"] == "Default"
    two = got[2]
    assert (two["Barcode"], two["Brand"], two["Weight"], two["Image"], two["Online Url Key"]) == ("", "", "", None, None)
    assert two["Attribute Set"] is None and two["Product Name"] is None


def test_report_does_not_depend_on_row_order(frame):
    plain = rows(catalog.product_report(catalog.pieces(tables(frame)), PREFIXES))
    assert rows(catalog.product_report(catalog.pieces(tables(frame, random.Random(5))), PREFIXES)) == plain


def test_text_over_its_declared_length_stops_the_report(frame):
    long = tables(frame, products=(S.PRODUCTS, [(1, 10, "A" * 256, "simple", 4, T1, T1)]))
    with pytest.raises(Exception, match="longer than 255"):
        catalog.product_report(catalog.pieces(long), PREFIXES).collect()


def test_catalog_job_publishes_its_nine_tables(spark, frame, tmp_path):
    t = tables(frame)
    assert set(t) == set(jobs.CATALOG_SOURCES)
    done = jobs.run_catalog(t, jobs.Mart(spark, "catalog_mart", str(tmp_path)), PREFIXES)
    assert len(done) == 9
    assert done["vw_product_urls"].count() == 4 and done["vw_product_base"].count() == 5
    direct = catalog.product_report(catalog.pieces(t), PREFIXES)
    assert done["vw_product"].dtypes == direct.dtypes and rows(done["vw_product"]) == rows(direct)
    alone = {
        "vw_product_attributes_varchar": eav.eav_pivot(t["product_texts"], V.VARCHAR_ATTRIBUTES),
        "vw_product_attributes_decimal": eav.eav_pivot(t["product_decimals"], V.DECIMAL_ATTRIBUTES),
        "vw_product_attributes_int_options": eav.eav_pivot_options(t["product_codes"], t["options"], V.OPTION_ATTRIBUTES, Settings().decoded),
        "vw_product_special_prices": eav.special_prices(t["product_decimals"], t["product_datetimes"], V.SPECIAL_PRICE_ATTRIBUTES),
    }
    for name, pivot in alone.items():  # the cuts of the one wide table hold what each pivot gives by itself
        assert done[name].dtypes == pivot.dtypes and rows(done[name]) == rows(pivot)


def test_attributes_read_listed_rows_only(frame):
    t = tables(frame)
    wide = catalog.attributes(t)
    assert not set(catalog.GROUPS) & set(wide.columns)
    assert {r["row_id"] for r in wide.collect()} <= {r["row_id"] for r in catalog.attributes(t, members=True).collect()}


def test_a_shop_with_other_ids(frame):
    """Every attribute id and one location moved: the same report as the shop the defaults describe."""
    moved = lambda t: t.withColumn("attribute_id", F.col("attribute_id") + 5000)
    t = tables(frame)
    other = {k: moved(v) if "attribute_id" in v.columns else v for k, v in t.items()}
    other["stock_9"] = other.pop("stock_2")
    up = lambda m: {k + 5000: v for k, v in m.items()}
    base = Settings()
    settings = Settings(texts=up(base.texts), decimals=up(base.decimals), options=up(base.options), decoded=up(base.decoded),
                        special_prices={k: v + 5000 for k, v in base.special_prices.items()}, stock={9: base.stock[2], 6: base.stock[6]})
    want = rows(catalog.product_report(catalog.pieces(t), PREFIXES))
    assert rows(catalog.product_report(catalog.pieces(other, settings), PREFIXES)) == want
