"""Catalogue tables: product addresses and the typed product report."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.functions import fixed_values as V
from cartwright.functions.columns import text_or_empty
from cartwright.operators.dedupe import latest_per_key
from cartwright.operators.eav import Long, coded_rows, coded_values, eav_wide, stock_by_location
from cartwright.operators.joins import lookup_join
from cartwright.plans.settings import Settings
from cartwright.sources.tables import conform


def product_base(products: DataFrame) -> DataFrame:
    return products.select("entity_id", "sku", "type_id", "attribute_set_id", "created_at", "updated_at", "row_id")


def product_urls(rewrites: DataFrame) -> DataFrame:
    """(entity_id, request_path) of product addresses."""
    return rewrites.where(F.col("entity_type") == "product").select("entity_id", "request_path")


def one_url(urls: DataFrame) -> DataFrame:
    """The shortest path per product, the first by alphabet among equals."""
    best = F.min(F.struct(F.length("request_path").alias("len"), "request_path")).alias("best")
    usable = urls.where(F.col("request_path").isNotNull())
    return usable.groupBy("entity_id").agg(best).select("entity_id", F.col("best.request_path").alias("request_path"))


@dataclass(frozen=True)
class Prefixes:
    """Address prefixes of images and of the two shop fronts."""

    image: str
    online: str
    store: str


@dataclass(frozen=True)
class Pieces:
    """The tables the product report is made of, built here or read back after they were published."""

    base: DataFrame
    attributes: DataFrame
    sets: DataFrame
    stock: DataFrame
    urls: DataFrame


#: Flags of ``attributes``: which group of its columns a row id belongs to.
GROUPS = ("in_texts", "in_decimals", "in_options", "in_prices")


def group_columns(settings: Settings = Settings()) -> dict[str, list[str]]:
    """The columns of ``attributes`` by group."""
    columns = (settings.texts.values(), settings.decimals.values(),
               [name for name, _, _ in settings.decoded.values()] + list(settings.options.values()), settings.special_prices)
    return {group: list(names) for group, names in zip(GROUPS, columns)}


def attributes(t: Mapping[str, DataFrame], settings: Settings = Settings(), members: bool = False) -> DataFrame:
    """(row_id, every attribute of the report): texts, decimals, option texts and labels, and special prices, from one
    scan of each value table and one shuffle for all of them. With ``members``, a flag per group tells which row ids that
    group's own pivot has."""
    special, kept = settings.special_prices, F.col("store_id") == 0
    dates = {c: special[c] for c in ("special_from", "special_to")}
    by_name = lambda columns: {name: k for k, name in columns.items()}
    coded = coded_values(coded_rows(t["product_codes"], t["options"], list(settings.options)), settings.decoded)
    return eav_wide([
        Long(t["product_texts"].where(kept), by_name(settings.texts), {"in_texts": F.lit(True)}),
        Long(t["product_decimals"].where(kept), by_name(settings.decimals) | {"special_price": special["special_price"]},
             {"in_decimals": F.lit(True), "in_prices": F.col("attribute_id") == special["special_price"]}),
        Long(t["product_datetimes"].where(kept), dates, {"in_prices": F.col("attribute_id").isin(list(dates.values()))}),
        Long(coded, {name: k for k, (name, _, _) in settings.decoded.items()} | by_name(settings.options), {"in_options": F.lit(True)}),
    ], members=members)


def stock(t: Mapping[str, DataFrame], settings: Settings = Settings()) -> DataFrame:
    return stock_by_location({k: t[f"stock_{k}"] for k in settings.stock}, settings.stock)


def attribute_sets(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["attribute_sets"].select("attribute_set_id", "attribute_set_name")


def pieces(t: Mapping[str, DataFrame], settings: Settings = Settings()) -> Pieces:
    return Pieces(product_base(t["products"]), attributes(t, settings), attribute_sets(t), stock(t, settings),
                  product_urls(t["url_rewrites"]))


def product_report(made: Pieces, prefixes: Prefixes) -> DataFrame:
    """One row per product entity in the declared columns and types.

    The newest version of each entity is chosen before any join (highest row id on equal times), so every
    join is one row to at most one row. The addresses are joined while the products still lie by entity;
    the attributes are one table, grouped by row id, and meet the products on it without another shuffle.
    """
    base = latest_per_key(
        made.base, ["entity_id"], [F.col("updated_at").desc_nulls_last(), F.col("row_id").desc()], []
    )
    described = base.join(one_url(made.urls), "entity_id", "left").join(made.attributes, "row_id", "left")
    wide = lookup_join(described, made.stock, "sku", "left", made.base.select("sku"), ["entity_id"])
    wide = lookup_join(
        wide, made.sets, "attribute_set_id", "left", made.base.select("attribute_set_id"), ["entity_id"]
    )
    online_qty, path = F.col("online_qty"), F.col("request_path")
    columns = {
        "Id": F.col("entity_id"),
        "SKU": F.col("sku"),
        "Type": F.col("type_id"),
        "Barcode": text_or_empty(F.col("barcode")),
        "Attribute Set": F.col("attribute_set_name"),
        "Brand": text_or_empty(F.col("brand")),
        "Warranty": text_or_empty(F.col("warranty")),
        "Product Name": F.col("product_name"),
        "Other Language Name": text_or_empty(F.col("other_language_name")),
        "Sold By": text_or_empty(F.col("sold_by")),
        "Weight": text_or_empty(F.col("weight")),
        "Status": F.col("status"),
        "Visibility": F.col("visibility"),
        "Price": F.col("price"),
        "special_price": F.col("special_price"),
        "special_from": F.col("special_from"),
        "special_to": F.col("special_to"),
        "cost": F.col("cost"),
        "Qty": online_qty,
        "Online Qty": online_qty,
        "is salable online": F.col("is_salable_online"),
        "Smart Store Qty": F.col("smart_qty"),
        "is salable smart": F.col("is_salable_smart"),
        "created_at": F.col("created_at"),
        "updated_at": F.col("updated_at"),
        "Image": F.concat(F.lit(prefixes.image), "image"),
        "Online Url Key": F.concat(F.lit(prefixes.online), path),
        "rstore Url key": F.concat(F.lit(prefixes.store), path),
    }
    return conform(wide.select(*[c.alias(n) for n, c in columns.items()]), V.PRODUCT_REPORT_DDL)
