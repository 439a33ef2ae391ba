"""The two table-building jobs: every derived table, built from the source tables and published."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from cartwright.plans import catalog, sales
from cartwright.plans.settings import Settings
from cartwright.sources.tables import publish

# Logical name -> source table. Names in PREFIXED carry the shop platform's own prefix in the source.
SALES_SOURCES = {
    "orders": "sales_order",
    "items": "sales_order_item",
    "payments": "sales_order_payment",
    "addresses": "sales_order_address",
    "status_history": "sales_order_status_history",
    "shipment_items": "sales_shipment_item",
    "shipments": "sales_shipment",
    "shipment_tracks": "sales_shipment_track",
    "rules": "salesrule",
    "coupons": "salesrule_coupon",
    "balances": "customerbalance",
    "customers": "customer_entity",
    "return_items": "rma_item_entity",
    "return_heads": "rma",
    "return_codes": "rma_item_entity_int",
    "options": "eav_attribute_option_value",
    "attributes": "eav_attribute",
    "products": "catalog_product_entity",
    "product_codes": "catalog_product_entity_int",
    "category_nodes": "catalog_category_entity",
    "category_names": "catalog_category_entity_varchar",
    "category_links": "catalog_category_product",
}
CATALOG_SOURCES = {
    "products": "catalog_product_entity",
    "product_texts": "catalog_product_entity_varchar",
    "product_decimals": "catalog_product_entity_decimal",
    "product_codes": "catalog_product_entity_int",
    "product_datetimes": "catalog_product_entity_datetime",
    "options": "eav_attribute_option_value",
    "attribute_sets": "eav_attribute_set",
    "stock_2": "inventory_stock_2",
    "stock_6": "inventory_stock_6",
    "url_rewrites": "url_rewrite",
}
PREFIXED = {"balances", "return_items", "return_heads", "return_codes"}


def source_names(sources: Mapping[str, str], prefix: str = "", names: Mapping[str, str] | None = None) -> dict[str, str]:
    """Source table names by logical name, with the platform's prefix where the source has it (empty: none). ``names``
    gives full names for any of them that the shop calls otherwise."""
    unknown = set(names or {}) - set(sources)
    if unknown:
        raise ValueError(f"no such logical names: {', '.join(sorted(unknown))}")
    return {k: f"{prefix}_{v}" if prefix and k in PREFIXED else v for k, v in sources.items()} | dict(names or {})


class Mart:
    """Where a job's tables go: a database, and optionally a folder of one's own below which files land."""

    def __init__(self, spark: SparkSession, database: str = "default", root: str | None = None,
                 buckets: int | None = None):
        self.spark, self.database, self.root, self.buckets = spark, database, root, buckets
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def put(self, name: str, frame: DataFrame, key: str | None = None) -> DataFrame:
        """Publish and read back, so that later tables start from files and not from the whole plan again.

        With ``buckets`` set, tables that name a key are bucketed by it.
        """
        layout = (self.buckets, key) if self.buckets and key else None
        return publish(frame, f"{self.database}.{name}", root=self.root, buckets=layout)


def run_sales(t: Mapping[str, DataFrame], mart: Mart, house_seller: str,
              left_out: sales.Subtrees = sales.Subtrees(), settings: Settings = Settings()) -> dict[str, DataFrame]:
    """Build and publish the ten sales tables. The wide table and the refund flags read the published paths,
    shipments, subsidies and returns; the wide table finds margins, totals, fees and flags again where its rows lie.
    ``bad_list_elements`` counts, per item, list elements that are no ids. A failure stops the job and leaves the tables
    after it as they were."""
    plan = sales.pieces(t, left_out, settings)
    done = {
        "product_categories": mart.put("product_categories", plan.paths, "product_id"),
        "shipments_agg": mart.put("shipments_agg", plan.shipments, "order_item_id"),
        "sales_order_item_cost": mart.put("sales_order_item_cost", sales.item_margin(t["items"]), "item_id"),
        "shipping_fee": mart.put("shipping_fee", plan.subsidies, "item_id"),
        "rma": mart.put("rma", plan.returns, "order_item_id"),
        "bad_list_elements": mart.put("bad_list_elements", sales.bad_list_elements(t["items"])),
    }
    shipments = done["shipments_agg"]
    done["sales_refunded"] = mart.put(
        "sales_refunded", sales.refund_flag(t["items"], shipments, t["payments"]), "order_item_id"
    )
    done["orders_adminfees"] = mart.put("orders_adminfees", sales.payment_fee(t["orders"], t["payments"], settings), "entity_id")
    done["order_total"] = mart.put("order_total", sales.order_total(t["orders"], t["payments"]), "entity_id")
    done["customer_balance"] = mart.put("customer_balance", sales.customer_balance(t["balances"], t["customers"]))
    made = sales.Pieces(
        paths=done["product_categories"],
        shipments=shipments,
        subsidies=done["shipping_fee"],
        returns=done["rma"],
    )
    done["orders_items_denorm"] = mart.put("orders_items_denorm", sales.orders_items_wide(t, made, house_seller, settings))
    return done


def run_catalog(t: Mapping[str, DataFrame], mart: Mart, prefixes: catalog.Prefixes,
                settings: Settings = Settings()) -> dict[str, DataFrame]:
    """Build and publish the nine catalogue tables, and ``product_attributes``, of which the four attribute tables
    are cuts and which the report reads: no value table is read or shuffled twice."""
    wide = mart.put("product_attributes", catalog.attributes(t, settings, members=True), "row_id")
    columns = catalog.group_columns(settings)
    cuts = {group: wide.where(group).select("row_id", *columns[group]) for group in catalog.GROUPS}
    done = {
        "vw_product_base": mart.put("vw_product_base", catalog.product_base(t["products"]), "entity_id"),
        "vw_product_attributes_varchar": mart.put("vw_product_attributes_varchar", cuts["in_texts"], "row_id"),
        "vw_product_attributes_decimal": mart.put("vw_product_attributes_decimal", cuts["in_decimals"], "row_id"),
        "vw_product_attributes_int_options": mart.put("vw_product_attributes_int_options", cuts["in_options"], "row_id"),
        "vw_product_special_prices": mart.put("vw_product_special_prices", cuts["in_prices"], "row_id"),
        "vw_attribute_sets": mart.put("vw_attribute_sets", catalog.attribute_sets(t)),
        "vw_inventory_stock": mart.put("vw_inventory_stock", catalog.stock(t, settings), "sku"),
        "vw_product_urls": mart.put("vw_product_urls", catalog.product_urls(t["url_rewrites"]), "entity_id"),
    }
    made = catalog.Pieces(done["vw_product_base"], wide, done["vw_attribute_sets"], done["vw_inventory_stock"], done["vw_product_urls"])
    done["vw_product"] = mart.put("vw_product", catalog.product_report(made, prefixes))
    return done
