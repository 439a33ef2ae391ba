"""Sales tables: shipments, margins, refunds, subsidies, fees, balances, returns, and the wide item table.

Frames carry the shop's own column names (entity_id, parent_id, order_id, ...); every function returns a
lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.functions import fixed_values as V
from cartwright.functions.columns import decode, folded_key, percent_of, same_text, shift_hours, since, text_in
from cartwright.operators.dedupe import distinct_ordered_concat, latest_per_key
from cartwright.operators.eav import attribute_lookup, eav_pivot, option_texts
from cartwright.operators.joins import is_large, lookup_join
from cartwright.operators.lists import explode_ids, list_elements
from cartwright.operators.narrow import pack_columns, packed, unpacked
from cartwright.operators.repeat import repeat_rows
from cartwright.operators.siblings import with_first_differing
from cartwright.operators.tree import category_paths, excluded_subtrees
from cartwright.plans.settings import Settings


# ---- sides reduced to one row per key -----------------------------------------------------------


def one_payment(payments: DataFrame) -> DataFrame:
    """(entity_id, method): one payment per order, the first method by name."""
    return payments.groupBy(F.col("parent_id").alias("entity_id")).agg(F.min("method").alias("method"))


def one_address(addresses: DataFrame, address_type: str = V.SHIPPING_ADDRESS) -> DataFrame:
    """(entity_id, area, city): one address of the type per order, first by city, then region."""
    place = F.min(F.struct("city", "region")).alias("place")
    return (
        addresses.where(same_text(F.col("address_type"), address_type))
        .groupBy(F.col("parent_id").alias("entity_id"))
        .agg(place)
        .select("entity_id", F.col("place.city").alias("area"), F.col("place.region").alias("city"))
    )


def coupon_types(coupons: DataFrame, rules: DataFrame) -> DataFrame:
    """(code_key, coupon_type): one rule per code, case-blind (``folded``; a stored ``code_key`` is taken as it is); the
    lowest rule id where a code has several."""
    types = rules.select("rule_id", "rule_cart_type")
    first = F.min(F.struct("rule_id", "rule_cart_type")).alias("rule")
    usable = coupons.select("rule_id", folded_key(coupons, "code").alias("code_key")).where(F.col("code_key").isNotNull())
    return (
        lookup_join(usable, types, "rule_id", "left")
        .groupBy("code_key")
        .agg(first)
        .select("code_key", F.col("rule.rule_cart_type").alias("coupon_type"))
    )


# ---- shipments ----------------------------------------------------------------------------------


def latest_shipment(shipment_items: DataFrame, shipments: DataFrame, tracks: DataFrame,
                    statuses: Mapping[int, str] = V.SHIPMENT_STATUS, default: str = V.SHIPMENT_DEFAULT) -> DataFrame:
    """(order_item_id, shipment_ids, courier_names, shipment_statuses): newest shipment per order item.

    Ties: highest shipment id, then highest track id. A line without a shipment header stays, as ``default``.
    """
    return _shown_shipment(newest_shipment(shipment_items, shipments, tracks), statuses, default)


def _shown_shipment(newest: DataFrame, statuses: Mapping[int, str], default: str) -> DataFrame:
    return newest.select(
        "order_item_id",
        F.col("increment_id").alias("shipment_ids"),
        F.col("title").alias("courier_names"),
        decode(F.col("shipment_status"), statuses, default).alias("shipment_statuses"),
    )


def newest_shipment(shipment_items: DataFrame, shipments: DataFrame, tracks: DataFrame) -> DataFrame:
    """(order_item_id, shipment_lines, increment_id, shipment_status, title): per order item the number of its shipment
    lines and the newest header, which moves as one text.

    The condition on both results is always true. It is there for plans that read the numbers in one place and the headers
    in another: they need the same rows, so that Spark has one shuffle for both.
    """
    last_track = tracks.groupBy(F.col("parent_id").alias("entity_id")).agg(
        F.max(F.struct(F.col("entity_id").alias("track_id"), "title")).alias("track")
    )
    plain = shipments.join(last_track, "entity_id", "left").select(
        F.col("entity_id").alias("parent_id"), "created_at", "increment_id", "shipment_status",
        F.col("track.title").alias("title"),
    )
    shown = [plain.schema[c] for c in pack_columns(plain, ["increment_id", "shipment_status", "title"])]
    heads = plain.withColumn("_head", packed(plain, [f.name for f in shown])).drop(*[f.name for f in shown])
    lines = shipment_items.select("order_item_id", "parent_id")
    shipped = lookup_join(lines, heads, "parent_id", "left", profile=shipment_items.select("parent_id"))
    newest = F.max(F.struct("created_at", "parent_id", *[c for c in heads.columns if c not in ("created_at", "parent_id")]))
    reduced = shipped.groupBy("order_item_id").agg(F.count("*").alias("shipment_lines"), newest.alias("_newest"))
    found = reduced.where((F.col("shipment_lines") > 0) & F.col("_newest").isNotNull())
    rows = found.select("order_item_id", "shipment_lines", "_newest.*").drop("created_at", "parent_id")
    return unpacked(rows, "_head", shown)


# ---- margins and refunds ------------------------------------------------------------------------


def with_margin(items: DataFrame, lie_by: Sequence[str] = ("order_id", "sku"), profile: DataFrame | None = None,
                narrow: Sequence[str] = ()) -> DataFrame:
    """``items`` with their margin; NULL for marketplace items. The items are shuffled by ``lie_by`` and stay there;
    ``profile`` and ``narrow`` as in ``with_first_differing``.

    The sibling is another line of the same order and sku with another product and product type; of several,
    the one with the lowest item id counts.
    """
    paired = with_first_differing(
        items, ["order_id", "sku"], "product_type", "product_id", "item_id",
        ["base_price", "base_cost", "qty_ordered"], "sibling", lie_by, profile, narrow,
    )
    price, cost, qty, other = F.col("base_price"), F.col("base_cost"), F.col("qty_ordered"), F.col("sibling")
    margin = (
        F.when(same_text(F.col("product_type"), V.CONFIGURABLE), (price - other["base_cost"]) * qty)
        .when((price == 0) & (other["base_price"] > price), (other["base_price"] - cost) * other["qty_ordered"])
        .otherwise((price - cost) * qty)
    )
    return paired.withColumn("margin", F.when(F.col("marketplace_seller").isNull(), margin)).drop("sibling")


def item_margin(items: DataFrame) -> DataFrame:
    """(item_id, margin) of first-party items."""
    needed = items.select(
        "item_id", "order_id", "sku", "product_id", "product_type", "marketplace_seller",
        "base_price", "base_cost", "qty_ordered",
    )
    return with_margin(needed).where(F.col("marketplace_seller").isNull()).select("item_id", "margin")


def refunded(qty_refunded: Column, method: Column, shipment_status: Column) -> Column:
    """True when something was refunded and the money had been taken: paid up front, or delivered."""
    taken = ~same_text(method, V.CASH_ON_DELIVERY) | (shipment_status == V.SHIPMENT_DONE)
    return F.coalesce((qty_refunded > 0) & taken, F.lit(False))


def refund_flag(items: DataFrame, shipments: DataFrame, payments: DataFrame, as_text: bool = True) -> DataFrame:
    """(order_item_id, is_refunded) of top-level items; ``shipments`` as from ``latest_shipment``."""
    top = items.where(F.col("parent_item_id").isNull()).select("item_id", "order_id", "qty_refunded")
    methods = one_payment(payments).withColumnRenamed("entity_id", "order_id")
    paid = lookup_join(top, methods, "order_id", "left", profile=items.select("order_id"))
    status = shipments.select(F.col("order_item_id").alias("item_id"), "shipment_statuses")
    flag = refunded(F.col("qty_refunded"), F.col("method"), F.col("shipment_statuses"))
    if as_text:
        flag = F.when(flag, "True").otherwise("False")
    return paid.join(status, "item_id", "left").select(
        F.col("item_id").alias("order_item_id"), flag.alias("is_refunded")
    )


# ---- shipping subsidies -------------------------------------------------------------------------


def shipping_subsidy(items: DataFrame, rules: DataFrame, coupons: DataFrame | None = None,
                     start: str = V.SUBSIDY_SINCE, per_coupon: bool = False) -> DataFrame:
    """One row per item and applied rule with the shipping fee under the rule's cart type.

    ``per_coupon`` repeats a row once per coupon of its rule, from a count: no coupon row is joined.
    """
    paid_nothing = F.col("paid_shipping_amount").isNull() | (F.col("paid_shipping_amount") == 0)
    due = items.where(
        F.col("parent_item_id").isNull() & (F.col("created_at") >= since(start)) & paid_nothing
    ).select("item_id", "order_id", "created_at", "applied_rule_ids", "original_shipping_amount",
             "paid_shipping_amount")
    applied = explode_ids(due, "applied_rule_ids", "rule_id").drop("applied_rule_ids")
    free_rules = rules.where(F.col("discount_amount") == 0).select(
        F.col("rule_id").cast("bigint").alias("rule_id"), F.col("name").alias("rule_name"), "rule_cart_type",
        "discount_amount",
    )
    if per_coupon:
        counts = coupons.groupBy("rule_id").agg(F.count("*").alias("_coupons"))
        free_rules = free_rules.join(counts, "rule_id", "left")
    out = lookup_join(applied, free_rules, "rule_id", "inner")
    if per_coupon:
        out = repeat_rows(out, F.coalesce("_coupons", F.lit(1)))
    fee = F.col("original_shipping_amount")

    def under(cart_type: str) -> Column:
        return F.when(same_text(F.col("rule_cart_type"), cart_type), fee).otherwise(F.lit(0).cast("decimal(20,4)"))

    return out.select(
        "item_id",
        "order_id",
        "created_at",
        F.col("rule_id").alias("applied_rule_id"),
        "rule_name",
        "rule_cart_type",
        "discount_amount",
        "original_shipping_amount",
        "paid_shipping_amount",
        under(V.COMMERCIAL_RULE).alias("commercial_shipping"),
        under(V.MARKETING_RULE).alias("marketing_shipping"),
    )


def bad_list_elements(items: DataFrame) -> DataFrame:
    """(item_id, bad_ids): how many elements of an item's rule list are no ids, where there are any."""
    elements = list_elements(items.select("item_id", "applied_rule_ids"), "applied_rule_ids", "rule_id")
    return elements.where(F.col("rule_id").isNull()).groupBy("item_id").agg(F.count("*").alias("bad_ids"))


def subsidy_per_item(subsidies: DataFrame) -> DataFrame:
    """Greatest amount of each kind per item: one row even where a commercial and a marketing rule both apply."""
    return subsidies.groupBy("item_id").agg(
        F.max("commercial_shipping").alias("commercial_shipping"),
        F.max("marketing_shipping").alias("marketing_shipping"),
    )


# ---- order money --------------------------------------------------------------------------------


def fee_of(method: Column, settings: Settings = Settings()) -> Column:
    """The order's fee under its payment method. A NULL fee stays NULL; other methods cost nothing."""
    fee = F.when(text_in(method, list(settings.pay_later)), F.coalesce("amount_to_collect", F.lit(0)))
    for name, column in settings.fee_columns.items():
        fee = fee.when(same_text(method, name), F.col(column))
    return fee.otherwise(F.lit(0)).cast("decimal(20,4)")


def total_of(method: Column) -> Column:
    """Grand total plus balance used; balance alone when the method is free; 0 without a method."""
    balance = F.coalesce("base_customer_balance_amount", F.lit(0))
    free = same_text(method, V.FREE_METHOD)
    total = F.when(~free, F.coalesce("base_grand_total", F.lit(0)) + balance).when(free, balance)
    return total.otherwise(F.lit(0)).cast("decimal(21,4)")


def payment_fee(orders: DataFrame, payments: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per payment of a known order, with the fee of its method."""
    needed = orders.select("entity_id", "created_at", "increment_id", "amount_to_collect",
                           *dict.fromkeys(settings.fee_columns.values()))
    paid = payments.select(F.col("parent_id").alias("entity_id"), "method")
    return lookup_join(paid, needed, "entity_id", "inner").select(
        "entity_id", "created_at", "increment_id", "method", fee_of(F.col("method"), settings).alias("payment_fees")
    )


def order_total(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """(entity_id, order_total), one row per order."""
    needed = orders.select("entity_id", "base_grand_total", "base_customer_balance_amount")
    return needed.join(one_payment(payments), "entity_id", "left").select(
        "entity_id", total_of(F.col("method")).alias("order_total")
    )


def customer_balance(balances: DataFrame, customers: DataFrame) -> DataFrame:
    """Positive balances with the customer's name, mail and site. A name with a NULL part is NULL."""
    people = customers.select(
        F.col("entity_id").alias("customer_id"),
        F.concat("firstname", F.lit(" "), "lastname").alias("customer_name"),
        F.col("email").alias("user_email"),
        F.col("created_in").alias("website"),
    )
    held = balances.where(F.col("amount") > 0).select("customer_id", F.col("amount").alias("balance_amount"))
    return lookup_join(held, people, "customer_id", "left").select(
        F.col("customer_id").alias("user_id"), "balance_amount", "customer_name", "user_email", "website"
    )


# ---- returns and status history -----------------------------------------------------------------


def returns(shipment_items: DataFrame, return_items: DataFrame, return_heads: DataFrame, return_codes: DataFrame,
            options: DataFrame, reason_attribute: int = V.RETURN_REASON_ATTRIBUTE,
            per_shipment_line: bool = False, shipped: DataFrame | None = None) -> DataFrame:
    """Approved return items of shipped order items, with the reason's text.

    ``shipment_lines`` says how many shipment lines the order item has, counted before the join: lines and
    returns of one item are never paired. ``per_shipment_line`` repeats each row that often. ``shipped``: these numbers
    per order item, where a plan has them anyway.
    """
    approved = return_items.where(same_text(F.col("status"), V.APPROVED)).select(
        F.col("entity_id").alias("return_item_id"), "rma_entity_id", "order_item_id",
        F.col("qty_approved").alias("quantity_returned"), F.col("status").alias("item_status"),
    )
    if shipped is None:
        shipped = shipment_items.groupBy("order_item_id").agg(F.count("*").alias("shipment_lines"))
    coded = return_codes.where(F.col("attribute_id") == reason_attribute).select(
        F.col("entity_id").alias("return_item_id"), "value"
    )
    reasons = lookup_join(coded, option_texts(options), "value", "left").drop("value")
    heads = return_heads.select(
        F.col("entity_id").alias("rma_entity_id"), F.col("date_requested").alias("rma_created_at"),
        F.col("status").alias("rma_status"),
    )
    lines = approved.join(reasons, "return_item_id", "left")
    lines = lookup_join(lines, heads, "rma_entity_id", "left", profile=return_items.select("rma_entity_id"))
    lines = lookup_join(lines, shipped, "order_item_id", "inner", profile=return_items.select("order_item_id"))
    out = lines.select(
        "order_item_id", "return_item_id", "quantity_returned", "rma_created_at", "item_status", "rma_status",
        F.coalesce("option_text", F.lit("")).alias("return_reason"), "shipment_lines",
    )
    if per_shipment_line:
        out = repeat_rows(out, F.col("shipment_lines"))
    return out


def status_trail(history: DataFrame, hours: int = V.STATUS_SHIFT_HOURS) -> DataFrame:
    """(parent_id, order_status, status_changed_at): distinct statuses in time order, and the last change."""
    trail = distinct_ordered_concat(
        history, ["parent_id"], "status", "created_at", V.ENTRY_SEPARATOR, "order_status", last="_changed"
    )
    return trail.select("parent_id", "order_status", shift_hours(F.col("_changed"), hours).alias("status_changed_at"))


# ---- the wide item table ------------------------------------------------------------------------


@dataclass(frozen=True)
class Subtrees:
    """What to leave out of the category breadcrumbs."""

    prefixes: Sequence[str] = ()
    ids: Sequence[int] = ()
    parent_ids: Sequence[int] = ()
    names: Sequence[str] = ()


def order_side(t: Mapping[str, DataFrame], settings: Settings = Settings()) -> DataFrame:
    """One row per order with everything the wide table takes from the order.

    The coupon of a small table comes first: the joins after it are all on the order id, one row per order on both sides,
    and leave the result partitioned for the items. Of a large one only ids and codes move to the coupons.
    """
    orders = t["orders"].withColumn("code_key", folded_key(t["orders"], "coupon_code"))
    types = coupon_types(t["coupons"], t["rules"])
    if is_large(t["orders"]):
        used = orders.where(F.col("entity_id").isNotNull() & F.col("code_key").isNotNull()).select("entity_id", "code_key")
        typed = lookup_join(used, types, "code_key", "inner", orders.select("code_key"))
        by_code = F.map_from_entries(F.collect_set(F.struct("code_key", "coupon_type"))).alias("_types")
        by_order = typed.groupBy("entity_id").agg(by_code)
        narrow = pack_columns(orders, [c for c in SHOWN_OF_ORDERS if c in orders.columns] + ["code_key"])
        moved = orders.select(*[c for c in orders.columns if c not in narrow], packed(orders, narrow).alias("_shown"))
        met = unpacked(moved.join(by_order, "entity_id", "left"), "_shown", [orders.schema[c] for c in narrow])
        coded = met.withColumn("coupon_type", F.try_element_at("_types", "code_key"))
    else:
        coded = lookup_join(orders, types, "code_key", "left", profile=orders.select("code_key"))
    payment = one_payment(t["payments"]).withColumn("_paid", F.lit(True))
    trail = status_trail(t["status_history"], settings.status_hours).withColumnRenamed("parent_id", "entity_id")
    joined = (
        coded.join(payment, "entity_id", "left")
        .join(one_address(t["addresses"]), "entity_id", "left")
        .join(trail, "entity_id", "left")
    )
    method = F.col("method")
    return joined.select(
        F.col("entity_id").alias("order_id"),
        F.col("increment_id").alias("order_number"),
        shift_hours(F.col("created_at"), settings.order_hours).alias("transaction_date"),
        F.col("customer_id").alias("user_id"),
        F.concat("customer_firstname", F.lit(" "), "customer_lastname").alias("customer_name"),
        F.col("customer_email").alias("user_email"),
        "order_status",
        "status_changed_at",
        F.col("status").alias("current_status"),
        shift_hours(F.col("updated_at"), settings.order_hours).alias("updated_at"),
        F.col("store_id").alias("site_language"),
        F.col("coupon_code").alias("promo_code"),
        "coupon_type",
        F.col("base_currency_code").alias("currency"),
        total_of(method).alias("order_total"),
        F.col("base_discount_amount").alias("discount_amount"),
        F.col("base_shipping_amount").alias("shipping_fee"),
        F.col("base_tax_amount").alias("tax_amount"),
        F.when(F.col("_paid"), fee_of(method, settings)).alias("order_fees"),
        "checkout_from",
        method.alias("payment_method"),
        "area",
        "city",
    )


def product_paths(t: Mapping[str, DataFrame], left_out: Subtrees, settings: Settings = Settings()) -> DataFrame:
    """(product_id, category_path) with the name attribute looked up by its code."""
    name_id = attribute_lookup(t["attributes"], "name", settings.category_entity)
    nodes, names = t["category_nodes"], t["category_names"]
    excluded = excluded_subtrees(
        nodes, names, name_id, left_out.prefixes, left_out.ids, left_out.parent_ids, left_out.names
    )
    return category_paths(t["category_links"], nodes, names, name_id, excluded)


def product_side(t: Mapping[str, DataFrame], paths: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per product id: brand and colour text, and the category breadcrumbs."""
    coded = t["attributes"].where(
        F.col("attribute_code").isin("brand", "color") & (F.col("entity_type_id") == settings.product_entity)
    )
    wanted = coded.groupBy("attribute_code").agg(F.min("attribute_id").alias("attribute_id"))
    codes = t["product_codes"].where(F.col("store_id") == 0).select("row_id", "store_id", "attribute_id", "value")
    # At most two rows, one per code.
    texts = lookup_join(codes.join(F.broadcast(wanted), "attribute_id"), option_texts(t["options"]), "value", "inner")
    named = eav_pivot(
        texts.drop("value").withColumnRenamed("option_text", "value"),
        {"brand": "brand_name", "color": "variant_id"}, attribute="attribute_code",
    )
    newest = t["products"].groupBy(F.col("entity_id").alias("product_id")).agg(F.max("row_id").alias("row_id"))
    described = newest.join(named, "row_id", "left").drop("row_id")
    return described.join(paths, "product_id", "full")


@dataclass(frozen=True)
class Pieces:
    """The tables the wide table is made of, built here or read back after they were published. Margins are not among
    them: the wide table finds them where its items lie."""

    paths: DataFrame
    shipments: DataFrame
    subsidies: DataFrame
    returns: DataFrame


def pieces(t: Mapping[str, DataFrame], left_out: Subtrees = Subtrees(), settings: Settings = Settings(),
           one_plan: bool = False) -> Pieces:
    """``one_plan``: all of them are read by one plan, in which returns find the numbers of shipment lines where the newest
    shipments are made. Pieces that are written one by one count them on their own."""
    lines = t["shipment_items"]
    newest = newest_shipment(lines, t["shipments"], t["shipment_tracks"])
    return Pieces(
        paths=product_paths(t, left_out, settings),
        shipments=_shown_shipment(newest, settings.shipment_status, settings.shipment_default),
        subsidies=shipping_subsidy(t["items"], t["rules"], start=settings.subsidy_since),
        returns=returns(lines, t["return_items"], t["return_heads"], t["return_codes"], t["options"],
                        settings.return_reason,
                        shipped=newest.select("order_item_id", "shipment_lines") if one_plan else None),
    )


def orders_items_wide(t: Mapping[str, DataFrame], made: Pieces, house_seller: str,
                      settings: Settings = Settings()) -> DataFrame:
    """One row per top-level order item with a known order: 58 columns, in the order of ``WIDE_COLUMNS``.

    Every one-to-many side is reduced to one row per key before it is joined, so no join multiplies rows and
    nothing needs to be picked afterwards. The items are shuffled once by order: their siblings are found there and
    the order side is joined there. Then a small table moves once for the sides by item id and once for the product
    side. Of a table that is large enough to be profiled only the keys move for these sides, and what they find comes to
    the items' place: no column of an item moves twice, and none of an order is repeated per item before the end. What a
    row only shows moves as one text. Items of hot orders and products are spread.
    """
    items = t["items"]
    if is_large(items):
        placed = _with_sides_by_keys(items, t, made, house_seller, settings)
        wide = _with_order(placed, t, settings)
    else:
        top = with_margin(items, ["order_id"]).where(F.col("parent_item_id").isNull()).select(*_item_columns(house_seller))
        wide = _with_product(_with_item_sides(_with_order(top, t, settings), made), t, made, settings)
    flag = refunded(F.col("quantity_refunded"), F.col("payment_method"), F.col("shipment_statuses"))
    return wide.withColumn("is_refunded", F.when(flag, "True").otherwise("False")).withColumnsRenamed({
        "category_path": "product_category_name", "commercial_shipping": "commercial_shipping_fee",
        "marketing_shipping": "marketing_shipping_fee"}).select(*WIDE_COLUMNS)


def _with_order(rows: DataFrame, t: Mapping[str, DataFrame], settings: Settings) -> DataFrame:
    profile = t["items"].select("order_id")
    return lookup_join(rows, order_side(t, settings), "order_id", "inner", profile, ["item_id"])


def _with_product(rows: DataFrame, t: Mapping[str, DataFrame], made: Pieces, settings: Settings,
                  spread_by: str = "item_id") -> DataFrame:
    products = product_side(t, made.paths, settings)
    return lookup_join(rows, products, "product_id", "left", t["items"].select("product_id"), [spread_by])


def _with_item_sides(rows: DataFrame, made: Pieces) -> DataFrame:
    """Subsidies, newest shipment and newest return, each one row per item id."""
    keyed = "item_id"
    ship = made.shipments.withColumnRenamed("order_item_id", keyed)
    back = latest_per_key(
        made.returns.withColumnRenamed("order_item_id", keyed), [keyed],
        [F.col("rma_created_at").desc_nulls_last(), F.col("return_item_id").desc()], ["return_reason"],
    ).select(keyed, "quantity_returned", "rma_created_at", F.col("item_status").alias("rma_item_status"),
             "rma_status", F.col("return_reason").alias("rma_return_reason"))
    return rows.join(subsidy_per_item(made.subsidies), keyed, "left").join(ship, keyed, "left").join(back, keyed, "left")


def _with_sides_by_keys(items: DataFrame, t: Mapping[str, DataFrame], made: Pieces, house_seller: str,
                        settings: Settings) -> DataFrame:
    """Top-level items with margin, product side and item sides, lying by order.

    (order, product) is joined with the product side and (order, item) with the item sides. What they find is put under the
    items as rows of their shuffle by order, and a window over the two ids hands it to the items: rows of equal ids find
    equal values, however many they are. Rows of keys have no sku and are nobody's sibling. Child items move with what
    siblings need only.
    """
    keys = items.where(F.col("parent_item_id").isNull() & F.col("order_id").isNotNull())
    by_product = keys.where(F.col("product_id").isNotNull()).select("order_id", "product_id")
    by_item = keys.where(F.col("item_id").isNotNull()).select("order_id", "item_id")
    found = [(_with_product(by_product, t, made, settings, "order_id"), ["order_id", "product_id"]),
             (_with_item_sides(by_item, made), ["order_id", "item_id"])]
    shown = [F.when(F.col("parent_item_id").isNull(), F.col(c)).alias(c) for c in SHOWN_INPUTS + ROLLED_INPUTS]
    rows, texts = _as_texts(items.select(*SIBLING_INPUTS, *shown), {"_shown": SHOWN_INPUTS})
    over = {}
    for side, ids in found:
        name = f"_by_{ids[-1]}"
        side, text = _as_texts(side, {name: [c for c in side.columns if c not in ids]})
        over |= {c: F.max(c).over(Window.partitionBy(*ids)) for c in side.columns if c not in ids}
        texts |= text
        rows = rows.unionByName(side.withColumn("_found", F.lit(True)), allowMissingColumns=True)
    met = with_margin(rows, ["order_id"], items, NARROW_INPUTS).withColumns(over)
    top = met.where(F.col("parent_item_id").isNull() & F.col("_found").isNull())
    for name, fields in texts.items():
        top = unpacked(top, name, fields)
    sides = [c for side, ids in found for c in side.columns if c not in ids]
    return top.select(*_item_columns(house_seller), *sides)


def _as_texts(df: DataFrame, groups: Mapping[str, Sequence[str]]) -> tuple[DataFrame, dict[str, list[T.StructField]]]:
    """``df`` with each group's columns packed into a text of the group's name, and which columns that holds."""
    out, fields = df, {}
    for name, columns in groups.items():
        columns = pack_columns(df, columns)
        if columns:
            out = out.withColumn(name, packed(df, columns)).drop(*columns)
            fields[name] = [df.schema[c] for c in columns]
    return out, fields


# Columns of an item that siblings need, those that rollups read too, and those that only the row itself shows.
SIBLING_INPUTS = [
    "item_id", "order_id", "parent_item_id", "product_id", "sku", "product_type", "marketplace_seller", "qty_ordered",
    "base_price", "base_cost",
]
ROLLED_INPUTS = ["main_category", "sub_category", "base_row_total", "base_discount_amount", "marketplace_commission"]
SHOWN_INPUTS = [
    "name", "qty_refunded", "qty_shipped", "marketing_discount", "commercial_discount", "base_tax_amount",
    "original_shipping_amount", "paid_shipping_amount",
]
# What every plan over items reads, as one text; of a row that carries sides only the first or the last is there.
NARROW_INPUTS = [
    "product_id", "base_price", "marketplace_seller", "parent_item_id", "product_type", "sku", "base_discount_amount",
    "marketplace_commission", "base_cost", "qty_ordered", "item_id",
]
# Columns of an order that rollups do not read.
SHOWN_OF_ORDERS = [
    "customer_id", "customer_firstname", "customer_lastname", "customer_email", "status", "store_id", "coupon_code",
    "base_currency_code", "base_discount_amount", "base_shipping_amount", "base_tax_amount", "base_grand_total",
    "base_customer_balance_amount", "paymentfees", "nbeinstallmentfees", "misrinstallmentfees", "qnbinstallmentfees",
    "amount_to_collect",
]


def _item_columns(house_seller: str) -> list[Column]:
    plain = {
        "item_id": "item_id", "order_id": "order_id", "sku": "sku", "product_name": "name",
        "product_id": "product_id", "quantity": "qty_ordered", "quantity_refunded": "qty_refunded",
        "quantity_shipped": "qty_shipped", "unit_price": "base_price", "total_price": "base_row_total",
        "item_discount": "base_discount_amount", "Marketing_Discount": "marketing_discount",
        "Commercial_Discount": "commercial_discount",
        "marketplace_commission_percentage": "marketplace_commission", "retail_margin": "margin",
        "item_tax": "base_tax_amount", "original_shipping_fee": "original_shipping_amount",
        "paid_shipping_amount": "paid_shipping_amount", "main_category": "main_category",
        "sub_category": "sub_category",
    }
    made = {
        "marketplace_commission_amount": percent_of(F.col("base_row_total"), F.col("marketplace_commission")),
        "retail_margin_after_discount": F.col("margin") - F.col("commercial_discount"),
        "seller_name": F.coalesce("marketplace_seller", F.lit(house_seller)),
    }
    return [F.col(c).alias(n) for n, c in plain.items()] + [e.alias(n) for n, e in made.items()]


WIDE_COLUMNS = [
    "order_number", "transaction_date", "user_id", "customer_name", "user_email", "order_status",
    "status_changed_at", "current_status", "updated_at",
    "site_language", "promo_code", "coupon_type", "currency",
    "order_total", "discount_amount", "shipping_fee", "tax_amount", "order_fees", "checkout_from",
    "item_id", "sku", "product_name", "product_id", "quantity", "quantity_refunded", "quantity_shipped",
    "unit_price", "total_price",
    "item_discount", "Marketing_Discount", "Commercial_Discount", "marketplace_commission_percentage",
    "marketplace_commission_amount", "retail_margin", "retail_margin_after_discount",
    "item_tax", "original_shipping_fee", "paid_shipping_amount", "is_refunded", "commercial_shipping_fee",
    "marketing_shipping_fee",
    "brand_name", "variant_id", "seller_name", "product_category_name", "main_category", "sub_category",
    "payment_method", "area", "city", "shipment_ids", "courier_names", "shipment_statuses",
    "quantity_returned", "rma_created_at", "rma_item_status", "rma_status", "rma_return_reason",
]
