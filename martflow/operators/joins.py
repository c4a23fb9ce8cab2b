"""Joins with a declared cardinality, match indicators, growth logs and calendar-slot lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.functions.expr import safe_divide

JOINED, LEFT_ONLY = "both", "left_only"


def key_is_unique(df: DataFrame, keys: list[str], label: str) -> Column:
    """Scalar subquery that is true, or fails the query when a non-null key occurs twice.

    It reads the key columns only, counts per key before any shuffle, and stays outside the join
    itself, so adaptive execution can still split a skewed join.
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    most = F.coalesce(F.max("count"), F.lit(0))
    message = f"join key ({', '.join(keys)}) is not unique in {label}"
    return (
        df.where(known)
        .groupBy(*keys)
        .count()
        .agg(most.alias("most"))
        .select(F.when(F.col("most") > 1, F.raise_error(F.lit(message))).otherwise(F.lit(True)).cast("boolean"))
        .scalar()
    )


def keys_are_unique(tables: dict[str, tuple[DataFrame, list[str]]]) -> Column:
    """Scalar subquery that is true, or fails the query and names the tables whose non-null key repeats.

    One subquery for all tables of a plan, each of which is read once and by its key columns alone.
    """
    counted = []
    for label, (df, keys) in tables.items():
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        most = df.where(known).groupBy(*keys).count().agg(F.coalesce(F.max("count"), F.lit(0)).alias("most"))
        counted.append(most.select(F.lit(f"{label} ({', '.join(keys)})").alias("key"), "most"))
    repeated = F.collect_list(F.when(F.col("most") > 1, F.col("key")))
    message = F.concat(F.lit("join key is not unique in "), F.array_join("repeated", ", "))
    verdict = F.when(F.size("repeated") > 0, F.raise_error(message)).otherwise(F.lit(True)).cast("boolean")
    return reduce(DataFrame.unionByName, counted).agg(repeated.alias("repeated")).select(verdict).scalar()


#: Tables that own a key: label -> (table, key columns). If the key repeats in none of them, it cannot repeat in what
#: has been computed from them, and the computed side needs no check of its own.
Owners = dict[str, tuple[DataFrame, list[str]]]


def checked_left_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    validate: str | None = "m:1",
    suffix: str = "_right",
    owners: Owners | None = None,
) -> DataFrame:
    """Left join that enforces ``m:1`` or ``1:1``; ``None`` skips the check for keys known unique.

    With ``owners`` the check reads the key columns of those tables, each once, instead of computing the sides
    again; they must vouch for the right key, and for the left one, too, if the join is ``1:1``. Columns of the
    right side that already exist on the left get ``suffix``. NULL keys never match.
    """
    keys = [on] if isinstance(on, str) else list(on)
    guards = []
    if owners is not None and validate is not None:
        guards += [keys_are_unique(owners)] if owners else []
    elif validate in ("m:1", "1:1"):
        guards.append(key_is_unique(right, keys, "the right table"))
        if validate == "1:1":
            guards.append(key_is_unique(left, keys, "the left table"))
    overlap = [c for c in right.columns if c in left.columns and c not in keys]
    renamed = right.withColumnsRenamed({c: f"{c}{suffix}" for c in overlap}) if overlap else right
    guarded = reduce(lambda df, g: df.where(g), guards, left)
    return guarded.join(renamed, keys, "left")


def left_join_with_status(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    status: str,
    validate: str | None = "m:1",
    suffix: str = "_right",
    owners: Owners | None = None,
) -> DataFrame:
    """Checked left join plus a column that says whether the row found a partner."""
    marked = right.withColumn("_found", F.lit(True))
    joined = checked_left_join(left, marked, on, validate, suffix, owners)
    return joined.withColumn(
        status, F.when(F.col("_found"), F.lit(JOINED)).otherwise(F.lit(LEFT_ONLY))
    ).drop("_found")


def join_growth(
    name: str, left: DataFrame, right: DataFrame, on: str, expected: str, note: str = ""
) -> DataFrame:
    """One row: how many rows a left join takes in and gives out.

    Both sides are counted per key and the counts are multiplied, so not even a many-to-many join
    has to be carried out to know its size, and a hot key is one row after the map-side count.
    """
    left_n = left.groupBy(on).agg(F.count(F.lit(1)).alias("left_n"))
    right_n = right.groupBy(on).agg(F.count(F.lit(1)).alias("right_n"))
    both = left_n.join(right_n, on, "full_outer")
    lefts, rights = F.coalesce("left_n", F.lit(0)), F.coalesce("right_n", F.lit(0))
    counts = both.agg(
        F.coalesce(F.sum(lefts), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum(rights), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(lefts * F.greatest(rights, F.lit(1))), F.lit(0)).alias("output_rows"),
    )
    growth = F.col("output_rows") / F.greatest("left_rows", F.lit(1))
    good = (growth <= 1.05) | F.lit(expected == "1:n allowed")
    return counts.select(
        F.lit(name).alias("join_name"),
        "left_rows",
        "right_rows",
        "output_rows",
        growth.alias("growth_vs_left"),
        F.lit(on).alias("left_key"),
        F.lit(on).alias("right_key"),
        F.lit(expected).alias("expected"),
        F.when(good, "PASS").otherwise("CHECK").alias("status"),
        F.lit(note).alias("note"),
    )


def join_log(t: dict[str, DataFrame]) -> DataFrame:
    """Growth of the six base joins."""
    orders, items = t["orders"], t["order_items"]
    logs = [
        join_growth("orders_payments", orders, t["payments"], "order_id", "1:1"),
        join_growth("items_orders", items, orders, "order_id", "m:1"),
        join_growth("items_products", items, t["products"], "product_id", "m:1"),
        join_growth("orders_customers", orders, t["customers"], "customer_id", "m:1"),
        join_growth("orders_geography", orders, t["geography"], "zip", "m:1"),
        join_growth("orders_shipments", orders, t["shipments"], "order_id", "1:0/1"),
    ]
    return reduce(DataFrame.unionByName, logs)


def orders_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    return left_join_with_status(
        orders, payments, "order_id", "payment_join_status", validate=None, suffix="_payment"
    )


# ``owners`` of these joins: see checked_left_join; ``checked=False`` for keys that the caller has checked.


def items_orders(items: DataFrame, orders: DataFrame, owners: Owners | None = None, checked: bool = True) -> DataFrame:
    return left_join_with_status(items, orders, "order_id", "order_join_status", _validate("m:1", checked), owners=owners)


def items_products(items: DataFrame, products: DataFrame, owners: Owners | None = None, checked: bool = True) -> DataFrame:
    return left_join_with_status(items, products, "product_id", "product_join_status", _validate("m:1", checked), owners=owners)


def items_returns(items: DataFrame, returns: DataFrame) -> DataFrame:
    """Order lines with their returns; a line that was returned in parts has a row for each."""
    keys = ["order_id", "product_id"]
    return left_join_with_status(items, returns, keys, "return_join_status", validate=None, suffix="_return")


def items_reviews(items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Order lines with their reviews, one row for each."""
    keys = ["order_id", "product_id"]
    return left_join_with_status(items, reviews, keys, "review_join_status", validate=None, suffix="_review")


def items_double_promotions(items: DataFrame) -> DataFrame:
    """Order lines under two promotions."""
    return items.where(F.col("promo_id").isNotNull() & F.col("promo_id_2").isNotNull())


def orders_customers(orders: DataFrame, customers: DataFrame, owners: Owners | None = None, checked: bool = True) -> DataFrame:
    return left_join_with_status(orders, customers, "customer_id", "customer_join_status", _validate("m:1", checked), "_customer", owners)


def orders_geography(orders: DataFrame, geography: DataFrame, owners: Owners | None = None, checked: bool = True) -> DataFrame:
    return left_join_with_status(orders, geography, "zip", "geo_join_status", _validate("m:1", checked), "_geo", owners)


def orders_shipments(orders: DataFrame, shipments: DataFrame, owners: Owners | None = None, checked: bool = True) -> DataFrame:
    joined = left_join_with_status(orders, shipments, "order_id", "shipment_join_status", _validate("1:1", checked), owners=owners)
    return joined.withColumns(
        {
            "ship_lead_days": F.datediff("ship_date", "order_date"),
            "delivery_lead_days": F.datediff("delivery_date", "order_date"),
        }
    )


def _validate(rule: str, checked: bool) -> str | None:
    return rule if checked else None


def group_share(df: DataFrame, part: str, group: str | list[str], share: str, total: str) -> DataFrame:
    """Share of a measure within its group, for a summary already reduced to a few rows per group."""
    keys = [group] if isinstance(group, str) else list(group)
    whole = df.withColumn(total, F.sum(part).over(Window.partitionBy(*keys)))
    return whole.withColumn(share, safe_divide(part, total))


def slot_lookup(
    days: DataFrame, profile: DataFrame, keys: list[str], fallback: dict[str, Column] | None = None
) -> DataFrame:
    """Attach calendar-slot values to dates.

    A profile has one row per slot (at most 366), which is what makes the broadcast safe. Missing
    slots take the fallback.
    """
    joined = days.join(F.broadcast(profile), keys, "left")
    filled = {c: F.coalesce(F.col(c), value) for c, value in (fallback or {}).items()}
    return joined.withColumns(filled) if filled else joined
