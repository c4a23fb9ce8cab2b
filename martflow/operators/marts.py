"""Item, order, customer, product, daily and product-month tables.

Two definitions exist for some tables: the enriched facts (item_fact, order_fact, customer_360,
product_360, daily_panel, product_month_panel) and the lighter marts (order_line_fact,
customer_mart, product_mart, daily_business_panel). Both are kept under their own names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.functions.calendar import month_key
from martflow.functions.expr import (
    all_present,
    any_present,
    divide_if_positive,
    flag,
    keep_present,
    known,
    safe_divide,
    sum_or_zero,
    with_line_money,
    zero_if_null,
)
from martflow.functions.ordering import running_totals
from martflow.operators.joins import Owners, checked_left_join, keys_are_unique

PROFILE = ["customer_id", "signup_date", "gender", "age_group", "acquisition_channel"]
PLACE = ["zip", "region", "district"]
PAYMENT = ["order_id", "payment_value", "installments"]
SHIPMENT = ["order_id", "ship_date", "delivery_date", "shipping_fee"]


# Builders check their join keys unless told that the caller has done so (``checked=False``): a key
# check reads and shuffles the key column once more, which a job over many tables does only once.


# Tables joined by key.
JOIN_KEYS = {
    "orders": ["order_id"], "products": ["product_id"], "customers": ["customer_id"], "geography": ["zip"],
    "payments": ["order_id"], "shipments": ["order_id"],
}


def _context_sides(customers, geography, payments, shipments) -> dict[str, DataFrame]:
    return {"customers": customers, "geography": geography, "payments": payments, "shipments": shipments}


def _with_unique(df: DataFrame, sides: dict[str, DataFrame], owners: Owners | None) -> DataFrame:
    """The frame behind one check of all keys: those of the owners if given, else those of the sides."""
    keys = {n: (side, JOIN_KEYS[n]) for n, side in sides.items()} if owners is None else owners
    return df.where(keys_are_unique(keys)) if keys else df


def _many_to_one(checked: bool) -> str | None:
    return "m:1" if checked else None


def _as_count(condition_column: str):
    return F.sum(F.col(condition_column).cast("int"))


# ---------------------------------------------------------------- items


def returns_agg(returns: DataFrame) -> DataFrame:
    """Returns per (order, product). Of equally frequent reasons the alphabetically first is kept."""
    return known(returns, "order_id", "product_id").groupBy("order_id", "product_id").agg(
        F.count_distinct("return_id").alias("return_records"),
        F.sum("return_quantity").alias("return_quantity"),
        F.sum("refund_amount").alias("refund_amount"),
        F.min("return_date").alias("first_return_date"),
        F.mode("return_reason", True).alias("top_return_reason"),
    )


def reviews_agg(reviews: DataFrame) -> DataFrame:
    return known(reviews, "order_id", "product_id").groupBy("order_id", "product_id").agg(
        F.count_distinct("review_id").alias("review_records"),
        F.avg("rating").alias("avg_rating"),
        F.min("review_date").alias("first_review_date"),
    )


def item_measures(
    items: DataFrame, products: DataFrame, returns: DataFrame, reviews: DataFrame, checked: bool = True
) -> DataFrame:
    """Order lines with product context, money, promotion and return facts, but no order columns.

    Enough for the order, customer and product tables, which therefore skip the five order-side
    joins of :func:`item_fact`.
    """
    return _with_line_facts(checked_left_join(items, products, "product_id", _many_to_one(checked)), returns, reviews, items.columns)


def _with_line_facts(lines: DataFrame, returns: DataFrame, reviews: DataFrame, item_columns: list[str]) -> DataFrame:
    """Lines with their returns, reviews, money and flags."""
    item_keys = ["order_id", "product_id"]
    enriched = checked_left_join(lines, returns_agg(returns), item_keys, validate=None)
    enriched = checked_left_join(enriched, reviews_agg(reviews), item_keys, validate=None)
    promo = [c for c in ("promo_id", "promo_id_2") if c in item_columns]
    return with_line_money(enriched).withColumns(
        {"has_promo": any_present(promo), "is_returned": zero_if_null("return_records") > 0}
    )


def order_context(
    orders: DataFrame,
    customers: DataFrame,
    geography: DataFrame,
    payments: DataFrame,
    shipments: DataFrame,
    checked: bool = True,
) -> DataFrame:
    """Orders with customer profile, place, payment and shipment.

    Built at order grain, so each of these joins moves one row per order instead of one per line.
    """
    validate = _many_to_one(checked)
    enriched = checked_left_join(orders, keep_present(customers, PROFILE), "customer_id", validate)
    enriched = checked_left_join(enriched, keep_present(geography, PLACE), "zip", validate, "_geo")
    enriched = checked_left_join(enriched, keep_present(payments, PAYMENT), "order_id", validate)
    return checked_left_join(enriched, keep_present(shipments, SHIPMENT), "order_id", validate)


def item_fact(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    geography: DataFrame,
    payments: DataFrame,
    shipments: DataFrame,
    returns: DataFrame,
    reviews: DataFrame,
    checked: bool = True,
    owners: Owners | None = None,
) -> DataFrame:
    """Full order-line fact; one row per line, because returns and reviews are summed beforehand.

    ``owners``: tables that own the joined keys, to be checked instead of the joined tables themselves.
    """
    if checked:
        items = _with_unique(items, {"orders": orders, "products": products, **_context_sides(customers, geography, payments, shipments)}, owners)
    # Products first, so that their shuffle moves the narrowest lines; then everything that is joined by order.
    context = order_context(orders, customers, geography, payments, shipments, checked=False)
    lines = checked_left_join(items, products, "product_id", validate=None)
    placed = lines.join(context, "order_id", "left")
    fact = _with_line_facts(placed, returns, reviews, items.columns).withColumn("order_month", month_key("order_date"))
    order_side = [c for c in context.columns if c != "order_id"]
    own = [c for c in fact.columns if c not in {*order_side, "order_month"}]
    return fact.select(*[F.col(f"`{c}`") for c in (*own, *order_side, "order_month")])


def order_line_fact(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    payments: DataFrame | None = None,
    shipments: DataFrame | None = None,
    returns: DataFrame | None = None,
    reviews: DataFrame | None = None,
    checked: bool = True,
    owners: Owners | None = None,
) -> DataFrame:
    """Lighter order-line fact with optional payment, shipment, return and review parts.

    A line counts as promoted by its first promotion id alone. For ``owners`` see item_fact.
    """
    if checked:
        # Shipments are allowed to repeat, so they are not checked.
        sides = {"orders": orders, "products": products, "payments": payments}
        items = _with_unique(items, {n: df for n, df in sides.items() if df is not None}, owners)
    order_side = orders
    if payments is not None:
        order_side = checked_left_join(order_side, keep_present(payments, PAYMENT), "order_id", validate=None)
    if shipments is not None:
        if {"ship_date", "delivery_date"} <= set(shipments.columns):
            shipments = shipments.withColumn("delivery_lead_days", F.datediff("delivery_date", "ship_date"))
        wanted = ["order_id", "shipping_fee", "delivery_lead_days"]
        order_side = order_side.join(keep_present(shipments, wanted), "order_id", "left")

    fact = checked_left_join(items, products, "product_id", None, "_product")
    fact = fact.join(order_side, "order_id", "left")
    if returns is not None:
        records = F.count_distinct("return_id") if "return_id" in returns.columns else F.count(F.lit(1))
        per_line = returns.groupBy("order_id", "product_id").agg(
            F.sum("return_quantity").alias("return_quantity"),
            F.sum("refund_amount").alias("refund_amount"),
            records.alias("return_records"),
        )
        fact = fact.join(per_line, ["order_id", "product_id"], "left")
    if reviews is not None:
        per_line = reviews.groupBy("order_id", "product_id").agg(
            F.avg("rating").alias("avg_rating"), F.count(F.lit(1)).alias("review_records")
        )
        fact = fact.join(per_line, ["order_id", "product_id"], "left")

    revenue = F.col("quantity") * F.col("unit_price")
    fact = fact.withColumn("line_revenue", revenue)
    if "cogs" in fact.columns:
        cost = F.col("quantity") * F.col("cogs")
        fact = fact.withColumns(
            {
                "line_cogs": cost,
                "line_gross_profit": revenue - cost,
                "line_margin_pct": safe_divide(revenue - cost, revenue),
            }
        )
    has_promo = F.col("promo_id").isNotNull() if "promo_id" in fact.columns else F.lit(False)
    fact = fact.withColumn("has_promo", has_promo)
    if "promo_id_2" in fact.columns:
        fact = fact.withColumn("has_double_promo", all_present(["promo_id", "promo_id_2"]))
    day = F.col("order_date")
    return fact.withColumns({"year": F.year(day), "month": F.month(day), "year_month": month_key(day)})


# ---------------------------------------------------------------- orders


def order_item_totals(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_id").agg(
        F.count("product_id").alias("order_items"),
        sum_or_zero("quantity").alias("order_units"),
        sum_or_zero("line_revenue").alias("order_revenue_from_items"),
        sum_or_zero("line_cogs").alias("order_cogs_from_items"),
        sum_or_zero("discount_amount").alias("order_discount"),
        F.bool_or("has_promo").alias("any_promo"),
        F.bool_or("is_returned").alias("any_return"),
        F.avg("avg_rating").alias("avg_order_rating"),
    )


def order_fact(
    orders: DataFrame,
    lines: DataFrame,
    customers: DataFrame,
    geography: DataFrame,
    payments: DataFrame,
    shipments: DataFrame,
    checked: bool = True,
    owners: Owners | None = None,
) -> DataFrame:
    """Order fact; ``lines`` needs the columns of :func:`item_measures`. For ``owners`` see item_fact."""
    if checked:
        orders = _with_unique(orders, _context_sides(customers, geography, payments, shipments), owners)
    context = order_context(orders, customers, geography, payments, shipments, checked=False)
    fact = checked_left_join(context, order_item_totals(lines), "order_id", validate=None)
    return fact.withColumns(
        {
            "ship_lead_days": F.datediff("ship_date", "order_date"),
            "delivery_lead_days": F.datediff("delivery_date", "order_date"),
            "order_month": month_key("order_date"),
        }
    )


def order_outcomes(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """The part of the order fact that needs no customer, place, payment or shipment."""
    return checked_left_join(orders, order_item_totals(lines), "order_id", validate=None)


def order_days(orders: DataFrame, lines: DataFrame, shipments: DataFrame, checked: bool = False) -> DataFrame:
    """What daily tables need of the order fact: line totals and delivery lead; no customer or place."""
    dates = keep_present(shipments, ["order_id", "delivery_date"])
    dated = checked_left_join(order_outcomes(orders, lines), dates, "order_id", _many_to_one(checked))
    return dated.withColumn("delivery_lead_days", F.datediff("delivery_date", "order_date"))


# ---------------------------------------------------------------- customers


def customer_360(customers: DataFrame, order_facts: DataFrame) -> DataFrame:
    """Customers with order totals and rates; customers without orders are kept with 0 orders."""
    totals = order_facts.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("orders"),
        sum_or_zero("order_revenue_from_items").alias("total_revenue"),
        sum_or_zero("order_units").alias("total_units"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.coalesce(_as_count("any_return"), F.lit(0)).alias("return_orders"),
        F.coalesce(_as_count("any_promo"), F.lit(0)).alias("promo_orders"),
    )
    return checked_left_join(customers, totals, "customer_id", validate=None).withColumn(
        "orders", zero_if_null("orders")
    ).withColumns(
        {
            "return_order_rate": divide_if_positive("return_orders", "orders"),
            "promo_order_rate": divide_if_positive("promo_orders", "orders"),
        }
    )


def customer_mart(customers: DataFrame, orders: DataFrame, line_fact: DataFrame) -> DataFrame:
    """Customers with order count, dates, revenue, average order value and activity.

    Lines are summed to orders before they meet the orders table.
    """
    order_revenue = line_fact.groupBy("order_id").agg(sum_or_zero("line_revenue").alias("order_revenue"))
    totals = (
        orders.select("order_id", "customer_id", "order_date")
        .join(order_revenue, "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.count_distinct("order_id").alias("n_orders"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            sum_or_zero("order_revenue").alias("total_revenue"),
            F.avg("order_revenue").alias("avg_order_value"),
        )
        .withColumn("active_days", F.datediff("last_order_date", "first_order_date") + 1)
        .withColumn("orders_per_active_day", safe_divide("n_orders", "active_days"))
    )
    return checked_left_join(customers, totals, "customer_id", validate=None).withColumns(
        {"n_orders": zero_if_null("n_orders"), "total_revenue": F.coalesce("total_revenue", F.lit(0.0))}
    )


# ---------------------------------------------------------------- products


def product_totals(products: DataFrame, lines: DataFrame) -> DataFrame:
    """Products with line totals and rates; products never sold are kept with 0."""
    sold = lines.groupBy("product_id").agg(
        F.count("order_id").alias("item_lines"),
        sum_or_zero("quantity").alias("units_sold"),
        sum_or_zero("line_revenue").alias("revenue"),
        sum_or_zero("line_cogs").alias("cogs_total"),
        sum_or_zero("gross_profit").alias("gross_profit"),
        F.coalesce(_as_count("has_promo"), F.lit(0)).alias("promo_lines"),
        F.coalesce(_as_count("is_returned"), F.lit(0)).alias("returned_lines"),
        F.avg("avg_rating").alias("avg_rating"),
    )
    counts = ["item_lines", "promo_lines", "returned_lines"]
    money = ["units_sold", "revenue", "cogs_total", "gross_profit"]
    filled = {c: zero_if_null(c) for c in counts} | {c: F.coalesce(c, F.lit(0.0)) for c in money}
    return checked_left_join(products, sold, "product_id", validate=None).withColumns(filled).withColumns(
        {
            "gross_margin": divide_if_positive("gross_profit", "revenue"),
            "promo_line_rate": divide_if_positive("promo_lines", "item_lines"),
            "return_line_rate": divide_if_positive("returned_lines", "item_lines"),
        }
    )


def abc_class(cum_share):
    """A up to 80 % of revenue, B up to 95 %, C the rest; upper bounds included."""
    return F.when(cum_share <= 0.80, "A").when(cum_share <= 0.95, "B").when(cum_share <= 1.01, "C")


def product_360(products: DataFrame, lines: DataFrame) -> DataFrame:
    """Products ranked by revenue with cumulative share and ABC class.

    Rank and running sum are taken over range partitions, so the number of products is not limited
    by what one task can sort. Equal revenues are ordered by product id.
    """
    ranked = running_totals(
        product_totals(products, lines),
        [F.col("revenue").desc(), F.col("product_id").asc()],
        {"_revenue_so_far": F.col("revenue")},
        rank="revenue_rank",
    )
    share = safe_divide("_revenue_so_far", "_revenue_so_far_total")
    return (
        ranked.withColumn("cum_revenue_share", share)
        .withColumn("abc_class", abc_class(F.col("cum_revenue_share")))
        .drop("_revenue_so_far", "_revenue_so_far_total")
    )


def sku_pareto(product_mart: DataFrame, revenue_col: str = "revenue") -> DataFrame:
    """Revenue share, cumulative share, rank and ABC class of every product."""
    ranked = running_totals(
        product_mart,
        [F.col(revenue_col).desc(), F.col("product_id").asc()],
        {"_so_far": F.col(revenue_col)},
        rank="sku_rank",
    )
    return (
        ranked.withColumns(
            {
                "revenue_share": safe_divide(revenue_col, "_so_far_total", 0.0),
                "cum_revenue_share": safe_divide("_so_far", "_so_far_total", 0.0),
            }
        )
        .withColumn("abc_class", abc_class(F.col("cum_revenue_share")))
        .drop("_so_far", "_so_far_total")
    )


def product_mart(products: DataFrame, line_fact: DataFrame, inventory: DataFrame | None = None) -> DataFrame:
    """Products with units, revenue, orders, promotion and return rates, list margin and stock means.

    Missing values are filled with 0; margin on a zero price is NULL.
    """
    measures = {
        "units_sold": sum_or_zero("quantity"),
        "revenue": sum_or_zero("line_revenue"),
        "orders": F.count_distinct("order_id"),
        "promo_line_rate": F.avg(F.col("has_promo").cast("int")),
    }
    if "return_quantity" in line_fact.columns:
        measures["return_units"] = sum_or_zero("return_quantity")
    sold = line_fact.groupBy("product_id").agg(*[c.alias(n) for n, c in measures.items()])
    if "return_units" in measures:
        sold = sold.withColumn("unit_return_rate", safe_divide("return_units", "units_sold"))
    out = checked_left_join(products, sold, "product_id", validate=None)
    filled = [c for c in sold.columns if c != "product_id"]
    out = out.withColumns({c: zero_if_null(c) for c in filled})
    out = out.withColumn("gross_margin_pct", safe_divide(F.col("price") - F.col("cogs"), "price"))
    if inventory is not None:
        out = out.join(product_stock(inventory), "product_id", "left")
    return out


def product_stock(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("product_id").agg(
        F.avg("stockout_days").alias("avg_stockout_days"),
        F.sum("stockout_flag").alias("stockout_months"),
        F.avg("days_of_supply").alias("avg_days_of_supply"),
        F.avg("fill_rate").alias("avg_fill_rate"),
    )


def product_month_totals(dated_lines: DataFrame) -> DataFrame:
    """Line measures per product and month end."""
    return dated_lines.groupBy(F.last_day("order_date").alias("snapshot_date"), "product_id").agg(
        sum_or_zero("quantity").alias("item_units_sold"),
        sum_or_zero("line_revenue").alias("item_revenue"),
        sum_or_zero("gross_profit").alias("item_gross_profit"),
        F.coalesce(_as_count("has_promo"), F.lit(0)).alias("promo_lines"),
        F.coalesce(_as_count("is_returned"), F.lit(0)).alias("returned_lines"),
    )


def product_month_panel(inventory: DataFrame, products: DataFrame, dated_lines: DataFrame) -> DataFrame:
    """Monthly stock rows with list price, cost, that month's sales and a stock risk score."""
    master = keep_present(products, ["product_id", "price", "cogs", "size", "color"])
    panel = checked_left_join(inventory, master, "product_id", validate=None, suffix="_master")
    panel = panel.join(product_month_totals(dated_lines), ["snapshot_date", "product_id"], "left")
    money = ["item_units_sold", "item_revenue", "item_gross_profit"]
    filled = {c: F.coalesce(c, F.lit(0.0)) for c in money}
    filled |= {c: zero_if_null(c) for c in ("promo_lines", "returned_lines")}
    risk = zero_if_null("stockout_flag") + zero_if_null("reorder_flag") - zero_if_null("overstock_flag")
    return panel.withColumns(filled).withColumn("inventory_risk_score", risk)


# ---------------------------------------------------------------- days


def daily_traffic(web_traffic: DataFrame) -> DataFrame:
    """Traffic per day; rates are plain means over that day's rows."""
    sources = (
        F.count_distinct("traffic_source") if "traffic_source" in web_traffic.columns else F.count(F.lit(1))
    )
    per_day = known(web_traffic, "date").groupBy("date").agg(
        F.sum("sessions").alias("sessions"),
        F.sum("unique_visitors").alias("unique_visitors"),
        F.sum("page_views").alias("page_views"),
        F.avg("bounce_rate").alias("bounce_rate"),
        F.avg("avg_session_duration_sec").alias("avg_session_duration_sec"),
        sources.alias("n_traffic_sources"),
    )
    return per_day.withColumns(
        {
            "views_per_session": safe_divide("page_views", "sessions"),
            "visitors_per_session": safe_divide("unique_visitors", "sessions"),
        }
    ).withColumnRenamed("date", "Date")


def daily_orders(orders: DataFrame) -> DataFrame:
    """Orders, cancelled orders and cancellation rate per day."""
    return known(orders, "order_date").groupBy("order_date").agg(
        F.count_distinct("order_id").alias("n_orders"),
        F.count_if(F.col("order_status") == "cancelled").alias("cancelled_orders"),
    ).withColumn("cancel_rate", safe_divide("cancelled_orders", "n_orders")).withColumnRenamed("order_date", "Date")


def daily_order_facts(order_facts: DataFrame) -> DataFrame:
    """Orders, units, promoted and returned orders and mean delivery lead per day."""
    return known(order_facts, "order_date").groupBy(F.col("order_date").alias("Date")).agg(
        F.count_distinct("order_id").alias("orders"),
        sum_or_zero("order_units").alias("order_units"),
        F.coalesce(_as_count("any_promo"), F.lit(0)).alias("promo_orders"),
        F.coalesce(_as_count("any_return"), F.lit(0)).alias("return_orders"),
        F.avg("delivery_lead_days").alias("avg_delivery_lead_days"),
    )


def daily_panel(sales: DataFrame, web_traffic: DataFrame, order_facts: DataFrame) -> DataFrame:
    """Sales, traffic and order facts of each day with margin and calendar columns."""
    traffic = daily_traffic(web_traffic).select(
        "Date", "sessions", "unique_visitors", "page_views",
        F.col("bounce_rate").alias("avg_bounce_rate"), "avg_session_duration_sec",
    )
    profit = F.col("Revenue") - F.col("COGS")
    day = F.col("Date")
    return (
        sales.join(traffic, "Date", "left")
        .join(daily_order_facts(order_facts), "Date", "left")
        .withColumns(
            {
                "gross_profit": profit,
                "gross_margin": divide_if_positive(profit, "Revenue"),
                "year": F.year(day),
                "month": F.month(day),
                "dayofweek": F.weekday(day),
                "is_weekend": flag(F.weekday(day) >= 5),
            }
        )
    )


def daily_business_panel(
    sales: DataFrame, web_traffic: DataFrame | None = None, orders: DataFrame | None = None
) -> DataFrame:
    """Sales of each day with optional traffic and cancellation columns."""
    profit = F.col("Revenue") - F.col("COGS")
    panel = sales.withColumns({"gross_profit": profit, "gross_margin_pct": safe_divide(profit, "Revenue")})
    if web_traffic is not None:
        traffic = daily_traffic(web_traffic).drop("n_traffic_sources", "views_per_session", "visitors_per_session")
        panel = panel.join(traffic, "Date", "left")
    if orders is not None:
        panel = panel.join(daily_orders(orders), "Date", "left")
    day = F.col("Date")
    return panel.withColumns(
        {"year": F.year(day), "month": F.month(day), "dayofweek": F.weekday(day), "weekofyear": F.weekofyear(day)}
    )


def daily_promo_features(line_fact: DataFrame) -> DataFrame:
    """Promoted share of lines and revenue, and discount, per day."""
    promoted = F.when(F.col("has_promo"), F.col("line_revenue"))
    discount = sum_or_zero("discount_amount") if "discount_amount" in line_fact.columns else F.lit(0.0)
    return known(line_fact, "order_date").groupBy(F.col("order_date").alias("Date")).agg(
        F.avg(F.col("has_promo").cast("int")).alias("promo_line_rate"),
        sum_or_zero(promoted).alias("promo_revenue"),
        sum_or_zero("line_revenue").alias("total_revenue_items"),
        discount.alias("total_discount"),
    ).withColumn("promo_revenue_share", safe_divide("promo_revenue", "total_revenue_items"))


# ---------------------------------------------------------------- months


def monthly_inventory_features(inventory: DataFrame) -> DataFrame:
    return known(inventory, "snapshot_date").groupBy(month_key("snapshot_date").alias("year_month")).agg(
        F.sum("stockout_days").alias("stockout_days"),
        F.avg("stockout_flag").alias("stockout_product_rate"),
        F.avg("overstock_flag").alias("overstock_product_rate"),
        F.avg("reorder_flag").alias("reorder_product_rate"),
        F.avg("days_of_supply").alias("avg_days_of_supply"),
        F.avg("fill_rate").alias("avg_fill_rate"),
        F.sum("units_sold").alias("total_units_sold_inventory"),
    )


def add_inventory_month_to_daily(daily: DataFrame, monthly: DataFrame, date_col: str = "Date") -> DataFrame:
    return daily.withColumn("year_month", month_key(date_col)).join(monthly, "year_month", "left")
