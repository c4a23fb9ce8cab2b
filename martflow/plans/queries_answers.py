"""Registered queries: revenue, customer, promotion, product and traffic answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from martflow.functions.expr import clip, money_text, period_label, safe_divide
from martflow.operators import customers, marts, products, promotions, revenue, traffic
from martflow.operators.joins import orders_shipments
from martflow.plans.queries_marts import product_marts, product_months, slim_line_fact
from martflow.plans.queries_quality import item_lines
from martflow.plans.registry import Query
from martflow.sources import raw
from martflow.sources.retail_views import RetailViews

# Compared years of the test tables: 1995-1998 against 1999-2001.
YEARS = (1995, 1998, 2001)
SPAN = (1995, 2001)
POST = (1999, 2001)
TARGETS = {"conversion_30": 980e6, "cr_retention": 1085e6}
H1 = ("2001-01-01", "2001-07-01")


def items(v: RetailViews):
    return raw.item_level(v.order_items(), v.orders_without_place(), v.products())


def orders_paid(v: RetailViews):
    return raw.order_level(v.orders_without_place(), v.payments())


def shipped_orders(v: RetailViews):
    return orders_shipments(v.orders_without_place(), v.shipments())


def promo_orders(v: RetailViews):
    lines = promotions.sold_lines(items(v), *SPAN)
    return promotions.promo_order_level(lines).withColumn("period", period_label(F.year("order_date"), YEARS[1]))


def half_year_months(v: RetailViews):
    sales = v.sales().where((F.col("Date") >= F.lit(H1[0]).cast("date")) & (F.col("Date") < F.lit(H1[1]).cast("date")))
    return revenue.month_totals(sales)


def six_buckets(v: RetailViews):
    return products.sku_buckets(v.inventory(), items(v), *POST)


def q70(v: RetailViews):
    return products.sku_action_q70(products.sku_ops(product_months(v)))


H1_SQL = """select cast(date_trunc('month', "Date") as date) as month, sum("Revenue") as revenue from v_sales
            where "Date" >= date '2001-01-01' and "Date" < date '2001-07-01' group by 1"""


def _before_after(view: str, changes: list[tuple[str, str, bool]]) -> str:
    """Changes between the two rows or row groups of a pre/post view; True marks percent."""
    pre = {c: f"avg(case when period = 'pre' then {c} end)" for _, c, _ in changes}
    post = {c: f"avg(case when period = 'post' then {c} end)" for _, c, _ in changes}
    columns = [
        f"({post[c]} / {pre[c]} - 1) * 100 as {n}" if pct else f"({post[c]} - {pre[c]}) * 100 as {n}" for n, c, pct in changes
    ]
    return f"select {', '.join(columns)} from {view}"


SCORED_SQL = """select "Date", "Revenue", "COGS", m as revenue_28d_mean, s as revenue_28d_std, ("Revenue" - m) / nullif(s, 0) as z_score
    from (select *, case when count(*) over w >= 7 then avg("Revenue") over w end as m,
                 case when count(*) over w >= 7 then stddev_samp("Revenue") over w end as s
          from v_sales window w as (order by "Date" rows between 27 preceding and current row)) a"""

QUERIES: dict[str, Query] = {
    # ---- revenue
    "revenue_kpis": Query(
        "total_revenue:0 total_cogs:0 gross_profit:0 gross_margin_pct:6 start_date:d end_date:d",
        lambda v: revenue.revenue_kpis(v.sales()),
        """select sum("Revenue") as total_revenue, sum("COGS") as total_cogs, sum("Revenue") - sum("COGS") as gross_profit,
                  (sum("Revenue") - sum("COGS")) / sum("Revenue") as gross_margin_pct, min("Date") as start_date, max("Date") as end_date
           from v_sales""",
    ),
    "portfolio_counts": Query(
        "n_item_lines:i n_products:i",
        lambda v: revenue.portfolio_counts(v.order_items(), v.products()),
        "select (select count(*) from v_order_items) as n_item_lines, (select count(distinct product_id) from v_products) as n_products",
    ),
    "monthly_revenue": Query(
        "year_month revenue:2 cogs:2 avg_daily_revenue:2 n_days:i gross_margin:6",
        lambda v: revenue.monthly_revenue(v.sales()),
        """select strftime("Date", '%Y-%m') as year_month, sum("Revenue") as revenue, sum("COGS") as cogs,
                  avg("Revenue") as avg_daily_revenue, count(*) as n_days, (sum("Revenue") - sum("COGS")) / sum("Revenue") as gross_margin
           from v_sales group by 1""",
    ),
    "monthly_resample": Query(
        "month_end:d Revenue:2 COGS:2 gross_margin:6 revenue_3m_avg:2 margin_3m_avg:6",
        lambda v: revenue.monthly_resample(v.sales()),
        """select *, avg("Revenue") over w as revenue_3m_avg, avg(gross_margin) over w as margin_3m_avg
           from (select last_day(m) as month_end, coalesce("Revenue", 0) as "Revenue", coalesce("COGS", 0) as "COGS",
                        ("Revenue" - "COGS") / nullif("Revenue", 0) as gross_margin
                 from (select cast(unnest(generate_series(date_trunc('month', min("Date")), date_trunc('month', max("Date")), interval 1 month)) as date) as m
                       from v_sales) c
                 left join (select last_day("Date") as me, sum("Revenue") as "Revenue", sum("COGS") as "COGS" from v_sales group by 1) s
                   on last_day(c.m) = s.me) t
           window w as (order by month_end rows between 2 preceding and current row)""",
    ),
    "seasonality": Query(
        "month:i avg_daily_revenue:2 avg_margin:6 days:i",
        lambda v: revenue.seasonality(v.sales()),
        """select extract(month from "Date") as month, avg("Revenue") as avg_daily_revenue,
                  avg(case when "Revenue" > 0 then ("Revenue" - "COGS") / "Revenue" end) as avg_margin, count(*) as days from v_sales group by 1""",
    ),
    "annual_mean_revenue": Query(
        "year:i avg_daily_revenue:2",
        lambda v: revenue.annual_mean_revenue(v.sales()),
        """select extract(year from "Date") as year, avg("Revenue") as avg_daily_revenue from v_sales group by 1""",
    ),
    "regime_summary": Query(
        "period total_revenue:0 avg_daily_revenue:2 avg_monthly_revenue:1 peak_month_revenue:2 peak_month weighted_gross_margin:6 "
        "worst_gross_margin:6 worst_margin_month",
        lambda v: revenue.regime_summary(v.sales(), *YEARS),
        "select * from m_regime_summary",
    ),
    "regime_shift": Query(
        "avg_daily_change_pct:6 avg_monthly_change_pct:6 peak_change_pct:6 gross_margin_change_pp:6",
        lambda v: revenue.regime_shift(v.sales(), *YEARS),
        _before_after(
            "m_regime_summary",
            [
                ("avg_daily_change_pct", "avg_daily_revenue", True),
                ("avg_monthly_change_pct", "avg_monthly_revenue", True),
                ("peak_change_pct", "peak_month_revenue", True),
                ("gross_margin_change_pp", "weighted_gross_margin", False),
            ],
        ),
    ),
    "neg_margin_months": Query(
        "year_month period revenue:2 cogs:2 gross_margin:6 is_odd_august",
        # The test tables never sell a month below cost, so the bound is a 20 % margin here.
        lambda v: revenue.negative_margin_months(v.sales(), *YEARS, below=0.20),
        """select strftime(month_start, '%Y-%m') as year_month, period, revenue, cogs, gross_margin,
                  (month = 8 and year % 2 = 1) as is_odd_august from m_regime_months where gross_margin < 0.20""",
    ),
    "scored_revenue": Query(
        "Date:d Revenue:2 COGS:2 revenue_28d_mean:2 revenue_28d_std:2 z_score:6 is_anomaly",
        lambda v: revenue.scored_revenue(v.sales(), threshold=2.5),
        f"select *, coalesce(abs(z_score) >= 2.5, false) as is_anomaly from ({SCORED_SQL}) s",
    ),
    "revenue_anomalies": Query(
        "Date:d Revenue:2 COGS:2 revenue_28d_mean:2 revenue_28d_std:2 z_score:6",
        # 2.5 deviations instead of 3, so that the small scale factors show some days.
        lambda v: revenue.top_anomalies(revenue.scored_revenue(v.sales(), threshold=2.5)),
        f"""select * from ({SCORED_SQL}) s where abs(z_score) >= 2.5 order by abs(z_score) desc, "Date" limit 30""",
    ),
    "scenario_scale": Query(
        "month:d status_quo:2 conversion_30:2 cr_retention:2 status_quo_mn:6 conversion_30_mn:6 cr_retention_mn:6",
        lambda v: revenue.scenario_scale(half_year_months(v), TARGETS),
        f"""select month, revenue as status_quo, revenue * 980e6 / total as conversion_30, revenue * 1085e6 / total as cr_retention,
                   revenue / 1e6 as status_quo_mn, revenue * 980 / total as conversion_30_mn, revenue * 1085 / total as cr_retention_mn
            from (select *, sum(revenue) over () as total from ({H1_SQL}) m) t""",
    ),
    "scenario_lift": Query(
        "scenario status_quo_mn:6 target_mn:6 lift_mn:6 lift_pct:6",
        lambda v: revenue.scenario_lift(half_year_months(v), TARGETS),
        f"""select scenario, status_quo_mn, target_mn, target_mn - status_quo_mn as lift_mn, (target_mn - status_quo_mn) / status_quo_mn * 100 as lift_pct
            from (select sum(revenue) / 1e6 as status_quo_mn from ({H1_SQL}) m) s
            cross join (select 'conversion_30' as scenario, 980.0 as target_mn union all select 'cr_retention', 1085.0) t""",
    ),
    "money_text": Query(
        "category revenue_text mean_text",
        lambda v: products.category_contribution(item_lines(v)).select(
            "category",
            money_text("revenue").alias("revenue_text"),
            money_text(safe_divide("revenue", "item_lines")).alias("mean_text"),
        ),
        """select category, case when r >= 1e9 then printf('%.2fB', r / 1e9) when r >= 1e6 then printf('%.2fM', r / 1e6)
                  when r >= 1e3 then printf('%.2fK', r / 1e3) else printf('%.2f', r) end as revenue_text,
                  case when a >= 1e9 then printf('%.2fB', a / 1e9) when a >= 1e6 then printf('%.2fM', a / 1e6)
                  when a >= 1e3 then printf('%.2fK', a / 1e3) else printf('%.2f', a) end as mean_text
           from (select category, sum(line_revenue) as r, sum(line_revenue) / count(*) as a from m_item_measures group by category) t""",
    ),
    "safe_divide": Query(
        "Date:d cancel_rate:6 cancelled_per_shipped:6 cancelled_per_shipped_or_zero:6",
        lambda v: v.orders_without_place()
        .groupBy(F.col("order_date").alias("Date"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("order_status") == "cancelled").alias("cancelled"),
            F.count_if(F.col("order_status") == "shipped").alias("shipped"),
        )
        .select(
            "Date",
            safe_divide("cancelled", "n").alias("cancel_rate"),
            safe_divide("cancelled", "shipped").alias("cancelled_per_shipped"),
            safe_divide("cancelled", "shipped", 0.0).alias("cancelled_per_shipped_or_zero"),
        ),
        """select "Date", c / n as cancel_rate, c / nullif(s, 0) as cancelled_per_shipped, coalesce(c / nullif(s, 0), 0) as cancelled_per_shipped_or_zero
           from (select order_date as "Date", cast(count(*) as double) as n, sum(case when order_status = 'cancelled' then 1.0 else 0.0 end) as c,
                        sum(case when order_status = 'shipped' then 1.0 else 0.0 end) as s from v_orders group by order_date) t""",
    ),
    # ---- customers
    "customer_health": Query(
        "year:i active_customers:i orders:i revenue:1 repeat_rate:6 orders_per_active_customer:6 aov:2 period",
        lambda v: customers.customer_health(orders_paid(v), *YEARS),
        "select * from m_health",
    ),
    "customer_health_shift": Query(
        "active_customers_change_pct:6 orders_per_customer_change_pct:6 repeat_rate_change_pp:6 aov_change_pct:6",
        lambda v: customers.customer_health_shift(orders_paid(v), *YEARS),
        _before_after(
            "m_health",
            [
                ("active_customers_change_pct", "active_customers", True),
                ("orders_per_customer_change_pct", "orders_per_active_customer", True),
                ("repeat_rate_change_pp", "repeat_rate", False),
                ("aov_change_pct", "aov", True),
            ],
        ),
    ),
    "order_gap_stats": Query(
        "metric value:6",
        lambda v: customers.order_gap_stats(v.orders_without_place()),
        """select 'repeat_orders' as metric, cast(count(*) as double) as value from m_gaps
           union all select 'median_inter_order_gap', median(gap_days) from m_gaps
           union all select 'mean_inter_order_gap', avg(gap_days) from m_gaps
           union all select 'p75_inter_order_gap', quantile_cont(gap_days, 0.75) from m_gaps""",
    ),
    "order_gap_hist": Query(
        "bin:i bin_start:6 bin_end:6 n:i",
        lambda v: customers.order_gap_histogram(v.orders_without_place()),
        """select bin, lo + (hi - lo) * bin / 40.0 as bin_start, lo + (hi - lo) * (bin + 1) / 40.0 as bin_end, count(*) as n
           from (select lo, hi, least(((g - lo) * 40) // (hi - lo), 39) as bin
                 from (select least(gap_days, 730) as g, min(least(gap_days, 730)) over () as lo, max(least(gap_days, 730)) over () as hi from m_gaps) a) b
           group by bin, lo, hi""",
    ),
    "repurchase_90d": Query(
        "order_id:i customer_id:i order_date:d period revenue:4 promo_used:i next_order_date:d next_gap_days:i eligible_90d repurchase_90d:i",
        lambda v: customers.repurchase_90d(promo_orders(v)),
        "select * from m_repurchase",
    ),
    "age_group_intensity": Query(
        "age_group customers:i total_orders:i avg_orders_per_customer:6",
        lambda v: customers.age_group_intensity(v.customers(), v.orders_without_place()),
        """select age_group, count(distinct c.customer_id) as customers, sum(coalesce(n, 0)) as total_orders, avg(coalesce(n, 0)) as avg_orders_per_customer
           from v_customers c left join (select customer_id, count(distinct order_id) as n from v_orders group by customer_id) o
             on c.customer_id = o.customer_id where age_group is not null group by age_group""",
    ),
    "payment_status_share": Query(
        "payment_method order_status orders:i total_orders:i status_share:6",
        lambda v: customers.payment_status_share(v.orders_without_place()),
        """select *, sum(orders) over (partition by payment_method) as total_orders, orders / cast(sum(orders) over (partition by payment_method) as double) as status_share
           from (select payment_method, order_status, count(distinct order_id) as orders from v_orders group by 1, 2) t""",
    ),
    "cancelled_share": Query(
        "payment_method orders:i total_orders:i status_share:6",
        lambda v: customers.cancelled_share(v.orders_without_place()),
        """select payment_method, count(distinct case when order_status = 'cancelled' then order_id end) as orders, count(distinct order_id) as total_orders,
                  count(distinct case when order_status = 'cancelled' then order_id end) / cast(count(distinct order_id) as double) as status_share
           from v_orders group by payment_method""",
    ),
    "lead_time_stats": Query(
        "count:i mean:6 std:6 min:2 p25:4 median:4 p75:4 max:2",
        lambda v: customers.lead_time_stats(shipped_orders(v)),
        """select count(*) as "count", avg(delivery_lead_days) as mean, stddev_samp(delivery_lead_days) as std, min(delivery_lead_days) as "min",
                  quantile_cont(delivery_lead_days, 0.25) as p25, median(delivery_lead_days) as median, quantile_cont(delivery_lead_days, 0.75) as p75,
                  max(delivery_lead_days) as "max" from m_lead""",
    ),
    "lead_time_hist": Query(
        "bin:i bin_start:6 bin_end:6 n:i",
        lambda v: customers.lead_time_histogram(shipped_orders(v)),
        """select bin, lo + (hi - lo) * bin / 30.0 as bin_start, lo + (hi - lo) * (bin + 1) / 30.0 as bin_end, count(*) as n
           from (select lo, hi, least(((g - lo) * 30) // (hi - lo), 29) as bin
                 from (select delivery_lead_days as g, min(delivery_lead_days) over () as lo, max(delivery_lead_days) over () as hi from m_lead) a) b
           group by bin, lo, hi""",
    ),
    # ---- promotions, returns, ratings
    "promo_summary": Query(
        "has_promo lines:i revenue:0 units:2 avg_line_revenue:4 margin_pct:6",
        lambda v: promotions.promo_summary(slim_line_fact(v)),
        """select has_promo, count(*) as lines, sum(line_revenue) as revenue, sum(quantity) as units, avg(line_revenue) as avg_line_revenue,
                  avg(line_margin_pct) as margin_pct from m_order_line_fact group by has_promo""",
    ),
    "promo_tradeoff": Query(
        "has_promo item_lines:i units:2 revenue:0 cogs:0 discount:0 gross_profit:0 gross_margin:6 revenue_share:6 line_share:6 label",
        lambda v: promotions.promo_tradeoff(item_lines(v)),
        """select *, revenue - cogs as gross_profit, (revenue - cogs) / revenue as gross_margin, revenue / sum(revenue) over () as revenue_share,
                  item_lines / cast(sum(item_lines) over () as double) as line_share, case when has_promo then 'Promo lines' else 'Non-promo lines' end as label
           from (select has_promo, count(*) as item_lines, sum(quantity) as units, sum(line_revenue) as revenue, sum(line_cogs) as cogs,
                        sum(discount_amount) as discount from m_item_measures group by has_promo) t""",
    ),
    "promo_diag": Query(
        "period promo_used:i orders:i revenue:1 gross_profit:1 eligible_orders_90d:i repurchase_90d:i gross_margin:6 repurchase_90d_rate:6 "
        "total_revenue:0 total_orders:i revenue_share:6",
        lambda v: promotions.promo_diag(items(v), *YEARS),
        """select *, gross_profit / nullif(revenue, 0) as gross_margin, repurchase_90d / cast(nullif(eligible_orders_90d, 0) as double) as repurchase_90d_rate,
                  sum(revenue) over (partition by period) as total_revenue, sum(orders) over (partition by period) as total_orders,
                  revenue / sum(revenue) over (partition by period) as revenue_share
           from (select period, promo_used, count(distinct order_id) as orders, sum(revenue) as revenue, sum(gross_profit) as gross_profit,
                        sum(case when eligible_90d then 1 else 0 end) as eligible_orders_90d, sum(repurchase_90d) as repurchase_90d
                 from m_repurchase group by period, promo_used) t""",
    ),
    "promo_effect": Query(
        "promo_used:i orders:i revenue:1 gross_merch_value:1 gross_profit:1 discount_amount:1 eligible_orders:i repurchase_90d:i "
        "revenue_share:6 gross_margin:6 discount_rate:6 repurchase_90d_rate:6",
        lambda v: promotions.promo_effect(items(v), *POST),
        "select * from m_promo_effect",
    ),
    "promo_gaps": Query(
        "promo_revenue_share_pct:6 promo_margin_gap_pp:6 promo_90d_repeat_gap_pp:6",
        lambda v: promotions.promo_gaps(promotions.promo_effect(items(v), *POST)),
        """select p.revenue_share * 100 as promo_revenue_share_pct, (p.gross_margin - n.gross_margin) * 100 as promo_margin_gap_pp,
                  (p.repurchase_90d_rate - n.repurchase_90d_rate) * 100 as promo_90d_repeat_gap_pp
           from (select * from m_promo_effect where promo_used = 1) p cross join (select * from m_promo_effect where promo_used = 0) n""",
    ),
    "category_period": Query(
        "period category revenue:1 gross_profit:1 promo_revenue:1 gross_margin:6 promo_revenue_share:6 total_period_revenue:0 revenue_share:6",
        lambda v: promotions.category_period(items(v), *YEARS),
        "select * from m_category_period",
    ),
    "category_regime": Query(
        "category rev_share_pre:6 gm_pre:6 promo_share_pre:6 rev_share_post:6 gm_post:6 promo_share_post:6",
        lambda v: promotions.category_regime(items(v), *YEARS),
        """select coalesce(a.category, b.category) as category, a.revenue_share as rev_share_pre, a.gross_margin as gm_pre,
                  a.promo_revenue_share as promo_share_pre, b.revenue_share as rev_share_post, b.gross_margin as gm_post,
                  b.promo_revenue_share as promo_share_post
           from (select * from m_category_period where period = 'pre') a
           full outer join (select * from m_category_period where period = 'post') b on a.category = b.category""",
    ),
    "margin_clip": Query(
        "order_id:i product_id:i margin_clipped:6 revenue_floored:4",
        lambda v: items(v)
        .withColumn("Revenue", F.col("net_item_revenue"))
        .withColumn("margin", safe_divide("gross_profit", "Revenue"))
        .select(
            "order_id",
            "product_id",
            clip("margin", 0.02, 0.35).alias("margin_clipped"),
            clip("net_item_revenue", lower=0.0).alias("revenue_floored"),
        ),
        """select order_id, product_id, least(greatest(gross_profit / nullif(net_item_revenue, 0), 0.02), 0.35) as margin_clipped,
                  greatest(net_item_revenue, 0) as revenue_floored from v_item_level""",
    ),
    "return_reasons": Query(
        "return_reason category return_records:i return_units:2 refund_amount:1",
        lambda v: promotions.return_reason_summary(v.returns(), v.products()),
        """select return_reason, category, count(*) as return_records, sum(return_quantity) as return_units, sum(refund_amount) as refund_amount
           from v_returns r left join v_products p on r.product_id = p.product_id group by return_reason, category""",
    ),
    "top_return_reasons": Query(
        "return_reason records:i",
        lambda v: promotions.top_return_reasons(item_lines(v)),
        """select top_return_reason as return_reason, count(*) as records from m_item_measures where top_return_reason is not null
           group by 1 order by records desc, return_reason limit 10""",
    ),
    "rating_return": Query(
        "rating:i reviews:i returned_review_items:i return_rate_among_reviewed:6",
        lambda v: promotions.rating_return(v.reviews(), v.returns()),
        """select rating, count(distinct review_id) as reviews, sum(coalesce(hit, 0)) as returned_review_items,
                  sum(coalesce(hit, 0)) / cast(count(distinct review_id) as double) as return_rate_among_reviewed
           from v_reviews w left join (select distinct order_id, product_id, 1 as hit from v_returns) r
             on w.order_id = r.order_id and w.product_id = r.product_id group by rating""",
    ),
    # ---- products
    "category_summary": Query(
        "category revenue:1 units:2 orders:i margin_pct:6 promo_line_rate:6",
        lambda v: products.category_summary(slim_line_fact(v)),
        """select category, sum(line_revenue) as revenue, sum(quantity) as units, count(distinct order_id) as orders, avg(line_margin_pct) as margin_pct,
                  avg(case when has_promo then 1.0 else 0.0 end) as promo_line_rate from m_order_line_fact group by category""",
    ),
    "category_contribution": Query(
        "category revenue:1 cogs:1 units:2 item_lines:i gross_profit:1 gross_margin:6 revenue_share:6",
        lambda v: products.category_contribution(item_lines(v)),
        """select *, revenue - cogs as gross_profit, (revenue - cogs) / revenue as gross_margin, revenue / sum(revenue) over () as revenue_share
           from (select category, sum(line_revenue) as revenue, sum(line_cogs) as cogs, sum(quantity) as units, count(*) as item_lines
                 from m_item_measures group by category) t""",
    ),
    "sku_pareto": Query(
        "product_id:i revenue:2 revenue_share:8 cum_revenue_share:6 sku_rank:i abc_class",
        lambda v: marts.sku_pareto(marts.product_mart(v.products(), slim_line_fact(v)).select("product_id", "revenue")),
        """select *, case when cum_revenue_share <= 0.80 then 'A' when cum_revenue_share <= 0.95 then 'B' else 'C' end as abc_class
           from (select product_id, revenue, revenue / sum(revenue) over () as revenue_share,
                        sum(revenue) over (order by revenue desc, product_id rows unbounded preceding) / sum(revenue) over () as cum_revenue_share,
                        row_number() over (order by revenue desc, product_id) as sku_rank from m_product_mart) t""",
    ),
    "abc_summary": Query(
        "abc_class n_skus:i revenue:0 avg_margin:6 revenue_share:6",
        lambda v: products.abc_summary(marts.product_360(v.products(), item_lines(v))),
        """select *, revenue / sum(revenue) over () as revenue_share from (select abc_class, count(*) as n_skus, sum(revenue) as revenue,
                  avg(gross_margin) as avg_margin from m_product_360 group by abc_class) t""",
    ),
    "sku_action_2x2": Query(
        "product_id:i revenue:2 avg_stockout_days:6 sku_action",
        lambda v: products.sku_action_matrix(product_marts(v)),
        "select * from m_sku_2x2",
    ),
    "sku_action_totals": Query(
        "sku_action sku_count:i revenue:0 avg_stockout_days:6",
        lambda v: products.sku_action_totals(products.sku_action_matrix(product_marts(v))),
        "select sku_action, count(*) as sku_count, sum(revenue) as revenue, avg(avg_stockout_days) as avg_stockout_days from m_sku_2x2 group by 1",
    ),
    "sku_ops": Query(
        "product_id:i product_name category segment units_sold:2 stock_on_hand:4 stockout_days:6 stockout_rate:6 overstock_rate:6 "
        "reorder_rate:6 sell_through_rate:6 revenue:2",
        lambda v: products.sku_ops(product_months(v), marts.product_totals(v.products(), item_lines(v))),
        "select * from m_sku_ops",
    ),
    "sku_action_q70": Query(
        "product_id:i revenue:2 stockout_rate:6 overstock_rate:6 sell_through_rate:6 action",
        q70,
        "select * from m_sku_q70",
    ),
    "sku_action_summary": Query(
        "action n_skus:i revenue:0 avg_stockout_rate:6 avg_overstock_rate:6 avg_sell_through:6 revenue_share:6",
        lambda v: products.sku_action_summary(q70(v)),
        """select *, revenue / sum(revenue) over () as revenue_share
           from (select action, count(*) as n_skus, sum(revenue) as revenue, avg(stockout_rate) as avg_stockout_rate,
                        avg(overstock_rate) as avg_overstock_rate, avg(sell_through_rate) as avg_sell_through from m_sku_q70 group by action) t""",
    ),
    "sku_buckets": Query(
        "product_id:i sell_through_avg:6 stockout_days_avg:6 stockout_rate:6 overstock_rate:6 fill_rate_avg:6 revenue_total:3 "
        "active_months:i avg_monthly_revenue:3 action_bucket",
        six_buckets,
        "select * from m_sku_buckets",
    ),
    "sku_bucket_summary": Query(
        "action_bucket sku_count:i revenue_total:0 avg_monthly_revenue:1 sku_share:6 avg_monthly_revenue_mn:6",
        lambda v: products.sku_bucket_summary(six_buckets(v)),
        """select *, sku_count / cast(sum(sku_count) over () as double) as sku_share, avg_monthly_revenue / 1e6 as avg_monthly_revenue_mn
           from (select action_bucket, count(*) as sku_count, sum(revenue_total) as revenue_total, sum(avg_monthly_revenue) as avg_monthly_revenue
                 from m_sku_buckets group by action_bucket) t""",
    ),
    # ---- traffic and place
    "traffic_source": Query(
        "traffic_source sessions:i unique_visitors:i page_views:2 avg_bounce_rate:6 avg_session_duration_sec:6",
        lambda v: traffic.traffic_source_quality(v.web_traffic()),
        """select traffic_source, sum(sessions) as sessions, sum(unique_visitors) as unique_visitors, sum(page_views) as page_views,
                  avg(bounce_rate) as avg_bounce_rate, avg(avg_session_duration_sec) as avg_session_duration_sec from v_web_traffic group by 1""",
    ),
    "traffic_source_events": Query(
        "traffic_source sessions:i unique_visitors:i page_views:i avg_bounce_rate:6 avg_session_duration_sec:6",
        lambda v: traffic.traffic_source_quality(v.event_traffic()),
        """select traffic_source, sum(sessions) as sessions, sum(unique_visitors) as unique_visitors, sum(page_views) as page_views,
                  avg(bounce_rate) as avg_bounce_rate, avg(avg_session_duration_sec) as avg_session_duration_sec from v_event_traffic group by 1""",
    ),
    "conversion_funnel": Query(
        "year:i sessions:i orders:i revenue:1 conversion_rate:6 revenue_per_session:4 period",
        lambda v: traffic.conversion_funnel(v.web_traffic(), orders_paid(v), *YEARS),
        "select * from m_funnel",
    ),
    "funnel_shift": Query(
        "sessions_change_pct:6 conversion_rate_change_pct:6 revenue_per_session_change_pct:6",
        lambda v: traffic.funnel_shift(v.web_traffic(), orders_paid(v), *YEARS),
        _before_after(
            "m_funnel",
            [
                ("sessions_change_pct", "sessions", True),
                ("conversion_rate_change_pct", "conversion_rate", True),
                ("revenue_per_session_change_pct", "revenue_per_session", True),
            ],
        ),
    ),
    "region_revenue": Query(
        "region revenue:1 orders:i units:2 revenue_share:6",
        lambda v: traffic.region_revenue(
            with_region(v)
        ),
        """select *, revenue / sum(revenue) over () as revenue_share
           from (select region, sum(line_revenue) as revenue, count(distinct order_id) as orders, sum(quantity) as units
                 from m_item_fact where region is not null group by region) t""",
    ),
}


def with_region(v: RetailViews):
    """Lines with their order's region; the two small joins happen at order grain."""
    place = v.orders().join(v.geography().select("zip", "region"), "zip", "left").select("order_id", "region")
    return (
        v.order_items()
        .withColumn("line_revenue", F.col("quantity") * F.col("unit_price"))
        .join(place, "order_id", "left")
    )
