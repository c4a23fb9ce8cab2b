"""SQL text of the retail tables and marts, used only to check the Spark results.

Written independently of the DataFrame code: ``v_`` views restate the raw tables over the test
tables, ``m_`` views the marts. Order matters: a view may use the ones above it.
"""

VIEWS: dict[str, str] = {}

VIEWS["v_orders"] = """
select o_orderkey as order_id, cast(o_orderdate as date) as order_date, o_custkey as customer_id, c_nationkey as zip,
       case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'cancelled' end as order_status,
       o_orderpriority as payment_method
from orders left join customer on o_custkey = c_custkey"""

VIEWS["v_order_items"] = """
select l_orderkey as order_id, l_partkey as product_id, l_quantity as quantity, l_extendedprice / l_quantity as unit_price,
       l_extendedprice * l_discount as discount_amount,
       case when l_discount >= 0.05 then concat('P', cast(cast(round(l_discount * 100) as int) as varchar)) end as promo_id,
       case when l_discount >= 0.09 then 'X' end as promo_id_2
from lineitem"""

VIEWS["v_products"] = """
select p_partkey as product_id, p_name as product_name, p_type as category, p_brand as segment, p_size as size,
       2.0 * p_retailprice as price, 1.6 * p_retailprice as cogs
from part"""

VIEWS["v_customers"] = """
select c_custkey as customer_id, c_nationkey as zip, c_mktsegment as age_group from customer"""

VIEWS["v_geography"] = """
select n_nationkey as zip, n_name as district, r_name as region from nation join region on n_regionkey = r_regionkey"""

VIEWS["v_payments"] = """
select o_orderkey as order_id, o_totalprice as payment_value, cast(1 + o_orderkey % 12 as int) as installments from orders"""

VIEWS["v_shipments"] = """
select l_orderkey as order_id, cast(min(l_shipdate) as date) as ship_date, cast(max(l_shipdate) as date) as delivery_date,
       sum(l_tax * l_extendedprice) as shipping_fee
from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus <> 'P' group by l_orderkey"""

VIEWS["v_returns"] = """
select l_orderkey * 10 + l_linenumber as return_id, l_orderkey as order_id, l_partkey as product_id,
       cast(l_shipdate as date) as return_date,
       case l_linenumber % 4 when 0 then 'wrong_size' when 1 then 'defective' when 2 then 'late_delivery' else 'changed_mind' end as return_reason,
       l_quantity as return_quantity, l_extendedprice * (1 - l_discount) as refund_amount
from lineitem where l_returnflag = 'R'"""

VIEWS["v_reviews"] = """
select l_orderkey * 10 + l_linenumber as review_id, l_orderkey as order_id, l_partkey as product_id, o_custkey as customer_id,
       cast(l_shipdate as date) as review_date, cast(1 + (l_partkey + l_linenumber) % 5 as int) as rating
from lineitem join orders on l_orderkey = o_orderkey where l_returnflag in ('A', 'R')"""

VIEWS["v_sales"] = """
select cast(o_orderdate as date) as "Date", sum(l_extendedprice * (1 - l_discount)) as "Revenue",
       sum(l_quantity * 1.6 * p_retailprice) as "COGS"
from lineitem join orders on l_orderkey = o_orderkey left join part on l_partkey = p_partkey group by cast(o_orderdate as date)"""

VIEWS["v_web_traffic"] = """
select cast(l_shipdate as date) as "date", l_returnflag as traffic_source, count(*) as sessions,
       count(distinct l_suppkey) as unique_visitors, sum(l_quantity) as page_views,
       avg(l_discount) as bounce_rate, avg(l_tax) * 1000 as avg_session_duration_sec
from lineitem group by cast(l_shipdate as date), l_returnflag"""

VIEWS["v_event_traffic"] = """
select cast(ts as date) as "date", event_type as traffic_source, count(*) as sessions,
       count(distinct user_id) as unique_visitors, count(*) as page_views,
       avg(cast(case when value < 20 then 1 else 0 end as double)) as bounce_rate, avg(value) as avg_session_duration_sec
from events group by cast(ts as date), event_type"""

VIEWS["v_inventory"] = """
select snapshot_date, product_id, category, segment, product_name, units_sold, p_size * 4 as stock_on_hand,
       greatest(0.0, least(30.0, units_sold - p_size)) as stockout_days,
       30.0 * p_size / units_sold as days_of_supply, least(1.0, p_size / units_sold) as fill_rate,
       units_sold / (units_sold + p_size) as sell_through_rate,
       case when units_sold > p_size then 1 else 0 end as stockout_flag,
       case when units_sold < 0.5 * p_size then 1 else 0 end as overstock_flag,
       case when units_sold > 0.8 * p_size then 1 else 0 end as reorder_flag
from (select last_day(cast(l_shipdate as date)) as snapshot_date, l_partkey as product_id, p_type as category,
             p_brand as segment, p_name as product_name, p_size, sum(l_quantity) as units_sold
      from lineitem left join part on l_partkey = p_partkey
      group by last_day(cast(l_shipdate as date)), l_partkey, p_type, p_brand, p_name, p_size) t"""

# ---- loaders

VIEWS["v_order_level"] = """
select o.*, coalesce(p.payment_value, 0) as payment_value
from v_orders o left join (select order_id, sum(payment_value) as payment_value from v_payments group by order_id) p
  on o.order_id = p.order_id"""

VIEWS["v_item_level"] = """
select i.order_id, i.product_id, i.quantity, i.unit_price, coalesce(i.discount_amount, 0) as discount_amount,
       i.promo_id, i.promo_id_2, o.customer_id, o.order_date, o.order_status,
       p.product_name, p.category, p.segment, p.price, p.cogs,
       i.quantity * i.unit_price as gross_merch_value,
       i.quantity * i.unit_price - coalesce(i.discount_amount, 0) as net_item_revenue,
       i.quantity * p.cogs as item_cogs,
       i.quantity * i.unit_price - coalesce(i.discount_amount, 0) - i.quantity * p.cogs as gross_profit,
       case when i.promo_id is not null or i.promo_id_2 is not null then 1 else 0 end as promo_used_flag
from v_order_items i left join v_orders o on i.order_id = o.order_id left join v_products p on i.product_id = p.product_id"""

VIEWS["v_sold_lines"] = """
select order_id, customer_id, order_date, category, product_id, quantity, gross_merch_value, gross_profit, discount_amount, promo_used_flag,
       greatest(net_item_revenue, 0) as net_item_revenue,
       case when extract(year from order_date) <= 1998 then 'pre' else 'post' end as period
from v_item_level
where order_status in ('delivered', 'returned', 'shipped') and extract(year from order_date) between 1995 and 2001"""

VIEWS["v_sold_orders"] = """
select *, extract(year from order_date) as year from v_order_level
where order_status in ('delivered', 'returned', 'shipped') and extract(year from order_date) between 1995 and 2001"""

# ---- marts

VIEWS["m_returns_agg"] = """
select a.*, t.return_reason as top_return_reason
from (select order_id, product_id, count(distinct return_id) as return_records, sum(return_quantity) as return_quantity,
             sum(refund_amount) as refund_amount, min(return_date) as first_return_date
      from v_returns group by order_id, product_id) a
join (select order_id, product_id, return_reason,
             row_number() over (partition by order_id, product_id order by count(*) desc, return_reason) as rn
      from v_returns group by order_id, product_id, return_reason) t
  on a.order_id = t.order_id and a.product_id = t.product_id and t.rn = 1"""

VIEWS["m_reviews_agg"] = """
select order_id, product_id, count(distinct review_id) as review_records, avg(rating) as avg_rating,
       min(review_date) as first_review_date
from v_reviews group by order_id, product_id"""

VIEWS["m_item_measures"] = """
select i.*, p.product_name, p.category, p.segment, p.size, p.price, p.cogs,
       r.return_records, r.return_quantity, r.refund_amount, r.first_return_date, r.top_return_reason,
       w.review_records, w.avg_rating, w.first_review_date,
       i.quantity * i.unit_price as line_revenue, i.quantity * p.cogs as line_cogs,
       i.quantity * i.unit_price - i.quantity * p.cogs as gross_profit,
       case when i.quantity * i.unit_price > 0
            then (i.quantity * i.unit_price - i.quantity * p.cogs) / (i.quantity * i.unit_price) end as gross_margin,
       (i.promo_id is not null or i.promo_id_2 is not null) as has_promo,
       coalesce(r.return_records, 0) > 0 as is_returned
from v_order_items i
left join v_products p on i.product_id = p.product_id
left join m_returns_agg r on i.order_id = r.order_id and i.product_id = r.product_id
left join m_reviews_agg w on i.order_id = w.order_id and i.product_id = w.product_id"""

VIEWS["m_order_context"] = """
select o.*, c.age_group, g.region, g.district, p.payment_value, p.installments, s.ship_date, s.delivery_date, s.shipping_fee
from v_orders o
left join v_customers c on o.customer_id = c.customer_id
left join v_geography g on o.zip = g.zip
left join v_payments p on o.order_id = p.order_id
left join v_shipments s on o.order_id = s.order_id"""

VIEWS["m_item_fact"] = """
select i.*, o.order_date, o.customer_id, o.zip, o.order_status, o.payment_method, o.age_group, o.region, o.district,
       o.payment_value, o.installments, o.ship_date, o.delivery_date, o.shipping_fee,
       strftime(o.order_date, '%Y-%m') as order_month
from m_item_measures i left join m_order_context o on i.order_id = o.order_id"""

VIEWS["m_order_fact"] = """
select o.*, a.order_items, a.order_units, a.order_revenue_from_items, a.order_cogs_from_items, a.order_discount,
       a.any_promo, a.any_return, a.avg_order_rating,
       date_diff('day', o.order_date, o.ship_date) as ship_lead_days,
       date_diff('day', o.order_date, o.delivery_date) as delivery_lead_days,
       strftime(o.order_date, '%Y-%m') as order_month
from m_order_context o
left join (select order_id, count(product_id) as order_items, sum(quantity) as order_units,
                  sum(line_revenue) as order_revenue_from_items, sum(line_cogs) as order_cogs_from_items,
                  sum(discount_amount) as order_discount, bool_or(has_promo) as any_promo,
                  bool_or(is_returned) as any_return, avg(avg_rating) as avg_order_rating
           from m_item_measures group by order_id) a on o.order_id = a.order_id"""

VIEWS["m_order_line_fact"] = """
select i.*, p.product_name, p.category, p.segment, p.size, p.price, p.cogs, o.order_date, o.customer_id, o.zip, o.order_status, o.payment_method,
       y.payment_value, y.installments, s.shipping_fee, date_diff('day', s.ship_date, s.delivery_date) as delivery_lead_days,
       r.return_quantity, r.refund_amount, r.return_records, w.avg_rating, w.review_records,
       i.quantity * i.unit_price as line_revenue, i.quantity * p.cogs as line_cogs,
       i.quantity * i.unit_price - i.quantity * p.cogs as line_gross_profit,
       (i.quantity * i.unit_price - i.quantity * p.cogs) / nullif(i.quantity * i.unit_price, 0) as line_margin_pct,
       i.promo_id is not null as has_promo, (i.promo_id is not null and i.promo_id_2 is not null) as has_double_promo,
       extract(year from o.order_date) as year, extract(month from o.order_date) as month,
       strftime(o.order_date, '%Y-%m') as year_month
from v_order_items i
left join v_products p on i.product_id = p.product_id
left join v_orders o on i.order_id = o.order_id
left join v_payments y on i.order_id = y.order_id
left join v_shipments s on i.order_id = s.order_id
left join (select order_id, product_id, sum(return_quantity) as return_quantity, sum(refund_amount) as refund_amount,
                  count(distinct return_id) as return_records from v_returns group by order_id, product_id) r
  on i.order_id = r.order_id and i.product_id = r.product_id
left join (select order_id, product_id, avg(rating) as avg_rating, count(*) as review_records
           from v_reviews group by order_id, product_id) w
  on i.order_id = w.order_id and i.product_id = w.product_id"""

VIEWS["m_customer_360"] = """
select c.*, coalesce(a.orders, 0) as orders, a.total_revenue, a.total_units, a.first_order_date, a.last_order_date,
       a.return_orders, a.promo_orders,
       case when a.orders > 0 then a.return_orders / cast(a.orders as double) end as return_order_rate,
       case when a.orders > 0 then a.promo_orders / cast(a.orders as double) end as promo_order_rate
from v_customers c
left join (select customer_id, count(distinct order_id) as orders, coalesce(sum(order_revenue_from_items), 0) as total_revenue,
                  coalesce(sum(order_units), 0) as total_units, min(order_date) as first_order_date,
                  max(order_date) as last_order_date, sum(case when any_return then 1 else 0 end) as return_orders,
                  sum(case when any_promo then 1 else 0 end) as promo_orders
           from m_order_fact group by customer_id) a on c.customer_id = a.customer_id"""

VIEWS["m_product_totals"] = """
select p.*, coalesce(a.item_lines, 0) as item_lines, coalesce(a.units_sold, 0) as units_sold, coalesce(a.revenue, 0) as revenue,
       coalesce(a.cogs_total, 0) as cogs_total, coalesce(a.gross_profit, 0) as gross_profit,
       coalesce(a.promo_lines, 0) as promo_lines, coalesce(a.returned_lines, 0) as returned_lines, a.avg_rating,
       case when a.revenue > 0 then a.gross_profit / a.revenue end as gross_margin,
       case when a.item_lines > 0 then a.promo_lines / cast(a.item_lines as double) end as promo_line_rate,
       case when a.item_lines > 0 then a.returned_lines / cast(a.item_lines as double) end as return_line_rate
from v_products p
left join (select product_id, count(order_id) as item_lines, sum(quantity) as units_sold, sum(line_revenue) as revenue,
                  sum(line_cogs) as cogs_total, sum(gross_profit) as gross_profit,
                  sum(case when has_promo then 1 else 0 end) as promo_lines,
                  sum(case when is_returned then 1 else 0 end) as returned_lines, avg(avg_rating) as avg_rating
           from m_item_measures group by product_id) a on p.product_id = a.product_id"""

VIEWS["m_product_360"] = """
select t.*, case when cum_revenue_share <= 0.80 then 'A' when cum_revenue_share <= 0.95 then 'B'
                 when cum_revenue_share <= 1.01 then 'C' end as abc_class
from (select *, row_number() over (order by revenue desc, product_id) as revenue_rank,
             sum(revenue) over (order by revenue desc, product_id rows unbounded preceding) / sum(revenue) over () as cum_revenue_share
      from m_product_totals) t"""

VIEWS["m_product_stock"] = """
select product_id, avg(stockout_days) as avg_stockout_days, sum(stockout_flag) as stockout_months,
       avg(days_of_supply) as avg_days_of_supply, avg(fill_rate) as avg_fill_rate
from v_inventory group by product_id"""

VIEWS["m_product_mart"] = """
select p.*, coalesce(a.units_sold, 0) as units_sold, coalesce(a.revenue, 0) as revenue, coalesce(a.orders, 0) as orders,
       coalesce(a.promo_line_rate, 0) as promo_line_rate, coalesce(a.return_units, 0) as return_units,
       coalesce(a.return_units / nullif(a.units_sold, 0), 0) as unit_return_rate,
       (p.price - p.cogs) / nullif(p.price, 0) as gross_margin_pct,
       s.avg_stockout_days, s.stockout_months, s.avg_days_of_supply, s.avg_fill_rate
from v_products p
left join (select product_id, sum(quantity) as units_sold, sum(line_revenue) as revenue, count(distinct order_id) as orders,
                  avg(case when has_promo then 1.0 else 0.0 end) as promo_line_rate,
                  coalesce(sum(return_quantity), 0) as return_units
           from m_order_line_fact group by product_id) a on p.product_id = a.product_id
left join m_product_stock s on p.product_id = s.product_id"""

VIEWS["m_daily_traffic"] = """
select "date" as "Date", sum(sessions) as sessions, sum(unique_visitors) as unique_visitors, sum(page_views) as page_views,
       avg(bounce_rate) as bounce_rate, avg(avg_session_duration_sec) as avg_session_duration_sec,
       count(distinct traffic_source) as n_traffic_sources
from v_web_traffic group by "date" """

VIEWS["m_daily_panel"] = """
select s."Date", s."Revenue", s."COGS", t.sessions, t.unique_visitors, t.page_views, t.bounce_rate as avg_bounce_rate,
       t.avg_session_duration_sec, o.orders, o.order_units, o.promo_orders, o.return_orders, o.avg_delivery_lead_days,
       s."Revenue" - s."COGS" as gross_profit,
       case when s."Revenue" > 0 then (s."Revenue" - s."COGS") / s."Revenue" end as gross_margin,
       extract(year from s."Date") as year, extract(month from s."Date") as month, isodow(s."Date") - 1 as dayofweek,
       case when isodow(s."Date") >= 6 then 1 else 0 end as is_weekend
from v_sales s left join m_daily_traffic t on s."Date" = t."Date"
left join (select order_date, count(distinct order_id) as orders, coalesce(sum(order_units), 0) as order_units,
                  sum(case when any_promo then 1 else 0 end) as promo_orders,
                  sum(case when any_return then 1 else 0 end) as return_orders,
                  avg(delivery_lead_days) as avg_delivery_lead_days
           from m_order_fact group by order_date) o on s."Date" = o.order_date"""

VIEWS["m_product_month"] = """
select v.snapshot_date, v.product_id, v.category, v.segment, v.product_name, v.units_sold, v.stock_on_hand, v.stockout_days,
       v.days_of_supply, v.fill_rate, v.sell_through_rate, v.stockout_flag, v.overstock_flag, v.reorder_flag,
       p.price, p.cogs, p.size,
       coalesce(a.item_units_sold, 0) as item_units_sold, coalesce(a.item_revenue, 0) as item_revenue,
       coalesce(a.item_gross_profit, 0) as item_gross_profit, coalesce(a.promo_lines, 0) as promo_lines,
       coalesce(a.returned_lines, 0) as returned_lines,
       v.stockout_flag + v.reorder_flag - v.overstock_flag as inventory_risk_score
from v_inventory v left join v_products p on v.product_id = p.product_id
left join (select last_day(o.order_date) as snapshot_date, i.product_id, sum(i.quantity) as item_units_sold,
                  sum(i.line_revenue) as item_revenue, sum(i.gross_profit) as item_gross_profit,
                  sum(case when i.has_promo then 1 else 0 end) as promo_lines,
                  sum(case when i.is_returned then 1 else 0 end) as returned_lines
           from m_item_measures i join v_orders o on i.order_id = o.order_id group by last_day(o.order_date), i.product_id) a
  on v.snapshot_date = a.snapshot_date and v.product_id = a.product_id"""

# ---- status joins

VIEWS["m_orders_payments"] = """
select o.*, p.payment_value, p.installments,
       case when p.order_id is null then 'left_only' else 'both' end as payment_join_status
from v_orders o left join v_payments p on o.order_id = p.order_id"""

VIEWS["m_items_orders"] = """
select i.*, o.order_date, o.customer_id, o.zip, o.order_status, o.payment_method,
       case when o.order_id is null then 'left_only' else 'both' end as order_join_status
from v_order_items i left join v_orders o on i.order_id = o.order_id"""

VIEWS["m_items_products"] = """
select i.*, p.product_name, p.category, p.segment, p.size, p.price, p.cogs,
       case when p.product_id is null then 'left_only' else 'both' end as product_join_status
from v_order_items i left join v_products p on i.product_id = p.product_id"""

VIEWS["m_orders_customers"] = """
select o.*, c.zip as zip_customer, c.age_group,
       case when c.customer_id is null then 'left_only' else 'both' end as customer_join_status
from v_orders o left join v_customers c on o.customer_id = c.customer_id"""

VIEWS["m_orders_geography"] = """
select o.*, g.district, g.region, case when g.zip is null then 'left_only' else 'both' end as geo_join_status
from v_orders o left join v_geography g on o.zip = g.zip"""

VIEWS["m_orders_shipments"] = """
select o.*, s.ship_date, s.delivery_date, s.shipping_fee,
       case when s.order_id is null then 'left_only' else 'both' end as shipment_join_status,
       date_diff('day', o.order_date, s.ship_date) as ship_lead_days,
       date_diff('day', o.order_date, s.delivery_date) as delivery_lead_days
from v_orders o left join v_shipments s on o.order_id = s.order_id"""

# ---- customers

VIEWS["m_items_returns"] = """
select i.*, r.return_id, r.return_date, r.return_reason, r.return_quantity, r.refund_amount,
       case when r.return_id is null then 'left_only' else 'both' end as return_join_status
from v_order_items i left join v_returns r on i.order_id = r.order_id and i.product_id = r.product_id"""

VIEWS["m_items_reviews"] = """
select i.*, w.review_id, w.customer_id, w.review_date, w.rating,
       case when w.review_id is null then 'left_only' else 'both' end as review_join_status
from v_order_items i left join v_reviews w on i.order_id = w.order_id and i.product_id = w.product_id"""

VIEWS["m_items_double_promotions"] = """
select * from v_order_items where promo_id is not null and promo_id_2 is not null"""

VIEWS["m_product_month_audit"] = """
select *, extract(year from snapshot_date) as year, extract(month from snapshot_date) as month from m_product_month"""

# Views of audited tables that are not named like them.
AUDIT_VIEWS = {"product_month_panel": "m_product_month_audit"}

VIEWS["m_promo_orders"] = """
select order_id, customer_id, order_date, period, sum(net_item_revenue) as revenue, sum(gross_merch_value) as gross_merch_value,
       sum(gross_profit) as gross_profit, sum(discount_amount) as discount_amount, max(promo_used_flag) as promo_used
from v_sold_lines group by order_id, customer_id, order_date, period"""

VIEWS["m_repurchase"] = """
select t.*, date_diff('day', order_date, next_order_date) as next_gap_days,
       order_date <= max(order_date) over () - interval 90 day as eligible_90d,
       case when order_date <= max(order_date) over () - interval 90 day
             and date_diff('day', order_date, next_order_date) between 1 and 90 then 1 else 0 end as repurchase_90d
from (select *, lead(order_date) over (partition by customer_id order by order_date, order_id) as next_order_date
      from m_promo_orders) t"""

VIEWS["m_post_repurchase"] = """
select t.*, date_diff('day', order_date, next_order_date) as next_gap_days,
       order_date <= max(order_date) over () - interval 90 day as eligible_90d
from (select *, lead(order_date) over (partition by customer_id order by order_date, order_id) as next_order_date
      from m_promo_orders where period = 'post') t"""

VIEWS["m_promo_effect"] = """
select t.*, revenue / sum(revenue) over () as revenue_share, gross_profit / nullif(revenue, 0) as gross_margin,
       discount_amount / nullif(gross_merch_value, 0) as discount_rate,
       repurchase_90d / cast(nullif(eligible_orders, 0) as double) as repurchase_90d_rate
from (select promo_used, count(*) as orders, sum(revenue) as revenue, sum(gross_merch_value) as gross_merch_value,
             sum(gross_profit) as gross_profit, sum(discount_amount) as discount_amount,
             sum(case when eligible_90d then 1 else 0 end) as eligible_orders,
             sum(case when eligible_90d and next_gap_days between 1 and 90 then 1 else 0 end) as repurchase_90d
      from m_post_repurchase group by promo_used) t"""

VIEWS["m_gaps"] = """
select date_diff('day', prev_day, order_date) as gap_days
from (select order_date, lag(order_date) over (partition by customer_id order by order_date, order_id) as prev_day from v_orders) t
where prev_day is not null"""

VIEWS["m_lead"] = """
select delivery_lead_days from m_orders_shipments
where delivery_lead_days is not null and delivery_lead_days >= 0
  and delivery_lead_days <= (select quantile_cont(delivery_lead_days, 0.995) from m_orders_shipments where delivery_lead_days is not null)"""

VIEWS["m_health"] = """
select b.year, active_customers, orders, revenue, repeat_rate, orders / cast(active_customers as double) as orders_per_active_customer,
       revenue / orders as aov, case when b.year <= 1998 then 'pre' else 'post' end as period
from (select year, count(distinct customer_id) as active_customers, count(distinct order_id) as orders, sum(payment_value) as revenue
      from v_sold_orders group by year) b
join (select year, avg(case when n >= 2 then 1.0 else 0.0 end) as repeat_rate
      from (select year, customer_id, count(distinct order_id) as n from v_sold_orders group by year, customer_id) c
      group by year) r on b.year = r.year"""

VIEWS["m_funnel"] = """
select w.year, sessions, orders, revenue, orders / cast(sessions as double) as conversion_rate, revenue / sessions as revenue_per_session,
       case when w.year <= 1998 then 'pre' else 'post' end as period
from (select extract(year from "date") as year, sum(sessions) as sessions from v_web_traffic
      where extract(year from "date") between 1995 and 2001 group by extract(year from "date")) w
join (select year, count(distinct order_id) as orders, sum(payment_value) as revenue from v_sold_orders group by year) o
  on w.year = o.year"""

VIEWS["m_regime_months"] = """
select m.*, (revenue - cogs) / nullif(revenue, 0) as gross_margin, extract(year from month_start) as year,
       extract(month from month_start) as month,
       case when extract(year from month_start) <= 1998 then 'pre' else 'post' end as period
from (select cast(date_trunc('month', "Date") as date) as month_start, sum("Revenue") as revenue, sum("COGS") as cogs, count(*) as n_days
      from v_sales where extract(year from "Date") between 1995 and 2001 group by 1) m"""

VIEWS["m_regime_summary"] = """
select period, sum(revenue) as total_revenue, sum(revenue) / sum(n_days) as avg_daily_revenue, avg(revenue) as avg_monthly_revenue,
       max(revenue) as peak_month_revenue, max(case when best = 1 then strftime(month_start, '%Y-%m') end) as peak_month,
       (sum(revenue) - sum(cogs)) / sum(revenue) as weighted_gross_margin, min(gross_margin) as worst_gross_margin,
       max(case when worst = 1 then strftime(month_start, '%Y-%m') end) as worst_margin_month
from (select *, row_number() over (partition by period order by revenue desc, month_start) as best,
             row_number() over (partition by period order by gross_margin, month_start) as worst
      from m_regime_months) t group by period"""

VIEWS["m_category_period"] = """
select t.*, gross_profit / nullif(revenue, 0) as gross_margin, promo_revenue / nullif(revenue, 0) as promo_revenue_share,
       sum(revenue) over (partition by period) as total_period_revenue,
       revenue / sum(revenue) over (partition by period) as revenue_share
from (select period, category, sum(net_item_revenue) as revenue, sum(gross_profit) as gross_profit,
             sum(case when promo_used_flag = 1 then net_item_revenue else 0 end) as promo_revenue
      from v_sold_lines group by period, category) t"""

# ---- products

VIEWS["m_sku_2x2"] = """
select *, case when hi_rev and hi_stock then 'Priority Replenish' when hi_rev then 'Protect Winners'
               when hi_stock then 'Selective Reorder' else 'Reduce/Markdown' end as sku_action
from (select *, coalesce(revenue >= (select median(revenue) from m_product_mart), false) as hi_rev,
             coalesce(avg_stockout_days >= (select median(avg_stockout_days) from m_product_mart), false) as hi_stock
      from m_product_mart) t"""

VIEWS["m_sku_ops"] = """
select product_id, product_name, category, segment, sum(units_sold) as units_sold, avg(stock_on_hand) as stock_on_hand,
       avg(stockout_days) as stockout_days, avg(stockout_flag) as stockout_rate, avg(overstock_flag) as overstock_rate,
       avg(reorder_flag) as reorder_rate, avg(sell_through_rate) as sell_through_rate, sum(item_revenue) as revenue
from m_product_month group by product_id, product_name, category, segment"""

VIEWS["m_sku_q70"] = """
select *, case when revenue >= rev and stockout_rate >= stock then 'Reorder / protect'
               when revenue >= rev and stockout_rate < stock then 'Monitor / maintain'
               when revenue < rev and overstock_rate >= over_cut then 'Markdown / rationalize'
               else 'Review' end as action
from (select *, (select quantile_cont(revenue, 0.70) from m_sku_ops) as rev,
             (select quantile_cont(stockout_rate, 0.70) from m_sku_ops) as stock,
             (select quantile_cont(overstock_rate, 0.70) from m_sku_ops) as over_cut
      from m_sku_ops) t"""

VIEWS["m_sku_avg"] = """
select product_id, avg(sell_through_rate) as sell_through_avg, avg(stockout_days) as stockout_days_avg,
       avg(stockout_flag) as stockout_rate, avg(overstock_flag) as overstock_rate, avg(fill_rate) as fill_rate_avg,
       sum(revenue) as revenue_total, count(*) as active_months, sum(revenue) / count(*) as avg_monthly_revenue
from (select s.*, coalesce(r.revenue, 0) as revenue
      from (select product_id, date_trunc('month', snapshot_date) as ym, greatest(avg(sell_through_rate), 0) as sell_through_rate,
                   greatest(avg(stockout_days), 0) as stockout_days, least(greatest(avg(stockout_flag), 0), 1) as stockout_flag,
                   least(greatest(avg(overstock_flag), 0), 1) as overstock_flag, least(greatest(avg(fill_rate), 0), 1) as fill_rate
            from v_inventory where extract(year from snapshot_date) between 1999 and 2001 group by 1, 2) s
      left join (select product_id, date_trunc('month', order_date) as ym, sum(net_item_revenue) as revenue from v_item_level
                 where order_status in ('delivered', 'returned', 'shipped') and extract(year from order_date) between 1999 and 2001
                 group by 1, 2) r on s.product_id = r.product_id and s.ym = r.ym) t
group by product_id"""

VIEWS["m_sku_buckets"] = """
select *, case when sell_through_avg >= sq75 and stockout_days_avg >= tq75 then 'Refill trước'
               when sell_through_avg >= sq75 and stockout_days_avg <= tq25 then 'Bảo vệ SKU thắng'
               when sell_through_avg <= sq25 and overstock_rate >= oq75 then 'Clear tồn chậm'
               when stockout_days_avg >= tq75 and overstock_rate >= oq75 then 'Chẩn đoán 2 chiều'
               when sell_through_avg < sq75 and sell_through_avg > sq25 and stockout_days_avg < tq75 and overstock_rate < oq75
                 then 'Theo dõi'
               else 'Chẩn đoán từng SKU' end as action_bucket
from (select a.*, (select quantile_cont(sell_through_avg, 0.25) from m_sku_avg) as sq25,
             (select quantile_cont(sell_through_avg, 0.75) from m_sku_avg) as sq75,
             (select quantile_cont(stockout_days_avg, 0.25) from m_sku_avg) as tq25,
             (select quantile_cont(stockout_days_avg, 0.75) from m_sku_avg) as tq75,
             (select quantile_cont(overstock_rate, 0.75) from m_sku_avg) as oq75
      from m_sku_avg a) t"""

# ---- forecast

VIEWS["v_train"] = """select * from v_sales where "Date" < date '2001-01-01'"""

VIEWS["v_horizon"] = """select "Date" from v_sales where "Date" >= date '2001-01-01'"""

VIEWS["m_slot_ratios"] = """
select extract(month from "Date") as "Month", extract(day from "Date") as "Day",
       avg(case when extract(year from "Date") % 2 = 1 then "COGS" / nullif("Revenue", 0) end) as md_ratio_odd,
       avg(case when extract(year from "Date") % 2 = 0 then "COGS" / nullif("Revenue", 0) end) as md_ratio_even,
       avg(case when extract(year from "Date") >= 1999 then "COGS" / nullif("Revenue", 0) end) as md_ratio_post
from v_train group by 1, 2"""

VIEWS["m_slot_revenue"] = """
select s.*, md_avg_rev / (select avg("Revenue") from v_train) as md_rev_ratio,
       case when md_avg_rev > quantile_90 then 1 else 0 end as is_hi_rev_md,
       case when md_avg_rev < quantile_10 then 1 else 0 end as is_lo_rev_md
from (select extract(month from "Date") as "Month", extract(day from "Date") as "Day", avg("Revenue") as md_avg_rev
      from v_train group by 1, 2) s
cross join (select quantile_cont(md_avg_rev, 0.9) as quantile_90, quantile_cont(md_avg_rev, 0.1) as quantile_10
            from (select avg("Revenue") as md_avg_rev from v_train group by extract(month from "Date"), extract(day from "Date")) x) c"""

VIEWS["m_doy"] = """select dayofyear("Date") as "DayOfYear", median("Revenue") as rev_doy_median from v_train group by 1"""

VIEWS["m_mdow"] = """
select extract(month from "Date") as "Month", isodow("Date") - 1 as "DayOfWeek", avg("Revenue") as rev_month_dow_mean
from v_train group by 1, 2"""

VIEWS["m_md"] = """
select extract(month from "Date") as "Month", extract(day from "Date") as "Day", median("Revenue") as rev_month_day_median
from v_train group by 1, 2"""

VIEWS["m_inv_slot"] = """
select extract(month from snapshot_date) as "Month", avg(stockout_days) as inv_stockout, avg(fill_rate) as inv_fillrate,
       avg(sell_through_rate) as inv_sellthru from v_inventory group by 1"""

VIEWS["m_wt_slot"] = """
select extract(month from "date") as "Month", extract(day from "date") as "Day", avg(sessions) as sessions_md,
       avg(unique_visitors) as visitors_md from v_web_traffic group by 1, 2"""

VIEWS["m_ret_slot"] = """
select extract(month from return_date) as "Month", extract(day from return_date) as "Day", count(*) as returns_md
from v_returns group by 1, 2"""

VIEWS["m_ship_slot"] = """
select extract(month from ship_date) as "Month", extract(day from ship_date) as "Day", avg(shipping_fee) as avg_ship_fee,
       avg(date_diff('day', ship_date, delivery_date)) as avg_delivery_days from v_shipments group by 1, 2"""

VIEWS["m_naive"] = """
select h."Date", case when t."Date" is not null then t."Revenue" else f.fallback end as "Revenue",
       case when t."Date" is not null then (t."Revenue" - t."COGS") / nullif(t."Revenue", 0) end as lag_margin
from v_horizon h left join v_train t on t."Date" + interval 365 day = h."Date"
cross join (select avg("Revenue") as fallback from (select "Revenue" from v_train order by "Date" desc limit 28) x) f"""

VIEWS["m_average"] = """
select h."Date", f.fallback as "Revenue" from v_horizon h
cross join (select avg("Revenue") as fallback from (select "Revenue" from v_train order by "Date" desc limit 28) x) f"""

VIEWS["m_blend"] = """
select t.*, 0.58 * pred_a + seasonal as final_a, 0.58 * pred_b + seasonal as final_b,
       greatest(0.54 * (0.58 * pred_a + seasonal) + 0.46 * (0.58 * pred_b + seasonal), 0) as "Revenue"
from (select n."Date", n."Revenue" as pred_a, a."Revenue" as pred_b,
             0.02 * coalesce(d.rev_doy_median, g.m) + 0.04 * coalesce(w.rev_month_dow_mean, g.m)
             + 0.36 * coalesce(s.rev_month_day_median, g.m) as seasonal
      from m_naive n join m_average a on n."Date" = a."Date"
      left join m_doy d on d."DayOfYear" = dayofyear(n."Date")
      left join m_mdow w on w."Month" = extract(month from n."Date") and w."DayOfWeek" = isodow(n."Date") - 1
      left join m_md s on s."Month" = extract(month from n."Date") and s."Day" = extract(day from n."Date")
      cross join (select median("Revenue") as m from v_train) g) t"""

VIEWS["m_margin"] = """
select "Date", "Revenue", "Margin", "Revenue" * (1 - "Margin") as "COGS"
from (select b."Date", b."Revenue",
             least(greatest(0.54 * least(greatest(coalesce(n.lag_margin, o.overall), 0.02), 0.35)
                            + 0.46 * least(greatest(o.overall, 0.02), 0.35), 0.02), 0.35) as "Margin"
      from m_blend b join m_naive n on b."Date" = n."Date"
      cross join (select avg(("Revenue" - "COGS") / nullif("Revenue", 0)) as overall from v_train) o) t"""
