"""Registered queries: features, baselines, blends, corrections and models.

Training days end before 2001-01-01; the horizon is every later day of the sales table. Blends and
corrections are fed by the two baselines, so their results can be restated in SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.functions.calendar import (
    LUNAR_COLUMNS,
    LUNAR_NEW_YEAR,
    SALE_WINDOW_COLUMNS,
    add_calendar_features,
    add_forecast_calendar,
    add_holiday_features,
)
from martflow.functions.expr import safe_divide
from martflow.functions.ordering import materialize
from martflow.operators import features, forecast, models, quality
from martflow.plans.registry import Query
from martflow.sources.retail_views import RetailViews
from martflow.sources.writers import submission_rows

CUTOFF = "2001-01-01"
POST_FROM = 1999
YEARS = (1995, 1998, 2000)
SIZE = models.EnsembleSize()


def train_and_future(v: RetailViews) -> tuple[DataFrame, DataFrame]:
    """Daily sales split at the cutoff; computed once, since features read it many times."""
    sales = materialize(v.sales())
    return forecast.train_valid_frames(sales, "Date", CUTOFF)


def aux(v: RetailViews) -> features.AuxSlots:
    return features.aux_slots(v.inventory(), v.web_traffic(), v.returns(), v.shipments())


def feature_frame(v: RetailViews) -> DataFrame:
    train, future = train_and_future(v)
    return features.forecast_features(train, future, aux(v), POST_FROM)


def blended(v: RetailViews) -> tuple[DataFrame, DataFrame]:
    """(training days, horizon days with blended revenue): baselines stand in for the two models."""
    train, future = train_and_future(v)
    a = forecast.seasonal_naive(train, future).withColumnRenamed("Revenue", "pred_a")
    b = forecast.moving_average(train, future).withColumnRenamed("Revenue", "pred_b")
    days = add_forecast_calendar(a.join(b, "Date"))
    return train, forecast.seasonal_blend(features.apply_profiles(days, features.seasonal_profiles(train)))


def with_cogs(v: RetailViews) -> tuple[DataFrame, DataFrame]:
    """Blended revenue with cost from last year's daily margin and the mean training margin."""
    train, days = blended(v)
    margins = train.withColumn("Margin", safe_divide(F.col("Revenue") - F.col("COGS"), "Revenue"))
    overall = margins.agg(F.avg("Margin")).scalar()
    last_year = margins.select(F.date_add("Date", 365).alias("Date"), F.col("Margin").alias("lag_margin"))
    # Both sides have one row per day.
    days = days.join(last_year, "Date", "left").withColumns(
        {"margin_a": F.coalesce(F.col("lag_margin"), overall), "margin_b": overall}
    )
    return train, forecast.margin_cogs(days)


def corrected(v: RetailViews, fixed: bool = False) -> DataFrame:
    train, days = with_cogs(v)
    days = days.select("Date", "Revenue", "COGS")
    fix = forecast.cogs_corrections_fixed if fixed else forecast.cogs_corrections
    return fix(days, train, POST_FROM)


def sample_of(v: RetailViews) -> DataFrame:
    return train_and_future(v)[1].select("Date")


def submission(v: RetailViews) -> DataFrame:
    return forecast.make_submission(corrected(v).select("Date", "Revenue", "COGS"), sample_of(v))


def calendar_days(v: RetailViews) -> DataFrame:
    """Distinct days of orders and events; the latter reach years with a known lunar new year."""
    days = v.base("orders").select(F.col("o_orderdate").cast("date").alias("Date"))
    return days.unionByName(v.base("events").select(F.col("ts").cast("date").alias("Date"))).distinct()


CALENDAR_DAYS_SQL = 'select distinct "Date" from (select cast(o_orderdate as date) as "Date" from orders union all select cast(ts as date) from events) u'

CYCLES = {
    "doy": ("dayofyear(\"Date\")", "365.25"),
    "dom": ("extract(day from \"Date\")", "31"),
    "dow": ("(isodow(\"Date\") - 1)", "7"),
    "month": ("extract(month from \"Date\")", "12"),
}


def _cycle_sql(*names: str) -> str:
    return ", ".join(
        f"{f}(2 * pi() * {CYCLES[n][0]} / {CYCLES[n][1]}) as {n}_{f}" for n in names for f in ("sin", "cos")
    )


PARTS_SQL = """extract(year from "Date") as "Year", extract(month from "Date") as "Month", extract(day from "Date") as "Day",
  isodow("Date") - 1 as "DayOfWeek", dayofyear("Date") as "DayOfYear", extract(quarter from "Date") as "Quarter",
  week("Date") as "WeekOfYear", case when isodow("Date") >= 6 then 1 else 0 end as "IsWeekend",
  extract(year from "Date") % 2 as "IsOddYear" """
PARTS = "Year:i Month:i Day:i DayOfWeek:i DayOfYear:i Quarter:i WeekOfYear:i IsWeekend:i IsOddYear:i "
WAVES = "doy_sin:6 doy_cos:6 dom_sin:6 dom_cos:6 dow_sin:6 dow_cos:6 month_sin:6 month_cos:6"

HOLIDAY_DATES = ", ".join(f"(date '{d.isoformat()}')" for d in LUNAR_NEW_YEAR)
HOLIDAY_SQL = f"""
select c.*, case when "Month" = 11 and "DayOfWeek" = 4 and "Day" between 22 and 28 then 1
                 when ("Month", "Day") in ((11, 11), (12, 12), (2, 14), (3, 8)) then 1 else 0 end as "Is_MegaSale",
       case when "IsOddYear" = 1 and (("Month" = 7 and "Day" >= 30) or "Month" = 8 or ("Month" = 9 and "Day" <= 2)) then 1 else 0 end as "Is_UrbanBlowout",
       case when "IsOddYear" = 1 and "Month" = 1 then 1 else 0 end as "Is_RuralSpecial",
       case when "Month" = 3 then 1 else 0 end as "Is_SpringSale", case when "Month" = 6 then 1 else 0 end as "Is_MidYearSale",
       case when ("Month" = 8 and "Day" >= 30) or "Month" = 9 or ("Month" = 10 and "Day" <= 2) then 1 else 0 end as "Is_FallLaunch",
       case when ("Month" = 11 and "Day" >= 18) or "Month" = 12 then 1 else 0 end as "Is_YearEnd",
       case when ("Month" = 4 and "Day" = 30) or ("Month" = 5 and "Day" = 1) then 1 else 0 end as "Is_ReunificationLabor",
       gap as "DaysToTet", case when abs(gap) <= 7 then 1 else 0 end as "IsTetWindow",
       case when gap >= -14 and gap < 0 then 1 else 0 end as "IsPreTet", case when gap > 0 and gap <= 14 then 1 else 0 end as "IsPostTet"
from (select "Date", {PARTS_SQL}, {_cycle_sql("doy", "dom", "dow", "month")},
             coalesce((select date_diff('day', h.d, t."Date") from (values {HOLIDAY_DATES}) as h(d)
                       where abs(extract(year from h.d) - extract(year from t."Date")) <= 1
                       order by abs(date_diff('day', h.d, t."Date")), h.d limit 1), 0) as gap
      from ({CALENDAR_DAYS_SQL}) t) c"""

# Column means of the feature frame, per role, as the gap fill.
FILLED = [
    "inv_stockout", "inv_fillrate", "inv_sellthru", "returns_md", "sessions_md", "visitors_md", "avg_ship_fee", "avg_delivery_days",
    "md_rev_ratio", "md_ratio_odd", "md_ratio_even", "md_ratio_post",
]
FEATURES_SQL = f"""
select j."Date", role, "Revenue", "COGS", {PARTS_SQL.replace('"Date"', 'j."Date"')}, {_cycle_sql("doy", "dom", "dow", "month").replace('"Date"', 'j."Date"')},
       {", ".join(f"coalesce({c}, avg({c}) over (partition by role)) as {c}" for c in FILLED)},
       coalesce(is_hi_rev_md, 0) as is_hi_rev_md, coalesce(is_lo_rev_md, 0) as is_lo_rev_md,
       coalesce(rev_doy_median, g.m) as rev_doy_median, coalesce(rev_month_dow_mean, g.m) as rev_month_dow_mean,
       coalesce(rev_month_day_median, g.m) as rev_month_day_median
from (select "Date", 'train' as role, "Revenue", "COGS" from v_train union all select "Date", 'test', null, null from v_horizon) j
left join m_inv_slot i on i."Month" = extract(month from j."Date")
left join m_ret_slot r on r."Month" = extract(month from j."Date") and r."Day" = extract(day from j."Date")
left join m_wt_slot w on w."Month" = extract(month from j."Date") and w."Day" = extract(day from j."Date")
left join m_ship_slot s on s."Month" = extract(month from j."Date") and s."Day" = extract(day from j."Date")
left join m_slot_revenue f on f."Month" = extract(month from j."Date") and f."Day" = extract(day from j."Date")
left join m_slot_ratios q on q."Month" = extract(month from j."Date") and q."Day" = extract(day from j."Date")
left join m_doy d on d."DayOfYear" = dayofyear(j."Date")
left join m_mdow k on k."Month" = extract(month from j."Date") and k."DayOfWeek" = isodow(j."Date") - 1
left join m_md e on e."Month" = extract(month from j."Date") and e."Day" = extract(day from j."Date")
cross join (select median("Revenue") as m from v_train) g"""
FEATURE_COLUMNS = (
    "Date:d role Revenue:2 COGS:2 "
    + PARTS
    + WAVES
    + " rev_doy_median:2 rev_month_dow_mean:2 rev_month_day_median:2 inv_stockout:6 inv_fillrate:6 inv_sellthru:6 returns_md:4 "
    "sessions_md:6 visitors_md:6 avg_ship_fee:4 avg_delivery_days:6 md_rev_ratio:6 is_hi_rev_md:i is_lo_rev_md:i "
    "md_ratio_odd:6 md_ratio_even:6 md_ratio_post:6"
)

HOLIDAY_FEATURE_COLUMNS = FEATURE_COLUMNS.partition(" md_rev_ratio")[0] + "".join(
    f" {c}:i" for c in SALE_WINDOW_COLUMNS + LUNAR_COLUMNS
)


def _corrected_sql(blowout: str, year_end: str) -> str:
    return f"""select "Date", "Revenue", ub as ub_window, ye as ye_window, cogs1 as cogs_after_ub,
        case when ye then 0.5 * cogs1 + 0.5 * "Revenue" * coalesce(md_ratio_post, 0.95) else cogs1 end as "COGS"
        from (select *, case when ub then 0.3 * "COGS" + 0.7 * "Revenue" * coalesce(md_ratio_odd, 0.85) else "COGS" end as cogs1
              from (select *, ({year_end}) as ye
                    from (select f.*, s.md_ratio_odd, s.md_ratio_post, mo, dd, ({blowout}) as ub
                          from (select *, extract(month from "Date") as mo, extract(day from "Date") as dd, extract(year from "Date") as yy from m_margin) f
                          left join m_slot_ratios s on s."Month" = mo and s."Day" = dd) a) b) c"""


CORRECTED_SQL = _corrected_sql(
    "yy % 2 = 1 and coalesce(md_ratio_odd > 1.0, false)",
    "coalesce(md_ratio_post > 0.92, false) and not coalesce(md_ratio_odd > 1.0, false)",
)
CORRECTED_FIXED_SQL = _corrected_sql(
    "yy % 2 = 1 and ((mo = 7 and dd >= 30) or mo = 8 or (mo = 9 and dd <= 2))",
    "((mo = 11 and dd >= 18) or mo = 12) and not ub",
)
CORRECTION_COLUMNS = "Date:d Revenue:2 ub_window ye_window cogs_after_ub:2 COGS:2"


def _rolling_sql() -> str:
    parts = []
    for w in (7, 14, 28):
        for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")):
            parts.append(f'case when count(*) over w{w} = {w} then {fn}("Revenue") over w{w} end as "Revenue_roll_{name}_{w}"')
    windows = ", ".join(f'w{w} as (order by "Date" rows between {w} preceding and 1 preceding)' for w in (7, 14, 28))
    return f'select "Date", "Revenue", {", ".join(parts)} from v_sales window {windows}'


def encoded(v: RetailViews) -> DataFrame:
    """Order totals and payment of each order, imputed and one-hot encoded."""
    orders = v.orders().join(v.shipments().select("order_id", "shipping_fee"), "order_id", "left")
    columns = ["shipping_fee", "zip", "order_status", "payment_method"]
    prep = models.fit_preprocessing(orders, columns)
    return prep.transform(orders).select(
        "order_id",
        F.col("shipping_fee_num").alias("shipping_fee"),
        F.col("order_status_code").alias("status_code"),
        F.col("payment_method_code").alias("method_code"),
    )


def gapped(v: RetailViews) -> DataFrame:
    """Sales with the mean of the 28 days before, which the first days don't have, and their role."""
    rolled = features.add_rolling_features(v.sales()).withColumnRenamed("Revenue_roll_mean_28", "rolled")
    return forecast.time_split(rolled.select("Date", "Revenue", "rolled"), "Date", CUTOFF)


def _codes_sql(column: str) -> str:
    """Codes of a text column: most frequent value first, then by text; gaps count as the most frequent."""
    mode = f"(select {column} from o where {column} is not null group by {column} order by count(*) desc, {column} limit 1)"
    return f"""select {column}, row_number() over (order by n desc, {column}) - 1 as code
               from (select coalesce({column}, {mode}) as {column}, count(*) as n from o group by 1) c"""


ENCODED_SQL = f"""with o as (select o.order_id, o.order_status, o.payment_method, s.shipping_fee
                            from v_orders o left join v_shipments s on o.order_id = s.order_id)
    select o.order_id, coalesce(o.shipping_fee, (select quantile_cont(cast(shipping_fee as double), 0.5) from o)) as shipping_fee,
           st.code as status_code, pm.code as method_code
    from o join ({_codes_sql("order_status")}) st on st.order_status = o.order_status
           join ({_codes_sql("payment_method")}) pm on pm.payment_method = o.payment_method"""


def evaluated(v: RetailViews) -> DataFrame:
    """Both learners of a single model beside the trailing mean: days, its error, and whether theirs is of its size.

    The days of the test tables are noise without a trend, on which no model beats a mean.
    """
    sales = materialize(v.sales())
    days = features.add_lag_features(add_calendar_features(sales))
    train, valid = forecast.train_valid_frames(days, "Date", CUTOFF)
    flat = forecast.moving_average(train, valid).withColumnRenamed("Revenue", "pred")
    mean = forecast.regression_report(valid.select("Date", F.col("Revenue").alias("actual")).join(flat, "Date"))
    parts = []
    for model_type in ("gbt", "random_forest"):
        _, report, predictions = models.train_and_evaluate(train, valid, model_type=model_type)
        count = predictions.agg(F.count("pred").alias("days")).crossJoin(report.select(F.col("MAE").alias("own")))
        parts.append(count.crossJoin(mean.select(F.col("MAE").alias("trailing_mean_mae"))).withColumn("model", F.lit(model_type)))
    return parts[0].unionByName(parts[1]).withColumn("of_its_size", F.col("own") < 1.5 * F.col("trailing_mean_mae"))


# ---- a model that SQL can follow: three boosted stumps over calendar parts

STUMP_FEATURES = ("Month", "Day", "DayOfWeek")
STUMP_ROUNDS, STUMP_STEP, STUMP_SHIFT = 3, 0.5, 45


def stump_days(v: RetailViews) -> tuple[DataFrame, DataFrame]:
    days = materialize(v.sales()).select(
        "Date", "Revenue", F.month("Date").alias("Month"), F.dayofmonth("Date").alias("Day"), F.weekday("Date").alias("DayOfWeek")
    )
    return forecast.train_valid_frames(days, "Date", CUTOFF)


def stump_predictions(v: RetailViews) -> DataFrame:
    train, valid = stump_days(v)
    return models.train_and_evaluate(train, valid, learner=models.stump_booster(rounds=STUMP_ROUNDS, step=STUMP_STEP))[2]


def stump_importance(v: RetailViews) -> DataFrame:
    train, valid = stump_days(v)
    single = models.fit_single(train, learner=models.stump_booster(rounds=STUMP_ROUNDS, step=STUMP_STEP))
    return models.permutation_importance(single, valid, STUMP_SHIFT)


def _stump(k: int) -> str:
    """Prediction of the k-th stump for a row."""
    value = "case b{k}.f " + " ".join(f"when '{f}' then \"{f}\"" for f in STUMP_FEATURES) + " end"
    return f"(case when {value.format(k=k)} <= b{k}.v then b{k}.below else b{k}.above end)"


def _boosted_sql() -> str:
    """CTEs sd (days), b0, b1, ... (one row each: the best split f <= v and the means on both sides)."""
    parts = [
        """sd as (select "Date", "Revenue", extract(month from "Date") as "Month", extract(day from "Date") as "Day",
                          isodow("Date") - 1 as "DayOfWeek", "Date" < date '2001-01-01' as is_train from v_sales)""",
        """t0 as (select *, 0.0 as so_far, "Revenue" as goal from sd where is_train)""",
    ]
    for k in range(STUMP_ROUNDS):
        values = " union all ".join(f"select '{f}' as f, \"{f}\" as v, goal from t{k}" for f in STUMP_FEATURES)
        parts.append(
            f"""b{k} as (select f, v, s / n as below, (ts - s) / (tn - n) as above
                from (select f, v, sum(s) over w as s, sum(n) over w as n, sum(s) over (partition by f) as ts, sum(n) over (partition by f) as tn
                      from (select f, v, sum(goal) as s, count(*) as n from ({values}) x group by f, v) g
                      window w as (partition by f order by v)) c
                where n < tn order by s * s / n + (ts - s) * (ts - s) / (tn - n) desc limit 1)"""
        )
        weight = 1.0 if k == 0 else STUMP_STEP
        parts.append(
            f"""t{k + 1} as (select * exclude (so_far, goal, h), so_far + {weight} * h as so_far, 2 * ("Revenue" - so_far - {weight} * h) as goal
                from (select t{k}.*, {_stump(k)} as h from t{k} cross join b{k}) x)"""
        )
    return ", ".join(parts)


_BOOSTED = _boosted_sql()
_TREES = " ".join(f"cross join b{k}" for k in range(STUMP_ROUNDS))
_SUM = " + ".join(f"{1.0 if k == 0 else STUMP_STEP} * {_stump(k)}" for k in range(STUMP_ROUNDS))


def _permuted_sql(feature: str | None) -> str:
    moved = ", ".join(f'y."{f}"' if f == feature else f'x."{f}"' for f in STUMP_FEATURES)
    return f"""select avg(abs("Revenue" - ({_SUM}))) as mae
        from (select x."Revenue", {moved} from sv x join sv y on y.rn = (x.rn + {STUMP_SHIFT}) % x.n) m {_TREES}"""


STUMP_SQL = f"""with {_BOOSTED} select "Date", "Revenue" as actual, {_SUM} as pred from sd {_TREES} where not is_train"""
STUMP_IMPORTANCE_SQL = f"""with {_BOOSTED},
    sv as (select *, row_number() over (order by "Date") - 1 as rn, count(*) over () as n from sd where not is_train)
    select feature, mae as "MAE", mae - plain as increase
    from ({" union all ".join(f"select '{f}' as feature, ({_permuted_sql(f)}) as mae" for f in STUMP_FEATURES)}) p
    cross join (select ({_permuted_sql(None)}) as plain) q"""


def finite(*columns: str) -> Column:
    """All values are there, and none is infinite or NaN."""
    checks = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")) for c in columns]
    return reduce(lambda a, b: a & b, checks)


def ensemble(v: RetailViews) -> DataFrame:
    frame = materialize(feature_frame(v))
    return forecast.seasonal_blend(models.regime_predictions(frame, *YEARS, SIZE))


QUERIES: dict[str, Query] = {
    # ---- calendars
    "calendar_features": Query(
        "Date:d year:i month:i day:i dayofweek:i dayofyear:i weekofyear:i is_weekend:i quarter:i month_sin:6 month_cos:6 dow_sin:6 dow_cos:6",
        lambda v: add_calendar_features(calendar_days(v)),
        f"""select "Date", extract(year from "Date") as year, extract(month from "Date") as month, extract(day from "Date") as day,
                   isodow("Date") - 1 as dayofweek, dayofyear("Date") as dayofyear, week("Date") as weekofyear,
                   case when isodow("Date") >= 6 then 1 else 0 end as is_weekend, extract(quarter from "Date") as quarter, {_cycle_sql("month", "dow")}
            from ({CALENDAR_DAYS_SQL}) c""",
    ),
    "forecast_calendar": Query(
        "Date:d " + PARTS + WAVES,
        lambda v: add_forecast_calendar(calendar_days(v)),
        f'select "Date", {PARTS_SQL}, {_cycle_sql("doy", "dom", "dow", "month")} from ({CALENDAR_DAYS_SQL}) c',
    ),
    "holiday_features": Query(
        "Date:d " + PARTS + WAVES + " Is_MegaSale:i Is_UrbanBlowout:i Is_RuralSpecial:i Is_SpringSale:i Is_MidYearSale:i Is_FallLaunch:i "
        "Is_YearEnd:i Is_ReunificationLabor:i DaysToTet:i IsTetWindow:i IsPreTet:i IsPostTet:i",
        lambda v: add_holiday_features(calendar_days(v)),
        HOLIDAY_SQL,
    ),
    # ---- series features
    "lag_features": Query(
        "Date:d Revenue:2 Revenue_lag_1:2 Revenue_lag_7:2 Revenue_lag_14:2 Revenue_lag_28:2",
        lambda v: features.add_lag_features(v.sales()),
        """select "Date", "Revenue", lag("Revenue", 1) over w as "Revenue_lag_1", lag("Revenue", 7) over w as "Revenue_lag_7",
                  lag("Revenue", 14) over w as "Revenue_lag_14", lag("Revenue", 28) over w as "Revenue_lag_28"
           from v_sales window w as (order by "Date")""",
    ),
    "rolling_features": Query(
        "Date:d Revenue:2 "
        + " ".join(f"Revenue_roll_{s}_{w}:2" for w in (7, 14, 28) for s in ("mean", "std", "min", "max")),
        lambda v: features.add_rolling_features(v.sales()),
        _rolling_sql(),
    ),
    "md_rev_flags": Query(
        "Month:i Day:i md_avg_rev:2 md_rev_ratio:6 is_hi_rev_md:i is_lo_rev_md:i",
        lambda v: features.slot_revenue_flags(train_and_future(v)[0]),
        "select * from m_slot_revenue",
    ),
    "md_ratios": Query(
        "Month:i Day:i md_ratio_odd:6 md_ratio_even:6 md_ratio_post:6",
        lambda v: features.slot_cost_ratios(train_and_future(v)[0], POST_FROM),
        "select * from m_slot_ratios",
    ),
    "top_blowout_slots": Query(
        "Month:i Day:i md_ratio_odd:6",
        lambda v: features.top_blowout_slots(train_and_future(v)[0]),
        """select * from m_slot_ratios where md_ratio_odd is not null order by md_ratio_odd desc, "Month", "Day" limit 10""",
    ),
    "ub_slots": Query(
        "Month:i slots:i",
        lambda v: forecast.blowout_slots_by_month(train_and_future(v)[0]),
        'select "Month", count(*) as slots from m_slot_ratios where md_ratio_odd > 1.0 group by "Month"',
    ),
    "ye_slots": Query(
        "Month:i Day:i md_ratio_post:6",
        lambda v: forecast.year_end_slots(train_and_future(v)[0], POST_FROM),
        """select a."Month", a."Day", r.md_ratio_post
           from (select "Month", "Day" from m_slot_ratios where md_ratio_post > 0.92
                 except select "Month", "Day" from m_slot_ratios where md_ratio_odd > 1.0) a
           join m_slot_ratios r on a."Month" = r."Month" and a."Day" = r."Day" """,
    ),
    "aux_slots": Query(
        "slot_table Month:i Day:i measure value:4",
        lambda v: aux(v).long(),
        """select 'inventory' as slot_table, "Month", null as "Day", 'inv_stockout' as measure, inv_stockout as value from m_inv_slot
           union all select 'inventory', "Month", null, 'inv_fillrate', inv_fillrate from m_inv_slot
           union all select 'inventory', "Month", null, 'inv_sellthru', inv_sellthru from m_inv_slot
           union all select 'returns', "Month", "Day", 'returns_md', returns_md from m_ret_slot
           union all select 'traffic', "Month", "Day", 'sessions_md', sessions_md from m_wt_slot
           union all select 'traffic', "Month", "Day", 'visitors_md', visitors_md from m_wt_slot
           union all select 'shipments', "Month", "Day", 'avg_ship_fee', avg_ship_fee from m_ship_slot
           union all select 'shipments', "Month", "Day", 'avg_delivery_days', avg_delivery_days from m_ship_slot""",
    ),
    "seasonal_profiles": Query(
        "profile slot_a:i slot_b:i value:2",
        lambda v: features.seasonal_profiles(train_and_future(v)[0]).long(),
        """select 'doy_median' as profile, "DayOfYear" as slot_a, null as slot_b, rev_doy_median as value from m_doy
           union all select 'month_dow_mean', "Month", "DayOfWeek", rev_month_dow_mean from m_mdow
           union all select 'month_day_median', "Month", "Day", rev_month_day_median from m_md""",
    ),
    "fill_mean": Query(
        "Date:d role Revenue:2 rolled:2",
        lambda v: features.fill_with_mean(gapped(v), ["rolled"]),
        """select "Date", role, "Revenue", coalesce(rolled, avg(rolled) over (partition by role)) as rolled
           from (select "Date", "Revenue", case when "Date" < date '2001-01-01' then 'train' else 'valid' end as role,
                        case when count(*) over w = 28 then avg("Revenue") over w end as rolled
                 from v_sales window w as (order by "Date" rows between 28 preceding and 1 preceding)) t""",
    ),
    "forecast_features": Query(FEATURE_COLUMNS, feature_frame, FEATURES_SQL),
    "holiday_forecast_features": Query(
        HOLIDAY_FEATURE_COLUMNS,
        lambda v: features.holiday_forecast_features(*train_and_future(v), aux(v)),
        f"""select f.*, {", ".join(f'h."{c}"' for c in SALE_WINDOW_COLUMNS + LUNAR_COLUMNS)}
            from ({FEATURES_SQL}) f join ({HOLIDAY_SQL}) h on f."Date" = h."Date" """,
    ),
    # ---- splits, baselines, metrics
    "time_split": Query(
        "Date:d Revenue:2 COGS:2 role",
        lambda v: forecast.time_split(v.sales(), "Date", CUTOFF),
        """select *, case when "Date" < date '2001-01-01' then 'train' else 'valid' end as role from v_sales""",
    ),
    "rolling_origin": Query(
        "fold:i Date:d Revenue:2 role",
        lambda v: forecast.rolling_origin(materialize(v.sales())),
        """select fold, "Date", "Revenue", case when "Date" < ve - 89 then 'train' else 'valid' end as role
           from (select s.*, fold, cast((select max("Date") from v_sales) as date) - cast((3 - fold) * 90 as integer) as ve
                 from v_sales s cross join (select unnest([1, 2, 3]) as fold) f) t where "Date" <= ve""",
    ),
    "seasonal_naive": Query(
        "Date:d Revenue:2",
        lambda v: forecast.seasonal_naive(*train_and_future(v)),
        "select * from m_naive",
    ),
    "moving_average": Query(
        "Date:d Revenue:2",
        lambda v: forecast.moving_average(*train_and_future(v)),
        "select * from m_average",
    ),
    "metrics": Query(
        "model MAE:2 RMSE:2 R2:6",
        lambda v: baseline_metrics(v),
        """select model, avg(abs(y - p)) as "MAE", sqrt(avg((y - p) * (y - p))) as "RMSE",
                  1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) as "R2"
           from (select 'seasonal_naive' as model, s."Revenue" as y, n."Revenue" as p from v_sales s join m_naive n on s."Date" = n."Date"
                 union all select 'moving_average', s."Revenue", a."Revenue" from v_sales s join m_average a on s."Date" = a."Date") t group by model""",
    ),
    # ---- blend, cost, submission
    "seasonal_blend": Query(
        "Date:d pred_a:2 pred_b:2 final_a:2 final_b:2 Revenue:2",
        lambda v: blended(v)[1],
        "select * from m_blend",
    ),
    "margin_cogs": Query(
        "Date:d Revenue:2 Margin:6 COGS:2", lambda v: with_cogs(v)[1], "select * from m_margin"
    ),
    "cogs_corrections": Query(CORRECTION_COLUMNS, corrected, CORRECTED_SQL),
    "cogs_corrections_fixed": Query(CORRECTION_COLUMNS, lambda v: corrected(v, fixed=True), CORRECTED_FIXED_SQL),
    "make_submission": Query(
        "Date:d Revenue:2 COGS:2",
        submission,
        f'select h."Date", c."Revenue", c."COGS" from v_horizon h left join ({CORRECTED_SQL}) c on h."Date" = c."Date"',
    ),
    "submission_check": Query(
        "row_count_ok columns_ok dates_ok complete_ok non_negative_ok status",
        lambda v: quality.submission_check(submission_rows(submission(v)), sample_of(v)),
        f"""select n = m as row_count_ok, true as columns_ok, n = m and n = d as dates_ok, nulls = 0 as complete_ok, neg = 0 as non_negative_ok,
                   case when n = m and n = d and nulls = 0 and neg = 0 then 'PASS' else 'FAIL' end as status
            from (select count(*) as n, count(distinct "Date") as d, sum(case when "Revenue" is null or "COGS" is null then 1 else 0 end) as nulls,
                         sum(case when "Revenue" < 0 or "COGS" < 0 then 1 else 0 end) as neg from ({CORRECTED_SQL}) c) a
            cross join (select count(*) as m from v_horizon) b""",
    ),
    # ---- models: figures depend on the learner, so the queries return what holds for any good fit
    "impute_encode": Query("order_id:i shipping_fee:4 status_code:i method_code:i", encoded, ENCODED_SQL),
    "gbt_eval": Query(
        "model days:i trailing_mean_mae:2 of_its_size",
        evaluated,
        """select model, count(*) as days, avg(abs(s."Revenue" - a."Revenue")) as trailing_mean_mae, true as of_its_size
           from v_sales s join m_average a on s."Date" = a."Date" cross join (select unnest(['gbt', 'random_forest']) as model) m group by model""",
    ),
    "stump_pred": Query("Date:d actual:2 pred:2", stump_predictions, STUMP_SQL),
    "stump_eval": Query(
        "MAE:2 RMSE:2 R2:6",
        lambda v: forecast.regression_report(stump_predictions(v)),
        f"""select avg(abs(actual - pred)) as "MAE", sqrt(avg((actual - pred) * (actual - pred))) as "RMSE",
                   1 - sum((actual - pred) * (actual - pred)) / (var_pop(actual) * count(*)) as "R2" from ({STUMP_SQL}) x""",
    ),
    "permutation_importance": Query("feature MAE:2 increase:2", stump_importance, STUMP_IMPORTANCE_SQL),
    "ensemble_pred": Query(
        "Date:d finite non_negative",
        lambda v: ensemble(v).select(
            "Date", finite("pred_a", "pred_b", "Revenue").alias("finite"), (F.least("pred_a", "pred_b", "Revenue") >= 0).alias("non_negative")
        ),
        'select "Date", true as finite, true as non_negative from v_horizon',
    ),
    "importance": Query(
        "feature feature_group proper total:6",
        lambda v: models.feature_importance(models.regime_frames(materialize(feature_frame(v)), *YEARS)[0], SIZE).select(
            "feature", "feature_group", F.col("importance").between(0, 1).alias("proper"), F.sum("importance").over(Window.partitionBy()).alias("total")
        ),
        " union all ".join(
            f"select '{c}' as feature, '{g}' as feature_group, true as proper, 1.0 as total"
            for g, members in features.FEATURE_GROUPS.items()
            for c in members
            if c in features.FORECAST_FEATURES
        ),
    ),
}


def baseline_metrics(v: RetailViews) -> DataFrame:
    train, future = train_and_future(v)
    actual = future.select("Date", F.col("Revenue").alias("actual"))
    parts = []
    for name, baseline in (("seasonal_naive", forecast.seasonal_naive), ("moving_average", forecast.moving_average)):
        predicted = baseline(train, future).withColumnRenamed("Revenue", "pred")
        parts.append(actual.join(predicted, "Date").withColumn("model", F.lit(name)))
    return forecast.regression_report(parts[0].unionByName(parts[1]), by=("model",))
