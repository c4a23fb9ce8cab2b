"""Registered queries: the six answers as KPI rows, backtest and whole forecast runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.functions.ordering import materialize
from martflow.operators import forecast, models, products
from martflow.operators.features import FEATURE_GROUPS
from martflow.plans import answers, forecasting
from martflow.plans.queries_answers import H1, TARGETS
from martflow.plans.queries_answers import QUERIES as ANSWERS
from martflow.plans.queries_answers import YEARS
from martflow.plans.queries_forecast import SIZE, feature_frame, finite
from martflow.plans.queries_forecast import YEARS as FORECAST_YEARS
from martflow.plans.registry import Query
from martflow.sources.retail_views import RetailViews

PERIODS = answers.Periods(*YEARS)


def _sql(name: str) -> str:
    return ANSWERS[name].sql


def run_checks(v: RetailViews) -> DataFrame:
    """Of each forecast variant: days, whether all figures are finite and not negative, and whether the error of its
    revenue is of the size of the trailing mean's (see queries_forecast.evaluated)."""
    tables = {**v.tables("inventory", "web_traffic", "returns", "shipments"), "sales": v.sales().where("Date < '2001-01-01'")}
    tables["sample_submission"] = v.sales().where("Date >= '2001-01-01'").select("Date")
    checked = []
    actual = v.sales().select("Date", F.col("Revenue").alias("actual"))
    flat = forecast.moving_average(tables["sales"], tables["sample_submission"]).withColumnRenamed("Revenue", "flat")
    error, flat_error = (F.avg(F.abs(F.col("actual") - F.col(c))) for c in ("Revenue", "flat"))
    for variant in forecasting.VARIANTS:
        days = forecasting.forecast_days(tables, variant, answers.Periods(*FORECAST_YEARS), SIZE)
        checked.append(
            days.join(actual, "Date", "left").join(flat, "Date", "left").agg(
                F.count(F.lit(1)).alias("days"),
                F.bool_and(finite("Revenue", "COGS")).alias("finite"),
                F.bool_and((F.col("Revenue") >= 0) & (F.col("COGS") >= 0)).alias("non_negative"),
                flat_error.alias("trailing_mean_mae"),
                (error < 1.5 * flat_error).alias("of_its_size"),
            ).select(F.lit(variant).alias("variant"), "*")
        )
    return reduce(DataFrame.unionByName, checked)


def group_totals(v: RetailViews) -> DataFrame:
    """Groups of features with their number of regimes, and whether shares are proper, before and after the break."""
    frame = materialize(feature_frame(v))
    before, after, _ = models.regime_frames(frame, *FORECAST_YEARS)
    parts = [
        models.grouped_importance(models.feature_importance(part, SIZE)).withColumn("regime", F.lit(name))
        for name, part in (("before", before), ("after", after))
    ]
    both = parts[0].unionByName(parts[1])
    total = both.groupBy("regime").agg(F.sum("importance").alias("total"))
    return both.join(total, "regime").select("regime", "feature_group", F.col("importance").between(0, 1).alias("proper"), F.col("total"))


_GROUPS = " union all ".join(f"select '{g}' as feature_group" for g in FEATURE_GROUPS)
_SCENARIOS = ", ".join(
    f"max(case when scenario = '{name}' then {c} end) as {name}_{c}" for name in TARGETS for c in ("target_mn", "lift_mn", "lift_pct")
)

_W = forecast.WEIGHTS
BACKTEST_SQL = f"""
with d as (
  select fold, s."Date", s."Revenue", s."Date" < ve - 89 as is_train, dayofyear(s."Date") as doy, extract(month from s."Date") as m,
         extract(day from s."Date") as dd, isodow(s."Date") as dow
  from v_sales s cross join (select fold, cast((select max("Date") from v_sales) as date) - cast((3 - fold) * 90 as integer) as ve
                             from (select unnest([1, 2, 3]) as fold) f) e
  where s."Date" <= ve
), by_doy as (select fold, doy, median("Revenue") as p from d where is_train group by fold, doy),
by_dow as (select fold, m, dow, avg("Revenue") as p from d where is_train group by fold, m, dow),
by_day as (select fold, m, dd, median("Revenue") as p from d where is_train group by fold, m, dd),
whole as (select fold, median("Revenue") as p from d where is_train group by fold),
last as (select fold, avg("Revenue") as p from (select *, row_number() over (partition by fold order by "Date" desc) as rn from d where is_train) x
         where rn <= 28 group by fold),
p as (
  select v.fold, v."Revenue" as y,
         ({_W.doy} * coalesce(a.p, w.p) + {_W.month_dow} * coalesce(b.p, w.p) + {_W.month_day} * coalesce(c.p, w.p))
           / ({_W.doy} + {_W.month_dow} + {_W.month_day}) as seasonal_profiles,
         case when e."Date" is not null then e."Revenue" else l.p end as seasonal_naive, l.p as moving_average
  from d v join whole w on v.fold = w.fold join last l on v.fold = l.fold
  left join by_doy a on v.fold = a.fold and v.doy = a.doy left join by_dow b on v.fold = b.fold and v.m = b.m and v.dow = b.dow
  left join by_day c on v.fold = c.fold and v.m = c.m and v.dd = c.dd
  left join d e on v.fold = e.fold and e.is_train and e."Date" + interval 365 day = v."Date"
  where not v.is_train
), r as (unpivot p on seasonal_profiles, seasonal_naive, moving_average into name model value pred)
select model, fold, avg(abs(y - pred)) as "MAE", sqrt(avg((y - pred) * (y - pred))) as "RMSE",
       1 - sum((y - pred) * (y - pred)) / (var_pop(y) * count(*)) as "R2" from r group by model, fold"""

QUERIES: dict[str, Query] = {
    "a1_regime": Query(
        f"{ANSWERS['regime_shift'].columns} negative_odd_augusts:i",
        lambda v: answers.a1_regime(v.tables("sales"), PERIODS),
        f"""select r.*, (select count(*) from m_regime_months where gross_margin < 0 and month = 8 and year % 2 = 1) as negative_odd_augusts
            from ({_sql("regime_shift")}) r""",
    ),
    "a2_customers": Query(
        ANSWERS["customer_health_shift"].columns,
        lambda v: answers.a2_customers(v.tables("orders", "payments"), PERIODS),
        _sql("customer_health_shift"),
    ),
    "a3_promotions": Query(
        ANSWERS["promo_gaps"].columns,
        lambda v: answers.a3_promotions(v.tables("order_items", "orders", "products"), PERIODS),
        _sql("promo_gaps"),
    ),
    "a4_conversion": Query(
        ANSWERS["funnel_shift"].columns,
        lambda v: answers.a4_conversion(v.tables("web_traffic", "orders", "payments"), PERIODS),
        _sql("funnel_shift"),
    ),
    "a5_sku_actions": Query(
        "refill_sku_count:i clear_sku_count:i top_bucket top_bucket_monthly_revenue_mn:6",
        lambda v: answers.a5_sku_actions(v.tables("order_items", "orders", "products", "inventory"), PERIODS),
        f"""select coalesce(max(case when action_bucket = '{products.BUCKET_REFILL}' then sku_count end), 0) as refill_sku_count,
                   coalesce(max(case when action_bucket = '{products.BUCKET_CLEAR}' then sku_count end), 0) as clear_sku_count,
                   arg_max(action_bucket, avg_monthly_revenue) as top_bucket, max(avg_monthly_revenue_mn) as top_bucket_monthly_revenue_mn
            from ({_sql("sku_bucket_summary")}) b""",
    ),
    "a6_scenarios": Query(
        "status_quo_mn:6 " + " ".join(f"{name}_{c}:6" for name in TARGETS for c in ("target_mn", "lift_mn", "lift_pct")),
        lambda v: answers.a6_scenarios(v.sales(), *H1, TARGETS),
        f"select max(status_quo_mn) as status_quo_mn, {_SCENARIOS} from ({_sql('scenario_lift')}) s",
    ),
    "rolling_backtest": Query("model fold:i MAE:2 RMSE:2 R2:6", lambda v: forecasting.rolling_backtest(v.sales()), BACKTEST_SQL),
    "forecast_run_checks": Query(
        "variant days:i finite non_negative trailing_mean_mae:2 of_its_size",
        run_checks,
        " union all ".join(
            f"""select '{variant}' as variant, count(*) as days, true as finite, true as non_negative,
                       avg(abs(s."Revenue" - a."Revenue")) as trailing_mean_mae, true as of_its_size
                from v_sales s join m_average a on s."Date" = a."Date" """
            for variant in forecasting.VARIANTS
        ),
    ),
    "grouped_importance": Query(
        "regime feature_group proper total:6",
        group_totals,
        f"""select regime, feature_group, true as proper, 1.0 as total from ({_GROUPS}) g
            cross join (select unnest(['before', 'after']) as regime) r where (select count(*) from v_sales) > 0""",
    ),
}
