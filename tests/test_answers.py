from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from martflow.operators import customers, products, promotions, revenue, traffic
from martflow.sources.raw import item_level, order_level
from tests.conftest import by_key

SALES = "Date date, Revenue double, COGS double"


def daily(spark, rows):
    return spark.createDataFrame(rows, SALES)


def test_resample_fills_empty_months(spark):
    sales = daily(spark, [(date(2020, 1, 5), 10.0, 5.0), (date(2020, 4, 1), 30.0, 33.0)])
    rows = sorted(revenue.monthly_resample(sales).collect(), key=lambda r: r["month_end"])
    assert [r["Revenue"] for r in rows] == [10.0, 0.0, 0.0, 30.0]
    assert [r["gross_margin"] for r in rows] == [0.5, None, None, -0.1]
    assert [r["revenue_3m_avg"] for r in rows] == pytest.approx([10.0, 5.0, 10 / 3, 10.0])


def test_regime_summary_takes_the_earlier_of_equal_months(spark):
    sales = daily(spark, [(date(2017, 3, 1), 10.0, 9.0), (date(2017, 5, 1), 10.0, 9.0), (date(2019, 8, 1), 4.0, 6.0)])
    rows = by_key(revenue.regime_summary(sales, 2013, 2018, 2022), "period")
    assert (rows["pre"]["peak_month"], rows["pre"]["worst_margin_month"]) == ("2017-03", "2017-03")
    shift = revenue.regime_shift(sales, 2013, 2018, 2022).first()
    assert shift["peak_change_pct"] == pytest.approx(-60.0)
    odd = revenue.negative_margin_months(sales, 2013, 2018, 2022).collect()
    assert [(r["year_month"], r["is_odd_august"]) for r in odd] == [("2019-08", True)]


def test_anomaly_needs_seven_days_and_ignores_constant_windows(spark):
    start = date(2020, 1, 1)
    values = [10.0] * 40 + [11.0] * 3 + [100.0]
    sales = daily(spark, [(start + timedelta(i), v, 1.0) for i, v in enumerate(values)])
    got = revenue.top_anomalies(revenue.scored_revenue(sales)).collect()
    series = pd.Series(values)
    z = (series - series.rolling(28, min_periods=7).mean()) / series.rolling(28, min_periods=7).std()
    want = z[z.abs() >= 3]
    assert sorted(r["Date"] for r in got) == [start + timedelta(int(i)) for i in want.index]
    assert got[0]["z_score"] == pytest.approx(want.abs().max())


def test_scenarios_reach_their_targets(spark):
    months = spark.createDataFrame([(date(2024, 1, 1), 1e6), (date(2024, 2, 1), 3e6)], "month date, revenue double")
    scaled = revenue.scenario_scale(months, {"x": 8e6})
    assert scaled.agg(F.sum("x")).first()[0] == pytest.approx(8e6)
    lift = revenue.scenario_lift(months, {"x": 8e6}).first()
    assert (lift["lift_mn"], lift["lift_pct"]) == (4.0, 100.0)


@pytest.fixture(scope="module")
def busy_orders(spark):
    """One customer holds a third of all orders; many share a day."""
    rng = np.random.default_rng(3)
    n = 900
    who = np.where(np.arange(n) < 300, 1, rng.integers(2, 120, n))
    day = [date(2020, 1, 1) + timedelta(int(d)) for d in rng.integers(0, 500, n)]
    rows = [(int(i), d, int(c)) for i, (d, c) in enumerate(zip(day, who))]
    return spark.createDataFrame(rows, "order_id bigint, order_date date, customer_id bigint"), rows


def brute_gaps(rows):
    gaps, following = [], {}
    for c in {r[2] for r in rows}:
        mine = sorted((r[1], r[0]) for r in rows if r[2] == c)
        for (d0, i0), (d1, _) in zip(mine, mine[1:]):
            gaps.append((d1 - d0).days)
            following[i0] = (d1 - d0).days
    return gaps, following


def test_gap_statistics_match_brute_force(busy_orders):
    df, rows = busy_orders
    gaps, _ = brute_gaps(rows)
    got = by_key(customers.order_gap_stats(df), "metric")
    assert got["repeat_orders"]["value"] == len(gaps)
    assert got["median_inter_order_gap"]["value"] == np.median(gaps)
    assert got["mean_inter_order_gap"]["value"] == pytest.approx(np.mean(gaps))
    assert got["p75_inter_order_gap"]["value"] == np.quantile(gaps, 0.75)
    counts, edges = np.histogram(np.minimum(gaps, 100), bins=40)
    bins = by_key(customers.order_gap_histogram(df, 40, 100), "bin")
    assert [bins[i]["n"] if i in bins else 0 for i in range(40)] == counts.tolist()
    assert bins[0]["bin_start"] == edges[0]


def test_next_order_matches_brute_force(busy_orders):
    df, rows = busy_orders
    _, following = brute_gaps(rows)
    got = by_key(customers.repurchase_90d(df), "order_id")
    latest = max(r[1] for r in rows)
    assert len(got) == len(rows)
    for order_id, day, _ in rows:
        row, gap = got[order_id], following.get(order_id)
        assert row["next_gap_days"] == gap
        old_enough = day <= latest - timedelta(90)
        assert row["eligible_90d"] == old_enough
        assert row["repurchase_90d"] == int(old_enough and gap is not None and 1 <= gap <= 90)


def test_repurchase_window_edges(spark):
    first = date(2020, 1, 1)
    rows = [(10 * c + k, first + timedelta(days), c) for c, gap in enumerate((0, 1, 90, 91)) for k, days in enumerate((0, gap))]
    rows.append((99, first + timedelta(400), 9))
    got = by_key(customers.repurchase_90d(spark.createDataFrame(rows, "order_id bigint, order_date date, customer_id bigint")), "order_id")
    assert [got[10 * c]["repurchase_90d"] for c in range(4)] == [0, 1, 1, 0]
    assert got[99]["eligible_90d"] is False


def test_customer_health(shop):
    level = order_level(shop["orders"], shop["payments"])
    rows = by_key(customers.customer_health(level, 2013, 2018, 2022), "year")
    assert (rows[2018]["active_customers"], rows[2018]["orders"], rows[2018]["repeat_rate"]) == (1, 3, 1.0)
    assert (rows[2019]["orders"], rows[2019]["revenue"]) == (2, 0.0)  # the cancelled order does not count
    shift = customers.customer_health_shift(level, 2013, 2018, 2022).first()
    assert shift["aov_change_pct"] == pytest.approx(-100.0)


def test_lead_time_statistics(spark):
    values = [0, 1, 1, 2, 2, 2, 3, 50, -4, None]
    df = spark.createDataFrame([(v,) for v in values], "delivery_lead_days int")
    known = np.array([v for v in values if v is not None])
    kept = known[(known >= 0) & (known <= np.quantile(known, 0.995))]
    row = customers.lead_time_stats(df).first()
    assert (row["count"], row["min"], row["max"]) == (len(kept), kept.min(), kept.max())
    assert row["std"] == pytest.approx(kept.std(ddof=1)) and row["median"] == np.median(kept)
    counts, _ = np.histogram(kept, bins=30)
    assert sum(r["n"] for r in customers.lead_time_histogram(df).collect()) == counts.sum()


def test_small_customer_answers(shop):
    ages = by_key(customers.age_group_intensity(shop["customers"], shop["orders"]), "age_group")
    assert set(ages) == {"18-24", "25-34"} and ages["18-24"]["avg_orders_per_customer"] == 3.0
    shares = by_key(customers.payment_status_share(shop["orders"]), "payment_method", "order_status")
    assert shares["cod", "cancelled"]["status_share"] == 0.5
    for method in ("card", "cod"):
        assert sum(r["status_share"] for k, r in shares.items() if k[0] == method) == pytest.approx(1.0)
    assert [r["payment_method"] for r in customers.cancelled_share(shop["orders"]).collect()] == ["cod"]


def test_promotion_answers(shop):
    items = item_level(shop["order_items"], shop["orders"], shop["products"])
    diag = by_key(promotions.promo_diag(items, 2013, 2018, 2022), "period", "promo_used")
    assert diag["pre", 1]["orders"] == 3 and diag["pre", 1]["revenue"] == 74.0
    assert diag["post", 0]["revenue"] == 0.0  # a loss-making line is floored at 0
    assert sum(r["revenue_share"] for k, r in diag.items() if k[0] == "pre") == pytest.approx(1.0)
    regime = by_key(promotions.category_regime(items, 2013, 2018, 2022), "category")
    assert regime["tops"]["rev_share_post"] is None and regime["feet"]["rev_share_pre"] is None
    reasons = by_key(promotions.return_reason_summary(shop["returns"], shop["products"]), "return_reason")
    assert reasons["defective"]["return_records"] == 2
    rated = by_key(promotions.rating_return(shop["reviews"], shop["returns"]), "rating")
    assert (rated[4]["return_rate_among_reviewed"], rated[1]["return_rate_among_reviewed"]) == (1.0, 0.0)


def test_traffic_answers(shop):
    level = order_level(shop["orders"], shop["payments"])
    funnel = by_key(traffic.conversion_funnel(shop["web_traffic"], level, 2013, 2018, 2022), "year")
    assert funnel[2018]["conversion_rate"] == 0.03
    assert funnel[2019]["conversion_rate"] is None  # no sessions
    assert traffic.funnel_shift(shop["web_traffic"], level, 2013, 2018, 2022).first()["sessions_change_pct"] == -100.0


def test_sku_rules_on_their_cut_points(spark):
    mart = spark.createDataFrame(
        [(1, 10.0, 1.0), (2, 20.0, 2.0), (3, 30.0, 3.0), (4, 40.0, None), (5, 5.0, 9.0)],
        "product_id bigint, revenue double, avg_stockout_days double",
    )
    labels = {r["product_id"]: r["sku_action"] for r in products.sku_action_matrix(mart).collect()}
    assert labels == {1: products.REDUCE, 2: products.PROTECT, 3: products.PRIORITY, 4: products.PROTECT, 5: products.SELECTIVE}
    skus = spark.createDataFrame(
        [(i, float(i), float(i % 2), float(i < 3), 0.5) for i in range(1, 11)],
        "product_id bigint, revenue double, stockout_rate double, overstock_rate double, sell_through_rate double",
    )
    frame = skus.toPandas()
    actions = {r["product_id"]: r["action"] for r in products.sku_action_q70(skus).collect()}
    r70, s70, o70 = (frame[c].quantile(0.7) for c in ("revenue", "stockout_rate", "overstock_rate"))
    for _, r in frame.iterrows():
        if r.revenue >= r70:
            want = products.REORDER if r.stockout_rate >= s70 else products.MONITOR
        else:
            want = products.MARKDOWN if r.overstock_rate >= o70 else products.REVIEW
        assert actions[int(r.product_id)] == want
    summary = products.sku_action_summary(products.sku_action_q70(skus)).collect()
    assert sum(r["revenue_share"] for r in summary) == pytest.approx(1.0)


def test_sku_ops_falls_back_to_listed_revenue(spark, shop):
    panel = shop["inventory"].withColumn("item_revenue", F.lit(0.0))
    listed = spark.createDataFrame([(1, 12.5)], "product_id bigint, revenue double")
    rows = by_key(products.sku_ops(panel, listed), "product_id")
    assert (rows[1]["revenue"], rows[3]["revenue"]) == (12.5, 0.0)
    kept = by_key(products.sku_ops(panel.withColumn("item_revenue", F.lit(3.0)), listed), "product_id")
    assert (kept[1]["revenue"], kept[3]["revenue"]) == (3.0, 3.0)


def test_every_day_is_scored_and_the_top_is_cut_from_it(spark):
    start = date(2020, 1, 1)
    values = [10.0, 12.0] * 20 + [100.0, 90.0]
    scored = revenue.scored_revenue(daily(spark, [(start + timedelta(i), v, 1.0) for i, v in enumerate(values)]))
    rows = scored.orderBy("Date").collect()
    assert len(rows) == len(values) and not any(r["is_anomaly"] for r in rows[:40]) and rows[40]["is_anomaly"]
    assert rows[0]["z_score"] is None and revenue.top_anomalies(scored, top=1).count() == 1


def test_orders_without_customer_leave_the_promotion_answer(spark):
    lines = spark.createDataFrame(
        [(1, 1, date(2020, 1, 1), 5.0, 6.0, 1.0, 0.0, 1), (2, None, date(2020, 1, 1), 5.0, 6.0, 1.0, 0.0, 1)],
        "order_id bigint, customer_id bigint, order_date date, net_item_revenue double, gross_merch_value double, gross_profit double, discount_amount double, promo_used_flag int",
    )
    assert [r["order_id"] for r in promotions.promo_order_level(lines).collect()] == [1]


def test_repeats_follow_the_last_order_of_a_day(spark):
    day = [date(2020, 1, 1), date(2020, 1, 20), date(2020, 12, 1)]
    orders = spark.createDataFrame(
        [(1, 7, day[0], 1), (2, 7, day[0], 0), (3, 7, day[1], 1), (4, 8, day[0], 1), (5, 8, day[2], 0)],
        "order_id bigint, customer_id bigint, order_date date, promo_used int",
    ).selectExpr("*", "1.0D as revenue", "1.0D as gross_merch_value", "1.0D as gross_profit", "0.0D as discount_amount")
    found = {(r["order_date"], r["promo_used"]): (r["orders"], r["repeated"]) for r in promotions.promo_days(orders).collect()}
    assert found == {(day[0], 1): (2, 0), (day[0], 0): (1, 1), (day[1], 1): (1, 0), (day[2], 0): (1, 0)}
