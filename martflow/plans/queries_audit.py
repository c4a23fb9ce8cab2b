"""Registered queries over all built tables: null classes, verdicts, mart checks.

The six facts and marts are written once to a layer and read back; the nine joined tables are read as they are
computed. One pass over these 15 tables gives their profiles, which are kept beside the marts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.operators import joins, marts, quality
from martflow.plans.layers import Layer
from martflow.plans.oracle_views import AUDIT_VIEWS
from martflow.plans.queries_marts import CUSTOMER_360, DAILY_PANEL, ITEM_FACT, ORDER_FACT, PRODUCT_360, PRODUCT_MONTH
from martflow.plans.queries_quality import ITEM, JOINED_COLUMNS, _duplicates_sql, _has_null, _union
from martflow.plans.registry import Query
from martflow.sources.retail_views import DRIVER_TABLES, RetailViews
from martflow.sources.schema import EXPECTED_GRAIN, MART_KEYS, NULL_RULES


def _names(columns: str) -> str:
    return " ".join(c.partition(":")[0] for c in columns.split())


# Columns of the built tables, in order, for the oracle text.
AUDITED_COLUMNS = {
    **JOINED_COLUMNS,
    "items_returns": ITEM + "return_id return_date return_reason return_quantity refund_amount return_join_status",
    "items_reviews": ITEM + "review_id customer_id review_date rating review_join_status",
    "items_double_promotions": ITEM,
    "item_fact": _names(ITEM_FACT),
    "order_fact": _names(ORDER_FACT),
    "customer_360": _names(CUSTOMER_360),
    "product_360": _names(PRODUCT_360),
    "daily_panel": _names(DAILY_PANEL),
    "product_month_panel": _names(PRODUCT_MONTH) + " year month",
}
MART_COLUMNS = {name: AUDITED_COLUMNS[name] for name in MART_KEYS} | {"product_month_panel": _names(PRODUCT_MONTH)}


def layer_of(v: RetailViews) -> Layer:
    return Layer(v.spark, [f"{v.sf_dir}/{table}.parquet" for table in DRIVER_TABLES])


def written_marts(v: RetailViews, layer: Layer) -> dict[str, DataFrame]:
    """The six facts and marts, each derived from the written facts before it. Join keys are checked once, when the
    first is built."""
    t = v.tables()

    def item_fact() -> DataFrame:
        return marts.item_fact(
            t["order_items"], t["orders"], t["products"], t["customers"], t["geography"], t["payments"], t["shipments"],
            t["returns"], t["reviews"], owners=v.owners("orders", "products", "customers", "geography", "payments", "shipments"),
        )

    items = layer.table("item_fact", item_fact)
    orders = layer.table(
        "order_fact",
        lambda: marts.order_fact(t["orders"], items, t["customers"], t["geography"], t["payments"], t["shipments"], checked=False),
    )
    return {
        "item_fact": items,
        "order_fact": orders,
        "customer_360": layer.table("customer_360", lambda: marts.customer_360(t["customers"], orders)),
        "product_360": layer.table("product_360", lambda: marts.product_360(t["products"], items)),
        "daily_panel": layer.table("daily_panel", lambda: marts.daily_panel(t["sales"], t["web_traffic"], orders)),
        "product_month_panel": layer.table(
            "product_month_panel",
            lambda: marts.product_month_panel(t["inventory"], t["products"], items.where(F.col("order_date").isNotNull())),
        ),
    }


def audited_tables(v: RetailViews, layer: Layer) -> dict[str, DataFrame]:
    """The 15 tables of the audit; keys have been checked with the facts."""
    built = written_marts(v, layer)
    t = v.tables("orders", "order_items", "products", "customers", "geography", "payments", "shipments", "returns", "reviews")
    months = built["product_month_panel"]
    return {
        "orders_customers": joins.orders_customers(t["orders"], t["customers"], checked=False),
        "orders_payments": joins.orders_payments(t["orders"], t["payments"]),
        "orders_geography": joins.orders_geography(t["orders"], t["geography"], checked=False),
        "orders_shipments": joins.orders_shipments(t["orders"], t["shipments"], checked=False),
        "items_orders": joins.items_orders(t["order_items"], t["orders"], checked=False),
        "items_products": joins.items_products(t["order_items"], t["products"], checked=False),
        "items_returns": joins.items_returns(t["order_items"], t["returns"]),
        "items_reviews": joins.items_reviews(t["order_items"], t["reviews"]),
        "items_double_promotions": joins.items_double_promotions(t["order_items"]),
        **built,
        "product_month_panel": months.withColumns({"year": F.year("snapshot_date"), "month": F.month("snapshot_date")}),
    }


def profiled(layer: Layer, name: str, tables: dict[str, DataFrame], grains: dict[str, list[str]]) -> DataFrame:
    """Profiles of the tables, written one by one, so that the shuffles of one table are gone before the next is read."""
    one = lambda table: lambda: quality.table_profiles({table: tables[table]}, grains)
    return quality.union_all([layer.table(f"{name}-{table}", one(table)) for table in tables])


def audit_profiles(v: RetailViews) -> DataFrame:
    """Profiles of the 15 tables under their expected grain."""
    layer = layer_of(v)
    return layer.table("audit_profiles", lambda: profiled(layer, "audit-profile", audited_tables(v, layer), EXPECTED_GRAIN))


def mart_profiles(v: RetailViews) -> DataFrame:
    """Profiles of the marts under the keys that they are checked by."""
    layer = layer_of(v)
    keys = {name: key for name, (key, _) in MART_KEYS.items()}
    return layer.table("mart_profiles", lambda: profiled(layer, "mart-profile", written_marts(v, layer), keys))


def _class_sql(name: str) -> str:
    label = {c: quality.NULL_CLASSES[k] for k, cs in NULL_RULES[name].items() for c in cs}
    return _union(
        [
            f"""select '{name}' as "table", '{c}' as "column", count(*) - count("{c}") as null_count,
                round((count(*) - count("{c}")) * 100.0 / count(*), 2) as null_pct,
                '{label.get(c, "unclassified")}' as null_class from {AUDIT_VIEWS.get(name, "m_" + name)}"""
            for c in AUDITED_COLUMNS[name].split()
        ]
    )


def _verdict_sql(name: str) -> str:
    keys, columns, view = EXPECTED_GRAIN[name], AUDITED_COLUMNS[name].split(), AUDIT_VIEWS.get(name, "m_" + name)
    rules = NULL_RULES[name]
    bad = [c for c in columns if c in rules.get("unexpected", [])]
    structural = [c for c in columns if c in rules.get("structural", [])]
    nulls = ", ".join(f'count(*) - count("{c}") as n_{c}' for c in sorted({*bad, *structural, *keys}))
    bad_n = " + ".join(f"case when n_{c} > 0 then 1 else 0 end" for c in bad)
    bad_list = ", ".join(f"case when n_{c} > 0 then '{c}' end" for c in bad)
    has_structural = " or ".join(f"n_{c} > 0" for c in structural) or "false"
    return f"""select '{name}' as "table", n_rows as "rows", {len(columns)} as cols, '{", ".join(keys)}' as expected_key,
        'checked' as key_state, key_nulls as null_key_rows, dup as duplicate_key_rows, grain_check,
        bad_n as unexpected_null_columns, null_risk,
        case when 'FAIL' in (grain_check, null_risk) then 'FAIL' when 'WARN' in (grain_check, null_risk) then 'WARN' else 'PASS' end
          as overall_status,
        concat_ws(' | ', case when dup > 0 then concat('duplicate by expected grain = ', cast(dup as bigint)) end,
                  case when bad_n > 0 then concat('unexpected null in: ', concat_ws(', ', {bad_list})) end,
                  case when {has_structural} then 'structural null present (likely normal)' end) as notes
        from (select *, {bad_n} as bad_n,
                     case when dup = 0 then 'PASS' when dup <= 20 then 'WARN' else 'FAIL' end as grain_check,
                     case when {bad_n} = 0 then 'PASS' when {bad_n} <= 2 then 'WARN' else 'FAIL' end as null_risk
              from ({_duplicates_sql(view, keys)}) d
              cross join (select {nulls} from {view}) z
              cross join (select count(*) as key_nulls from {view} where {_has_null(keys)}) k) t"""


def _mart_check_sql(name: str) -> str:
    keys, unique = MART_KEYS[name]
    view = {"product_month_panel": "m_product_month"}.get(name, "m_" + name)
    good = "dup = 0" if unique else "true"
    return f"""select '{name}' as mart, n_rows as "rows", {len(MART_COLUMNS[name].split())} as cols, '{", ".join(keys)}' as "key",
        dup as duplicate_key_rows, {str(unique).lower()} as expected_unique, case when {good} then 'PASS' else 'CHECK' end as status
        from ({_duplicates_sql(view, keys)}) d"""


QUERIES: dict[str, Query] = {
    "null_classes": Query(
        "table column null_count:i null_pct:2 null_class",
        lambda v: quality.null_classes_of(audit_profiles(v)),
        _union([_class_sql(name) for name in AUDITED_COLUMNS]),
    ),
    "audit_conclusion": Query(
        "table rows:i cols:i expected_key key_state null_key_rows:i duplicate_key_rows:i grain_check unexpected_null_columns:i "
        "null_risk overall_status notes",
        lambda v: quality.verdicts_of(audit_profiles(v)),
        _union([_verdict_sql(name) for name in AUDITED_COLUMNS]),
    ),
    "mart_checks": Query(
        "mart rows:i cols:i key duplicate_key_rows:i expected_unique status",
        lambda v: quality.mart_checks_of(mart_profiles(v), [name for name, (_, unique) in MART_KEYS.items() if unique]),
        _union([_mart_check_sql(name) for name in MART_KEYS]),
    ),
}
