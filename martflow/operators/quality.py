"""Data-quality reports: nulls, keys, relations, dates, business rules, verdicts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions.expr import SOLD_STATUSES, any_present, is_true, safe_divide
from martflow.operators.tagged import column_counts, grain_counts, relation_counts, row_counts
from martflow.sources.schema import (
    CANDIDATE_ITEM_KEYS,
    CARDINALITY_KEYS,
    DATA_DICTIONARY,
    DATE_COLUMNS,
    EXPECTED_GRAIN,
    NULL_RULES,
    PRIMARY_KEYS,
    RELATIONS,
)

NULL_CLASSES = {
    "structural": "structural_null",
    "expected": "expected_nullable",
    "unexpected": "unexpected_null",
}
STRUCTURAL_NOTE = "structural null present (likely normal)"


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _constant_row(spark: SparkSession, **values: Column) -> DataFrame:
    return spark.range(1).select(*[v.alias(k) for k, v in values.items()])


def _rows() -> Column:
    return F.count(F.lit(1))


def _missing(name: str) -> Column:
    return F.col(name).isNull()


# ---------------------------------------------------------------- nulls


def null_counts(df: DataFrame, table: str) -> DataFrame:
    """(table, column, position, dtype, rows, null_count) from one pass without a row shuffle."""
    dtypes = dict(df.dtypes)
    counted = df.agg(_rows().alias("rows"), *[F.count_if(_missing(c)).alias(f"n_{i}") for i, c in enumerate(df.columns)])
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(i).alias("position"),
                F.lit(dtypes[c]).alias("dtype"),
                F.col(f"n_{i}").alias("null_count"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return counted.select("rows", F.explode(entries).alias("e")).select(F.lit(table).alias("table"), "rows", "e.*")


def null_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Columns that hold nulls, worst first within each table."""
    counts = union_all([null_counts(df, name) for name, df in tables.items()])
    return (
        counts.where(F.col("null_count") > 0)
        .select("table", "column", "null_count", safe_divide("null_count", "rows").alias("null_rate"))
        .orderBy("table", F.desc("null_rate"), "column")
    )


def column_profile(df: DataFrame, table: str) -> DataFrame:
    """Type, nulls and exact distinct values per column of one table."""
    return null_profile({table: df})


def null_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Type, nulls and exact distinct values of every column; each table is read once (see tagged.column_counts)."""
    pct = F.round(safe_divide(F.col("null_count") * 100.0, "rows"), 2).alias("null_pct")
    profile = column_counts(tables).select("table", "column", "dtype", "null_count", pct, "n_unique")
    return profile.orderBy("table", F.desc("null_count"), "column")


def _class_of(rules: dict[str, dict[str, list[str]]]) -> Column:
    """Map from "table column" to the class that the rules give it; the first of structural, expected, unexpected wins."""
    classes = {}
    for table, kinds in rules.items():
        for kind in ("unexpected", "expected", "structural"):
            classes.update({f"{table} {column}": NULL_CLASSES[kind] for column in kinds.get(kind, [])})
    if not classes:
        return F.lit(None).cast("map<string,string>")
    return F.create_map(*[F.lit(x) for entry in sorted(classes.items()) for x in entry])


def table_profiles(tables: dict[str, DataFrame], grains: dict[str, list[str]] = EXPECTED_GRAIN) -> DataFrame:
    """One row a table: rows, cols, its expected key with counts, and the null count of each column.

    Each table is read once, all of them share their shuffles (see tagged.grain_counts). A key that is not
    given, or not there, has no counts; ``key_state`` says why.
    """
    usable = {t: grains[t] for t, df in tables.items() if grains.get(t) and set(grains[t]) <= set(df.columns)}
    states = []
    for table, df in tables.items():
        keys = grains.get(table, [])
        state = "checked" if table in usable else "missing_key_columns" if keys else "no_key"
        states.append((table, len(df.columns), ", ".join(keys) if keys else None, state))
    spark = next(iter(tables.values())).sparkSession
    known = spark.createDataFrame(states, "table string, cols int, expected_key string, key_state string")
    checked = F.col("key_state") == "checked"
    return F.broadcast(known).join(grain_counts(tables, usable), "table").select(
        "table",
        "rows",
        "cols",
        "expected_key",
        "key_state",
        F.when(checked, F.col("null_key_rows")).alias("null_key_rows"),
        F.when(checked, F.col("distinct_keys")).alias("distinct_keys"),
        F.when(checked, F.col("rows") - F.col("distinct_keys")).alias("duplicate_key_rows"),
        "columns",
    )


def null_classes_of(profiles: DataFrame, rules: dict[str, dict[str, list[str]]] = NULL_RULES) -> DataFrame:
    """Null count of each column with the class its table's rules give it, from ``table_profiles``."""
    columns = profiles.select("table", "rows", F.explode("columns").alias("c"))
    label = F.coalesce(F.try_element_at(_class_of(rules), F.concat_ws(" ", "table", "c.column")), F.lit("unclassified"))
    pct = F.round(safe_divide(F.col("c.null_count") * 100.0, "rows"), 2)
    return columns.select("table", "c.column", "c.null_count", pct.alias("null_pct"), label.alias("null_class"))


def null_classes(tables: dict[str, DataFrame], rules: dict[str, dict[str, list[str]]] = NULL_RULES) -> DataFrame:
    return null_classes_of(table_profiles(tables, {}), rules)


def incomplete_rows(df: DataFrame, needed: tuple[str, ...]) -> DataFrame:
    """Rows that lack one of the needed columns' values; columns that the table does not have are not asked for."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in needed if c in df.columns], F.lit(True))
    return df.where(~complete)


def missing_payment_rows(orders_payments: DataFrame) -> DataFrame:
    """Orders whose payment is missing or incomplete."""
    return incomplete_rows(orders_payments, ("payment_method", "payment_value", "installments"))


def missing_shipment_rows(orders_shipments: DataFrame) -> DataFrame:
    """Orders whose shipment is missing or incomplete."""
    return incomplete_rows(orders_shipments, ("ship_date", "delivery_date", "shipping_fee"))


# ---------------------------------------------------------------- keys


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows, distinct keys, surplus rows per key, rows with a missing key part."""
    has_null = ~reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    groups = df.groupBy(*keys).agg(_rows().alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        _rows().alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_key_rows"),
        F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("null_key_rows"),
    )


def duplicate_key_report(
    tables: dict[str, DataFrame], primary_keys: dict[str, list[str]] = PRIMARY_KEYS
) -> DataFrame:
    reports = []
    for table, keys in primary_keys.items():
        if table not in tables:
            continue
        df = tables[table]
        names = F.lit(",".join(keys))
        if not set(keys) <= set(df.columns):
            reports.append(
                _constant_row(
                    df.sparkSession,
                    table=F.lit(table),
                    keys=names,
                    status=F.lit("MISSING_COLUMNS"),
                    duplicate_rows=F.lit(None).cast("bigint"),
                )
            )
            continue
        surplus = F.col("duplicate_key_rows")
        reports.append(
            key_counts(df, keys).select(
                F.lit(table).alias("table"),
                names.alias("keys"),
                F.when(surplus == 0, "PASS").otherwise("FAIL").alias("status"),
                surplus.alias("duplicate_rows"),
            )
        )
    return union_all(reports)


def key_profile(df: DataFrame, table: str, keys: list[str], expected_unique: bool = False) -> DataFrame:
    clean = F.col("null_key_rows") == 0
    if expected_unique:
        clean = clean & (F.col("duplicate_key_rows") == 0)
    return key_counts(df, keys).select(
        F.lit(table).alias("table"),
        F.lit(", ".join(keys)).alias("key_cols"),
        "rows",
        "distinct_keys",
        "duplicate_key_rows",
        "null_key_rows",
        F.lit(expected_unique).alias("expected_unique"),
        F.when(clean, "PASS").otherwise("CHECK").alias("status"),
    )


def cardinality_checks(
    tables: dict[str, DataFrame], checks: list[tuple[str, list[str], bool]] = CARDINALITY_KEYS
) -> DataFrame:
    return union_all([key_profile(tables[t], t, keys, unique) for t, keys, unique in checks if t in tables])


def require_unique(keys: dict[str, tuple[DataFrame, list[str]]]) -> None:
    """Fail when a table's key repeats. One job over key columns; each table yields one row."""
    checks = union_all([key_profile(df, name, key, True) for name, (df, key) in keys.items()])
    bad = checks.where(F.col("duplicate_key_rows") > 0).select("table", "key_cols", "duplicate_key_rows").collect()
    if bad:
        listed = "; ".join(f"{r['table']} ({r['key_cols']}): {r['duplicate_key_rows']}" for r in bad)
        raise ValueError(f"join keys are not unique, surplus rows: {listed}")


def candidate_keys(items: DataFrame, keys: list[list[str]] = CANDIDATE_ITEM_KEYS) -> DataFrame:
    """Surplus rows for each candidate key, to find the real grain of a table."""
    tried = [[c for c in key if c in items.columns] for key in keys]
    return union_all(
        [
            key_counts(items, key).select(
                F.lit(", ".join(key)).alias("candidate_key"), F.col("duplicate_key_rows").alias("duplicate_rows")
            )
            for key in tried
            if key
        ]
    )


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their size."""
    return df.groupBy(*keys).agg(_rows().alias("n_rows")).where(F.col("n_rows") > 1)


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of duplicated keys. The sizes are joined back instead of counted in a window, so a
    key with very many rows is never buffered in one task."""
    return df.join(duplicate_groups(df, keys), keys, "inner")


def mart_checks_of(profiles: DataFrame, unique: list[str]) -> DataFrame:
    """Rows, width and key surplus of built tables, from ``table_profiles``; keys of those in ``unique`` may not repeat."""
    expected = F.col("table").isin(unique)
    good = ~expected | (F.col("duplicate_key_rows") == 0)
    return profiles.select(
        F.col("table").alias("mart"),
        "rows",
        "cols",
        F.col("expected_key").alias("key"),
        "duplicate_key_rows",
        expected.alias("expected_unique"),
        F.when(good, "PASS").otherwise("CHECK").alias("status"),
    )


def mart_checks(marts: dict[str, tuple[DataFrame, list[str], bool]]) -> DataFrame:
    """Rows, width and key surplus of every built table, each read once."""
    tables = {name: df for name, (df, _, _) in marts.items()}
    profiles = table_profiles(tables, {name: keys for name, (_, keys, _) in marts.items()})
    return mart_checks_of(profiles, [name for name, (_, _, unique) in marts.items() if unique])


# ---------------------------------------------------------------- relations


def foreign_key_coverage(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Share of non-null child keys that exist in the parent.

    Child rows are counted per key first: a key held by a third of the child is one row when it
    reaches the join.
    """
    keys = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("_key")).agg(_rows().alias("n"))
    known = parent.select(F.col(parent_key).alias("_key")).distinct().withColumn("_known", F.lit(True))
    counts = keys.join(known, "_key", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("child_non_null_rows"),
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("missing_fk_rows"),
    )
    return counts.select(
        F.lit(child_key).alias("child_key"),
        F.lit(parent_key).alias("parent_key"),
        "child_non_null_rows",
        "missing_fk_rows",
        (1 - safe_divide("missing_fk_rows", "child_non_null_rows", 0.0)).alias("coverage_rate"),
        F.when(F.col("missing_fk_rows") == 0, "PASS").otherwise("WARN").alias("status"),
    )


def relationship_report(
    tables: dict[str, DataFrame], relations: list[tuple[str, str, str]] = RELATIONS
) -> DataFrame:
    """Coverage of every relation whose tables and keys are there; each table is read once for all of its relations."""
    known = [
        (child, key, parent, key)
        for child, parent, key in relations
        if child in tables and parent in tables and key in tables[child].columns and key in tables[parent].columns
    ]
    return relation_counts(tables, known).select(
        "child_key",
        "parent_key",
        "child_non_null_rows",
        "missing_fk_rows",
        (1 - safe_divide("missing_fk_rows", "child_non_null_rows", 0.0)).alias("coverage_rate"),
        F.when(F.col("missing_fk_rows") == 0, "PASS").otherwise("WARN").alias("status"),
        "child_table",
        "parent_table",
    )


def order_payment_reconciliation(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Distinct orders against distinct paid orders, both differences, one row."""
    left = orders.select("order_id").distinct().withColumn("_order", F.lit(1))
    right = payments.select("order_id").distinct().withColumn("_paid", F.lit(1))
    has_order, has_payment = F.col("_order").isNotNull(), F.col("_paid").isNotNull()
    counts = left.join(right, "order_id", "full_outer").agg(
        F.count_if(has_order).alias("orders"),
        F.count_if(has_payment).alias("payments"),
        F.count_if(has_order & ~has_payment).alias("orders_without_payment"),
        F.count_if(has_payment & ~has_order).alias("payments_without_order"),
    )
    same = (F.col("orders_without_payment") == 0) & (F.col("payments_without_order") == 0)
    return counts.withColumn("status", F.when(same, "PASS").otherwise("WARN"))


# ---------------------------------------------------------------- dates and rules


def date_range_report(
    tables: dict[str, DataFrame], date_columns: dict[str, list[str]] = DATE_COLUMNS
) -> DataFrame:
    """Range, unreadable or missing dates, and rows for every declared date column."""
    reports = []
    for table, columns in date_columns.items():
        name = table.removesuffix(".csv")
        if name not in tables:
            continue
        df = tables[name]
        for column in [c for c in columns if c in df.columns]:
            is_text = dict(df.dtypes)[column] == "string"
            day = F.try_to_date(F.col(column)) if is_text else F.col(column).cast("date")
            reports.append(
                df.agg(
                    F.min(day).alias("min_date"),
                    F.max(day).alias("max_date"),
                    F.count_if(day.isNull()).alias("null_dates"),
                    _rows().alias("rows"),
                ).select(
                    F.lit(name).alias("table"), F.lit(column).alias("date_col"),
                    "min_date", "max_date", "null_dates", "rows",
                )
            )
    return union_all(reports)


def no_future_dates(df: DataFrame, date_col: str, max_date: str = "2024-07-01") -> DataFrame:
    """One boolean: every date lies on or before ``max_date``; a missing date fails."""
    on_time = is_true(F.col(date_col).cast("date") <= F.to_date(F.lit(max_date)))
    return df.agg(F.coalesce(F.bool_and(on_time), F.lit(True)).alias("no_future_dates"))


def product_margin_rule(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id",
        "price",
        "cogs",
        safe_divide(F.col("price") - F.col("cogs"), "price").alias("gross_margin_pct"),
        is_true(F.col("cogs") < F.col("price")).alias("rule_cogs_lt_price"),
    )


def shipment_status_rule(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Every shipped order with its status and whether that status may ship."""
    shipped = shipments.select("order_id").distinct()
    status = orders.select("order_id", "order_status")
    return shipped.join(status, "order_id", "left").withColumn(
        "allowed_status", is_true(F.col("order_status").isin(*SOLD_STATUSES))
    )


def shipment_violations(orders_shipments: DataFrame) -> DataFrame:
    """Counts of orders that lack a shipment they need, or have one they should not."""
    details = [c for c in ("ship_date", "delivery_date", "shipping_fee") if c in orders_shipments.columns]
    shipped = any_present(details)
    needs = is_true(F.col("order_status").isin(*SOLD_STATUSES))
    return orders_shipments.agg(
        F.count_if(needs & ~shipped).alias("missing_shipment"),
        F.count_if(~needs & shipped).alias("unexpected_shipment"),
    )


# ---------------------------------------------------------------- overviews and verdicts


def table_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all(
        [
            df.agg(_rows().alias("rows")).select(
                F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("cols")
            )
            for name, df in tables.items()
        ]
    )


def data_dictionary(spark: SparkSession) -> DataFrame:
    names = "table_name string, grain string, primary_key string, base_table string, joined_tables string, meaning string"
    return spark.createDataFrame(DATA_DICTIONARY, names)


def repeated_row_count(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier one in every column.

    Only a 64-bit hash of each row is shuffled to find candidates; whole rows are compared among
    the candidates alone, so equal hashes of different rows do no harm.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    shared = hashed.groupBy("_hash").agg(_rows().alias("_n")).where(F.col("_n") > 1).select("_hash")
    copies = hashed.join(shared, "_hash", "left_semi").groupBy(*df.columns).agg(_rows().alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def audit_overview(tables: dict[str, DataFrame]) -> DataFrame:
    """Size, null density and fully repeated rows per table.

    One read of each table counts rows, nulls and row hashes; only tables with equal hashes are read a second
    time, to compare those rows in full. To know which, the counts (one row a table) come to the driver.
    """
    spark = next(iter(tables.values())).sparkSession
    counts = [(r["table"], r["rows"], len(tables[r["table"]].columns), r["nulls"], r["shared"]) for r in row_counts(tables).collect()]
    sizes = spark.createDataFrame(counts, "table string, rows bigint, cols int, total_null_values bigint, shared bigint")
    suspects = [table for table, *_, shared in counts if shared]
    if suspects:
        repeats = union_all([repeated_row_count(tables[t]).withColumn("table", F.lit(t)) for t in suspects])
        sizes = sizes.join(F.broadcast(repeats), "table", "left")
    else:
        sizes = sizes.withColumn("duplicate_rows", F.lit(0))
    repeated = F.coalesce("duplicate_rows", F.lit(0)).cast("bigint")
    cells = F.col("rows") * F.col("cols")
    return (
        sizes.withColumn("duplicate_rows", repeated)
        .select(
            "table",
            "rows",
            "cols",
            "total_null_values",
            F.round(safe_divide(F.col("total_null_values") * 100.0, cells), 2).alias("null_density_pct"),
            "duplicate_rows",
            F.round(safe_divide(F.col("duplicate_rows") * 100.0, "rows"), 4).alias("duplicate_row_pct"),
        )
        .orderBy(F.desc("rows"), F.desc("cols"), "table")
    )


def verdicts_of(profiles: DataFrame, rules: dict[str, dict[str, list[str]]] = NULL_RULES) -> DataFrame:
    """Grain and null verdict of each table, from ``table_profiles``; the worse of both is its overall status."""

    def holes(kind: str) -> Column:
        label = lambda c: F.try_element_at(_class_of(rules), F.concat_ws(" ", F.col("table"), c["column"]))
        found = F.filter("columns", lambda c: is_true(label(c) == NULL_CLASSES[kind]) & (c["null_count"] > 0))
        return F.transform(found, lambda c: c["column"])

    judged = profiles.withColumns({"_bad": holes("unexpected"), "_structural": F.size(holes("structural")) > 0})
    surplus, bad_n = F.col("duplicate_key_rows"), F.size("_bad")
    grain = F.when(surplus.isNull(), "WARN").when(surplus == 0, "PASS").when(surplus <= 20, "WARN").otherwise("FAIL")
    risk = F.when(bad_n == 0, "PASS").when(bad_n <= 2, "WARN").otherwise("FAIL")
    notes = F.concat_ws(
        " | ",
        F.when(surplus > 0, F.concat(F.lit("duplicate by expected grain = "), surplus.cast("string"))),
        F.when(bad_n > 0, F.concat(F.lit("unexpected null in: "), F.concat_ws(", ", "_bad"))),
        F.when(F.col("_structural"), STRUCTURAL_NOTE),
    )
    worst = (
        F.when((F.col("grain_check") == "FAIL") | (F.col("null_risk") == "FAIL"), "FAIL")
        .when((F.col("grain_check") == "WARN") | (F.col("null_risk") == "WARN"), "WARN")
        .otherwise("PASS")
    )
    return (
        judged.withColumns({"grain_check": grain, "unexpected_null_columns": bad_n, "null_risk": risk, "notes": notes})
        .withColumn("overall_status", worst)
        .select(
            "table", "rows", "cols", "expected_key", "key_state", "null_key_rows", "duplicate_key_rows", "grain_check",
            "unexpected_null_columns", "null_risk", "overall_status", "notes",
        )
    )


def table_verdict(df: DataFrame, table: str, keys: list[str], rules: dict = NULL_RULES) -> DataFrame:
    """Grain and null verdict of one table."""
    return verdicts_of(table_profiles({table: df}, {table: keys}), rules)


def audit_conclusion(
    tables: dict[str, DataFrame], grains: dict[str, list[str]] = EXPECTED_GRAIN, rules: dict = NULL_RULES
) -> DataFrame:
    return verdicts_of(table_profiles(tables, grains), rules).orderBy("overall_status", "table")


def submission_check(submission: DataFrame, sample: DataFrame) -> DataFrame:
    """Contract of a submission against the sample's dates: one row of booleans and a verdict."""
    names_fit = submission.columns == ["Date", "Revenue", "COGS"]
    given = submission.groupBy(F.col("Date").cast("string").alias("Date")).agg(
        _rows().alias("got"),
        F.count_if(F.col("Revenue").isNull() | F.col("COGS").isNull()).alias("nulls"),
        F.count_if((F.col("Revenue") < 0) | (F.col("COGS") < 0)).alias("negatives"),
    )
    wanted = sample.groupBy(F.date_format("Date", "yyyy-MM-dd").alias("Date")).agg(_rows().alias("want"))
    got, want = F.coalesce("got", F.lit(0)), F.coalesce("want", F.lit(0))
    checks = wanted.join(given, "Date", "full_outer").agg(
        (F.sum(got) == F.sum(want)).alias("row_count_ok"),
        F.lit(names_fit).alias("columns_ok"),
        F.bool_and(got == want).alias("dates_ok"),
        (F.coalesce(F.sum("nulls"), F.lit(0)) == 0).alias("complete_ok"),
        (F.coalesce(F.sum("negatives"), F.lit(0)) == 0).alias("non_negative_ok"),
    )
    passed = reduce(
        lambda a, b: a & b,
        [F.col(c) for c in ("row_count_ok", "columns_ok", "dates_ok", "complete_ok", "non_negative_ok")],
    )
    return checks.withColumn("status", F.when(passed, "PASS").otherwise("FAIL"))
