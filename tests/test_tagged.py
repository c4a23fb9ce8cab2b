"""Tagged counts against plain Python, in all column types and with awkward rows."""

from __future__ import annotations

import math
import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martflow.operators import quality, tagged

TYPES = (
    "a tinyint, b smallint, c int, d bigint, e boolean, f date, g timestamp, h timestamp_ntz, i float, j double, k decimal(10,2), "
    "l string, m binary, n array<int>, `o.p` struct<x:int,y:string>"
)


def random_rows(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)

    def maybe(value):
        return None if rng.random() < 0.15 else value

    out = []
    for _ in range(n):
        whole = rng.choice([0, 1, -1, 63, 64, -64, -65, 100])
        day = rng.randint(1, 28)
        out.append(
            tuple(
                map(
                    maybe,
                    (
                        whole, whole, whole * 1000, rng.choice([whole, 2**62 + whole, -(2**63)]), rng.random() < 0.5, date(1969, 12, day),
                        datetime(2020, 1, day, 1), datetime(2020, 3, day, 2, 30), rng.choice([0.0, -0.0, 1.5, float("nan")]), rng.choice([0.0, -0.0, 0.1, float("nan"), float("inf")]),
                        Decimal(whole) / 4, rng.choice(["", "x", "ä", "X"]), rng.choice([b"", b"\xff", b"\xfe\x00"]),
                        rng.choice([[], [1], [None], [1, 2]]), rng.choice([(1, None), (None, "1"), (None, None)]),
                    ),
                )
            )
        )
    return out


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return bytes(value) if isinstance(value, bytearray) else value


@pytest.mark.parametrize("n", [0, 1, 400])
def test_column_counts_of_all_types(spark, n):
    rows = random_rows(n, n)
    df = spark.createDataFrame(rows, TYPES)
    other = spark.range(200).selectExpr("id", "id % 3 as a", "'x' as l")
    found = {(r["table"], r["column"]): r for r in tagged.column_counts({"t": df, "u": other}).collect()}
    assert len(found) == 18
    for at, (name, dtype) in enumerate(df.dtypes):
        column = [plain(r[at]) for r in rows]
        known = [x for x in column if x is not None]
        distinct = len({repr(x) for x in known})
        row = found["t", name]
        assert (row["position"], row["dtype"], row["rows"], row["null_count"], row["n_unique"]) == (at, dtype, n, n - len(known), distinct), name
    assert [found["u", c]["n_unique"] for c in ("id", "a", "l")] == [200, 3, 1]


def test_maps_have_no_distinct_values(spark):
    with pytest.raises(ValueError, match="map column 'm'"):
        tagged.column_counts({"t": spark.sql("select map(1, 2) as m")})


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_profile_copies_no_wide_rows(shop):
    plan = plan_of(quality.null_profile({t: shop[t] for t in ("orders", "payments", "order_items")}))
    assert "Expand" not in plan and plan.count("Aggregate") == 2


def naive_coverage(child, parent):
    known = {x for x in parent if x is not None}
    present = [x for x in child if x is not None]
    return len(present), sum(x not in known for x in present)


def test_relations_equal_plain_python(spark):
    rng = random.Random(3)
    values = lambda n, top: [rng.choice([None, *range(top)]) for _ in range(n)]
    customers, orders, lines = values(30, 40), values(50, 45), values(200, 60)
    codes, names = ["a", "b", None, "B", ""], ["a", "", "zz", None, "b", "b"]
    tables = {
        "customers": spark.createDataFrame([(c, str(c)) for c in customers], "customer_id int, name string"),
        "orders": spark.createDataFrame([(o, c, n) for o, c, n in zip(range(50), orders, names * 9)], "order_id bigint, customer_id bigint, code string"),
        "lines": spark.createDataFrame([(o, c) for o, c in zip(lines, values(200, 50))], "order_id int, customer_id int"),
        "codes": spark.createDataFrame([(c,) for c in codes], "code string"),
        "text_keys": spark.createDataFrame([("1",), ("x",), (None,), ("400",)], "customer_id string"),
        "empty": spark.createDataFrame([], "order_id bigint"),
    }
    relations = [
        ("orders", "customer_id", "customers", "customer_id"), ("lines", "customer_id", "customers", "customer_id"),
        ("lines", "order_id", "orders", "order_id"), ("orders", "code", "codes", "code"),
        ("empty", "order_id", "orders", "order_id"), ("lines", "order_id", "empty", "order_id"),
        ("orders", "order_id", "orders", "customer_id"), ("text_keys", "customer_id", "customers", "customer_id"),
    ]
    columns = {t: {c: [r[c] for r in df.collect()] for c in df.columns} for t, df in tables.items()}
    columns["text_keys"]["customer_id"] = [1, "x", None, 400]
    found = tagged.relation_counts(tables, relations).collect()
    got = {(r["child_table"], r["child_key"], r["parent_table"], r["parent_key"]): (r["child_non_null_rows"], r["missing_fk_rows"]) for r in found}
    assert got == {r: naive_coverage(columns[r[0]][r[1]], columns[r[2]][r[3]]) for r in relations}


def test_a_hot_key_is_one_row_before_the_shuffle(spark):
    child = spark.range(20_000, numPartitions=4).selectExpr("if(id % 3 = 0, 7, id) as k")
    found = tagged.relation_counts({"c": child, "p": spark.range(10).toDF("k")}, [("c", "k", "p", "k")]).first()
    missing = sum(1 for i in range(20_000) if i % 3 and i >= 10)
    assert (found["child_non_null_rows"], found["missing_fk_rows"]) == (20_000, missing)


def test_row_counts_and_repeats(spark):
    rows = random_rows(150, 5) + random_rows(30, 5)
    df = spark.createDataFrame(rows, TYPES)
    flat = df.drop("n", "o.p")
    overview = {r["table"]: r for r in quality.audit_overview({"t": flat, "none": flat.limit(0), "ids": spark.range(50).toDF("id")}).collect()}
    seen = {tuple(repr(plain(x)) for x in r[:13]) for r in rows}
    nulls = sum(x is None for r in rows for x in r[:13])
    assert (overview["t"]["rows"], overview["t"]["total_null_values"], overview["t"]["duplicate_rows"]) == (180, nulls, 180 - len(seen))
    assert (overview["none"]["rows"], overview["none"]["null_density_pct"], overview["none"]["duplicate_row_pct"]) == (0, None, None)
    assert (overview["ids"]["rows"], overview["ids"]["duplicate_rows"], overview["ids"]["cols"]) == (50, 0, 1)


@pytest.mark.parametrize("keys", [["a"], ["c", "i"], ["l", "m", "f"], ["j", "k", "o.p", "n"], []])
def test_grain_counts_equal_plain_python(spark, keys):
    rows = random_rows(300, 9)
    df = spark.createDataFrame(rows, TYPES)
    other = spark.createDataFrame([(1, 2.0, None), (1, 2.0, 5), (None, 2.0, 5), (None, 2.0, 6)], "id int, x double, y int")
    wide = spark.range(3).select(*[F.when(F.col("id") >= k % 4, F.lit(1)).alias(f"w{k}") for k in range(130)])
    tables = {"t": df, "o": other, "wide": wide, "none": other.limit(0)}
    grains = {"t": keys, "o": ["id", "x"], "wide": ["w0"], "none": ["id"]}
    found = {r["table"]: r for r in tagged.grain_counts(tables, grains).collect()}
    at = [df.columns.index(k) for k in keys]
    key_of = lambda r: tuple(repr(plain(r[i])) for i in at)
    assert (found["t"]["rows"], found["t"]["distinct_keys"]) == (300, len(set(map(key_of, rows))))
    assert found["t"]["null_key_rows"] == sum(any(r[i] is None for i in at) for r in rows)
    nulls = [(c["column"], c["position"], c["dtype"], c["null_count"]) for c in found["t"]["columns"]]
    assert nulls == [(name, k, dtype, sum(r[k] is None for r in rows)) for k, (name, dtype) in enumerate(df.dtypes)]
    assert tuple(found["o"])[1:4] == (4, 2, 2) and [c["null_count"] for c in found["o"]["columns"]] == [2, 0, 1]
    assert [c["null_count"] for c in found["wide"]["columns"]] == [k % 4 for k in range(130)] and found["wide"]["distinct_keys"] == 1
    assert tuple(found["none"])[1:4] == (0, 0, 0) and [c["null_count"] for c in found["none"]["columns"]] == [0, 0, 0]


def test_each_table_is_read_once_for_its_verdict(shop):
    tables = {t: shop[t] for t in ("orders", "payments", "shipments")}
    quality.audit_conclusion(tables, {t: ["order_id"] for t in tables}, {}).collect()
    plan = quality.table_profiles(tables, {t: ["order_id"] for t in tables})
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in text and text.count("Union") == 1


def test_keys_and_nulls_are_counted_in_one_shuffle(spark):
    rows = spark.createDataFrame([(1, None, 2), (1, 3, None), (None, 3, 4), (2, None, None)], "id int, x int, y int")
    counts = tagged.grain_counts({"t": rows}, {"t": ["id"]})
    found = counts.first()
    assert tuple(found)[1:4] == (4, 3, 1) and [c["null_count"] for c in found["columns"]] == [1, 2, 2]
    # only the groups themselves travel with a key: all later shuffles are by table alone
    counts = tagged.grain_counts({"t": rows}, {"t": ["id"]})
    counts.collect()
    text = counts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    shuffles = [line for line in text.splitlines() if "+- Exchange hashpartitioning" in line and "whole0" in line]
    assert len(shuffles) == 1 and "ReusedExchange" in text, text
