from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from martflow.functions.ordering import ensure_checkpoint_dir, exact_quantiles, materialize, running_totals
from martflow.operators.marts import sku_pareto


@pytest.fixture
def tied(many_chunks):
    """2,000 rows of which a third share the value 0 and a third the value 5."""
    rng = np.random.default_rng(7)
    value = np.concatenate([np.zeros(700), np.full(700, 5.0), rng.integers(1, 400, 600) / 4.0])
    frame = pd.DataFrame({"product_id": rng.permutation(2000), "revenue": value})
    return many_chunks.createDataFrame(frame).repartition(5), frame


def test_running_totals_match_pandas(tied):
    df, frame = tied
    got = running_totals(
        df, [F.col("revenue").desc(), F.col("product_id").asc()], {"so_far": F.col("revenue")}, rank="place"
    ).toPandas().sort_values("place")
    want = frame.sort_values(["revenue", "product_id"], ascending=[False, True])
    assert got["product_id"].tolist() == want["product_id"].tolist()
    assert got["place"].tolist() == list(range(1, 2001))
    np.testing.assert_allclose(got["so_far"], want["revenue"].cumsum())
    assert set(got["so_far_total"]) == {frame["revenue"].sum()}
    assert list(got.columns) == ["product_id", "revenue", "place", "so_far", "so_far_total"]


def test_running_totals_really_cut_the_tied_rows(tied):
    df, _ = tied
    chunks = (
        df.repartitionByRange(F.col("revenue").desc(), F.col("product_id").asc())
        .groupBy(F.spark_partition_id()).count().collect()
    )
    assert len(chunks) > 4 and max(r["count"] for r in chunks) < 700


def test_exact_quantiles_match_numpy(tied):
    df, frame = tied
    with_gap = df.withColumn("other", F.when(F.col("revenue") != 5.0, F.col("revenue") * 3))
    base = materialize(with_gap)
    wanted = {"q25": ("revenue", 0.25), "q70": ("revenue", 0.7), "q995": ("revenue", 0.995), "o50": ("other", 0.5), "o0": ("other", 0.0), "o1": ("other", 1.0)}
    cuts = exact_quantiles(base, wanted)
    row = base.limit(1).select(*[c.alias(n) for n, c in cuts.items()]).first()
    other = frame["revenue"][frame["revenue"] != 5.0] * 3
    for name, (column, p) in wanted.items():
        series = frame["revenue"] if column == "revenue" else other
        assert row[name] == pytest.approx(np.quantile(series, p)), name


def test_quantile_of_no_values_is_null(many_chunks):
    df = materialize(many_chunks.createDataFrame([(None,), (None,)], "v double"))
    assert df.select(exact_quantiles(df, {"q": ("v", 0.5)})["q"]).first()[0] is None


def test_quantile_of_one_row_is_its_value(many_chunks):
    df = materialize(many_chunks.createDataFrame([(4.5,), (None,)], "v double"))
    cuts = exact_quantiles(df, {"low": ("v", 0.0), "mid": ("v", 0.5), "high": ("v", 1.0)})
    assert tuple(df.select(*(cuts[n].alias(n) for n in cuts)).first()) == (4.5, 4.5, 4.5)


def test_checkpoint_folder_comes_from_the_session(spark):
    ensure_checkpoint_dir(spark)
    used = spark.sparkContext.getCheckpointDir()
    set_by_cluster = spark.conf.get("spark.checkpoint.dir", None)
    assert used is not None
    if set_by_cluster:
        assert set_by_cluster.removeprefix("file:") in used


def test_abc_boundaries_are_closed_above(many_chunks):
    df = many_chunks.createDataFrame([(1, 80.0), (2, 15.0), (3, 5.0), (4, 0.0)], "product_id bigint, revenue double")
    rows = {r["product_id"]: r for r in sku_pareto(df).collect()}
    assert [rows[i]["abc_class"] for i in (1, 2, 3, 4)] == ["A", "B", "C", "C"]
    assert [rows[i]["sku_rank"] for i in (1, 2, 3, 4)] == [1, 2, 3, 4]


def test_pareto_without_revenue(many_chunks):
    df = many_chunks.createDataFrame([(1, 0.0), (2, 0.0)], "product_id bigint, revenue double")
    assert {(r["revenue_share"], r["cum_revenue_share"]) for r in sku_pareto(df).collect()} == {(0.0, 0.0)}
