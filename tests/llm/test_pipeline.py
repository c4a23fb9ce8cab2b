"""Registered queries against their SQL, the pipeline against plain Python, and what both promise."""

from __future__ import annotations

import hashlib

import duckdb
import pytest

import corpus_pipeline
from martflow.llm import decontamination, queries

from .test_dedup import naive_components, naive_lines
from .test_filters import naive_hits

TINY, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", sorted(n for n, sql in queries.ORACLES.items() if sql))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = con.execute(queries.ORACLES[name])
    names = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(names)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_every_operator_has_a_query():
    assert sorted({int(n[2:].split("_")[0]) for n in queries.QUERIES}) == list(range(1, 14))


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that each stage got and returned."""
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, TINY).cache()
        out.append((name, docs.collect(), found.collect(), found.columns))
        docs = found
    return out


def plain(rows):
    return [tuple(r) for r in rows]


def test_stages_but_the_last_keep_the_columns(stages):
    assert [s[0] for s in stages] == ["quality_classifier", "line_dedup", "ngram_join", "decontamination", "bpe"]
    assert all(columns == DOCUMENT for *_, columns in stages[:-1])


def test_classifier_stage_only_takes_rows_away(stages):
    _, before, after, _ = stages[0]
    assert set(plain(after)) < set(plain(before)) and len(after) > 0.8 * len(before)


def test_line_stage_equals_brute_force(stages):
    _, before, after, _ = stages[1]
    want = [(i, t) for i, t, n, gone in naive_lines(plain(before), 2) if not (gone and t == "")]
    assert sorted((r["doc_id"], r["text"]) for r in after) == sorted(want)
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_join_stage_equals_brute_force(stages):
    _, before, after, _ = stages[2]
    found, _, _ = naive_components(plain(before), 5, 80)
    assert sorted(r["doc_id"] for r in after) == sorted(i for i, n, low in found if low == i)
    assert set(plain(after)) <= set(plain(before))


def test_decontamination_stage_equals_brute_force(spark, stages):
    _, before, after, _ = stages[3]
    items = [tuple(r) for r in spark.read.parquet(f"{TINY}/benchmark.parquet").collect()]
    want = []
    for r in before:
        scanner = decontamination.Scanner([(str(i), t) for i, t in items], 13)
        n, hit, _, _ = scanner.scan(r["text"].encode())
        if hit:
            assert (n, hit) == naive_hits(r["text"], items)[:2]
        if not (hit and 20 * hit >= n):
            want.append(tuple(r))
    assert sorted(plain(after)) == sorted(want)


def test_last_stage_decodes_to_what_it_got(stages):
    _, before, after, _ = stages[4]
    want = {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in before}
    assert {r["doc_id"]: r["decoded_sha256"] for r in after} == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in after)
