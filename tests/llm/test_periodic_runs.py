"""Periodic runs against the definition, and the query's periodic texts against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from martflow.llm import periodic_runs, queries

from . import cases


def naive_runs(words, min_exponent=4, min_length=6):
    """(start, length, smallest period) of every run, from the definition."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(min_length, min_exponent * q):
                found.setdefault((start, length), q)
            i = max(i, start + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def naive_collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def random_words(rng):
    letters = rng.choice([1, 2, 2, 3, 6])
    words = [rng.randrange(letters) for _ in range(rng.randint(0, 40))]
    for _ in range(rng.randint(0, 3)):
        block = [rng.randrange(letters) for _ in range(rng.randint(1, 6))]
        words += (block * 8)[: rng.randint(1, 40)]
    return words


@pytest.mark.parametrize("min_exponent, min_length", [(2, 1), (2, 6), (3, 4), (4, 6), (4, 1), (5, 9)])
def test_runs_equal_the_definition(min_exponent, min_length):
    rng = random.Random(min_exponent * 10 + min_length)
    for _ in range(150):
        texts = [random_words(rng) for _ in range(rng.randint(1, 6))]
        codes, ends = np.array(sum(texts, []), np.int64), np.cumsum([len(t) for t in texts])
        if len(codes):
            found = [tuple(r) for r in periodic_runs.runs_of(codes, ends, min_exponent, min_length).tolist()]
            assert found == [(k, *r) for k, t in enumerate(texts) for r in naive_runs(t, min_exponent, min_length)]


def test_long_periodic_texts_are_no_square():
    fibonacci, before = [0, 1], [0]
    while len(fibonacci) < 200_000:
        before, fibonacci = fibonacci, fibonacci + before
    one, fib = np.zeros(200_000, np.int64), np.array(fibonacci[:200_000])
    assert periodic_runs.runs_of(one, np.array([200_000])).tolist() == [[0, 0, 200_000, 1]]
    assert len(periodic_runs.runs_of(fib, np.array([200_000]), min_exponent=3)) > 1_000


def test_suffixes_in_order():
    rng = np.random.default_rng(2)
    symbols = np.append(rng.integers(0, 2, 200), 9)
    order, common = periodic_runs.sorted_suffixes(symbols)
    suffixes = [symbols[k:].tolist() for k in order]
    assert suffixes == sorted(suffixes)
    for a, b, n in zip(suffixes, suffixes[1:], common.tolist()):
        assert a[:n] == b[:n] and a[n] != b[n]


def expected(text):
    words = (text or "").encode().split()
    runs = naive_runs(words)
    return len(words), runs, None if text is None else naive_collapsed([w.decode() for w in words], runs)


def test_operator_on_awkward_rows(spark):
    spam = "SPAM ham\teggs  \n" * 9 + "x x x x x x y x x x x x"
    rows = [*cases.rows(), (50, spam, "en", "s", 1), (50, spam, "en", "s", 1), (51, "a b " * 4000 + "a", None, None, None)]
    found = periodic_runs.periodic_runs(cases.frame(spark, rows)).collect()
    assert len(found) == len(rows)
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found), key=repr)
    assert got == sorted(((i, *expected(t)) for i, t, *_ in rows), key=repr)


def test_operator_with_clashing_columns_and_empty_tables(spark):
    found = periodic_runs.periodic_runs(cases.clashing(spark)).collect()
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found), key=repr)
    assert got == sorted(((i, *expected(t)) for i, t, *_ in cases.rows()), key=repr)
    assert {r["start"] for r in found} == {"own start"}
    assert periodic_runs.periodic_runs(cases.frame(spark, [])).count() == 0


def test_query_makes_texts_periodic_as_agreed(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, None if i % 37 == 0 else " \n".join(cases.words(rng.randint(0, 60), i).split()), "en", "s", 1) for i in range(300)]
    cases.frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r["doc_id"]: r for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    changed = 0
    for i, text, *_ in rows:
        words, h = (text or "").split(), zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
            changed += 1
        runs = naive_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        row = found[i]
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (None if best[0] is None else 1000 * best[1] // best[2])
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(naive_collapsed(words, runs).encode()).hexdigest()
    assert changed > 10
