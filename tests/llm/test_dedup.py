"""Substring, line and near-duplicate operators against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from martflow.llm import line_dedup, ngram_join, substring_dedup
from martflow.llm.components import components

from . import cases

LAST = 1 << 63


def copies(seed: int, n: int = 60) -> list[tuple]:
    """Documents made of few phrases, so that everything repeats and nearly repeats."""
    rng = random.Random(seed)
    phrases = [cases.words(rng.randint(1, 25), 100 + k) for k in range(12)]
    rows = []
    for i in range(n):
        text = rng.choice(["", "\n", " "]).join(rng.choice(phrases) + rng.choice([" ", "\n", " x "]) for _ in range(rng.randint(0, 6)))
        rows.append((i, text, "en", "s", len(text)))
    return rows


def naive_substrings(rows, window):
    runs = {}
    texts = [(LAST if i is None else i, (t or "").encode().split()) for i, t, *_ in rows]
    for i, w in texts:
        for k in range(len(w) - window + 1):
            run = tuple(w[k : k + window])
            runs[run] = min(runs.get(run, LAST), i)
    out = []
    for (i, t, *_), (order, w) in zip(rows, texts):
        gone = {k + j for k in range(len(w) - window + 1) if runs[tuple(w[k : k + window])] < order for j in range(window)}
        out.append((i, None if t is None else b" ".join(x for k, x in enumerate(w) if k not in gone).decode(), len(w), len(gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window, shard", [(13, 40_000), (13, 3), (5, 2), (3, 7)])
def test_substrings_equal_brute_force(spark, window, shard):
    rows = cases.rows() + [(100 + i, *r) for i, *r in copies(1)]
    found = substring_dedup.dedup_substrings(cases.frame(spark, rows), window=window, shard_segments=shard)
    assert cases.tuples(found, "doc_id", "text", "n_words", "n_removed") == naive_substrings(rows, window)


def test_substrings_with_clashing_columns_and_empty_tables(spark):
    found = substring_dedup.dedup_substrings(cases.clashing(spark))
    assert cases.tuples(found, "doc_id", "text", "n_words", "n_removed") == naive_substrings(cases.rows(), 13)
    assert substring_dedup.dedup_substrings(cases.frame(spark, [])).count() == 0


def packed(texts):
    return pa.array([zstandard.ZstdCompressor().compress(t.encode()) for t in texts])


def test_segments_of_a_periodic_text_and_of_many_texts_are_spread():
    texts = [" ".join(cases.words(20, 7).split() * 30) + f" end{k}" for k in range(100)]
    ids, th = pa.array([*range(99), None], pa.int64()), pa.array(range(100), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, th, pa.array(texts), packed(texts)], names=["doc_id", "th", "text", "packed"])
    anchors = pa.Table.from_batches(substring_dedup._anchor_rows(13, 5)([batch])).to_pylist()
    of_each = [[{"anchor": a["anchor"], "salts": 8} for a in anchors if a["th"] == k] for k in range(100)]
    wanted = pa.array(of_each, pa.list_(pa.struct([("anchor", pa.int64()), ("salts", pa.int64())])))
    segments = pa.Table.from_batches(substring_dedup._segment_rows(13, 5, 1)([batch.append_column("wanted", wanted)])).to_pylist()
    assert sum(a["n"] for a in anchors) == len(segments) > 10 * len(anchors)
    for own in (segments, [s for s in segments if s["start"] == 0], [s for s in segments if s["doc_id"] == 3]):
        sizes = np.bincount([s["salt"] for s in own], minlength=8)
        assert len(sizes) == 8 and sizes.min() > 0 and sizes.max() < 3 * len(own) / 8


def test_copies_stand_aside_and_periodic_texts_are_found(spark):
    text = " ".join(cases.words(20, 7).split() * 30)
    rows = [(k, text if k % 2 else text + " end", "en", "s", 1) for k in range(30)]
    rows += [(None, text, "en", "s", 1), (3, text, "en", "s", 1), (40, cases.words(12, 8), "en", "s", 1), (41, cases.words(12, 8), "en", "s", 1)]
    found = substring_dedup.dedup_substrings(cases.frame(spark, rows), shard_segments=10)
    assert cases.tuples(found, "doc_id", "text", "n_words", "n_removed") == naive_substrings(rows, 13)


def test_hot_anchors_are_spread_and_recur_unseen(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT_TEXTS", 5)
    rows = cases.rows() + [(100 + i, *r) for i, *r in copies(4, 120)]
    frame = cases.frame(spark, rows)
    hashed = frame.select("text", F.xxhash64("text").alias("th"))
    hot = substring_dedup._hot_anchors(hashed, 13, 5, 1000)
    assert len(hot) > 10
    keys = np.array(sorted(hot), np.int64)
    places = hashed.mapInArrow(substring_dedup._anchor_rows(13, 5, keys), substring_dedup._ANCHORS).groupBy("anchor").agg(F.countDistinct("place").alias("p"))
    spread = {r["anchor"]: r["p"] for r in places.collect()}
    assert max(spread[k] for k in hot) > 4 and {p for k, p in spread.items() if k not in hot} == {1}
    for sample in (1000, 20):
        found = substring_dedup.dedup_substrings(frame, shard_segments=7, sample_texts=sample)
        assert cases.tuples(found, "doc_id", "text", "n_words", "n_removed") == naive_substrings(rows, 13)


def test_recurring_anchors_across_batches():
    names = ["anchor", "place", "th", "n"]
    rows = [(1, 0, 5, 1), (2, 0, 5, 2), (2, 0, 6, 1), (2, 0, 6, 1), (2, 0, 9, 4), (3, 0, 1, 1), (3, 0, 1, 1), (7, 3, 1, 1), (8, 0, 1, 1), (8, 0, 2, 1)]
    expected = [(5, 2, 2, 3), (6, 2, 1, 3), (9, 2, 4, 3), (1, 7, 1, 5), (1, 8, 1, 1), (2, 8, 1, 1)]
    for size in (1, 2, 3, 100):
        batches = [pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[k : k + size]]) for k in range(0, len(rows), size)]
        found = pa.Table.from_batches(substring_dedup._recurring_anchors({7: 15}, 3)(batches)).to_pylist()
        assert [tuple(r.values()) for r in found] == expected
    assert pa.Table.from_batches(substring_dedup._recurring_anchors({}, 3)([])).num_rows == 0


def test_every_window_holds_its_anchor():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 50, 500).astype(np.uint64)
    place, grams = substring_dedup.window_anchors(words, 13, 5)
    assert len(place) == 488 and ((place >= np.arange(488)) & (place <= np.arange(488) + 8)).all()
    again, same = substring_dedup.window_anchors(words[100:113], 13, 5)
    assert same[0] == grams[100] and again[0] + 100 == place[100]


def naive_lines(rows, least, long_words=13):
    blanks = " \t\v\f\r"
    solid = [[(k, s) for k, x in enumerate((t or "").split("\n")) if (s := x.strip(blanks))] for _, t, *_ in rows]
    order = [LAST if i is None else i for i, *_ in rows]
    # windows of ``least`` lines, and long lines by themselves; rows alike in id and text are the same place
    def windows(lines):
        found = [(k, tuple(s for _, s in lines[k : k + least])) for k in range(len(lines) - least + 1)]
        return found + [(k, (s,)) for k, (_, s) in enumerate(lines) if least > 1 and len(s.encode().split()) >= long_words]

    places: dict = {}
    for o, (_, t, *_), lines in zip(order, rows, solid):
        for k, window in windows(lines):
            places.setdefault(window, set()).add((o, k, t))
    out = []
    for o, (i, t, *_), lines in zip(order, rows, solid):
        gone = set()
        for k, window in windows(lines):
            if any((p, q) < (o, k) and (p < o or u == t) for p, q, u in places[window]):
                gone.update(lines[k + j][0] for j in range(len(window)))
                # the lines beside it go, too, if they are those beside the first place
                _, q, u = min(places[window], key=lambda x: x[:2])
                source = [x.strip(blanks) for x in u.split("\n") if x.strip(blanks)]
                gone.update(lines[k + d][0] for d in (-1, len(window)) if 0 <= q + d < len(source) and 0 <= k + d < len(lines) and source[q + d] == lines[k + d][1])
        new = t if not gone else "" if len(gone) == len(lines) else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)
        out.append((i, new, len(lines), len(gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least, long_words", [(1, 13), (2, 13), (3, 13), (2, 4), (4, 2)])
def test_lines_equal_brute_force(spark, least, long_words):
    rows = [r for r in cases.rows() if r[0] not in (None, 1)] + [(100 + i, *r) for i, *r in copies(2)]
    found = line_dedup.dedup_lines(cases.frame(spark, rows), min_lines=least, long_words=long_words)
    assert cases.tuples(found, "doc_id", "text", "n_lines", "n_removed") == naive_lines(rows, least, long_words)


def test_one_shared_long_line_between_different_neighbours(spark):
    long, short = cases.words(13, 21), cases.words(12, 22)
    rows = [(k, f"{cases.words(3, 30 + k)}\n{long}\n{cases.words(4, 40 + k)}\n{short}\nend {k}", "en", "s", 1) for k in range(4)]
    rows += [(9, long, "en", "s", 1), (10, short, "en", "s", 1)]
    found = {r["doc_id"]: r for r in line_dedup.dedup_lines(cases.frame(spark, rows)).collect()}
    assert [long in found[k]["text"] for k in (0, 1, 2, 3, 9)] == [True, False, False, False, False]
    assert all(short in found[k]["text"] for k in (0, 1, 2, 3, 10)) and found[9]["text"] == ""
    assert [tuple(x) for x in found[2]["runs"]] == [(1, 2, 0, 1)]


def test_only_window_minima_become_rows():
    text = "\n".join(cases.words(3, k) for k in range(400)).encode()
    for window in (2, 4, 8):
        found = line_dedup.fingerprints(text, window, 13)
        hashes = line_dedup.line_hashes(line_dedup.solid_lines(text))
        # about 2 of window + 1 lines are minima, and every window is named by exactly one of them
        assert 1.5 / (window + 1) < len(found) / 400 < 2.5 / (window + 1)
        named = sorted((start, place) for place, _, own in found for start, *_ in own)
        assert named == [(k, k + int(np.argmin(hashes[k : k + window]))) for k in range(400 - window + 1)]


def test_matches_grow_to_equal_lines_beside_them():
    match = {"at": 5, "size": 2, "src": 1, "src_at": 15, "left": 1, "right": 0}
    assert line_dedup.extended([match]) == [(4, 7, 1, 14)]
    beside = {**match, "at": 7, "src_at": 17, "left": 0, "right": 1}
    other = {**match, "at": 7, "src_at": 30, "left": 0, "right": 0}
    assert line_dedup.extended([beside, match, other]) == [(4, 10, 1, 14), (7, 9, 1, 30)]


def test_line_runs_extend_both_ways(spark):
    rows = [(1, "a\nb\nc\nd\ne", "en", "s", 9), (2, "x\nb\nc\n\nd\ny", "en", "s", 9), (3, "b\nc\nb\nc", "en", "s", 7)]
    found = {r["doc_id"]: r for r in line_dedup.dedup_lines(cases.frame(spark, rows)).collect()}
    assert [tuple(x) for x in found[2]["runs"]] == [(1, 4, 1, 1)] and found[2]["text"] == "x\n\ny"
    assert found[3]["text"] == "" and found[3]["n_removed"] == 4 and found[1]["runs"] == []


def test_lines_keep_rows_and_columns(spark):
    docs = cases.clashing(spark)
    found = line_dedup.dedup_lines(docs)
    assert found.count() == len(cases.rows()) and found.where("key = 'own key' and cluster = 'own cluster'").count() == len(cases.rows())
    alike = [r["text"] for r in found.where("doc_id = 1").collect() if r["text"].startswith(cases.words(60, 1)[:20])]
    assert len(set(alike)) == 1
    assert line_dedup.dedup_lines(cases.frame(spark, [])).count() == 0


def naive_components(rows, size=4, percent=85):
    sets = []
    for _, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    low: dict = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), LAST), i)
    return [(i, len(s), low.get(find(k)) if s else i) for k, ((i, *_), s) in enumerate(zip(rows, sets))], [find(k) for k in range(len(rows))], sets


def near_copies(seed: int) -> list[tuple]:
    """Groups of texts that differ in a few words, so that similarities lie around the threshold."""
    rng = random.Random(seed)
    rows = []
    for g in range(6):
        base = cases.words(rng.choice([3, 8, 40, 120]), 50 + g).split()
        for _ in range(12):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                own[rng.randrange(len(own))] = f"w{rng.randrange(9)}"
            text = " ".join(own)
            rows.append((len(rows), text, "en", "s", len(text)))
    return rows


@pytest.mark.parametrize("block", [512, 5])
def test_components_of_near_copies_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", block)
    rows = cases.rows() + [(100 + i, *r) for i, *r in near_copies(3) + copies(4, 40)]
    want, _, _ = naive_components(rows)
    assert cases.tuples(ngram_join.ngram_components(cases.frame(spark, rows)), "doc_id", "n_shingles", "component_id") == sorted(want, key=repr)


def test_similarity_of_just_the_threshold_links(spark):
    a = [f"a{k}" for k in range(103)]
    rows = [(1, " ".join(a), "en", "s", 1), (2, " ".join(a[:88]), "en", "s", 1), (3, " ".join(a[:87]), "en", "s", 1)]
    want, _, _ = naive_components(rows)
    assert cases.tuples(ngram_join.ngram_components(cases.frame(spark, rows)), "doc_id", "n_shingles", "component_id") == want


def test_one_of_each_component_stays(spark):
    rows = cases.rows() + [(100 + i, *r) for i, *r in near_copies(5)]
    _, roots, sets = naive_components(rows)
    kept = ngram_join.one_of_each(cases.frame(spark, rows)).collect()
    assert len(kept) == len({r for r, s in zip(roots, sets) if s}) + sum(not s for s in sets)
    assert ngram_join.one_of_each(cases.clashing(spark)).columns == cases.clashing(spark).columns
    assert ngram_join.one_of_each(cases.frame(spark, [])).count() == 0


def test_sketches_never_part_what_links():
    rng = random.Random(11)
    for percent in (60, 80, 85, 100):
        for _ in range(300):
            n = rng.randint(1, 400)
            own = rng.sample(range(4000), n)
            other = sorted({*rng.sample(own, rng.randint(n // 2, n)), *rng.sample(range(4000), rng.randint(0, n // 4 + 1))})
            a, b = (ngram_join.mixed(np.array(x, np.uint64)) for x in (own, other))
            sides = [(len(x), 8 * len(ngram_join.sketch(x)), int.from_bytes(ngram_join.sketch(x), "little")) for x in (a, b)]
            shared = len({*own} & {*other})
            if 100 * shared >= percent * (len(own) + len(other) - shared):
                assert ngram_join.may_link(*sides[0], *sides[1], percent) and ngram_join.may_link(*sides[1], *sides[0], percent)
    apart = [(300, 512, int.from_bytes(ngram_join.sketch(ngram_join.mixed(np.arange(k, k + 300, dtype=np.uint64))), "little")) for k in (0, 150)]
    assert not ngram_join.may_link(*apart[0], *apart[1], 85)


def chained(n: int, step: int = 20) -> list[tuple]:
    """Texts that share half of their words with the one before and half with the next; every tenth has a near copy."""
    words = cases.words(step * (n + 1), 900).split()
    texts = [words[k * step : (k + 2) * step] for k in range(n)]
    texts += [[*t[:-1], "other"] for t in texts[::10]]
    return [(k, " ".join(t), "en", "s", 1) for k, t in enumerate(texts)]


@pytest.mark.parametrize("group", [2_048, 2])
def test_chains_of_shared_shingles_dont_meet_in_pairs_of_blocks(spark, monkeypatch, group):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 8)
    monkeypatch.setattr(ngram_join, "GROUP_CLASSES", group)
    met = []
    monkeypatch.setattr(ngram_join, "links_forest", lambda docs, *rest, f=ngram_join.links_forest: met.append(rest[-3]) or f(docs, *rest))
    rows = chained(120)
    want, _, _ = naive_components(rows)
    assert cases.tuples(ngram_join.ngram_components(cases.frame(spark, rows)), "doc_id", "n_shingles", "component_id") == sorted(want, key=repr)
    # before: up to 40 classes a cluster, which took five blocks
    assert max(r["count"] for r in met[0].groupBy("cluster").count().collect()) <= 8


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(30)], [(5, 3), (3, 5), (9, 8), (8, 3), (20, 21), (None, 3)]])
def test_connected_components(spark, edges):
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    root: dict = {}
    for u, v in edges:
        if u is not None and v is not None:
            root.setdefault(u, u), root.setdefault(v, v)
            a, b = root[u], root[v]
            root = {k: min(a, b) if r in (a, b) else r for k, r in root.items()}
    assert found == root
