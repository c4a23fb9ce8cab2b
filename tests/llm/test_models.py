"""Language identification, compression classifier and hidden Markov model."""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from martflow.llm import compression_quality, hmm, language_id
from martflow.llm.common import fold_of, read_table

from . import cases

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def corpus(spark):
    return read_table(spark, SMALL, "documents"), read_table(spark, SMALL, "labels")


# --- language identification


def naive_kneser_ney(gram_counts: Counter, order: int):
    """Interpolated Kneser-Ney probabilities by definition, over tuples of symbols."""
    levels = {order: dict(gram_counts)}
    for n in range(order - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    alphabet = len(levels[1]) + 1

    def p(gram):
        if not gram:
            return 1 / alphabet
        n = len(gram)
        counts = levels[n]
        once, twice = (sum(v == k for v in counts.values()) for k in (1, 2))
        discount = once / (once + 2 * twice) if once and twice else 0.5
        own = {g: v for g, v in counts.items() if g[:-1] == gram[:-1]}
        lower = p(gram[1:])
        if not own:
            return lower
        total = sum(own.values())
        return max(own.get(gram, 0) - discount, 0) / total + discount * len(own) / total * lower

    return p


def test_kneser_ney_equals_its_definition_and_sums_to_one():
    texts = [b"abra cadabra", b"alakazam abra"]
    symbols, ends = language_id.symbols_of(texts)
    grams, times = np.unique(language_id.grams_of(symbols, ends), return_counts=True)
    orders, floor = language_id.kneser_ney({"x": (grams, times)})
    model = language_id.LanguageModel(("x",), orders, floor, 1.0, np.array([np.inf]))
    unpack = lambda g: tuple((int(g) >> (15 * k)) & 0x7FFF for k in range(3, -1, -1))
    naive = naive_kneser_ney(Counter({unpack(g): int(t) for g, t in zip(grams, times)}), 4)
    alphabet = sorted({s for g in grams for s in unpack(g)[-1:]}) + [ord("q")]
    for context in [(0, 0, 0), (0, 97, 98), (97, 98, 114), (113, 113, 113), (0, 122, 98)]:
        packed = np.array([sum(s << (15 * (3 - k)) for k, s in enumerate((*context, c))) for c in alphabet])
        got = np.exp(model.log_probabilities(packed)[:, 0])
        assert got == pytest.approx([naive((*context, c)) for c in alphabet], rel=1e-4)
        assert got.sum() == pytest.approx(1, rel=1e-4)


def test_symbols_are_letters_with_single_spaces():
    symbols, ends = language_id.symbols_of([b"A--b\0c", None, b"", "É1".encode()])
    parts = [symbols[s:e].tolist() for s, e in zip([0, *ends[:-1]], ends)]
    assert parts == [[97, 0, 98, 0, 99, 0], [0], [0], [ord("é"), 0]] or parts[3][0] == ord("é")


def test_held_out_languages(spark, corpus):
    docs, _ = corpus
    model = language_id.fit_languages(docs, fold_of("doc_id", 4) != 2)
    found = language_id.identify(docs, model).where(fold_of("doc_id", 4) == 2)
    share = found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert share > 0.99
    awkward = language_id.identify(cases.clashing(spark), model)
    assert awkward.count() == len(cases.rows())
    for r in awkward.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] != "und") == letters and 0 <= r["score"] <= 1 and r["words"] == "own words"


def test_languages_of_empty_tables(spark):
    model = language_id.fit_languages(cases.frame(spark, []), F.lit(True))
    assert {r["lang_pred"] for r in language_id.identify(cases.frame(spark), model).collect()} == {"und"}
    assert language_id.identify(cases.frame(spark, []), model).count() == 0


def test_other_scripts_are_rejected(spark, corpus):
    model = language_id.fit_languages(corpus[0], F.lit(True))
    text = "съешь ещё этих мягких французских булок да выпей же чаю " * 5
    assert language_id.identify(spark.createDataFrame([(text,)], "text string"), model).first()["rejected"]


def test_counts_of_many_tasks_are_summed_in_levels(spark):
    rng = np.random.default_rng(4)
    values = rng.random((70, 3, 5))
    rows = [(part, block, values[part, block].tobytes()) for part in range(70) for block in range(3)]
    parts = spark.createDataFrame(rows, "part int, block int, counts binary")
    for fan_in, levels in ((4, 4), (256, 3), (70, 1)):
        found = hmm.summed_blocks(parts, fan_in, levels).collect()
        assert sorted(r["block"] for r in found) == [0, 1, 2]
        for r in found:
            np.testing.assert_allclose(np.frombuffer(r["counts"], np.float64), values[:, r["block"]].sum(axis=0))
    one = hmm.summed_blocks(parts, 4, 1).groupBy("block").count().collect()
    assert {r["count"] for r in one} == {18}
    assert hmm.summed_blocks(parts.where("false")).count() == 0


# --- compression classifier


def test_held_out_quality(corpus):
    docs, labels = corpus
    model = compression_quality.fit_quality(docs, labels, fold_of("doc_id", 5) != 0)
    scored = compression_quality.quality_scores(docs, model).join(labels, "doc_id").where(fold_of("doc_id", 5) == 0)
    rows = [(r["score"], r["quality"]) for r in scored.collect()]
    good, bad = [s for s, q in rows if q == 1], [s for s, q in rows if q == 0]
    assert sum(g > b for g, b in itertools.product(good, bad)) > 0.97 * len(good) * len(bad)
    assert sum(s >= 0.3 for s in good) >= 0.97 * len(good)


@pytest.mark.parametrize("kept", [2, 3])
def test_few_labels_are_enough(corpus, kept):
    """A share of the labels, so that each half has a dozen bad texts or so."""
    docs, labels = corpus
    model = compression_quality.fit_quality(docs, labels, (fold_of("doc_id", 5) != 0) & (F.pmod(F.xxhash64("doc_id"), F.lit(4)) < kept))
    scored = compression_quality.quality_scores(docs, model).join(labels, "doc_id").where(fold_of("doc_id", 5) == 0)
    rows = [(r["score"], r["quality"]) for r in scored.collect()]
    good, bad = [s for s, q in rows if q == 1], [s for s, q in rows if q == 0]
    assert sum(g > b for g, b in itertools.product(good, bad)) > 0.9 * len(good) * len(bad)


def test_one_label_of_a_class(spark, corpus):
    docs, _ = corpus
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, 0), (3, 0, 0)], "doc_id bigint, quality int, toxic int")
    model = compression_quality.fit_quality(docs, labels, F.lit(True))
    assert all(0 <= r["score"] <= 1 for r in compression_quality.quality_scores(docs.limit(20), model).collect())


def test_scores_of_awkward_rows(spark, corpus):
    model = compression_quality.fit_quality(*corpus, F.lit(True))
    rows = compression_quality.quality_scores(cases.clashing(spark), model).collect()
    assert len(rows) == len(cases.rows()) and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if not r["text"]}
    assert len(empty) == 1 and all(r["key"] == "own key" for r in rows)


def test_quality_without_labels(spark):
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = compression_quality.fit_quality(cases.frame(spark), labels, F.lit(True))
    assert {r["score"] for r in compression_quality.quality_scores(cases.frame(spark), model).collect()} == {0.5}
    only_good = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = compression_quality.fit_quality(cases.frame(spark), only_good, F.lit(True))
    assert {r["score"] for r in compression_quality.quality_scores(cases.frame(spark, []), model).collect()} == set()


# --- hidden Markov model


def small_parameters(states=2, symbols=4, seed=0):
    rng = np.random.default_rng(seed)
    start, move, emit = rng.uniform(0.1, 1, states), rng.uniform(0.1, 1, (states, states)), rng.uniform(0.1, 1, (symbols, states))
    return hmm.Parameters(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def paths(seq, p):
    """Probability of each path of states, by enumeration."""
    k = len(p.start)
    for path in itertools.product(range(k), repeat=len(seq)):
        value = p.start[path[0]] * p.emit[seq[0], path[0]]
        for t in range(1, len(seq)):
            value *= p.move[path[t - 1], path[t]] * p.emit[seq[t], path[t]]
        yield path, value


SEQUENCES = [np.array(s, np.int32) for s in ([0], [1, 2, 3], [3, 3, 0, 1, 2], [2, 0], [1, 1, 1, 1])]


def test_forward_equals_the_sum_over_paths():
    p = small_parameters()
    want = [math.log(sum(v for _, v in paths(s, p))) for s in SEQUENCES]
    assert hmm.log_likelihoods(SEQUENCES, p) == pytest.approx(want)


def test_expected_counts_equal_the_sum_over_paths():
    p = small_parameters()
    start, move, emit = np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2))
    for seq in SEQUENCES:
        total = sum(v for _, v in paths(seq, p))
        for path, v in paths(seq, p):
            start[path[0]] += v / total
            for t, s in enumerate(path):
                emit[seq[t], s] += v / total
                if t:
                    move[path[t - 1], s] += v / total
    assert hmm.expected_counts(SEQUENCES, p) == pytest.approx(np.concatenate([start, move.ravel(), emit.ravel()]))


def test_a_round_over_partitions_equals_one_over_all(spark):
    p = small_parameters()
    frame = spark.createDataFrame([(bytearray(s.astype(np.uint16).tobytes()),) for s in SEQUENCES * 3], "symbols binary").repartition(4)
    assert hmm._summed_counts(frame, p, False) == pytest.approx(3 * hmm.expected_counts(SEQUENCES, p))


def test_base_scores_equal_brute_force_and_the_model_beats_them(spark, corpus):
    docs = corpus[0].select("doc_id", "text")
    model, counts, encoded = hmm.fit_hmm(docs, fold_of("doc_id", 5) != 1, own_words=500, states=4, sample_rounds=3)
    scored = {r["doc_id"]: r for r in hmm.score_texts(encoded, model, counts).collect()}
    rows = [(r["doc_id"], (r["text"] or "").encode().lower().split() + [None]) for r in docs.collect()]
    train: Counter = Counter()
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    for i, t in rows:
        if not held(i):
            train.update(t)
    total, distinct = sum(train.values()), len(train)
    assert (model.tokens, model.distinct) == (total, distinct)
    for i, t in rows:
        r = scored[i]
        assert (r["n_tokens"], r["n_known"]) == (len(t), sum(train[w] > 0 for w in t))
        assert r["base_score"] == pytest.approx(sum(math.log10((train[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in t))
    unseen = [scored[i] for i, _ in rows if held(i)]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_words_and_their_shapes_share_all_probability(spark):
    """Over all known words, one unknown word of each shape, and the end, next-word chances sum to one."""
    docs = spark.createDataFrame([(1, "a b c d e f gg hh ii"), (2, "a b a b jj kk"), (3, "c d e a")], "doc_id bigint, text string")
    model, counts, encoded = hmm.fit_hmm(docs, F.lit(True), own_words=3, states=2, sample_rounds=2)
    known = sorted(bytes(r["word"]).decode() for r in counts.collect())
    one_word = spark.createDataFrame([(k, w) for k, w in enumerate(known)], "doc_id bigint, text string")
    single = hmm.encoded_texts(one_word, F.lit(False), [w for w, _ in model.own], "doc_id", "text")
    scores = {r["doc_id"]: r["score"] for r in hmm.score_texts(single, model, counts).collect()}
    p = model.parameters
    # P(word, end) for each known word; what is left of each shape goes to its unknown words
    end = hmm._END
    total = sum(10 ** scores[k] for k in scores)
    for shape in range(hmm.SHAPES):
        rest = 0.5 / (model.shape_tokens[shape] + 0.5 * (model.shape_words[shape] + 1))
        total += rest * math.exp(hmm.log_likelihoods([np.array([shape, end], np.int32)], p)[0])
    exactly_one_word = float(sum((p.start * p.emit[s]) @ p.move @ p.emit[end] for s in range(len(p.emit)) if s != end))
    assert total == pytest.approx(exactly_one_word)


def test_awkward_rows_are_scored(spark, corpus):
    docs = cases.clashing(spark)
    model, counts, encoded = hmm.fit_hmm(docs, fold_of("doc_id", 5) != 1, own_words=10, states=2, sample_rounds=1)
    rows = hmm.score_texts(encoded, model, counts).collect()
    assert len(rows) == len(cases.rows())
    by_text: dict = {}
    for r in rows:
        by_text.setdefault(r["th"], set()).add((r["n_tokens"], r["n_known"], round(r["base_score"], 9), round(r["score"], 9)))
    assert all(len(v) == 1 for v in by_text.values())  # copies, repeated rows too, score alike
    model, counts, encoded = hmm.fit_hmm(cases.frame(spark, []), F.lit(True))
    assert hmm.score_texts(encoded, model, counts).count() == 0
    encoded = hmm.encoded_texts(cases.frame(spark), F.lit(False), [], "doc_id", "text")
    assert hmm.score_texts(encoded, model, counts).count() == len(cases.rows())


def test_rounds_cover_all_texts_and_the_sample_stays_bounded(spark, monkeypatch):
    """Copies are drawn apart, long texts are drawn too, and several rounds by default see every text."""
    samples, rounds = [], []
    expected, summed = hmm.expected_counts, hmm._summed_counts
    monkeypatch.setattr(hmm, "SAMPLE_TOKENS", 50)
    monkeypatch.setattr(hmm, "expected_counts", lambda symbols, p: (samples.append([len(x) for x in symbols]), expected(symbols, p))[1])
    monkeypatch.setattr(hmm, "_summed_counts", lambda encoded, p, wide: (rounds.append(encoded.count()), summed(encoded, p, wide))[1])
    rows = [(k, f"a b c d e {k // 400}") for k in range(1600)] + [(1600 + k, "a b c " * 40 + str(k)) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model, _, _ = hmm.fit_hmm(docs, F.lit(True), own_words=10, sample_texts=200)
    assert len(rounds) > 1 and set(rounds) == {2000} and len(model.parameters.start) == 12
    assert all(100 < len(s) < 300 and sum(n == 50 for n in s) > 10 and max(s) == 50 for s in samples[: hmm.SAMPLE_ROUNDS])
    same_rows = spark.createDataFrame([(1, "a b c")] * 900, "doc_id bigint, text string")
    samples.clear()
    hmm.fit_hmm(same_rows, F.lit(True), own_words=10, states=2, sample_texts=50, full_rounds=0)
    assert all(len(s) <= 200 for s in samples)


def test_every_round_is_over_all_texts_unless_a_sample_is_asked_for(spark, monkeypatch):
    """What a fit learns by default is what as many rounds over all texts give, from the drawn parameters on."""
    starts, samples = [], []
    expected, summed = hmm.expected_counts, hmm._summed_counts
    monkeypatch.setattr(hmm, "_summed_counts", lambda encoded, p, wide: (starts.append((p, encoded.count())), summed(encoded, p, wide))[1])
    monkeypatch.setattr(hmm, "expected_counts", lambda symbols, p: (samples.append(len(symbols)), expected(symbols, p))[1])
    docs = spark.createDataFrame([(k, f"a b c d e {k % 7}") for k in range(60)], "doc_id bigint, text string")
    model, _, _ = hmm.fit_hmm(docs, F.lit(True), own_words=10, states=2)
    assert samples == [] and [n for _, n in starts] == [60] * 11
    own = [w for w, _ in model.own]
    symbols = hmm.Symbols(own).of([hmm.tokens_of(f"a b c d e {k % 7}".encode()) for k in range(60)])
    frequency = np.concatenate([model.shape_tokens, [60], [c for _, c in model.own]])
    p, prior = hmm.Parameters.drawn(frequency, 2), (frequency + 0.5) / (frequency + 0.5).sum()
    for _ in range(11):
        p = hmm.Parameters.from_counts(expected(symbols, p), 2, prior)
    for name in ("start", "move", "emit"):
        np.testing.assert_allclose(getattr(model.parameters, name), getattr(p, name), rtol=1e-6)
