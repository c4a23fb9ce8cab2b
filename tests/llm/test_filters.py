"""Decontamination, quality rules and licence scans against plain Python."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from martflow.llm import decontamination, license_rules, licenses, quality_rules

from . import cases

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def naive_hits(text, items, window=13):
    words, hit, found = WORD.findall(lowered(text)), set(), set()
    for item, body in items:
        own = WORD.findall(lowered(body))
        runs = [own[k : k + window] for k in range(max(1, len(own) - window + 1))] if own else []
        for run in runs:
            for at in range(len(words) - len(run) + 1):
                if words[at : at + len(run)] == run:
                    hit.update(range(at, at + len(run)))
                    if item is not None:
                        found.add(str(item))
    return len(words), len(hit), sorted(found)


ITEMS = [(1, cases.BASE), (2, "one"), (3, None), (4, ""), (5, cases.BASE), (None, "line two here"), (10, "dog while, seven WIZARDS!"), (10, "dog while, seven WIZARDS!")]


def test_contamination_equals_brute_force(spark):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = decontamination.contamination(cases.clashing(spark), bench)
    got = cases.tuples(found, "doc_id", "n_words", "n_hit", "items")
    assert got == sorted(((i, *naive_hits(t, ITEMS)) for i, t, *_ in cases.rows()), key=repr)
    assert found.where("lang = 'own lang'").count() == 0 and "cluster" in found.columns


@pytest.mark.parametrize("max_nodes", [1, 60, 300])
def test_items_beyond_one_automaton_equal_brute_force(spark, max_nodes):
    items = ITEMS + [(20 + k, cases.words(20, 300 + k)) for k in range(8)]
    # passages of items of several automata that overlap in one text
    rows = cases.rows() + [(50 + k, cases.words(20, 300 + k) + " " + cases.BASE + " " + cases.words(20, 301 + k), "en", "s", 1) for k in range(7)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert len(decontamination.dealt_items(bench, "item_id", "text", 13, max_nodes)) > 2
    docs = cases.frame(spark, rows).withColumns({"runs": F.lit("own"), "h0": F.lit("own"), "__hits0": F.lit("own")})
    found = decontamination.contamination(docs, bench, max_nodes=max_nodes)
    assert cases.tuples(found, "doc_id", "n_words", "n_hit", "items") == sorted(((i, *naive_hits(t, items)) for i, t, *_ in rows), key=repr)
    whole = decontamination.contamination(docs, bench)
    assert cases.tuples(found, *found.columns) == cases.tuples(whole, *found.columns)
    assert found.where("__hits0 = 'own' and runs = 'own'").count() == len(rows)


def test_spans_point_into_the_original(spark):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    rows = decontamination.contamination(cases.frame(spark), bench).where("n_hit > 0").collect()
    assert rows
    for r in rows:
        assert sum(len(WORD.findall(lowered(r["text"][s["start"] : s["end"]]))) for s in r["spans"]) == r["n_hit"]


def test_contamination_of_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.contamination(cases.frame(spark, []), bench).count() == 0
    assert decontamination.contamination(cases.frame(spark), bench).where("n_hit > 0").count() == 0


def naive_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    covered = {k + j for k, r in enumerate(runs) if runs.count(r) > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


SHORT = [r for r in cases.rows() if len(r[1] or "") < 4000] + [(20, "a b c a b c d a b", None, None, None), (21, "x x x x", None, None, None), (22, "| a | b |\n| a | b |", None, None, None)]


def test_counts_equal_brute_force(spark):
    counted = quality_rules.with_counts(cases.frame(spark, SHORT)).select("doc_id", "counts.*")
    got = cases.tuples(counted, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert got == sorted(((i, *naive_counts(t)) for i, t, *_ in SHORT), key=repr)


def test_cascade_keeps_what_passes_every_rule_in_any_order(spark):
    docs = cases.clashing(spark)
    judged = quality_rules.quality_cascade(docs, counts="own_counts")
    counted = quality_rules.with_counts(docs, name="own_counts")
    whole = F.coalesce("text", F.lit(""))
    fails = [F.coalesce(r.fails(whole, F.col("own_counts")), F.lit(False)) for r in quality_rules.RULES]
    all_pass = counted.select("doc_id", "text", (~F.greatest(*fails)).alias("kept"))
    assert cases.tuples(judged, "doc_id", "text", "kept") == cases.tuples(all_pass, "doc_id", "text", "kept")
    lazy = quality_rules.quality_cascade(docs)
    assert cases.tuples(lazy, "doc_id", "text", "kept") == cases.tuples(all_pass, "doc_id", "text", "kept")
    assert "own_counts" not in lazy.columns and lazy.where("counts = 'own counts'").count() == docs.count()
    assert judged.where("doc_id = 12 and kept").count() == 1 and judged.where("doc_id = 16 and kept").count() == 0
    assert judged.where("kept = (rejected_by is null)").count() == docs.count()


def test_rules_are_ordered_by_rejection_per_cost():
    rules = quality_rules.RULES
    cheap, dear, never = quality_rules.RuleCost(rules[0], 0.1, 0.2), quality_rules.RuleCost(rules[1], 1.0, 0.4), quality_rules.RuleCost(rules[2], 0.1, 0.0)
    assert quality_rules.in_order([never, dear, cheap]) == [cheap, dear, never]
    # small differences of time are no differences, and ties keep their order
    a, b = quality_rules.RuleCost(rules[0], 0.50, 0.1), quality_rules.RuleCost(rules[1], 0.45, 0.1)
    assert quality_rules.in_order([a, b, dear]) == [dear, a, b] and quality_rules.in_order([b, a, dear]) == [dear, b, a]
    assert quality_rules.in_order([]) == []


def test_counts_cost_the_rules_that_need_them(spark):
    """The rule on repeated windows has to sort all windows of a text: it must come out dearer than a plain count."""
    docs = cases.frame(spark, [(k, cases.words(400, k), "en", "s", 1) for k in range(300)])
    costs = {c.rule.name: c.seconds for c in quality_rules.ordered_rules(docs, "text")}
    assert costs["repeated_windows"] > 3 * costs["few_words"]


@pytest.mark.parametrize("name", quality_rules.TextCounts.NAMES)
def test_counts_by_name_equal_the_struct(spark, name):
    docs = cases.frame(spark)
    both = quality_rules.with_counts(docs).select(F.col(f"counts.{name}").alias("a"), quality_rules.TextCounts(F.col("text"))[name].alias("b"))
    assert both.where("a <=> b").count() == docs.count()


def test_cascade_of_an_empty_table(spark):
    assert quality_rules.quality_cascade(cases.frame(spark, [])).count() == 0


def naive_places(text):
    words = WORD.findall(lowered(text))
    return len(words), sorted((at, label) for phrase, label in licenses.BASE_PHRASES.items() for at in range(len(words)) if words[at : at + len(phrase.split())] == phrase.split())


def test_phrases_equal_brute_force(spark):
    extra = [(30, "cc by nc cc by nc", None, None, None), (31, "xcc by nc", None, None, None), (32, "Apache\nLicense ** version 2.0", None, None, None), (33, "the mit license", None, None, None)]
    found = licenses.license_scan(cases.frame(spark, cases.rows() + extra))
    got = sorted(((r["doc_id"], r["n_words"], sorted((b["word"], b["label"]) for b in r["base"])) for r in found.collect()), key=repr)
    assert got == sorted(((i, *naive_places(t)) for i, t, *_ in cases.rows() + extra), key=repr)


def test_phrases_between_underscores_equal_brute_force(spark):
    joined = [f"{a}{gap.join(phrase.split())}{b}" for phrase in licenses.BASE_PHRASES for gap in (" ", "_") for a in ("", "_", "x_", "x", "9", "é") for b in ("", "_", "_4.0_", "x")]
    rows = [(k, t, None, None, None) for k, t in enumerate([*joined, "photo by Ann, _CC BY-NC 4.0_", "img_cc_by_nc.png"])]
    found = licenses.license_scan(cases.frame(spark, rows)).collect()
    got = sorted((r["doc_id"], r["n_words"], sorted((b["word"], b["label"]) for b in r["base"])) for r in found)
    assert got == sorted((i, *naive_places(t)) for i, t, *_ in rows)
    labels = {r["text"]: {d["label"] for d in r["licenses"]} for r in found}
    assert "cc-by-nc" in labels["photo by Ann, _CC BY-NC 4.0_"] and "mit" in labels["x_under the mit license_"]


@pytest.mark.parametrize(
    "text, labels",
    [
        ("SPDX-License-Identifier: MIT", ["mit"]),
        ("licensed under the GNU General Public License, version 3 or later", ["gpl-3-plus"]),
        ("GNU Lesser General Public License version 2.1", ["lgpl-2.1"]),
        ("Creative Commons Attribution-ShareAlike 4.0", ["cc-by-sa-4"]),
        ("Licensed under the Apache License, Version 2.0; all rights reserved", ["apache-2", "all-rights-reserved"]),
        ("nothing to see here", []),
        (None, []),
    ],
)
def test_signatures_and_suppression(spark, text, labels):
    found = licenses.license_scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert [d["label"] for d in found["licenses"]] == labels
    assert (found["license_score"] > 0) == bool(labels)
    for d in found["licenses"]:
        assert 0 <= d["start"] < d["end"] <= len(text)


def naive_resolved(found):
    """Matches (start, end, label, priority) taken in order of priority, from the definition."""
    taken = []
    for s, e, label, priority in sorted(set(found), key=lambda d: (d[3], d[0] - d[1], d[0], d[2])):
        contained = any(a <= s and b >= e for a, b, *_ in taken)
        if not contained and not any(a < e and b > s and p < priority for a, b, _, p in taken):
            taken.append((s, e, label, priority))
    return sorted(taken)


def test_overlaps_are_resolved_in_order_of_priority(spark):
    rng = random.Random(6)
    chain = [(0, 10, "c", 3), (8, 20, "b", 2), (18, 30, "a", 1)]
    sets = [chain, chain * 2, [], [(0, 5, "a", 1), (0, 5, "b", 1)], [(0, 9, "x", 2), (2, 4, "y", 2), (2, 4, "z", 1)]]
    for _ in range(200):
        spans = [(s, s + rng.randint(1, 12)) for s in (rng.randint(0, 30) for _ in range(rng.randint(0, 9)))]
        sets.append([(s, e, rng.choice("abcd"), rng.randint(1, 4)) for s, e in spans])
    rows = [(k, [(label, p, s, e) for s, e, label, p in found]) for k, found in enumerate(sets)]
    frame = spark.createDataFrame(rows, "k int, found array<struct<label:string,priority:int,start:int,end:int>>")
    got = {r["k"]: [(d["start"], d["end"], d["label"], d["priority"]) for d in r["left"]] for r in frame.select("k", licenses.resolved(F.col("found")).alias("left")).collect()}
    assert got == {k: naive_resolved(found) for k, found in enumerate(sets)}
    assert got[0] == [(0, 10, "c", 3), (18, 30, "a", 1)]


def test_every_signature_passes_the_prefilter():
    """The wording that a pattern asks for holds one of the prefilter's strings."""
    for rule in license_rules.signatures():
        wording = rule.pattern.replace(license_rules._gap("_"), " ").replace("[sc]", "s").replace("\\.", ".").replace("[eé]", "é")
        assert any(s in wording for s in licenses._ANY) or re.search(licenses._SHORT, wording), rule


def test_there_are_hundreds_of_signatures_and_all_compile(spark):
    rules = license_rules.signatures()
    assert len(rules) > 250
    pattern = F.array(*(F.lit(r.pattern) for r in rules))
    assert spark.range(1).select(F.size(F.filter(pattern, lambda p: F.rlike(F.lit("plain text"), p))).alias("n")).first()["n"] == 0


def test_license_scan_passes_columns_through_and_takes_no_rows(spark):
    assert licenses.license_scan(cases.clashing(spark)).where("cluster = 'own cluster'").count() == len(cases.rows())
    assert licenses.license_scan(cases.frame(spark, [])).count() == 0
