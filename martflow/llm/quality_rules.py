"""Quality rules as a short-circuit cascade of SQL expressions.

Each rule rejects a text by a boolean expression over the raw text. On a sample of bounded size the cascade measures
what every rule costs, counting included, and what share of the sample it rejects, then evaluates the rules in the
order of rejection per cost. A rule, with the counts that only it needs, is only evaluated for texts that all rules
before it let pass: CASE WHEN stops at the first branch that is true. The order changes the work, never which texts
are kept.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import written

#: Expected number of rows of the sample on which rejections are estimated, and costs on a part of it; how often a rule is
#: evaluated on each of the latter in one run, so that its own time stands out; and how many runs there are.
SAMPLE_ROWS, COSTED_ROWS, SAMPLE_COPIES, SAMPLE_RUNS = 1_000, 200, 3, 3
_GAP = "[ \\t-\\r]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for each row, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{_GAP}+"), "")


def repeated_window_words(words: Column, size: int = 3) -> Column:
    """How many words stand in windows of ``size`` words that the text has twice or more.

    Window hashes are sorted together with their places, so that equal ones are neighbours; the work
    grows as n log n with the length of the text.
    """

    def count(w: Column) -> Column:
        hashed = F.transform(
            F.slice(w, F.lit(1), F.size(w) - (size - 1)),
            lambda x, i: F.struct(F.xxhash64(x, *(F.get(w, i + k) for k in range(1, size))).alias("h"), i.alias("at")),
        )

        def places(s: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            twice = F.filter(s, lambda x, k: F.when(k > 0, same(x, k - 1)).otherwise(F.lit(False)) | same(x, k + 1))
            covered = F.flatten(F.transform(twice, lambda x: F.array(*(x["at"] + k for k in range(size)))))
            return F.size(F.array_distinct(covered)).cast("long")

        return F.when(F.size(w) >= size, let(F.sort_array(hashed), places)).otherwise(F.lit(0).cast("long"))

    return let(words, count)


class TextCounts:
    """Counts of a text by name, each an expression of its own over the raw text: n_words, word_chars, n_symbols (of
    ``#*$%&|<>``), n_lines (with a word), n_dup_lines (equal to an earlier one), n_repeat_words."""

    NAMES = ("n_words", "word_chars", "n_repeat_words", "n_symbols", "n_lines", "n_dup_lines")

    def __init__(self, text: Column):
        self.text = F.coalesce(text, F.lit(""))

    def lines(self) -> Column:
        return F.filter(F.split(self.text, "\n"), lambda x: F.rlike(x, F.lit("[^ \\t-\\r]")))

    def __getitem__(self, name: str) -> Column:
        made = {
            "n_words": lambda: F.size(words_of(self.text)),
            "word_chars": lambda: F.length(F.array_join(words_of(self.text), "")),
            "n_repeat_words": lambda: repeated_window_words(words_of(self.text)),
            "n_symbols": lambda: F.length(F.regexp_replace(self.text, "[^#*$%&|<>]+", "")),
            "n_lines": lambda: F.size(self.lines()),
            "n_dup_lines": lambda: let(self.lines(), lambda x: F.size(x) - F.size(F.array_distinct(x))),
        }
        return made[name]().cast("long")


def with_counts(docs: DataFrame, text: str = "text", name: str = "counts") -> DataFrame:
    """Adds a struct of all counts of each text (see TextCounts); words and lines are split once for all of them."""
    def counts(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_window_words(w).alias("n_repeat_words"),
        )

    def lines(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("long").alias("n_lines"),
            (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
        )

    symbols = TextCounts(F.col(text))["n_symbols"]
    parts = docs.withColumns({f"{name}_w": let(words_of(F.col(text)), counts), f"{name}_l": let(TextCounts(F.col(text)).lines(), lines), f"{name}_s": symbols})
    return parts.withColumn(
        name,
        F.struct(*(F.col(f"{name}_w.{c}").alias(c) for c in ("n_words", "word_chars", "n_repeat_words")), F.col(f"{name}_s").alias("n_symbols"), f"{name}_l.n_lines", f"{name}_l.n_dup_lines"),
    ).drop(f"{name}_w", f"{name}_l", f"{name}_s")


@dataclass(frozen=True)
class Rule:
    """``fails`` gets the text and its counts by name (see TextCounts, or a struct of them); null counts as passed."""

    name: str
    fails: Callable[[Column, TextCounts | Column], Column]


def _share(text: Column, kind: str, of: str) -> Column:
    """Characters of one class over those of another (0 if there are none)."""
    count = lambda c: F.length(F.regexp_replace(text, f"[^{c}]+", ""))
    return F.coalesce(F.try_divide(count(kind), count(of)), F.lit(0.0))


#: Thresholds are well away from prose: a rule must hold for a large part of a text.
RULES: tuple[Rule, ...] = (
    Rule("few_words", lambda t, c: c["n_words"] < 50),
    Rule("repeated_windows", lambda t, c: 100 * c["n_repeat_words"] > 50 * c["n_words"]),
    Rule("symbols", lambda t, c: 10 * c["n_symbols"] > c["n_words"]),
    Rule("short_words", lambda t, c: c["word_chars"] < 2 * c["n_words"]),
    Rule("long_words", lambda t, c: c["word_chars"] > 20 * c["n_words"]),
    Rule("repeated_lines", lambda t, c: (c["n_lines"] >= 4) & (2 * c["n_dup_lines"] > c["n_lines"])),
    Rule("capitals", lambda t, c: _share(t, "A-Z", "A-Za-z") > 0.6),
    Rule("exclamations", lambda t, c: F.length(F.regexp_replace(t, "[^!?]+", "")) > 0.5 * c["n_words"]),
    Rule("few_letters", lambda t, c: _share(t, "\\p{L}", "\\S") < 0.6),
    Rule("ellipsis_lines", lambda t, c: (c["n_lines"] >= 4) & (F.regexp_count(t, F.lit("(?m)(\\.\\.\\.|…)[ \\t-\\r]*$")) > 0.5 * c["n_lines"])),
    Rule("bullet_lines", lambda t, c: (c["n_lines"] >= 4) & (F.regexp_count(t, F.lit("(?m)^[ \\t]*[-•*·][ \\t]")) > 0.9 * c["n_lines"])),
    Rule("letter_runs", lambda t, c: F.rlike(t, F.lit("(\\p{L})\\1{15}"))),
)


@dataclass(frozen=True)
class RuleCost:
    """``seconds`` of one evaluation of the costed rows, and the share of the sample that the rule rejects."""

    rule: Rule
    seconds: float
    rejected: float

    def rank(self, unit: float) -> float:
        """Rejection per cost. Costs count as powers of two of ``unit``: finer differences are noise."""
        return self.rejected / 2.0 ** round(math.log2(max(self.seconds, unit) / unit))


def in_order(costs: list[RuleCost]) -> list[RuleCost]:
    """Best rejection per cost first; ties keep the given order. A quarter of the dearest rule is the unit of cost: below it,
    what one run measures is mostly the run itself."""
    unit = max((c.seconds for c in costs), default=0.0) / 4 or 1.0
    return sorted(costs, key=lambda c: -c.rank(unit))


def ordered_rules(docs: DataFrame, text: str, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[RuleCost]:
    """The rules, best rejection per cost first, from a sample of about ``sample_rows`` rows.

    Cost is the time to evaluate one rule on raw texts of the written sample, the least of several runs, less that
    of reading them. An empty table keeps the given order.
    """
    total = docs.count()
    if not total:
        return [RuleCost(r, 0.0, 0.0) for r in rules]
    picked = docs.select(text) if total <= sample_rows else docs.select(text).sample(sample_rows / total, seed=11)
    sample = written(picked.coalesce(1), "rule-sample")
    whole = F.coalesce(F.col(text), F.lit(""))
    tests = {r.name: F.coalesce(r.fails(whole, TextCounts(F.col(text))), F.lit(False)) for r in rules}
    shares = sample.agg(*(F.avg(t.cast("double")).alias(n) for n, t in tests.items())).first()
    copies = written(sample.limit(COSTED_ROWS).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(SAMPLE_COPIES)))), "rule-costs")

    def seconds(test: Column) -> float:
        start = time.perf_counter()
        copies.agg(F.count_if(test)).collect()
        return time.perf_counter() - start

    runs = [{"": seconds(F.col(text).isNotNull()), **{n: seconds(t) for n, t in tests.items()}} for _ in range(SAMPLE_RUNS)]
    least = {n: min(run[n] for run in runs) for n in runs[0]}
    return in_order([RuleCost(r, max(0.0, least[r.name] - least[""]) / SAMPLE_COPIES, shares[r.name] or 0.0) for r in rules])


def quality_cascade(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, counts: str | None = None) -> DataFrame:
    """Adds ``rejected_by`` (a rule's name, null if kept) and ``kept``.

    Counts are made inside the branches, for texts that get there. Who needs them all of all texts names a
    column ``counts``: they are then made first (see with_counts), added, and read by the rules.
    Null and empty texts have no words and fall to the rule on few words. Rows are never merged or
    dropped; other columns pass through. ``rejected_by`` names the first failed rule in the measured
    order, so it may differ from run to run where several rules fail; ``kept`` does not.
    """
    order = ordered_rules(docs, text, rules)
    counted = docs if counts is None else with_counts(docs, text, counts)
    known = TextCounts(F.col(text)) if counts is None else F.col(counts)
    whole = F.coalesce(F.col(text), F.lit(""))
    verdict = F.lit(None).cast("string")
    for found in reversed(order):
        verdict = F.when(found.rule.fails(whole, known), F.lit(found.rule.name)).otherwise(verdict)
    return counted.withColumn("rejected_by", verdict).withColumn("kept", F.col("rejected_by").isNull())
