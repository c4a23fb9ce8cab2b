"""Licence scans: ordered regex signatures behind a keyword prefilter, as SQL expressions only.

A text is first searched for any word that licences are named by; most texts end there. For the rest,
only signatures whose keyword stands in the text are tried. Their matches are intervals and are taken in order of
priority, longer ones first: a match is suppressed by one already taken that contains it, or that overlaps it
and has a better priority. What has itself been suppressed suppresses nothing. The matches taken are
the result, in order of place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.license_rules import Signature, signatures
from martflow.llm.quality_rules import let

#: Phrases of words and the labels they stand for (fixed values).
BASE_PHRASES: dict[str, str] = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
_NOT_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Any signature's keyword or base phrase needs one of these in the lower-cased text: plain strings first.
_ANY = (
    "licens", "licenc", "copyright", "creative", "©", "gpl", "bsd", "wtfpl", "cddl", "public", "rights", "derechos", "droits", "rechte",
    "proprietary", "prohibited", "granted", "redistribution", "advertising", "neither", "permission", "unicode", "zlib", "rail",
    "boost.org", "mozilla.org", "apache", "cecill", "mulan",
)
#: Short names, looked for as words only. An underscore ends a word, unlike at ``\b``.
_SHORT = r"(?<![a-z0-9])(?:cc|mit(?![a-z0-9]))|as.is"
#: How sure a match of each priority is.
_SURE = {1: 1.0, 2: 0.95, 3: 0.8, 4: 0.4}


def lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else changed."""
    return F.translate(text, _UPPER, _LOWER)


def is_likely(low: Column) -> Column:
    """Whether a lower-cased text may hold a licence. Plain strings are found much faster than alternatives of a regex."""
    strings = reduce(lambda a, b: a | b, (F.contains(low, F.lit(s)) for s in _ANY))
    return strings | F.rlike(low, F.lit(_SHORT))


def detections(low: Column, rules: list[Signature]) -> Column:
    """All matches of the signatures in a lower-cased text: label, priority, start, end (characters)."""
    table = F.array(*(F.struct(F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"), F.lit(r.keyword).alias("keyword"), F.lit(r.pattern).alias("pattern")) for r in rules))
    # keywords are written with single spaces; a text's gaps may be others
    flat = F.regexp_replace(low, r"[\s*#/;,\-]+", " ")

    def matches(rule: Column) -> Column:
        found = F.regexp_extract_all(low, rule["pattern"], F.lit(0))
        between = F.split(low, rule["pattern"])
        sizes = lambda m: F.transform(m, lambda x, k: F.struct(F.length(F.get(between, k)).alias("gap"), F.length(x).alias("own")))

        def placed(s: Column) -> Column:
            start = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<struct<start:int,end:int>>)").alias("out"))
            step = lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + x["own"]).alias("at"),
                F.concat(acc["out"], F.array(F.struct((acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["own"]).alias("end")))).alias("out"),
            )
            return F.aggregate(s, start, step, lambda acc: acc["out"])

        spans = let(sizes(found), placed)
        return F.transform(spans, lambda x: F.struct(rule["label"].alias("label"), rule["priority"].alias("priority"), x["start"].alias("start"), x["end"].alias("end")))

    tried = let(flat, lambda f: F.filter(table, lambda r: F.contains(f, F.regexp_replace(r["keyword"], r"[\s*#/;,\-]+", " "))))
    return F.flatten(F.transform(tried, matches))


def resolved(found: Column) -> Column:
    """The matches that are taken (see above), by place and label."""
    ranked = F.sort_array(
        F.transform(
            F.array_distinct(found),
            lambda d: F.struct(d["priority"].alias("priority"), (d["start"] - d["end"]).alias("size"), d["start"].alias("start"), d["label"].alias("label"), d["end"].alias("end")),
        )
    )

    def suppressed(d: Column, taken: Column) -> Column:
        # those taken before are at least as good, and as long if no better
        contains = lambda o: (o["start"] <= d["start"]) & (o["end"] >= d["end"])
        overlaps = lambda o: (o["start"] < d["end"]) & (o["end"] > d["start"])
        return F.exists(taken, lambda o: contains(o) | (overlaps(o) & (o["priority"] < d["priority"])))

    def take(taken: Column, d: Column) -> Column:
        match = F.struct(d["start"].alias("start"), d["end"].alias("end"), d["label"].alias("label"), d["priority"].alias("priority"))
        return F.when(suppressed(d, taken), taken).otherwise(F.concat(taken, F.array(match)))

    none = F.expr("CAST(array() AS array<struct<start:int,end:int,label:string,priority:int>>)")
    return F.sort_array(F.aggregate(ranked, none, take))


def phrase_places(norm: Column, phrases: dict[str, str]) -> Column:
    """Places of word phrases in a text of single-spaced words with a space at both ends."""

    def of(phrase: str, label: str) -> Column:
        # the closing space is only looked at, so that it can open the next match
        parts = F.split(norm, f" {phrase}(?= )")
        count = F.size(parts) - 1
        words_before = lambda s: F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))
        n = len(phrase.split())

        def placed(p: Column) -> Column:
            ends = F.aggregate(
                F.slice(p, F.lit(1), F.size(p) - 1),
                F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<int>)").alias("out")),
                lambda acc, x: F.struct((acc["at"] + words_before(x) + n).alias("at"), F.concat(acc["out"], F.array(acc["at"] + words_before(x))).alias("out")),
                lambda acc: acc["out"],
            )
            return F.transform(ends, lambda at: F.struct(at.alias("word"), F.lit(label).alias("label")))

        return F.when(count > 0, let(parts, placed)).otherwise(F.expr("CAST(array() AS array<struct<word:int,label:string>>)"))

    return F.concat(*(of(p, label) for p, label in phrases.items()))


def license_scan(docs: DataFrame, text: str = "text", rules: list[Signature] | None = None) -> DataFrame:
    """Adds to every row: n_words, base (word, label of each phrase place), licenses (start, end, label,
    priority of each match left), license_score (how sure the best match is, 0 without one).

    Null and empty texts have no words and no matches. A base phrase always counts, whatever the
    signatures find there. Rows are never merged or dropped; other columns pass through.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    norm = lambda low: F.concat(F.lit(" "), F.trim(F.regexp_replace(low, _NOT_WORDS, " ")), F.lit(" "))
    none_base = F.expr("CAST(array() AS array<struct<word:int,label:string>>)")
    none_found = F.expr("CAST(array() AS array<struct<start:int,end:int,label:string,priority:int>>)")
    chosen = signatures() if rules is None else rules

    # one lower-cased copy of the text and one branch for both results, so that the prefilter runs once for each text
    def scan(low: Column) -> Column:
        base = let(norm(low), lambda n: phrase_places(n, BASE_PHRASES))
        found = F.when(is_likely(low), F.struct(base.alias("base"), resolved(detections(low, chosen)).alias("licenses")))
        words = F.size(F.array_remove(F.split(low, _NOT_WORDS), "")).cast("long")
        return F.struct(words.alias("n_words"), found.otherwise(F.struct(none_base.alias("base"), none_found.alias("licenses"))).alias("found"))

    holder = next(n for n in (f"__found{k}" for k in range(len(docs.columns) + 1)) if n not in docs.columns)
    parts = {"n_words": f"{holder}.n_words", "base": f"{holder}.found.base", "licenses": f"{holder}.found.licenses"}
    scanned = docs.withColumn(holder, let(lowered(whole), scan)).withColumns({n: F.col(c) for n, c in parts.items()}).drop(holder)
    sure = F.array_max(F.transform("licenses", lambda d: F.coalesce(*(F.when(d["priority"] == p, F.lit(s)) for p, s in _SURE.items()), F.lit(0.0))))
    return scanned.withColumn("license_score", F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(sure, F.lit(0.0))))
