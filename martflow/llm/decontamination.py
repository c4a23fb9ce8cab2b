"""Benchmark decontamination with an Aho-Corasick automaton over the test items' word windows.

Items and documents are normalised the same way: A-Z become lower case, every other ASCII character
that is neither letter nor digit becomes a space. Each distinct word of the items is written as the same few
symbols, all other words of a document as a symbol that no item has. The automaton holds each distinct window of an
item once. A document is scanned once, whatever the number of items; the places of matches are mapped back to
words and to characters of the original text.

The nodes of an automaton are bounded. Items beyond the bound are dealt over several automata; each text is then
scanned with one after another, by tasks of their own, and what they found meets by the text's hash.
"""

from __future__ import annotations

import hashlib
import re
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.llm.common import as_bytes, per_slice, with_computed

WINDOW = 13
#: An automaton is held by every worker, so its nodes have a bound (about 90 bytes each). A window of 13 words takes at most
#: 13 times the symbols of a word.
MAX_NODES = 4_000_000

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-/:-@\[-`{-\x7f]+")


def normal_words(text: bytes) -> list[bytes]:
    """Lower-cased words of a UTF-8 text; all separators are ASCII, so bytes will do."""
    return text.translate(_LETTERS).split()


def item_windows(words: list[bytes], window: int) -> list[bytes]:
    """Each run of ``window`` words; all words of a shorter item; none if there are no words."""
    return [b" ".join(words[k : k + window]) for k in range(max(1, len(words) - window + 1))] if words else []


def _symbols(words: list[bytes]) -> tuple[dict[bytes, str], str]:
    """Each word as the same number of characters, and as many for a word that is none of them.

    The automaton looks through the children of a node one by one, so a word is written in digits of base 512.
    Every digit has an alphabet of its own: matches only start where words start.
    """
    width = max(1, -(-max(0, len(words) - 1).bit_length() // 9))
    digit = lambda code, d: chr((code >> (9 * d) & 511) + 256 + 512 * d)
    return {w: "".join(digit(k, d) for d in range(width)) for k, w in enumerate(words)}, "\x01" * width


class Scanner:
    """The automaton of a set of items, given as (id, text) pairs."""

    _built: dict[str, Scanner] = {}

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        owners: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            for run in item_windows(normal_words((text or "").encode()), window):
                owners.setdefault(tuple(run.split(b" ")), set()).update([item] if item is not None else [])
        self.symbols, self.unknown = _symbols(sorted({w for run in owners for w in run}))
        self.automaton = ahocorasick.Automaton()
        for run, ids in owners.items():
            self.automaton.add_word("".join(map(self.symbols.__getitem__, run)), (len(run), tuple(ids)))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    @classmethod
    def once(cls, key: str, items, window: int) -> Scanner:
        """One automaton for each Python worker; the last one goes before the next one comes."""
        if key not in cls._built:
            cls._built.clear()
            cls._built[key] = cls(items, window)
        return cls._built[key]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        """Runs (start, end) of hit words, and ids of the items met."""
        if not words or self.empty:
            return [], []
        width = len(self.unknown)
        line = "".join([self.symbols.get(w, self.unknown) for w in words])
        found = [((end + 1) // width, count, ids) for end, (count, ids) in self.automaton.iter(line)]
        return merged_runs([(end - count, end) for end, count, _ in found]), sorted({i for *_, ids in found for i in ids})

    def scan(self, text: bytes | None) -> tuple[int, int, list[str], list[tuple[int, int]]]:
        """Number of words, of hit words, ids of the items met, character spans of hit runs."""
        words = normal_words(text or b"")
        runs, ids = self.hits(words)
        return len(words), sum(e - s for s, e in runs), ids, character_spans(text, runs)


def merged_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs (start, end) that touch or overlap made one, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def character_spans(text: bytes | None, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Places of runs of words in the original text."""
    if not runs:
        return []
    places = [m.span() for m in _WORD.finditer((text or b"").decode())]
    return [(places[s][0], places[e - 1][1]) for s, e in runs]


def dealt_items(benchmark: DataFrame, item_id: str, text: str, window: int, max_nodes: int) -> list[list[tuple[str | None, str | None]]]:
    """The distinct items in groups, each of which makes an automaton of at most about ``max_nodes`` nodes.

    One item alone is never cut. The groups come to the driver, from where they are broadcast one by one.
    """
    rows = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).distinct().orderBy("i", "t")
    groups: list[list[tuple[str | None, str | None]]] = [[]]
    nodes = 0
    for r in rows.toLocalIterator():
        n = len(normal_words((r["t"] or "").encode()))
        # two symbols a word suffice for 262,144 distinct words
        cost = 2 * min(n, window) * max(1, n - window + 1)
        if groups[-1] and nodes + cost > max_nodes:
            groups.append([])
            nodes = 0
        groups[-1].append((r["i"], r["t"]))
        nodes += cost
    return groups


_RESULT = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _as_spans(rows: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": s, "end": e} for s, e in spans] for spans in rows], _SPANS)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_nodes: int = MAX_NODES,
) -> DataFrame:
    """Adds to every row of ``docs``: n_words, n_hit, items (sorted ids), spans (start, end in characters).

    A null or empty text has no words and no hits; an item without words matches nothing, one without an
    id marks words but is not listed. Equal windows of several items count for each. No rows are merged. A worker
    holds one automaton of at most about ``max_nodes`` nodes at a time, however many items there are; the items
    themselves pass through the driver.
    """
    spark = docs.sparkSession
    groups = dealt_items(benchmark, item_id, item_text, window, max_nodes)
    shared = [spark.sparkContext.broadcast(items) for items in groups]
    keys = [hashlib.sha256(repr((sorted(map(str, items)), window)).encode()).hexdigest() for items in groups]
    if len(groups) == 1:

        def work(texts: list[bytes | None]) -> list:
            scanner = Scanner.once(keys[0], shared[0].value, window)
            found = [scanner.scan(t) for t in texts]
            return [[f[0] for f in found], [f[1] for f in found], [f[2] for f in found], _as_spans([f[3] for f in found])]

        return with_computed(docs, text, _RESULT, work)

    hashes = [F.xxhash64(F.col(text)), F.xxhash64(F.col(text), F.lit(1))]
    texts = docs.select(F.col(text).alias("t"), *[h.alias(f"h{k}") for k, h in enumerate(hashes)])

    def scan_with(k: int) -> DataFrame:
        def scan(part: list[bytes | None]) -> list:
            scanner = Scanner.once(keys[k], shared[k].value, window)
            found = [scanner.hits(normal_words(t or b"")) for t in part]
            return [_as_spans([f[0] for f in found]), [f[1] for f in found]]

        scanned = with_computed(texts, "t", "runs array<struct<start:int,end:int>>, items array<string>", scan)
        return scanned.where(F.size("runs") > 0).select("h0", "h1", "runs", "items").distinct()

    found = reduce(DataFrame.unionByName, [scan_with(k) for k in range(len(groups))]).groupBy("h0", "h1").agg(
        F.flatten(F.collect_list("runs")).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    free = next(n for n in (f"__hits{k}" for k in range(len(docs.columns) + 1)) if n not in docs.columns)
    hits = found.select(F.struct("runs", "items").alias(free), F.col("h0").alias(f"{free}0"), F.col("h1").alias(f"{free}1"))
    joined = docs.join(hits, (hashes[0] == F.col(f"{free}0")) & (hashes[1] == F.col(f"{free}1")), "left").drop(f"{free}0", f"{free}1")
    schema = T.StructType.fromDDL(_RESULT)
    kept = [c for c in docs.columns if c not in schema.names]

    def finish(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[], [], [], []]
        for value, hit in zip(as_bytes(batch.column(text)), batch.column(free).to_pylist()):
            runs = merged_runs([(r["start"], r["end"]) for r in hit["runs"]]) if hit else []
            row = len(normal_words(value or b"")), sum(e - s for s, e in runs), hit["items"] if hit else [], character_spans(value, runs)
            for column, v in zip(out, row):
                column.append(v)
        arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.string())), _as_spans(out[3])]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *arrays], names=[*kept, *schema.names])

    return joined.mapInArrow(per_slice(finish, text), T.StructType([*(f for f in docs.schema if f.name in kept), *schema]))


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least one word in twenty is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
