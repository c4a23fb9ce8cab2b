"""Line deduplication by winnowing over line hashes.

A document is its sequence of non-blank lines, white space at their ends aside. Of every window of
``min_lines`` consecutive lines the one with the smallest hash is selected as its fingerprint (the leftmost of equal
ones), so a run of that length that two places share has a fingerprint in common for certain. A line of
``long_words`` words and more is a window of its own. Only selected lines become rows, each with the windows
that selected it. Their places are joined on the fingerprint and the window around it, each with the first place of
all, by id and line. A match is extended both ways to the lines beside it where they are equal, too, and to the
matches there on the same source; the lines of every run but the first are deleted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.llm.common import as_bytes, gram_hashes, list_array, per_slice, written

MIN_LINES = 2
#: A line of so many words repeats itself by itself.
LONG_WORDS = 13
_LAST = np.iinfo(np.int64).max
_BLANKS = b" \t\v\f\r"


def solid_lines(text: bytes | None) -> list[bytes]:
    """The non-blank lines, stripped of ASCII white space at both ends."""
    return [s for x in (text or b"").split(b"\n") if (s := x.strip(_BLANKS))]


def line_hashes(lines: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, lines), np.uint64, len(lines))


def selected_lines(lines: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of lines: its start, and the place of the line that it selects."""
    n = len(lines) - window + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    low, back = lines[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, window):
        less = lines[j : j + n] < low
        low[less] = lines[j : j + n][less]
        back[less] = j
    return np.arange(n), np.arange(n) + back


def fingerprints(text: bytes | None, window: int, long_words: int) -> list[tuple[int, int, list[tuple[int, int, int, int, int]]]]:
    """(place, hash, windows) of each selected line; a window is (start, lines, hash of all its lines, hash of the line
    before it, hash of the line after it), 0 where there is none."""
    lines = solid_lines(text)
    hashes = line_hashes(lines)
    around = np.concatenate([[np.uint64(0)], hashes, [np.uint64(0)]]).view(np.int64).tolist()
    windows = gram_hashes(hashes, window).view(np.int64).tolist()
    found: dict[int, list[tuple[int, int, int, int, int]]] = {}
    for start, place in zip(*(x.tolist() for x in selected_lines(hashes, window))):
        found.setdefault(place, []).append((start, window, windows[start], around[start], around[start + window + 1]))
    if window > 1:
        for place, line in enumerate(lines):
            if line.count(b" ") + line.count(b"\t") + 1 >= long_words and len(line.split()) >= long_words:
                found.setdefault(place, []).append((place, 1, around[place + 1], around[place], around[place + 2]))
    return [(place, around[place + 1], found[place]) for place in sorted(found)]


_WINDOW = pa.struct([("at", pa.int64()), ("size", pa.int32()), ("win", pa.int64()), ("before", pa.int64()), ("after", pa.int64())])
_SELECTED = "doc_id bigint, th bigint, fp bigint, windows array<struct<at:bigint,size:int,win:bigint,before:bigint,after:bigint>>"


def _selected_rows(window: int, long_words: int):
    """One row for each selected line, with the windows that selected it."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprints(t, window, long_words) for t in as_bytes(batch.column("text"))]
        rows = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
        flat = [x for f in found for x in f]
        windows = [w for _, _, own in flat for w in own]
        columns = [pa.array(c, f.type) for c, f in zip(zip(*windows), _WINDOW)] if windows else [pa.array([], f.type) for f in _WINDOW]
        listed = list_array(pa.StructArray.from_arrays(columns, fields=list(_WINDOW)), [len(own) for _, _, own in flat], _WINDOW)
        hashes = pa.array([h for _, h, _ in flat], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), batch.column("th").take(rows), hashes, listed], names=["doc_id", "th", "fp", "windows"])

    return per_slice(work, "text")


def extended(matches: list[dict]) -> list[tuple[int, int, int, int]]:
    """Matches (at, size, src, src_at, left, right) as maximal runs (start, end, source, source's start).

    ``left`` and ``right`` tell whether the lines beside the match are equal, too.
    """
    grown = [(m["src"], m["at"] - m["src_at"], m["at"] - m["left"], m["at"] + m["size"] + m["right"]) for m in matches]
    runs: list[tuple[int, int, int, int]] = []
    for src, shift, start, end in sorted(grown):
        if runs and runs[-1][2] == src and runs[-1][0] - runs[-1][3] == shift and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]), src, runs[-1][3])
        else:
            runs.append((start, end, src, start - shift))
    return sorted(runs)


def without_lines(text: str, runs: list[tuple[int, int, int, int]]) -> tuple[str, int]:
    """The text without the lines of the runs, and how many those are; empty if only blank lines are left."""
    lines = text.split("\n")
    solid = [k for k, x in enumerate(lines) if x.strip(_BLANKS.decode())]
    gone = {solid[k] for start, end, *_ in runs for k in range(start, end)}
    if len(gone) == len(solid):
        return "", len(gone)
    return "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone)


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES, long_words: int = LONG_WORDS
) -> DataFrame:
    """Every row of ``docs`` with its text deduplicated, and n_lines (non-blank), n_removed, runs.

    A run is (start, end, source, source_start) in non-blank lines. The first place of a run, by id and then
    by line, stays; this holds within one document too. Null ids come last, in no fixed order among
    themselves. Rows alike in id and text are the same place and stay alike. Null texts stay null; of texts
    of fewer lines than ``min_lines`` only lines of ``long_words`` words and more can go. Blank lines stay unless nothing else does: then the text
    is empty. Other columns pass through; columns named like the new ones are replaced.
    """
    free = lambda base: next(n for n in (f"{base}{k}" for k in range(len(docs.columns) + 1)) if n not in docs.columns)
    th, found_name, key_id, key_th = (free(base) for base in ("__hash", "__matches", "__id", "__key"))
    keyed = docs.withColumn(th, F.xxhash64(F.col(text)))
    order = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_LAST))
    rows = keyed.select(order.alias("doc_id"), F.col(th).alias("th"), F.col(text).alias("text"))
    selected = written(rows.mapInArrow(_selected_rows(min_lines, long_words), _SELECTED), "line-fingerprints")
    windows = selected.select("doc_id", "th", "fp", F.inline("windows"))

    place = F.struct("doc_id", "at", "th", "before", "after")
    first = windows.groupBy("fp", "size", "win").agg(F.min(place).alias("src"), F.max(place).alias("last")).where("src <> last").drop("last")
    same_id, same_text = F.col("src.doc_id") == F.col("doc_id"), F.col("src.th") == F.col("th")
    earlier = (F.col("src.doc_id") < F.col("doc_id")) | (same_id & ~same_text) | (same_id & same_text & (F.col("src.at") < F.col("at")))
    matches = windows.join(first, ["fp", "size", "win"]).where(earlier)
    beside = lambda side: ((F.col(side) != 0) & (F.col(side) == F.col(f"src.{side}"))).cast("int")
    match = F.struct("at", "size", F.col("src.doc_id").alias("src"), F.col("src.at").alias("src_at"), beside("before").alias("left"), beside("after").alias("right"))
    found = matches.groupBy(F.col("doc_id").alias(key_id), F.col("th").alias(key_th)).agg(F.collect_set(match).alias(found_name))

    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed", "runs")]
    joined = keyed.join(found, (order == F.col(key_id)) & (F.col(th) == F.col(key_th)), "left").select(*kept, found_name)
    new = T.StructType.fromDDL("n_lines bigint, n_removed bigint, runs array<struct<start:bigint,end:bigint,source:bigint,source_start:bigint>>")
    schema = T.StructType([*(f for f in docs.schema if f.name in kept), *new])

    def delete(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, lines, removed, runs = [], [], [], []
        for value, matched in zip(batch.column(text).to_pylist(), batch.column(found_name).to_pylist()):
            own = extended(matched) if matched else []
            new, gone = without_lines(value, own) if own else (value, 0)
            texts.append(new)
            lines.append(sum(1 for x in (value or "").split("\n") if x.strip(_BLANKS.decode())))
            removed.append(gone)
            runs.append([dict(zip(("start", "end", "source", "source_start"), r)) for r in own])
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "end", "source", "source_start")]))
        columns = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in kept]
        return pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, kind)], names=[*kept, "n_lines", "n_removed", "runs"])

    return joined.mapInArrow(per_slice(delete, text), schema)
