"""Substring deduplication by repeated-phrase automata.

A window is ``window`` consecutive words of a document. Words are removed where a window covers them
whose words also stand in a document with a smaller id; the first document keeps its text.

1. *Copies.* Of texts that are equal in full only the one with the smallest id goes through the steps below; the
   others lose all their words if they have a window at all.
2. *Anchors.* Of every window, the five-word run with the smallest hash is its anchor (winnowing): equal
   windows have equal anchors, and about one run in five is one. Each text's anchors are sent, as hashes, to where
   equal ones meet; those of several texts come back to their texts. Very frequent anchors, known from a sample of
   texts to recur, are spread over several places.
3. *Segments.* Around each anchor that recurs, the words of its windows are sent to the anchor's shard.
   An anchor that has very many segments is dealt over several salts of its shard, segment by segment,
   so that the segments of one periodic text are spread too.
4. *Confirming.* A shard finds the smallest id of each window; windows of one document only are left.
5. *Automata.* A shard compiles its confirmed windows into one Aho-Corasick automaton over words (each
   distinct word of the shard is the same few symbols) and streams every segment through it: each occurrence of a
   window in a later document becomes a span of words.
6. The spans of a document meet its text again. Texts are shuffled once for both uses, compressed one by one.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import SLICE_BYTES, WordHashes, as_bytes, gram_hashes, mixed, per_slice, written

WINDOW = 13
ANCHOR = 5
#: Segments that one task of a shard gets, roughly.
SHARD_SEGMENTS = 20_000
#: Texts of which very frequent anchors are learned, roughly, how many of them must have one, and how many anchors are
#: taken at most, the most frequent ones first. This only decides where rows are sent.
SAMPLE_TEXTS, HOT_TEXTS, MAX_HOT = 20_000, 40, 100_000
#: Places over which a hot anchor's texts are spread.
HOT_PLACES = 64
#: The id of rows whose id is null: they come after all others.
_LAST = np.iinfo(np.int64).max


def window_anchors(words: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of the word hashes: the place of its anchor run, and the hash of that run."""
    grams = gram_hashes(words, anchor)
    n = len(words) - window + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # the least of ``reach`` neighbours, from the least of ever more of them
    reach, low, size = window - anchor + 1, grams, 1
    while size < reach:
        step = min(size, reach - size)
        low = np.minimum(low[:-step], low[step:])
        size += step
    low = low[:n]
    back = np.zeros(n, np.int64)
    for j in range(reach - 1, -1, -1):
        np.putmask(back, grams[j : j + n] == low, j)
    return np.arange(n) + back, low.view(np.int64)


_IS_SPACE = np.isin(np.arange(256), [*range(9, 14), 32])


class Words:
    """The words of several texts in a row, as places in their joined bytes; no word is an object of its own."""

    def __init__(self, texts: list[bytes | None]):
        self.data = b"\n".join(t or b"" for t in texts) + b"\n"
        space = _IS_SPACE[np.frombuffer(self.data, np.uint8)]
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        edges = edges if space[0] else np.concatenate([[0], edges])
        self.starts, self.stops = edges[::2], edges[1::2]
        closed = np.cumsum([len(t or b"") + 1 for t in texts], dtype=np.int64)
        #: where each text ends among the words
        self.ends = np.searchsorted(self.starts, closed)

    def __len__(self) -> int:
        return len(self.starts)

    def codes(self) -> tuple[np.ndarray, list[bytes]]:
        """A number for each word, equal for equal words, and the distinct words by number (blanks among them)."""
        if not len(self):
            return np.empty(0, np.int64), []
        # words and what lies between them, in turn
        offsets = np.empty(2 * len(self), np.int64)
        offsets[::2], offsets[1::2] = self.starts, self.stops
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(self.data)]
        coded = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).dictionary_encode()
        return coded.indices.to_numpy()[::2].astype(np.int64), coded.dictionary.to_pylist()

    def hashes(self, known: WordHashes) -> np.ndarray:
        codes, distinct = self.codes()
        return known.of(distinct)[codes] if len(codes) else np.empty(0, np.uint64)

    def between(self, first: int, last: int) -> bytes:
        """The text from word ``first`` to word ``last``, with the white space between them as it is."""
        return self.data[self.starts[first] : self.stops[last]]


def _inside(n: int, ends: np.ndarray, window: int) -> np.ndarray:
    """Of the windows that start at 0 to n - 1 of joined texts, those that end within their text."""
    starts = np.concatenate([[0], ends[:-1]])
    left = np.repeat(ends, ends - starts)[:n] - np.arange(n)
    return left >= window


def _anchor_rows(window: int, anchor: int, hot: np.ndarray | None = None):
    """Rows (anchor, place, th, n) of each text: its anchors, where they are sent, and how many segments each will have.

    ``hot`` are the very frequent anchors, sorted.
    """
    hashes = WordHashes()
    hot = np.empty(0, np.int64) if hot is None else hot

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        th = batch.column("th").to_numpy(zero_copy_only=False)
        # copies within the batch have the same anchors
        batch = batch.take(pa.array(np.unique(th, return_index=True)[1]))
        th = batch.column("th").to_numpy(zero_copy_only=False)
        words = Words(as_bytes(batch.column("text")))
        ends = words.ends
        at, grams = window_anchors(words.hashes(hashes), window, anchor)
        inside = _inside(len(grams), ends, window)
        rows = np.searchsorted(ends, np.flatnonzero(inside), "right")
        at, grams = at[inside], grams[inside]
        # once for each place: neighbouring windows mostly share their anchor, and make one segment
        first = np.ones(len(grams), bool)
        first[1:] = (at[1:] != at[:-1]) | (rows[1:] != rows[:-1])
        rows, grams = rows[first], grams[first]
        order = np.lexsort((grams, rows))
        rows, grams = rows[order], grams[order]
        first = np.ones(len(grams), bool)
        first[1:] = (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])
        begin = np.flatnonzero(first)
        times = np.diff(np.append(begin, len(grams)))
        grams, th = grams[begin], th[rows[begin]]
        place = np.where(np.isin(grams, hot), mixed(th.view(np.uint64)) % np.uint64(HOT_PLACES), np.uint64(0))
        columns = [pa.array(grams), pa.array(place.astype(np.int32)), pa.array(th), pa.array(times.astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=["anchor", "place", "th", "n"])

    return per_slice(work, "text")


_ANCHORS = "anchor bigint, place int, th bigint, n int"


def _hot_anchors(rows: DataFrame, window: int, anchor: int, sample_texts: int) -> dict[int, int]:
    """Anchors that many texts of a sample have, with the estimated number of their segments in all texts."""
    step = max(1, rows.count() // sample_texts)
    sampled = rows.where(F.pmod(F.xxhash64("th"), F.lit(step)) == 0).dropDuplicates(["th"])
    counted = sampled.mapInArrow(_anchor_rows(window, anchor), _ANCHORS).groupBy("anchor").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"))
    hot = counted.where(F.col("c") >= HOT_TEXTS).orderBy(F.desc("c"), "anchor").limit(MAX_HOT)
    return {r["anchor"]: r["n"] * step for r in hot.select("anchor", "n").collect()}


def _recurring_anchors(hot: dict[int, int], shard_segments: int):
    """Of rows (anchor, place, th, n), ordered by anchor and text, those whose anchor several texts have, as rows
    (th, anchor, n, salts). Only the rows of one anchor are held at a time; a hot one counts as recurring unseen."""
    hot_keys = np.array(sorted(hot), np.int64)
    hot_sizes = np.array([hot[k] for k in sorted(hot)], np.int64)

    def chosen(anchors: np.ndarray, th: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        new = np.ones(len(anchors), bool)
        new[1:] = (anchors[1:] != anchors[:-1]) | (th[1:] != th[:-1])
        anchors, th, n = anchors[new], th[new], n[new]
        first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]])) if len(anchors) else np.empty(0, np.int64)
        texts = np.diff(np.append(first, len(anchors)))
        sizes = np.add.reduceat(n, first) if len(first) else np.empty(0, np.int64)
        at = np.searchsorted(hot_keys, anchors[first])
        known = np.zeros(len(first), bool)
        if len(hot_keys):
            at = np.minimum(at, len(hot_keys) - 1)
            known = hot_keys[at] == anchors[first]
            # all places of a hot anchor must agree on its salts, so these go by the estimate
            sizes = np.where(known, hot_sizes[at], sizes)
        keep = np.repeat((texts > 1) | known, texts)
        columns = [th[keep], anchors[keep], n[keep], np.repeat(np.maximum(1, -(-sizes // shard_segments)), texts)[keep]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["th", "anchor", "n", "salts"])

    def run(batches):
        held = [np.empty(0, np.int64)] * 3
        for batch in batches:
            rows = [np.asarray(batch.column(c), np.int64) for c in ("anchor", "th", "n")]
            held = [np.concatenate([h, r]) for h, r in zip(held, rows)]
            if len(held[0]):
                cut = int(np.searchsorted(held[0], held[0][-1]))
                if cut:
                    yield chosen(*(h[:cut] for h in held))
                    held = [h[cut:] for h in held]
        yield chosen(*held)

    return run


def _salts_of(ids: np.ndarray, th: np.ndarray, starts: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """A salt below ``salts`` for each segment, by document, text and place."""
    seen = mixed(mixed(ids.view(np.uint64)) ^ th.view(np.uint64)) + starts.astype(np.uint64)
    return (mixed(seen) % np.maximum(salts, 1).astype(np.uint64)).astype(np.int64)


def _segment_rows(window: int, anchor: int, shards: int):
    """Rows (shard, salt, salts, doc_id, th, start, words) around the recurring anchors of each text."""
    hashes = WordHashes()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(_unpacked(batch.column("packed")))
        ends = words.ends
        place, grams = window_anchors(words.hashes(hashes), window, anchor)
        inside = _inside(len(grams), ends, window)
        row_of = np.searchsorted(ends, np.arange(len(grams)), "right")
        # windows in a row that have the same anchor make one segment
        same = np.zeros(len(grams), bool)
        same[1:] = inside[1:] & inside[:-1] & (place[1:] == place[:-1]) & (row_of[1:] == row_of[:-1])
        firsts = np.flatnonzero(inside & ~same)
        lasts = np.flatnonzero(inside & ~np.append(same[1:], False)[: len(same)])
        column = batch.column("wanted")
        wanted = np.repeat(np.arange(batch.num_rows), np.diff(column.offsets.to_numpy()))
        found = column.flatten()
        keys, salts = _paired(found.field("anchor").to_numpy(), wanted), found.field("salts").to_numpy()
        order = np.argsort(keys)
        keys, salts = keys[order], salts[order]
        own = _paired(grams[firsts], row_of[firsts])
        at = np.minimum(np.searchsorted(keys, own), max(0, len(keys) - 1))
        hit = keys[at] == own if len(keys) else np.zeros(len(own), bool)
        firsts, lasts, k = firsts[hit], lasts[hit], salts[at[hit]]
        rows = row_of[firsts]
        th = batch.column("th").to_numpy(zero_copy_only=False)[rows]
        ids = _ids(batch.column("doc_id"))[rows]
        text = [words.between(s, e + window - 1) for s, e in zip(firsts.tolist(), lasts.tolist())]
        at = pa.array(rows)
        starts = firsts - np.concatenate([[0], ends[:-1]])[rows]
        columns = [pa.array(grams[firsts] % shards), pa.array(_salts_of(ids, th, starts, k)), pa.array(k), batch.column("doc_id").take(at)]
        columns += [pa.array(th), pa.array(starts.astype(np.int32)), pa.array(text, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "salt", "salts", "doc_id", "th", "start", "words"])

    return per_slice(work, "packed", SLICE_BYTES // 3)


def _paired(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """One key of an anchor and a row. Equal keys of different pairs would only add a segment without a match."""
    return mixed(anchors.view(np.uint64) ^ mixed(rows.astype(np.uint64), 1))


_SEGMENT = "shard bigint, salt bigint, salts bigint, doc_id bigint, th bigint, start int, words string"


def _ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.asarray(column.fill_null(_LAST), np.int64)


@lru_cache(maxsize=1)
def _shard_hashes() -> WordHashes:
    """Word hashes that the shards of one worker share."""
    return WordHashes()


def _shard_words(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers and hashes of the words of all segments in a row, and the end of each segment."""
    words = Words(as_bytes(table.column("words").combine_chunks()))
    codes, distinct = words.codes()
    return codes, _shard_hashes().of(distinct)[codes], words.ends


def _shard_windows(words: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows that lie in one segment, where they start, and the segment of each."""
    grams = gram_hashes(words, window).view(np.int64)
    at = np.flatnonzero(_inside(len(grams), ends, window))
    return grams[at], at, np.searchsorted(ends, at, "right")


def _firsts(windows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct windows, and the smallest and the largest id of each."""
    order = np.lexsort((ids, windows))
    windows, ids = windows[order], ids[order]
    starts = np.flatnonzero(np.diff(windows, prepend=~windows[:1]))
    return windows[starts], ids[starts], ids[np.append(starts[1:], len(windows))[: len(starts)] - 1]


def _local_firsts(window: int):
    """Of each window of a salted anchor, in one salt: its smallest and largest id."""

    def firsts(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        table = table.filter(pc.greater(table.column("salts"), 1))
        windows, ids, salts = (np.empty(0, np.int64),) * 3
        if table.num_rows:
            windows, _, rows = _shard_windows(*_shard_words(table)[1:], window)
            ids, salts = _ids(table.column("doc_id"))[rows], table.column("salts").to_numpy()[rows]
        # a window has one anchor, and an anchor one number of salts
        order = np.argsort(windows, kind="stable")
        salts = salts[order][np.flatnonzero(np.diff(windows[order], prepend=~windows[order][:1]))]
        windows, low, high = _firsts(windows, ids)
        return pa.table({"shard": pa.array([shard] * len(windows), pa.int64()), "salts": salts, "win": windows, "low": low, "high": high})

    return firsts


def _as_symbols(codes: np.ndarray) -> tuple[str, int]:
    """Each distinct word as the same number of characters, and that number.

    The automaton looks through the children of a node one by one, so a word is written in digits of
    base 512. Every digit has an alphabet of its own: matches only start where words start.
    """
    width = max(1, -(-int(codes.max(initial=0)).bit_length() // 9))
    digits = np.empty((len(codes), width), np.uint32)
    for d in range(width):
        digits[:, d] = (codes >> (9 * d) & 511) + (256 + 512 * d)
    return digits.tobytes().decode("utf-32-le"), width


def _occurrences(window: int):
    """Spans (doc_id, th, start, end) of words that a confirmed window of an earlier document covers."""

    def spans(segments: pa.Table, confirmed: pa.Table) -> pa.Table:
        rows = starts = stops = np.empty(0, np.int64)
        if segments.num_rows:
            codes, words, ends = _shard_words(segments)
            windows, at, row = _shard_windows(words, ends, window)
            line, width = _as_symbols(codes)
            distinct, places = np.unique(windows, return_index=True)
            # windows of unsalted anchors are all here; the others have been confirmed over all salts
            here = segments.column("salts").to_numpy()[row] == 1
            local, low, high = _firsts(windows[here], _ids(segments.column("doc_id"))[row[here]])
            wins = np.concatenate([local[low < high], confirmed.column("win").to_numpy()])
            firsts = np.concatenate([low[low < high], confirmed.column("low").to_numpy()])
            known, _, which = np.intersect1d(distinct, wins, return_indices=True)
            automaton = ahocorasick.Automaton()
            for place, which_first in zip(at[places[np.searchsorted(distinct, known)]].tolist(), which.tolist()):
                automaton.add_word(line[place * width : (place + window) * width], which_first)
            if len(automaton):
                automaton.make_automaton()
                found = np.fromiter(chain.from_iterable(automaton.iter(line)), np.int64).reshape(-1, 2)
                found[:, 0] //= width
                begin = found[:, 0] - window + 1
                segment = np.searchsorted(ends, begin, "right")
                ids = _ids(segments.column("doc_id"))
                # matches across two segments are none, and first places stay
                ok = (found[:, 0] < ends[segment]) & (firsts[found[:, 1]] < ids[segment])
                begin, segment = begin[ok], segment[ok]
                new = np.ones(len(begin), bool)
                new[1:] = (segment[1:] != segment[:-1]) | (begin[1:] > begin[:-1] + window)
                rows = segment[new]
                base = segments.column("start").to_numpy()[rows] - np.concatenate([[0], ends[:-1]])[rows]
                starts, stops = begin[new] + base, begin[np.append(new[1:], True)[: len(new)]] + window + base
        at = pa.array(rows)
        return pa.table({"doc_id": segments.column("doc_id").take(at), "th": segments.column("th").take(at), "start": pa.array(starts.astype(np.int32)), "end": pa.array(stops.astype(np.int32))})

    return spans


def _packed_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Texts compressed one by one: they travel smaller than in blocks of a shuffle."""
    packer = zstandard.ZstdCompressor(level=1)
    packed = [None if t is None else packer.compress(t) for t in as_bytes(batch.column("text"))]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(packed, pa.binary())], names=["doc_id", "th", "packed"])


def _unpacked(column: pa.Array) -> list[bytes | None]:
    unpacker = zstandard.ZstdDecompressor()
    return [None if p is None else unpacker.decompress(p) for p in column.to_pylist()]


def _without_spans(window: int):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, counts, removed, gone = [], [], [], []
        for text, spans, copy in zip(_unpacked(batch.column("packed")), batch.column("spans").to_pylist(), batch.column("copy").to_pylist()):
            words = kept = text.split() if text else []
            if copy and len(words) >= window:
                spans = [{"start": 0, "end": len(words)}]
            if spans:
                change = np.zeros(len(words) + 1, np.int32)
                for s in spans:
                    change[s["start"]] += 1
                    change[s["end"]] -= 1
                kept = [w for w, c in zip(words, (np.cumsum(change) > 0).tolist()) if not c]
            texts.append(b" ".join(kept) if text is not None else None)
            counts.append(len(words))
            removed.append(len(words) - len(kept))
            gone.append(spans)
        columns = [batch.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(gone, batch.schema.field("spans").type)], names=["doc_id", "text", "n_words", "n_removed", "spans"])

    return work


def dedup_substrings(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    shard_segments: int = SHARD_SEGMENTS,
    sample_texts: int = SAMPLE_TEXTS,
) -> DataFrame:
    """(doc_id, text, n_words, n_removed, spans) for every row: kept words joined by single spaces, and the
    removed spans (start, end in words, may touch or overlap).

    Words are separated by ASCII white space and compared as they are, by 64-bit hashes within a shard; whole texts
    by 128 bits. Ids are integers. Rows with a null id
    come after all others: they lose what any document with an id has, and take nothing from others. Rows
    with the same id take nothing from each other. Null texts stay null, with no words; texts of fewer words
    than a window stay whole. Windows within one document do not count. Other columns are not looked at.
    """
    anchor = min(ANCHOR, window)
    own_id = F.col(doc_id).cast("bigint")
    rows = docs.select(own_id.alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("th"))
    order = F.coalesce("doc_id", F.lit(_LAST))

    # texts that are equal in full: the smallest id stands for all
    hashes = docs.select(own_id.alias("doc_id"), F.xxhash64(F.col(text)).alias("th"), F.xxhash64(F.col(text), F.lit(1)).alias("th2"))
    classes = hashes.groupBy("th", "th2").agg(F.min(order).alias("first"))
    copies = hashes.join(classes, ["th", "th2"]).where(order > F.col("first")).select("doc_id", "th").distinct()
    heads = classes.select("th", F.when(F.col("first") < _LAST, F.col("first")).alias("doc_id"))

    hot = _hot_anchors(rows, window, anchor, sample_texts)
    anchors = rows.mapInArrow(_anchor_rows(window, anchor, np.array(sorted(hot), np.int64)), _ANCHORS)
    met = anchors.repartition("anchor", "place").sortWithinPartitions("anchor", "th")
    recurring = written(met.mapInArrow(_recurring_anchors(hot, shard_segments), "th bigint, anchor bigint, n bigint, salts bigint"), "anchors")
    total, most = recurring.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("salts"), F.lit(1))).first()
    shards = max(1, -(-total // shard_segments))

    wanted = recurring.groupBy("th").agg(F.collect_set(F.struct("anchor", "salts")).alias("wanted")).join(heads, "th")
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["th"] == b["th"])
    texts = rows.mapInArrow(per_slice(_packed_rows, "text"), "doc_id bigint, th bigint, packed binary")
    chosen = texts.join(wanted, same(texts, wanted)).select(texts["doc_id"], texts["packed"], texts["th"], "wanted")
    segments = chosen.mapInArrow(_segment_rows(window, anchor, shards), _SEGMENT)

    if most > 1:
        local = segments.groupBy("shard", "salt").applyInArrow(_local_firsts(window), "shard bigint, salts bigint, win bigint, low bigint, high bigint")
        firsts = local.groupBy("shard", "salts", "win").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high")
        confirmed = firsts.select("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)).alias("salt"), "win", "low")
    else:
        confirmed = docs.sparkSession.createDataFrame([], "shard bigint, salt bigint, win bigint, low bigint")
    found = segments.groupBy("shard", "salt").cogroup(confirmed.groupBy("shard", "salt")).applyInArrow(_occurrences(window), "doc_id bigint, th bigint, start int, end int")
    spans = found.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    marks = spans.withColumn("copy", F.lit(False)).unionByName(copies.withColumn("copy", F.lit(True)), allowMissingColumns=True)
    whole = texts.join(marks, same(texts, marks), "left").select(texts["doc_id"], texts["packed"], "spans", "copy")
    out = "doc_id bigint, text string, n_words bigint, n_removed bigint, spans array<struct<start:int,end:int>>"
    return whole.mapInArrow(per_slice(_without_spans(window), "packed", SLICE_BYTES // 3), out)
