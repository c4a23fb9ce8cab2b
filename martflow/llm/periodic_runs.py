"""Periodic runs of words by enumeration of maximal pairs.

A run is a stretch of words with smallest period q that cannot be extended, of at least ``min_exponent``
periods and ``min_length`` words. Two equal word sequences at places i < j that differ in the words before
and after them are a maximal pair. If their length l and distance p satisfy l + p >= min_exponent * p, the
words from i to j + l are a stretch of period p that no word extends, so such pairs are exactly the runs,
once for each multiple of the smallest period that still satisfies the constraint; the smallest distance
of a stretch is its period.

1. *Stretches.* A run's equal sequences consist of short runs of words (grams) that recur at distance p
   within the run. Words in no gram that recurs near enough are cut off, again and again, until
   nothing changes; what is left falls into stretches, mostly none.
2. *Suffixes* of all stretches are sorted by prefix doubling; the kept ranks give the lengths of common
   prefixes of neighbours (LCP).
3. *LCP-interval tree*, bottom-up. Every interval keeps its places in lists by the word to their left. When a
   child joins an interval, places of the smaller side look for partners of other left words within the
   distance that the length allows; the smaller side's lists then go into the larger one's.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from martflow.llm.common import gram_hashes, mixed, with_computed

MIN_EXPONENT = 4
MIN_LENGTH = 6


def shortest_match(min_exponent: int, min_length: int) -> int:
    """The least length of the equal sequences of a run, over all periods."""
    return min(max((min_exponent - 1) * p, min_length - p, 1) for p in range(1, max(2, min_length + 1)))


def _stretches(codes: np.ndarray, ends: np.ndarray, gram: int, min_exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of words that may hold runs. A stretch lies in one text."""
    starts, stops = np.concatenate([[0], ends[:-1]]), ends
    words = mixed(codes.astype(np.uint64))
    while True:
        long = stops - starts >= max(min_exponent, gram + 1)
        starts, stops = starts[long], stops[long]
        if not len(starts):
            return starts, stops
        sizes = stops - starts
        own = np.repeat(np.arange(len(starts)), sizes)
        place = np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)
        inside = place + gram <= stops[own]
        own, place = own[inside], place[inside]
        grams = gram_hashes(words, gram)[place] ^ mixed(own.astype(np.uint64), 1)
        order = np.lexsort((place, grams))
        sorted_grams, sorted_places = grams[order], place[order]
        near = (sorted_grams[1:] == sorted_grams[:-1]) & (np.diff(sorted_places) <= sizes[own[order[1:]]] // min_exponent)
        recurs = np.zeros(len(order), bool)
        recurs[order[1:][near]] = True
        recurs[order[:-1][near]] = True
        # words covered by recurring grams, and the stretches of neighbouring covered words
        change = np.zeros(len(codes) + 1, np.int32)
        np.add.at(change, place[recurs], 1)
        np.add.at(change, place[recurs] + gram, -1)
        covered = np.cumsum(change[:-1]) > 0
        edge = np.zeros(len(codes) + 1, bool)
        edge[:-1], edge[-1] = covered, False
        first = covered & ~np.concatenate([[False], covered[:-1]])
        first[starts] |= covered[starts]
        new_starts = np.flatnonzero(first)
        last = covered & ~edge[1:]
        last[stops - 1] |= covered[stops - 1]
        new_stops = np.flatnonzero(last) + 1
        if len(new_starts) == len(starts) and (new_starts == starts).all() and (new_stops == stops).all():
            return starts, stops
        starts, stops = new_starts, new_stops


def sorted_suffixes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the common prefix of each with the next. The last symbol must occur once."""
    size = len(symbols)
    ranks = [np.unique(symbols, return_inverse=True)[1]]
    step = 1
    while ranks[-1].max() < size - 1:
        now = ranks[-1].astype(np.int64)
        after = np.zeros(size, np.int64)
        after[:-step] = now[step:] + 1
        ranks.append(np.unique(now * (size + 1) + after, return_inverse=True)[1])
        step *= 2
    order = np.empty(size, np.int64)
    order[ranks[-1]] = np.arange(size)
    one, two = order[:-1], order[1:]
    common = np.zeros(size - 1, np.int64)
    for level in range(len(ranks) - 2, -1, -1):
        rank = ranks[level]
        common += np.where(rank[one + common] == rank[two + common], 1 << level, 0)
    return order, common


class _Intervals:
    """Places of LCP intervals in lists by the symbol to their left; joins give the maximal pairs."""

    def __init__(self, left: list[int], min_exponent: int, min_length: int):
        self.left, self.times, self.least = left, min_exponent - 1, min_length
        self.owner = [-1] * len(left)
        self.lists: dict[int, dict[int, list[int]]] = {}
        self.sizes: dict[int, int] = {}
        self.pairs: list[tuple[int, int, int]] = []

    def leaf(self, place: int) -> int:
        self.owner[place] = place
        self.lists[place] = {self.left[place]: [place]}
        self.sizes[place] = 1
        return place

    def join(self, a: int, b: int, length: int) -> int:
        """Joins two sets whose members have ``length`` symbols in common; gives the joined set's name."""
        small, large = (a, b) if self.sizes[a] <= self.sizes[b] else (b, a)
        low, high = max(1, self.least - length), length // self.times
        own, other = self.lists.pop(small), self.lists[large]
        if low <= high:
            for left, places in own.items():
                if high - low < len(other):
                    self._look_beside(left, places, large, low, high, length)
                else:
                    self._look_in_lists(left, places, other, low, high, length)
        owner = self.owner
        for left, places in own.items():
            for place in places:
                owner[place] = large
            known = other.get(left)
            if known is None:
                other[left] = places
            elif len(places) < 8:
                for place in places:
                    insort(known, place)
            else:
                known += places
                known.sort()
        self.sizes[large] += self.sizes.pop(small)
        return large

    def _look_beside(self, left: int, places: list[int], large: int, low: int, high: int, length: int) -> None:
        owner, lefts, end = self.owner, self.left, len(self.left)
        for place in places:
            for distance in range(low, high + 1):
                before, after = place - distance, place + distance
                if before >= 0 and owner[before] == large and lefts[before] != left:
                    self.pairs.append((before, distance, length))
                if after < end and owner[after] == large and lefts[after] != left:
                    self.pairs.append((place, distance, length))

    def _look_in_lists(self, left: int, places: list[int], other: dict[int, list[int]], low: int, high: int, length: int) -> None:
        for their_left, theirs in other.items():
            if their_left == left:
                continue
            for place in places:
                for before in theirs[bisect_left(theirs, place - high) : bisect_right(theirs, place - low)]:
                    self.pairs.append((before, place - before, length))
                for after in theirs[bisect_left(theirs, place + low) : bisect_right(theirs, place + high)]:
                    self.pairs.append((place, after - place, length))


def _maximal_pairs(symbols: np.ndarray, left: np.ndarray, min_exponent: int, min_length: int) -> list[tuple[int, int, int]]:
    """(place, distance, length) of the maximal pairs that are runs."""
    order, common = sorted_suffixes(symbols)
    shared = common >= shortest_match(min_exponent, min_length)
    intervals = _Intervals(left.tolist(), min_exponent, min_length)
    begins = np.flatnonzero(shared & ~np.concatenate([[False], shared[:-1]]))
    ends = np.flatnonzero(shared & ~np.concatenate([shared[1:], [False]])) + 1
    for begin, end in zip(begins.tolist(), ends.tolist()):
        places, depths = order[begin : end + 1].tolist(), common[begin:end].tolist()
        open_: list[tuple[int, int]] = []  # (depth, children so far) of the intervals around the current place
        current = intervals.leaf(places[0])
        for place, depth in zip(places[1:], depths):
            while open_ and open_[-1][0] >= depth:
                own_depth, children = open_.pop()
                current = intervals.join(children, current, own_depth)
            open_.append((depth, current))
            current = intervals.leaf(place)
        while open_:
            own_depth, children = open_.pop()
            current = intervals.join(children, current, own_depth)
        # nothing else is found under this interval
        del intervals.lists[current], intervals.sizes[current]
    return intervals.pairs


def runs_of(codes: np.ndarray, ends: np.ndarray, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Runs of several texts, given as word numbers in a row and the end of each text.

    Rows (text, start in it, length, period), ordered by text, start and period.
    """
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")
    starts, stops = _stretches(codes, ends, shortest_match(min_exponent, min_length), min_exponent)
    if not len(starts):
        return np.empty((0, 4), np.int64)
    # the stretches in a row, each closed by a symbol of its own
    sizes = stops - starts + 1
    begin = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(begin - starts, sizes)
    closing = begin + sizes - 1
    symbols = codes[np.minimum(place, len(codes) - 1)].astype(np.int64)
    symbols[closing] = codes.max() + 1 + np.arange(len(closing))
    text_starts = np.concatenate([[0], ends[:-1]])
    text_of = np.searchsorted(ends, place, "right")
    left = np.where(place > text_starts[np.minimum(text_of, len(ends) - 1)], codes[place - 1], -1)
    pairs = np.array(_maximal_pairs(symbols, left, min_exponent, min_length), np.int64).reshape(-1, 3)
    if not len(pairs):
        return np.empty((0, 4), np.int64)
    at, period = place[pairs[:, 0]], pairs[:, 1]
    length = pairs[:, 2] + period
    text = np.searchsorted(ends, at, "right")
    order = np.lexsort((period, length, at))
    text, at, length, period = text[order], at[order], length[order], period[order]
    first = np.ones(len(at), bool)
    first[1:] = (at[1:] != at[:-1]) | (length[1:] != length[:-1])
    found = np.stack([text, at - text_starts[text], length, period], axis=1)[first]
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def _scan(min_exponent: int, min_length: int):
    run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def work(texts: list[bytes | None]) -> list[pa.Array]:
        words = [t.split() if t else [] for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        flat = pa.array(list(chain.from_iterable(words)), pa.binary())
        codes = flat.dictionary_encode().indices.to_numpy().astype(np.int64) if len(flat) else np.empty(0, np.int64)
        found = runs_of(codes, ends, min_exponent, min_length) if len(codes) else np.empty((0, 4), np.int64)
        cuts = np.searchsorted(found[:, 0], np.arange(len(texts) + 1))
        kept = []
        for row, own in enumerate(words):
            if texts[row] is None:
                kept.append(None)
                continue
            if cuts[row] < cuts[row + 1]:
                change = np.zeros(len(own) + 1, np.int64)
                for _, start, length, period in found[cuts[row] : cuts[row + 1]].tolist():
                    change[start + period] += 1
                    change[start + length] -= 1
                own = [w for w, gone in zip(own, (np.cumsum(change) > 0).tolist()) if not gone]
            kept.append(b" ".join(own))
        columns = [pa.array(found[:, k]) for k in (1, 2, 3)]
        runs = pa.StructArray.from_arrays(columns, fields=list(run))
        return [
            pa.array(sizes),
            pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), runs),
            pa.array(kept, pa.binary()).cast(pa.string()),
        ]

    return work


def periodic_runs(docs: DataFrame, text: str = "text", min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> DataFrame:
    """Every row of ``docs`` with n_words, runs (start, length, period in words, by start and period) and
    collapsed: the words without all but the first period of each run, joined by single spaces.

    Words are separated by ASCII white space and compared as they are; words are numbered from 0. Null and
    blank texts have no words and no runs; collapsed is null for null. A text is worked on as a whole,
    however long. Rows, ids and their repeats do not matter to each other. Other columns pass through, whatever
    their names; those named like the new ones are replaced.
    """
    ddl = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return with_computed(docs, text, ddl, _scan(min_exponent, min_length))
