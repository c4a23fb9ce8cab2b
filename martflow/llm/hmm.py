"""Hidden Markov language model over words, trained by Baum-Welch with counts summed over partitions.

A token is a word, A-Z in lower case, or the end of the text. States emit *symbols*: the most frequent
words and the end are symbols of their own, every other word is one of a fixed number of shapes (its last
letters and length, hashed). A word that shares its shape is chosen from it by the corpus counts, with
the same smoothing as the unigram base, so that the model gives any text a probability:

    P(text) = forward(symbols) * product over shaped words of (c + 0.5) / (N_shape + 0.5 (V_shape + 1))

Counts of words cover all training texts; they are summed and joined by Spark, whatever their number.
Every round of Baum-Welch is over all training texts: each partition runs the scaled forward and
backward recursions over all of its training texts and returns its expected counts, which are summed
block by block and give the next parameters. Rounds on a bounded sample may be asked for before these, for another start.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import as_bytes, list_array, per_slice, written

STATES = 12
#: Words with a symbol of their own; the rest share SHAPES symbols. Bounds what every task holds.
OWN_WORDS = 32_768
SHAPES = 256
#: Rounds over all training texts, whatever their length.
FULL_ROUNDS = 11
#: Texts of the bounded sample (of each, SAMPLE_TOKENS tokens at most), and how many rounds on it come before: none, unless
#: a call asks for them.
SAMPLE_TEXTS = 1_500
SAMPLE_TOKENS = 16_384
SAMPLE_ROUNDS = 0
#: Arrays of counts that are summed in one group, and how often sums are summed again: enough for 16 million tasks.
FAN_IN, LEVELS = 256, 3
_SLICE = 12 << 20
_END = SHAPES


def tokens_of(text: bytes | None) -> list[bytes]:
    """Words of a text without its end."""
    return text.lower().split() if text else []


def shape_of(word: bytes) -> int:
    return zlib.crc32(word[-3:] + bytes([min(len(word), 255) // 3])) % SHAPES


class Symbols(dict):
    """Symbol of each word: shapes first, then the end, then own words. Kept shapes are bounded."""

    LIMIT = 300_000

    def __init__(self, own: list[bytes]):
        super().__init__((w, SHAPES + 1 + k) for k, w in enumerate(own))
        self.own = dict(self)
        self.size = SHAPES + 1 + len(own)

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.LIMIT + len(self.own):
            self.clear()
            self.update(self.own)
        found = self[word] = shape_of(word)
        return found

    def of(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """Symbols of each text, closed by the end."""
        sizes = [len(t) for t in texts]
        flat = np.fromiter(map(self.__getitem__, chain.from_iterable(texts)), np.int32, sum(sizes))
        ends = np.cumsum(sizes)
        closed = np.insert(flat, ends, _END)
        return np.split(closed, (ends + np.arange(1, len(ends) + 1))[:-1])


@dataclass(frozen=True)
class Parameters:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # a row for each symbol

    @staticmethod
    def drawn(frequency: np.ndarray, states: int, seed: int = 7) -> Parameters:
        """Random parameters near the frequencies of the symbols."""
        rng = np.random.default_rng(seed)
        emit = (frequency + 1.0)[:, None] * rng.uniform(0.5, 1.5, (len(frequency), states))
        move = rng.uniform(0.5, 1.5, (states, states)) + 4 * np.eye(states)
        start = rng.uniform(0.5, 1.5, states)
        return Parameters(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))

    @staticmethod
    def from_counts(counts: np.ndarray, states: int, prior: np.ndarray) -> Parameters:
        """Maximum likelihood from expected counts, each emission drawn a little towards ``prior``."""
        start, move, emit = counts[:states] + 0.1, counts[states : states + states**2].reshape(states, states) + 0.1, counts[states + states**2 :].reshape(-1, states)
        emit = emit + prior[:, None] * 50.0
        return Parameters(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def _padded(symbols: list[np.ndarray]):
    """Batches of texts of like length: (places, symbols by step, lengths), longest first in a batch."""
    order = sorted(range(len(symbols)), key=lambda k: -len(symbols[k]))
    start = 0
    while start < len(order):
        longest = len(symbols[order[start]])
        end = start
        # a batch takes what keeps its padding under half and its steps within 2 million cells
        while end < len(order) and end - start < 1024 and 2 * len(symbols[order[end]]) >= longest and (end - start + 1) * longest <= 600_000:
            end += 1
        end = max(end, start + 1)
        own = order[start:end]
        grid = np.zeros((longest, len(own)), np.int32)
        for col, k in enumerate(own):
            grid[: len(symbols[k]), col] = symbols[k]
        yield own, grid, np.array([len(symbols[k]) for k in own])
        start = end


def _live(lengths: np.ndarray, steps: int) -> list[int]:
    """How many of the texts, longest first, still have a symbol at each step, and none after the last."""
    return np.searchsorted(-lengths, -np.arange(steps + 1), "left").tolist()


def log_likelihoods(symbols: list[np.ndarray], p: Parameters) -> np.ndarray:
    """Natural log-probability of each symbol sequence by the scaled forward recursion; exact."""
    out = np.zeros(len(symbols))
    for own, grid, lengths in _padded(symbols):
        scales = np.ones(grid.shape)
        alpha = None
        for t, live in enumerate(_live(lengths, len(grid))[:-1]):
            alpha = p.emit[grid[t, :live]] * (p.start if alpha is None else alpha[:live] @ p.move)
            scale = alpha.sum(1)
            scales[t, :live] = scale
            alpha /= scale[:, None]
        out[own] = np.log(scales).sum(0)
    return out


def expected_counts(symbols: list[np.ndarray], p: Parameters) -> np.ndarray:
    """Expected counts of starts, moves and emissions (flat), by scaled forward and backward recursions."""
    k = len(p.start)
    start, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros((len(p.emit), k))
    for _, grid, lengths in _padded(symbols):
        steps, width = grid.shape
        lives = _live(lengths, steps)
        alphas, scales = np.zeros((steps, width, k)), np.ones((steps, width))
        for t in range(steps):
            live = lives[t]
            a = p.emit[grid[t, :live]] * (p.start if t == 0 else alphas[t - 1, :live] @ p.move)
            scales[t, :live] = a.sum(1)
            alphas[t, :live] = a / scales[t, :live, None]
        beta = np.ones((width, k))
        for t in range(steps - 1, -1, -1):
            live, follow = lives[t], lives[t + 1]
            if follow:  # texts that go on after t; the others end here with beta 1
                ahead = p.emit[grid[t + 1, :follow]] * beta[:follow] / scales[t + 1, :follow, None]
                move += alphas[t, :follow].T @ ahead
                beta[:follow] = ahead @ p.move.T
            alphas[t, :live] *= beta[:live]
        start += alphas[0].sum(0)
        flat, rows = grid.ravel(), alphas.reshape(-1, k)
        for state in range(k):
            emit[:, state] += np.bincount(flat, rows[:, state], len(emit))
    return np.concatenate([start, (move * p.move).ravel(), emit.ravel()])


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) of the words of a text column, lower-cased; each slice sends a word once."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: Counter = Counter()
        for t in as_bytes(batch.column("text")):
            found.update(tokens_of(t))
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "c"])

    return texts.mapInArrow(per_slice(count, "text", 16 << 20), "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class WordModel:
    """What scores: parameters, own words, and the totals that smooth words and shapes."""

    parameters: Parameters
    own: tuple[tuple[bytes, int], ...]
    shape_tokens: np.ndarray
    shape_words: np.ndarray
    tokens: int
    distinct: int
    texts: int


def encoded_texts(docs: DataFrame, learn: Column, own: list[bytes], doc_id: str, text: str) -> DataFrame:
    """(doc_id, th, learn, symbols, rare, times) of every row, written: its symbols as one binary value, and
    the words without a symbol of their own with their number of times."""
    symbols = Symbols(own)
    kind = np.uint16 if symbols.size <= 65_536 else np.int32

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [tokens_of(t) for t in as_bytes(batch.column("text"))]
        found = symbols.of(texts)
        words, times, sizes = [], [], []
        for t, f in zip(texts, found):
            rare = Counter(map(t.__getitem__, np.flatnonzero(f < SHAPES).tolist()))
            words += rare
            times += rare.values()
            sizes.append(len(rare))
        columns = [batch.column(c) for c in ("doc_id", "th", "learn")]
        columns.append(pa.array([f.astype(kind).tobytes() for f in found], pa.binary()))
        columns.append(list_array(pa.array(words, pa.binary()), sizes, pa.binary()))
        columns.append(list_array(np.array(times, np.int64), sizes, pa.int64()))
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "th", "learn", "symbols", "rare", "times"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(learn, F.lit(False)).alias("learn"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    id_kind = dict(rows.dtypes)["doc_id"]
    schema = f"doc_id {id_kind}, th bigint, learn boolean, symbols binary, rare array<binary>, times array<bigint>"
    return written(rows.withColumn("th", F.xxhash64("text")).mapInArrow(per_slice(encode, "text", _SLICE), schema), "symbols")


def summed_blocks(parts: DataFrame, fan_in: int = FAN_IN, levels: int = LEVELS) -> DataFrame:
    """(part, block, counts): the arrays of rows (part, block, counts) summed by block; ``part`` numbers the tasks.

    Tasks are summed in groups of ``fan_in`` neighbours, then these groups, and so on, so that no group grows with
    the number of tasks (as long as there are at most fan_in ** levels of them).
    """

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(len(table.column("counts")[0].as_py()) // 8)
        for value in table.column("counts"):
            total += np.frombuffer(value.as_py(), np.float64)
        first = [table.column(c)[:1].combine_chunks() for c in ("part", "block")]
        return pa.table([*first, pa.array([total.tobytes()], pa.binary())], names=["part", "block", "counts"])

    for _ in range(levels):
        grouped = parts.withColumn("part", F.floor(F.col("part") / fan_in).cast("int"))
        parts = grouped.groupBy("part", "block").applyInArrow(add, "part int, block int, counts binary")
    return parts


def _summed_counts(encoded: DataFrame, p: Parameters, wide: bool) -> np.ndarray:
    """Expected counts of all texts: one array for each task, cut into blocks that are summed apart."""
    kind, block = np.int32 if wide else np.uint16, 4_096
    size = len(p.start) * (1 + len(p.start) + len(p.emit))

    def count(batches):
        total = np.zeros(size)
        waiting: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for value in batch.column("symbols").to_pylist():
                waiting.append(np.frombuffer(value, kind).astype(np.int32))
                held += len(waiting[-1])
                if held > 2_000_000:
                    total += expected_counts(waiting, p)
                    waiting, held = [], 0
        if waiting:
            total += expected_counts(waiting, p)
        cut = [total[k : k + block].tobytes() for k in range(0, size, block)]
        columns = [pa.array([TaskContext.get().partitionId()] * len(cut), pa.int32()), pa.array(range(len(cut)), pa.int32()), pa.array(cut, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "counts"])

    parts = summed_blocks(encoded.mapInArrow(count, "part int, block int, counts binary")).select("block", "counts").collect()
    return np.concatenate([np.frombuffer(r["counts"], np.float64) for r in sorted(parts, key=lambda r: r["block"])]) if parts else np.zeros(size)


def fit_hmm(
    docs: DataFrame,
    learn: Column,
    text: str = "text",
    states: int = STATES,
    own_words: int = OWN_WORDS,
    sample_texts: int = SAMPLE_TEXTS,
    sample_rounds: int = SAMPLE_ROUNDS,
    full_rounds: int = FULL_ROUNDS,
    doc_id: str = "doc_id",
) -> tuple[WordModel, DataFrame, DataFrame]:
    """The model learned from the rows that ``learn`` picks, the written counts (word, c) of their words, and
    the written symbols of all rows (see encoded_texts), which score_texts takes.

    Null texts are empty. Without training rows all counts are 0 and the parameters are uniform.
    """
    texts = docs.where(learn).select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    counts = written(word_counts(texts), "word-counts")
    n_texts = texts.count()
    own = sorted(((bytes(r["word"]), r["c"]) for r in counts.orderBy(F.desc("c"), "word").limit(own_words).collect()), key=lambda x: (-x[1], x[0]))
    own_list = [w for w, _ in own]

    def shapes(batch: pa.RecordBatch) -> pa.RecordBatch:
        taken = set(own_list)
        rows = [(shape_of(w), c) for w, c in zip(batch.column("word").to_pylist(), batch.column("c").to_pylist()) if w not in taken]
        ids, values = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.float64)
        tokens, distinct = np.bincount(ids, values, SHAPES).astype(np.int64), np.bincount(ids, minlength=SHAPES).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(range(SHAPES), pa.int32()), pa.array(tokens), pa.array(distinct)], names=["shape", "n", "v"])

    found = counts.mapInArrow(per_slice(shapes, "word"), "shape int, n bigint, v bigint").groupBy("shape").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    shape_tokens, shape_words = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in found:
        shape_tokens[r["shape"]], shape_words[r["shape"]] = r["n"], r["v"]
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()

    frequency = np.concatenate([shape_tokens, [n_texts], [c for _, c in own]])
    prior = (frequency + 0.5) / (frequency + 0.5).sum()
    p = Parameters.drawn(frequency, states)
    wide = len(frequency) > 65_536
    kind = np.int32 if wide else np.uint16
    encoded = encoded_texts(docs, learn, own_list, doc_id, text)
    training = encoded.where("learn")
    if n_texts and sample_rounds:
        # by row, so that copies of a text are drawn apart; the limit holds for rows alike in id and text
        draw = F.pmod(F.xxhash64("doc_id", "th"), F.lit(1_000_003))
        head = F.substring("symbols", 1, SAMPLE_TOKENS * np.dtype(kind).itemsize)
        drawn = training.where(draw < max(1, int(1_000_003 * sample_texts / n_texts))).select(head).limit(4 * sample_texts)
        sample = [np.frombuffer(r[0], kind).astype(np.int32) for r in drawn.collect()]
        for _ in range(sample_rounds if sample else 0):
            p = Parameters.from_counts(expected_counts(sample, p), states, prior)
    if n_texts:
        # each task sends an array of all counts in each round: a quarter of the tasks, while they keep all cores busy
        cores, parts = docs.sparkSession.sparkContext.defaultParallelism, training.rdd.getNumPartitions()
        taken = training.select("symbols").coalesce(max(2 * cores, parts // 4))
        for _ in range(full_rounds):
            p = Parameters.from_counts(_summed_counts(taken, p, wide), states, prior)
    # the end is counted as a token of the base too
    return WordModel(p, tuple(own), shape_tokens, shape_words, totals[0] + n_texts, totals[1] + bool(n_texts), n_texts), counts, encoded


def score_texts(encoded: DataFrame, model: WordModel, counts: DataFrame) -> DataFrame:
    """(doc_id, th, n_tokens, n_known, base_score, score) of every encoded row: log10-probabilities of whole
    texts.

    ``base_score`` is the smoothed unigram, ``score`` the hidden Markov model. Null texts are empty and have
    the end as their only token. ``th`` is the hash of the text: rows alike in both are scored alike, rows
    that only share the id keep apart. Counts of words without a symbol of their own are joined by word,
    so that a frequent word never meets in one task.
    """
    kind = np.uint16 if len(model.parameters.emit) <= 65_536 else np.int32
    low = model.tokens + 0.5 * (model.distinct + 1)
    # base scores by symbol: words without one of their own are added after the join
    base_of = np.concatenate([np.zeros(SHAPES), np.log10((np.array([model.texts, *(c for _, c in model.own)]) + 0.5) / low)])
    known_of = np.concatenate([np.zeros(SHAPES, np.int64), [int(model.texts > 0)], np.ones(len(model.own), np.int64)])

    def direct(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.frombuffer(s, kind).astype(np.int32) for s in batch.column("symbols").to_pylist()]
        chain_ = log_likelihoods(found, model.parameters) / np.log(10)
        per_text = [(len(f), int((f < SHAPES).sum()), int(known_of[f].sum()), float(base_of[f].sum())) for f in found]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        columns = [batch.column("doc_id"), batch.column("th"), *(pa.array(c, k) for c, k in zip(zip(*per_text), kinds)), pa.array(chain_)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "th", "n_tokens", "n_rare", "n_known", "base_score", "score"])

    id_kind = dict(encoded.dtypes)["doc_id"]
    schema = f"doc_id {id_kind}, th bigint, n_tokens bigint, n_rare bigint, n_known bigint, base_score double, score double"
    plain = encoded.select("doc_id", "th", "symbols").mapInArrow(per_slice(direct, "symbols", _SLICE // 2), schema)
    words = encoded.select("doc_id", "th", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("doc_id", "th", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    rare = words.join(counts, "word", "left")
    shape = F.pmod(F.crc32(F.concat(F.substring("word", -3, 3), F.unhex(F.lpad(F.hex(F.floor(F.least(F.octet_length("word"), F.lit(255)) / 3).cast("bigint")), 2, "0")))), F.lit(SHAPES))
    smooth = F.array(*(F.lit(float(n + 0.5 * (v + 1))) for n, v in zip(model.shape_tokens, model.shape_words)))
    c = F.coalesce(F.col("c"), F.lit(0))
    summed = rare.groupBy(F.col("doc_id").alias("id2"), F.col("th").alias("th2")).agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((c + 0.5) / F.lit(float(low)))).alias("more_base"),
        F.sum(F.col("times") * F.log10((c + 0.5) / F.get(smooth, shape.cast("int")))).alias("more_score"),
        F.sum("times").alias("more_times"),
    )
    joined = plain.join(summed, F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("th") == F.col("th2")), "left")
    # rows alike in id and text were summed together: each takes its own share
    share = F.coalesce(F.col("n_rare") / F.col("more_times"), F.lit(0.0))
    return joined.select(
        "doc_id",
        "th",
        "n_tokens",
        (F.col("n_known") + F.coalesce(F.round(F.col("more_known") * share), F.lit(0)).cast("bigint")).alias("n_known"),
        (F.col("base_score") + F.coalesce(F.col("more_base") * share, F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce(F.col("more_score") * share, F.lit(0.0))).alias("score"),
    )
