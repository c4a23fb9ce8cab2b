"""Language identification with interpolated Kneser-Ney character models.

For every language, counts of character four-grams over letters (lower case, everything else one space)
give an interpolated Kneser-Ney model. The models of all languages share one array of sorted hashes for
each order; a row of the matrix beside it holds the log-probability of that gram in every language, so
one search serves all languages and only grams that no language has seen go down an order. A text gets
the language of the lowest cross-entropy per character, summed over the whole text. Texts on which even
the best language does much worse than on its own held-back texts are marked as rejected.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import as_bytes, mixed, per_slice, with_computed

ORDER = 4
#: Expected number of texts of a language that are learned from; a quarter more calibrate.
TEXTS_PER_LANGUAGE = 1_000
#: More distinct labels than this raise an error: each one is a column of the matrices.
MAX_LANGUAGES = 200
UNKNOWN = "und"
_BITS = 15
#: Texts are worked on in slices of this size; a symbol takes about a hundred bytes meanwhile.
_SLICE = 1 << 20


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """For each code point the 15-bit symbol of its lower-case letter, 0 for what is no letter."""
    table = np.zeros(0x110000, np.int64)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ord(ch.lower()[0])
            table[c] = low if low < 0x4000 else 0x4000 | (low * 0x9E37 >> 3) & 0x3FFF
    return table


def symbols_of(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each one closed by a space, and the end of each text."""
    points = np.frombuffer("\0".join([*((t or b"").decode() for t in texts), ""]).replace("\r", " ").encode("utf-32-le"), np.uint32)
    # separators are the NULs put in above; those inside texts are counted off by the lengths
    sizes = np.array([len((t or b"").decode()) + 1 for t in texts], np.int64)
    found = _symbols()[points]
    last = np.zeros(len(found), bool)
    last[np.cumsum(sizes) - 1] = True
    first = np.concatenate([[True], last[:-1]])
    before = np.concatenate([[0], found[:-1]])
    keep = (found != 0) | last | ((before != 0) & ~first)
    # a space before the closing one is dropped, so that a text ends with one space
    keep &= ~((found == 0) & ~last & np.concatenate([last[1:], [False]]))
    return found[keep], np.cumsum(keep)[np.cumsum(sizes) - 1]


def grams_of(symbols: np.ndarray, ends: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The packed gram that ends at each symbol; what lies before a text's start is space."""
    starts = np.concatenate([[0], ends[:-1]])
    place = np.arange(len(symbols)) - np.repeat(starts, ends - starts)
    gram = symbols.copy()
    for back in range(1, order):
        moved = np.zeros_like(symbols)
        moved[back:] = symbols[:-back] if len(symbols) > back else 0
        moved[place < back] = 0
        gram |= moved << (_BITS * back)
    return gram


@dataclass(frozen=True)
class OrderTable:
    """Log-probabilities of grams and back-off weights of contexts, for all languages at once."""

    grams: np.ndarray
    log_p: np.ndarray
    contexts: np.ndarray
    log_back: np.ndarray


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    orders: tuple[OrderTable, ...]
    log_floor: np.ndarray
    temperature: float
    limits: np.ndarray

    def log_probabilities(self, grams: np.ndarray) -> np.ndarray:
        """A row for each gram: its log-probability in every language."""
        out = np.empty((len(grams), len(self.languages)), np.float32)
        back = np.zeros((len(grams), len(self.languages)), np.float32)
        left = np.arange(len(grams))
        for order in range(ORDER, 0, -1):
            table = self.orders[order - 1]
            own = grams[left] & ((1 << (_BITS * order)) - 1)
            at, there = _find(table.grams, own)
            out[left[there]] = table.log_p[at[there]] + back[left[there]]
            left, own = left[~there], own[~there]
            at, there = _find(table.contexts, own >> _BITS)
            back[left[there]] += table.log_back[at[there]]
        out[left] = back[left] + self.log_floor
        return out

    def entropies(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character for each language, and the number of characters; 0 without letters."""
        symbols, ends = symbols_of(texts)
        starts = np.concatenate([[0], ends[:-1]])
        totals = np.add.reduceat(self.log_probabilities(grams_of(symbols, ends)), starts, axis=0, dtype=np.float64)
        letters = np.add.reduceat((symbols != 0).astype(np.int64), starts)
        return -totals / (ends - starts)[:, None], np.where(letters > 0, ends - starts, 0)


def _find(keys: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of grams in an array of sorted hashes, and whether they are there."""
    if not len(keys):
        return np.zeros(len(grams), np.int64), np.zeros(len(grams), bool)
    wanted = mixed(grams.astype(np.uint64))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _grouped(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with the sum of their values and their number."""
    if not len(keys):
        return keys, values.astype(float), values.astype(float)
    distinct, inverse, times = np.unique(keys, return_inverse=True, return_counts=True)
    return distinct, np.bincount(inverse, values), times.astype(float)


def kneser_ney(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> tuple[tuple[OrderTable, ...], np.ndarray]:
    """Tables of orders 1 to ORDER from the counts of the highest-order grams of each language."""
    n = len(counts)
    levels = []
    for grams, times in counts.values():
        own, value = grams, times.astype(float)
        levels.append({})
        for order in range(ORDER, 0, -1):
            if order < ORDER:  # a gram counts once for each symbol seen before it
                own, _, value = _grouped(own & ((1 << (_BITS * order)) - 1), np.ones(len(own)))
            once, twice = (value == 1).sum(), (value == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            context, total, kinds = _grouped(own >> _BITS, value)
            levels[-1][order] = (own, value, discount, context, total, kinds)
    alphabet = len(np.unique(np.concatenate([v[1][0] for v in levels]))) + 1 if levels else 1
    log_floor = np.full(n, -np.log(alphabet), np.float32)

    tables: list[OrderTable] = []
    for order in range(1, ORDER + 1):
        grams = np.unique(np.concatenate([v[order][0] for v in levels]))
        contexts = np.unique(np.concatenate([v[order][3] for v in levels]))
        p, back = np.zeros((len(grams), n)), np.ones((len(contexts), n))
        for k, v in enumerate(levels):
            own, value, discount, context, total, kinds = v[order]
            back[np.searchsorted(contexts, context), k] = discount * kinds / total
            at = np.searchsorted(context, own >> _BITS)
            p[np.searchsorted(grams, own), k] = (value - discount) / total[at]
        if order == 1:
            lower = np.full((len(grams), n), 1 / alphabet)
        else:
            # every suffix of a seen gram was seen in some language, so the table below has it
            below = tables[-1]
            lower = np.exp(below.log_p[_find(below.grams, grams & ((1 << (_BITS * (order - 1))) - 1))[0]])
        full = p + back[np.searchsorted(contexts, grams >> _BITS)] * lower
        g, c = mixed(grams.astype(np.uint64)), mixed(contexts.astype(np.uint64))
        by_g, by_c = np.argsort(g), np.argsort(c)
        tables.append(OrderTable(g[by_g], np.log(full[by_g]).astype(np.float32), c[by_c], np.log(back[by_c]).astype(np.float32)))
    return tuple(tables), log_floor


def _gram_counts(batches):
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        texts = as_bytes(batch.column("text"))
        for lang in sorted(set(langs.tolist())):
            grams, times = np.unique(grams_of(*symbols_of([t for t, of in zip(texts, langs) if of == lang])), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams), pa.array(times)], names=["lang", "gram", "n"])


def fit_languages(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", texts_per_language: int = TEXTS_PER_LANGUAGE) -> LanguageModel:
    """Learns from rows that ``learn`` picks and that have a text and a language.

    About ``texts_per_language`` texts of each language, chosen by a hash of the id, give the counts; a
    quarter of that number, others, set the temperature of the score and the limits of rejection.
    Without any such row the model has no language and answers ``und``.
    """
    rows = docs.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(doc_id).alias("k"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return LanguageModel((), (), np.zeros(0, np.float32), 1.0, np.zeros(0))
    share = F.create_map(*(F.lit(x) for s in sizes.items() for x in (s[0], min(1.0, 1.25 * texts_per_language / s[1]))))
    draw = F.pmod(F.xxhash64("k", "text"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    drawn = rows.withColumn("draw", draw / share[F.col("lang")])
    learned, held = drawn.where("draw < 0.8"), drawn.where("draw >= 0.8 and draw < 1")

    found = learned.select("lang", "text").mapInArrow(_gram_counts, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs, grams, times = (found.column(c).to_numpy() for c in ("lang", "gram", "n"))
    counts = {x: (grams[langs == x], times[langs == x]) for x in sorted(sizes) if (langs == x).any()}
    if not counts:
        return LanguageModel((), (), np.zeros(0, np.float32), 1.0, np.zeros(0))
    orders, floor = kneser_ney(counts)
    names = tuple(counts)
    plain = LanguageModel(names, orders, floor, 1.0, np.full(len(names), np.inf))

    def measured(texts: list[bytes | None]) -> list:
        entropy, n = plain.entropies(texts)
        return [entropy.tolist(), n]

    rows_held = with_computed(held.select("lang", "text"), "text", "e array<double>, n bigint", measured, _SLICE).where("n > 0").select("lang", "e", "n").collect()
    rows_held = [r for r in rows_held if r["lang"] in names]
    if not rows_held:
        return plain
    e, n = np.array([r["e"] for r in rows_held]), np.array([r["n"] for r in rows_held], float)
    true = np.array([names.index(r["lang"]) for r in rows_held])
    spread = lambda t: -np.log(np.maximum(_chances(e, n, t)[np.arange(len(true)), true], 1e-12)).mean()
    best = min((2.0**k for k in range(-2, 9)), key=spread)
    limits = np.full(len(names), np.inf)
    for k in range(len(names)):
        if (true == k).sum() >= 20:
            own = e[true == k, k]
            limits[k] = own.mean() + 6 * max(own.std(), 0.05)
    return LanguageModel(names, orders, floor, best, limits)


def _chances(entropy: np.ndarray, n: np.ndarray, temperature: float) -> np.ndarray:
    """Probabilities of the languages: softmax of the log-likelihoods, cooled by ``temperature``."""
    z = -entropy * n[:, None] / temperature
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Adds lang_pred, score (calibrated probability of lang_pred), entropy (nats per character) and
    rejected (the best language is still far above its usual entropy).

    Null texts and texts without a letter get ``und``, score 0 and no entropy, and are rejected. Ties go to
    the first name. Only the text is looked at; rows are never merged and other columns pass through.
    """

    def work(texts: list[bytes | None]) -> list:
        if not model.languages:
            return [[UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts), [True] * len(texts)]
        entropy, n = model.entropies(texts)
        best = entropy.argmin(1)
        chance = _chances(entropy, n.astype(float), model.temperature)[np.arange(len(best)), best]
        low = entropy[np.arange(len(best)), best]
        known = n > 0
        return [
            [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)],
            np.where(known, chance, 0.0),
            [float(x) if k else None for x, k in zip(low, known)],
            ~known | (low > model.limits[best]),
        ]

    return with_computed(docs, text, "lang_pred string, score double, entropy double, rejected boolean", work, _SLICE)
