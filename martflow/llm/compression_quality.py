"""Quality classifier by compression: which dictionary makes a text smaller, the good or the bad one.

Two zstandard dictionaries are trained, one from good and one from bad labelled texts. A text is cut
into blocks, each block is compressed once with either dictionary, and the normalised difference of the
two total sizes, (good - bad) / (good + bad), says whose wording the text shares. A logistic curve over
that difference and the compression ratios for the text's length (texts that repeat themselves shrink
with any dictionary) turns it into the probability of label 1. The curve is fitted on all labelled texts, each
measured with dictionaries that have not seen it: those of the other half of the labels.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import as_bytes, with_computed

#: Labelled texts of each class and half from which dictionaries are trained and the curve is fitted.
TEXTS_PER_HALF = 1_000
#: Blocks of a labelled text that go into a dictionary, evenly spread over the whole text.
BLOCKS_PER_TEXT = 6
BLOCK = 2_048
DICTIONARY_BYTES = 65_536
LEVEL = 3


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the curve; without labels of both classes every text scores ``prior``."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    center: tuple[float, ...]
    scale: tuple[float, ...]
    prior: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(features), self.prior)
        z = np.column_stack([np.ones(len(features)), (features - self.center) / self.scale])
        return 1 / (1 + np.exp(-np.clip(z @ np.array(self.weights), -30, 30)))


@lru_cache(maxsize=8)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    if not dictionary:
        return zstandard.ZstdCompressor(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), compression_params=params)


def blocks(text: bytes) -> list[bytes]:
    return [text[k : k + BLOCK] for k in range(0, len(text), BLOCK)]


def features(texts: list[bytes | None], good: bytes, bad: bytes) -> np.ndarray:
    """For each text: normalised size difference, ratio with the better dictionary, log of the ratio with
    no dictionary, log of the length. Null counts as empty, which has difference 0 and ratios 1."""
    out = np.zeros((len(texts), 4))
    with_good, with_bad, plain = (_compressor(d).compress for d in (good, bad, b""))
    for k, text in enumerate(texts):
        if not text:
            out[k] = 0.0, 1.0, 0.0, 0.0
            continue
        parts = blocks(text)
        a, b, c = (sum(len(f(p)) for p in parts) for f in (with_good, with_bad, plain))
        out[k] = (a - b) / (a + b), min(1.0, min(a, b) / len(text)), np.log(c / len(text)), np.log(len(text))
    return out


def _basis(raw: np.ndarray) -> np.ndarray:
    """What the curve is linear in. How far a text shrinks by itself depends on its length up to a block."""
    diff, ratio, plain, size = raw.T
    up_to_block = np.minimum(size, np.log(BLOCK))
    columns = [diff, np.abs(diff), diff * np.minimum(size, 8.0), ratio, np.log(np.maximum(ratio, 1e-3)), plain, up_to_block, plain * up_to_block, up_to_block**2]
    return np.column_stack(columns)


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; the plain end of the samples where there is too little to train from."""
    size = min(DICTIONARY_BYTES, max(256, sum(map(len, samples)) // 8))
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 40) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the first column is constant."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * np.maximum(p * (1 - p), 1e-6)) @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _picked(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, each: int) -> DataFrame:
    """(y, half, t): texts of at most ``each`` labelled documents of each class and half, the first by a hash of the id."""
    half = F.pmod(F.xxhash64(F.col(doc_id), F.lit(5)), F.lit(2)).cast("int")
    own = labels.where(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("k"), F.col(label).cast("int").alias("y"), half.alias("half")).distinct()
    parts = [own.where((F.col("y") == y) & (F.col("half") == h)).orderBy(F.xxhash64("k", F.lit(1)), "k").limit(each) for y in (0, 1) for h in (0, 1)]
    ids = reduce(DataFrame.unionByName, parts)
    return docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t")).where(F.col("t").isNotNull()).join(F.broadcast(ids), "k")


def _spread(batches):
    """(y, half, part): blocks from all over each text."""
    for batch in batches:
        made = []
        for y, half, text in zip(batch.column("y").to_pylist(), batch.column("half").to_pylist(), as_bytes(batch.column("t"))):
            parts = blocks(text)
            made += [(y, half, part) for part in parts[:: max(1, -(-len(parts) // BLOCKS_PER_TEXT))]]
        if made:
            columns = [pa.array(c, kind) for c, kind in zip(zip(*made), (pa.int32(), pa.int32(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["y", "half", "part"])


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    texts_per_half: int = TEXTS_PER_HALF,
) -> QualityModel:
    """Learns from the label rows that ``learn`` (over the columns of ``labels``) picks.

    The fit takes at most ``texts_per_half`` texts of each class from either half of the labels, chosen and halved
    by a hash of the id. Rows with a null label or id teach nothing. If a class has no texts, every score is the
    share of label 1 (0.5 without).
    """
    usable = labels.where(learn & F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    counts = {r[0]: r[1] for r in usable.groupBy(label).count().collect()}
    total = counts.get(0, 0) + counts.get(1, 0)
    prior = counts.get(1, 0) / total if total else 0.5

    picked = _picked(docs, usable, doc_id, text, label, texts_per_half)
    samples = [(r["y"], r["half"], bytes(r["part"])) for r in picked.select("y", "half", "t").mapInArrow(_spread, "y int, half int, part binary").collect()]
    if {y for y, _, _ in samples} != {0, 1}:
        return QualityModel(b"", b"", (), (), (), prior)

    def dictionaries(*halves: int) -> tuple[bytes, bytes]:
        good, bad = (_dictionary(sorted(part for own, half, part in samples if own == y and half in halves)) for y in (1, 0))
        return good, bad

    rows = []
    for half in (0, 1):
        others = dictionaries(1 - half)
        measured = with_computed(picked.where(F.col("half") == half), "t", "f array<double>", lambda texts, d=others: [features(texts, *d).tolist()])
        rows += measured.select("y", "f").collect()
    x, y = _basis(np.array([r["f"] for r in rows])), np.array([r["y"] for r in rows], float)
    center, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    weights = _logistic(np.column_stack([np.ones(len(x)), (x - center) / scale]), y)
    # the fitted rows may hold as many bad texts as good ones; weigh the constant to the true share
    seen = y.mean()
    if 0 < prior < 1 and 0 < seen < 1:
        weights[0] += np.log(prior / (1 - prior)) - np.log(seen / (1 - seen))
    return QualityModel(*dictionaries(0, 1), tuple(weights), tuple(center), tuple(scale), prior)


def quality_scores(docs: DataFrame, model: QualityModel, text: str = "text", score: str = "score") -> DataFrame:
    """Adds the probability that a text is good, from its whole text; null is scored as empty.

    Only the text is looked at. Rows are never merged or dropped; other columns pass through.
    """

    def work(texts: list[bytes | None]) -> list:
        return [model.scores(_basis(features(texts, model.good, model.bad)))]

    return with_computed(docs, text, f"`{score}` double", work)
