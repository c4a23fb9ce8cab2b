"""Similarity join of documents by word n-grams: Jaccard of 85 of 100 and more, by prefix filters.

Under any one order of all shingles, two sets that similar share a shingle among the first
``n - ceil(0.85 n) + 1`` of each: the prefix. Candidates must share one under several orders.

1. Every document becomes the set of hashes of its shingles; equal sets are one class from then on.
2. The first order puts the shingles whose hash lies in the lowest quarter first, rare ones before
   frequent ones (counted over all documents), then the rest by hash. Prefix shingles that no other class
   has are dropped; classes that share one are joined into clusters (connected components), so a frequent
   shingle never makes pairs.
3. Shared shingles chain classes that have little else in common, and the chains grow faster than the input.
   So a cluster of more than one block is clustered anew: classes that share a prefix shingle only stay
   together if their sizes and parity sketches allow a link, tested shingle by shingle.
4. A cluster is cut into blocks of bounded size; each pair of blocks is one task. There, pairs must also
   share prefix shingles under two further orders and fit in size. What is left is verified on the
   whole sets, and the task returns a spanning forest of its links, never all pairs.
5. The components of the forests are the components of all links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import WordHashes, as_bytes, gram_hashes, list_array, mixed, per_slice, written
from martflow.llm.components import components

SHINGLE = 4
PERCENT = 85
#: Orders by which pairs of a block are filtered, besides the one that joins them.
ORDER_SEEDS = (1, 2)
#: A block has at most about this many classes and shingles.
BLOCK_CLASSES = 512
BLOCK_SHINGLES = 1 << 18
#: Bits of the widest sketch; beyond about twice as many shingles it tells little, and blocks have to.
SKETCH_BITS = 8_192
#: Classes with one shingle that are compared at once; a task's table of what hangs together starts anew beyond KEPT_KEYS.
GROUP_CLASSES, KEPT_KEYS = 2_048, 100_000
_FIRST = np.uint64(1 << 62)


def prefix_size(n, percent: int):
    return n - -(-percent * n // 100) + 1


def shingle_sets(texts: list[bytes | None], hashes: WordHashes, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z lower-cased; a shorter text is one shingle."""
    sets = []
    for text in texts:
        words = text.lower().split() if text else []
        sets.append(np.unique(gram_hashes(hashes.of(words), min(size, len(words)))) if words else np.empty(0, np.uint64))
    return sets


def set_key(shingles: np.ndarray) -> int | None:
    """A 64-bit name of a set; null for the empty one."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63) if len(shingles) else None


def sketch(shingles: np.ndarray) -> bytes:
    """One bit for each place that shingles hash to: whether an odd number of them does. At least as many bits as
    shingles, up to SKETCH_BITS.

    Every shingle that only one of two sets has changes one bit, so sketches differ in no more bits than sets in shingles.
    """
    bits = min(max(64, 1 << (len(shingles) - 1).bit_length()), SKETCH_BITS)
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def may_link(n: int, bits: int, odd: int, n2: int, bits2: int, odd2: int, percent: int) -> bool:
    """Whether sets of these sizes and sketches (width, value) may be as similar as a link asks; never false for a link."""
    if 100 * min(n, n2) < percent * max(n, n2):
        return False
    while bits > bits2:
        bits //= 2
        odd = (odd >> bits) ^ (odd & ((1 << bits) - 1))
    while bits2 > bits:
        bits2 //= 2
        odd2 = (odd2 >> bits2) ^ (odd2 & ((1 << bits2) - 1))
    return (odd ^ odd2).bit_count() <= n + n2 - 2 * -(-percent * (n + n2) // (100 + percent))


def _profiles(size: int, percent: int):
    """Rows (doc_id, th, n, key, n_first, first, later, sketch): shingles of the first class, and those of the second
    that the prefix still reaches."""
    hashes = WordHashes()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(as_bytes(batch.column("text")), hashes, size)
        n_first = [int(np.searchsorted(s, _FIRST)) for s in sets]
        first = [s[:k] for s, k in zip(sets, n_first)]
        later = [s[k : max(k, prefix_size(len(s), percent))] if len(s) else s for s, k in zip(sets, n_first)]
        flat = lambda parts: list_array(np.concatenate([np.empty(0, np.uint64), *parts]).view(np.int64), [len(p) for p in parts], pa.int64())
        columns = [batch.column("doc_id"), batch.column("th"), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_key(s) for s in sets], pa.int64()), pa.array(n_first, pa.int64()), flat(first), flat(later)]
        columns.append(pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "th", "n", "key", "n_first", "first", "later", "sketch"])

    return per_slice(work, "text")


def prefix_rows(profiles: DataFrame, percent: int) -> DataFrame:
    """(t, key): shingles in the prefix of each class under the first order that another class may share."""
    rows = profiles.select("key", F.explode("first").alias("t"))
    counts = rows.groupBy("t").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = rows.join(counts, "t").groupBy("key").agg(F.sort_array(F.collect_set(F.struct("c", "t"))).alias("shared"))
    classes = profiles.where("key is not null").select("key", "n", "n_first", "later").dropDuplicates(["key"])
    reach = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("long") + 1
    # shingles that occur once come first in the order, so that they use up the prefix
    take = F.least(F.size("shared"), F.greatest(F.lit(0), (reach - (F.col("n_first") - F.size("shared"))).cast("int")))
    first = shared.join(classes.select("key", "n", "n_first"), "key").select("key", F.explode(F.slice("shared", F.lit(1), take)["t"]).alias("t"))
    later = classes.select("key", F.explode("later").alias("t"))
    return first.unionByName(later)


def clusters(prefixes: DataFrame) -> DataFrame:
    """(key, cluster) of the classes that share a prefix shingle with another, directly or by others."""
    first = prefixes.groupBy("t").agg(F.min("key").alias("v"), F.max("key").alias("w")).where("v < w").select("t", "v")
    edges = prefixes.join(first, "t").select(F.col("key").alias("u"), "v").distinct()
    return components(edges).select(F.col("node").alias("key"), F.col("root").alias("cluster"))


class _Roots(dict):
    """Union-find over keys."""

    def find(self, k: int) -> int:
        while (up := self.setdefault(k, k)) != k:
            self[k] = self[up]
            k = up
        return k


def candidate_links(members: list[tuple], others: list[tuple] | None, percent: int, roots: _Roots) -> list[tuple[int, int]]:
    """Pairs of keys that may link and connect what ``roots`` has apart: of members (n, bits, odd, key) among each
    other, or with the others. Whatever all pairs that may link connect is connected by these and ``roots``.

    Members are held in parts that hang together, and a key is compared with a part until one of it may link, so that many copies
    of each other cost no more than a comparison each.
    """
    parts: list[list[tuple]] = []
    found = []
    for place, row in enumerate([*sorted(members), *(others or [])]):
        held = others is None or place < len(members)
        mine = None
        for part in parts:
            if roots.find(part[0][3]) != roots.find(row[3]):
                if others is not None and held:
                    continue
                near = next((m for m in reversed(part) if may_link(*m[:3], *row[:3], percent)), None)
                if near is None:
                    continue
                found.append((near[3], row[3]))
                roots[roots.find(near[3])] = roots.find(row[3])
            mine = part
        if held and mine is not None:
            mine.append(row)
        elif held:
            parts.append([row])
    return found


def _candidates(percent: int):
    """Links that ``candidate_links`` finds in rows (t, i, j, side, key, n, sketch) that lie by t, i and j."""

    def one(rows: list[tuple], roots: _Roots) -> list[tuple[int, int]]:
        sides = [[(n, 8 * len(s), int.from_bytes(s, "little"), key) for side, key, n, s in rows if side in wanted] for wanted in ((0, 2), (1,))]
        return candidate_links(sides[0], sides[1] if rows[0][0] != 2 else None, percent, roots)

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots, at, waiting = _Roots(), None, []

        def out(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

        for batch in batches:
            found = []
            for *place, side, key, n, s in zip(*(batch.column(c).to_pylist() for c in ("t", "i", "j", "side", "key", "n", "sketch"))):
                if place != at and waiting:
                    found += one(waiting, roots)
                    waiting = []
                    if len(roots) > KEPT_KEYS:
                        roots.clear()
                at = place
                waiting.append((side, key, n, s))
            yield out(found)
        if waiting:
            yield out(one(waiting, roots))

    return links


def _cell_of(key: str, blocks: str) -> Column:
    """(i, j, side) of each cell that a row takes part in where the rows are dealt to blocks by key and all blocks meet.

    Side 2: both blocks of the cell are the same one.
    """
    own = F.pmod(F.xxhash64(key), F.col(blocks)).cast("int")
    return F.explode(F.transform(F.sequence(F.lit(0), F.col(blocks) - 1), lambda o: F.struct(F.least(own, o).alias("i"), F.greatest(own, o).alias("j"), F.when(own == o, 2).when(own < o, 0).otherwise(1).alias("side"))))


def _blocks() -> Column:
    return F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")


def refined(profiles: DataFrame, prefixes: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(key, rep, n, cluster): the classes, those in clusters of more than one block by new clusters.

    Classes that link share a prefix shingle, fit in size and have sketches that allow it. So components of the pairs that do
    all three hold every link, and a class without such a pair has none and goes.
    """
    large = classes.groupBy("cluster").agg(_blocks()).where("blocks > 1").select("cluster")
    inside = classes.join(large, "cluster", "left_semi").select("key")
    sketches = profiles.where("key is not null").select("key", "n", "sketch").join(inside, "key", "left_semi").dropDuplicates(["key"])
    rows = written(prefixes.join(sketches, "key").select("t", "key", "n", "sketch"), "sketches")
    hot = rows.groupBy("t").agg(F.ceil(F.count(F.lit(1)) / GROUP_CLASSES).cast("int").alias("many")).where("many > 1")
    dealt = rows.join(hot, "t", "left").withColumn("many", F.coalesce("many", F.lit(1)))
    cells = dealt.select("t", "key", "n", "sketch", _cell_of("key", "many").alias("cell")).select("t", "cell.*", "key", "n", "sketch")
    # a fixed number: merged by size, a few tasks would get all of the comparisons
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = cells.repartition(tasks, "t", "i", "j").sortWithinPartitions("t", "i", "j").mapInArrow(_candidates(percent), "u bigint, v bigint")
    anew = components(written(links, "candidates")).select(F.col("node").alias("key"), F.col("root").alias("anew"))
    kept = classes.join(large.withColumn("is_large", F.lit(True)), "cluster", "left").join(anew, "key", "left")
    new = F.when(F.col("is_large"), F.col("anew")).otherwise(F.col("cluster"))
    return kept.select("key", "rep", "n", new.alias("cluster")).where("cluster is not null")


def _shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many values each set of ``a`` shares with each set of ``b``, by products of 0-1 matrices."""
    out = np.zeros((len(a), len(b)), np.float32)
    values_a, values_b = np.concatenate(a), np.concatenate(b)
    common = np.intersect1d(values_a, values_b)
    if not len(common):
        return out
    rows_a, rows_b = np.repeat(np.arange(len(a)), [len(x) for x in a]), np.repeat(np.arange(len(b)), [len(x) for x in b])

    def cells(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(common, values), len(common) - 1)
        there = common[at] == values
        order = np.argsort(at[there], kind="stable")
        return at[there][order], rows[there][order]

    (cols_a, rows_a), (cols_b, rows_b) = cells(values_a, rows_a), cells(values_b, rows_b)
    step = 2048
    for start in range(0, len(common), step):
        parts = []
        for cols, rows, n in ((cols_a, rows_a, len(a)), (cols_b, rows_b, len(b))):
            lo, hi = np.searchsorted(cols, [start, start + step])
            part = np.zeros((n, min(step, len(common) - start)), np.float32)
            part[rows[lo:hi], cols[lo:hi] - start] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out


def block_links(a: list[np.ndarray], b: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Pairs (place in a, place in b) that link, after the filters by size and by every order."""
    na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    may = (100 * np.minimum(na[:, None], nb) >= percent * np.maximum(na[:, None], nb))
    for seed in ORDER_SEEDS:
        if not may.any():
            return []
        prefix = lambda x: x[np.argsort(mixed(x, seed))[: prefix_size(len(x), percent)]]
        may &= _shared_counts([prefix(x) for x in a], [prefix(x) for x in b]) > 0
    if not may.any():
        return []
    shared = _shared_counts(a, b).astype(np.int64)
    linked = may & (100 * shared >= percent * (na[:, None] + nb - shared))
    return list(zip(*(x.tolist() for x in np.nonzero(linked))))


def _cell(percent: int):
    """Spanning forest (u, v) of the links between two blocks of a cluster."""

    def links(table: pa.Table) -> pa.Table:
        keys, sides = table.column("key").to_numpy(), table.column("side").to_numpy()
        column = table.column("shingles").combine_chunks()
        flat, offsets = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()
        sets = [flat[s:e] for s, e in zip(offsets, offsets[1:])]
        a = np.flatnonzero(sides != 1)
        b = np.flatnonzero(sides != 0)
        root = {int(k): int(k) for k in keys}

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        forest = []
        if len(a) and len(b):
            for i, j in block_links([sets[k] for k in a], [sets[k] for k in b], percent):
                u, v = int(keys[a[i]]), int(keys[b[j]])
                if find(u) != find(v):
                    root[find(u)] = find(v)
                    forest.append((u, v))
        return pa.table({"u": pa.array([f[0] for f in forest], pa.int64()), "v": pa.array([f[1] for f in forest], pa.int64())})

    return links


def links_forest(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """(u, v): links between classes (key, rep, n, cluster), enough of them to connect whatever all links connect."""
    wanted = classes.join(classes.groupBy("cluster").agg(_blocks()), "cluster").select("rep", "key", "cluster", "blocks")
    hashes = WordHashes()

    def sets_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(as_bytes(batch.column("text")), hashes, size)
        # rows that repeat an id may have other texts: only those of the class count
        right = pa.array([set_key(s) == k for s, k in zip(sets, batch.column("key").to_pylist())])
        kept = [s for s, ok in zip(sets, right.to_pylist()) if ok]
        flat = np.concatenate([np.empty(0, np.uint64), *kept]).view(np.int64)
        others = [batch.column(c).filter(right) for c in ("key", "cluster", "blocks")]
        return pa.RecordBatch.from_arrays([*others, list_array(flat, [len(s) for s in kept], pa.int64())], names=["key", "cluster", "blocks", "shingles"])

    # one plan at every size, so that what a small input takes on disk tells what a large one does
    texts = docs.join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("rep"))).select("text", "key", "cluster", "blocks")
    sets = texts.mapInArrow(per_slice(sets_of, "text"), "key bigint, cluster bigint, blocks int, shingles array<bigint>")
    cells = sets.select("key", "cluster", "shingles", _cell_of("key", "blocks").alias("cell")).select("key", "cluster", "shingles", "cell.*")
    return cells.groupBy("cluster", "i", "j").applyInArrow(_cell(percent), "u bigint, v bigint")


def _by_class(docs: DataFrame, doc_id: str, text: str, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, th, n, key) of every row, and (key, root, low) of every class: the component and the
    smallest id of the class."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("th", F.xxhash64("text"))
    kind = dict(rows.dtypes)["doc_id"]
    profiles = written(rows.mapInArrow(_profiles(size, percent), f"doc_id {kind}, th bigint, n bigint, key bigint, n_first bigint, first array<bigint>, later array<bigint>, sketch binary"), "profiles")
    prefixes = written(prefix_rows(profiles, percent), "prefixes")
    chosen = profiles.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"))
    classes = written(chosen.join(clusters(prefixes), "key"), "clusters")
    linked = components(written(links_forest(rows, written(refined(profiles, prefixes, classes, percent), "refined"), size, percent), "links"))
    classes = profiles.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("low"))
    rooted = classes.join(linked, classes["key"] == linked["node"], "left").select("key", F.coalesce("root", "key").alias("root"), "low")
    return profiles.select("doc_id", "th", "n", "key"), rooted


def ngram_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    component_id is the smallest id of all rows that links reach, the row itself included. Texts without
    words, null ones too, have no shingles and their own id. Rows with a null id take part and get the
    smallest id of their component, if it has any. A repeated id is one document for each of its texts.
    Shingles are compared by 64-bit hashes. Other columns are not looked at.
    """
    rows, classes = _by_class(docs, doc_id, text, size, percent)
    lowest = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    found = classes.join(lowest, "root").select("key", "component_id")
    return rows.join(found, "key", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Of each component one row of ``docs``: the one with the smallest id (null last).

    Texts without words are linked with nothing, so all of them stay, as they are. All columns stay.
    """
    last = F.lit(np.iinfo(np.int64).max)
    order = F.coalesce(F.col(doc_id).cast("bigint"), last)
    rows, classes = _by_class(docs, doc_id, text, size, percent)
    place = F.struct(F.coalesce(F.col("doc_id").cast("bigint"), last).alias("o"), F.col("th").alias("t"))
    kept = rows.join(classes.select("key", "root"), "key").groupBy("root").agg(F.min(place).alias("place")).select("place.*").distinct()
    has_word = F.rlike(F.coalesce(F.col(text), F.lit("")), F.lit("[^ \\t-\\r]"))
    whole = docs.where(has_word).select(F.struct("*").alias("row"), order.alias("o"), F.xxhash64(F.col(text)).alias("t"))
    # rows alike in id and text are copies of each other
    linked = whole.join(kept, ["o", "t"], "left_semi").groupBy("o", "t").agg(F.first("row").alias("row")).select("row.*")
    return linked.unionByName(docs.where(~has_word))
