"""Byte-level BPE encoding and decoding; long texts by tree concatenation.

Short texts are encoded where they are. A text of more than ``leaf_chars`` characters is cut into
halves, quarters and so on; the pieces are rows of their own, so that different tasks encode them in
parallel. Then neighbours are joined pairwise up the tree: the tokens on both sides of a join are
encoded anew in a window that grows until its outer tokens are the ones that both sides already have.

Why agreement makes the join exact. A *safe boundary* is a place where every text splits before
merging, whatever stands around it: after a non-space and before a space, or after a letter and before
an ASCII digit or punctuation mark. Text between two safe boundaries has the same tokens wherever it
stands. A window starts and ends at safe boundaries and holds one whole safe run on each side of the
run that crosses the join; these two runs must come out as they were. Inside one huge run of letters,
which no boundary splits, the windows are counted in tokens: a token sequence is the encoding of a
letter run exactly if every pair of neighbours is the encoding of its own text, so equal outer tokens
suffice there too.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martflow.llm.common import list_array, per_slice

LEAF_CHARS = 32_768
#: Marks that are neither letter, digit nor space in every version of Unicode.
_MARKS = frozenset("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789")
#: Pre-tokenisation of this family of vocabularies (fixed value).
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: A space at either end of the text or beside another space of any kind.
_WIDE_GAP = re.compile(r"\s | \s|^ | $")


def _byte_of_char() -> dict[str, int]:
    """Characters by which the vocabulary file writes bytes: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Codec(dict):
    """Encoder and decoder of one vocabulary file. As a dict it keeps the ids of recent runs, as int32 bytes."""

    LIMIT = 120_000

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = _byte_of_char()
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in specials}
        self.specials = specials
        self.path, self.ranks = path, ranks
        self.text_of = [b""] * (max([*ranks.values(), *specials.values()]) + 1)
        for text, i in ranks.items():
            self.text_of[i] = text
        for text, i in specials.items():
            self.text_of[i] = text.encode()
        self.size_of = np.array([len(t) for t in self.text_of], np.int64)

    @cached_property
    def fast(self) -> tiktoken.Encoding:
        """Built when a text is encoded: what only decodes does without it."""
        return tiktoken.Encoding("bpe", pat_str=_SPLIT, mergeable_ranks=self.ranks, special_tokens={})

    @cached_property
    def exact(self) -> Tokenizer:
        found = Tokenizer.from_file(self.path)
        found.no_padding()
        found.no_truncation()
        return found

    def plain(self, text: str) -> list[int]:
        """Ids of a text without special tokens. The two libraries know different versions of Unicode,
        so that only letters of old blocks go the faster way."""
        if text.isascii() or max(text) < "ɐ":
            return self.fast.encode_ordinary(text)
        return self.exact.encode(text, add_special_tokens=False).ids

    def __missing__(self, run: str) -> bytes:
        ids = array("i", self.plain(run)).tobytes() if run else b""
        if len(run) <= 64:
            if len(self) >= self.LIMIT:
                self.clear()
            self[run] = ids
        return ids

    def runs(self, text: str) -> list[str]:
        """The text cut before single spaces between two non-spaces: safe boundaries."""
        if "\0" not in text and not _WIDE_GAP.search(text):
            return text.replace(" ", "\0 ").split("\0")
        first, *parts = text.split(" ")
        out = [first]
        for part in parts:
            if part and not part[0].isspace() and out[-1] and not out[-1][-1].isspace():
                out.append(" " + part)
            else:
                out[-1] += " " + part
        return out

    def pieces(self, text: str) -> list[str | int]:
        """The text cut at special tokens, which are replaced by their ids."""
        pieces: list[str | int] = [text]
        for special, i in self.specials.items():
            cut: list[str | int] = []
            for piece in pieces:
                if isinstance(piece, int) or special not in piece:
                    cut.append(piece)
                    continue
                first, *others = piece.split(special)
                cut += chain([first], *([i, part] for part in others))
            pieces = cut
        return [p for p in pieces if p != ""]

    def packed(self, text: str) -> bytes:
        """Ids of a text, run by run, as int32 bytes."""
        if not any(special in text for special in self.specials):
            return b"".join(map(self.__getitem__, self.runs(text)))
        return b"".join(np.int32(p).tobytes() if isinstance(p, int) else self.packed(p) for p in self.pieces(text))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def text(self, ids: list[int]) -> str:
        """The text of a leaf; nothing but its tokens has to be sent to the join."""
        return b"".join(map(self.text_of.__getitem__, ids)).decode()

    def decode(self, ids) -> str:
        return b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8", "replace")

    def join(self, left: tuple[str, list[int]], right: tuple[str, list[int]]) -> tuple[str, list[int]]:
        """The encoding of two neighbouring texts, each given with its own encoding."""
        (a, a_ids), (b, b_ids) = left, right
        if not a or not b:
            return a + b, a_ids + b_ids
        if a.isascii() and b.isascii() and a.removeprefix(" ").isalpha() and b.isalpha():
            return a + b, self._join_letters(a_ids, b_ids)
        reach = 64
        while True:
            cut_a, cut_b = _bounds_left(a, reach), _bounds_right(b, reach)
            start, end = cut_a[0] if cut_a else 0, cut_b[0] if cut_b else len(b)
            keep_a = self._tokens_before(a_ids, len(a[:start].encode()))
            keep_b = self._tokens_before(b_ids, len(b[:end].encode()))
            window = self.encode(a[start:] + b[:end])
            # one whole run on each side must be as it was, or the window holds everything
            known_a = a_ids[keep_a : self._tokens_before(a_ids, len(a[: cut_a[1]].encode()))] if cut_a else []
            known_b = b_ids[self._tokens_before(b_ids, len(b[: cut_b[1]].encode())) : keep_b] if cut_b else []
            if window[: len(known_a)] == known_a and (not known_b or window[-len(known_b) :] == known_b):
                return a + b, a_ids[:keep_a] + window + b_ids[keep_b:]
            if not cut_a and not cut_b:
                raise AssertionError("a window of the whole text always agrees")
            reach *= 2

    def _tokens_before(self, ids: list[int], size: int) -> int:
        """How many tokens make up the first ``size`` bytes."""
        ends = np.cumsum(self.size_of[ids]) if ids else np.empty(0, np.int64)
        return int(np.searchsorted(ends, size, "right")) if size else 0

    def _join_letters(self, a_ids: list[int], b_ids: list[int]) -> list[int]:
        k = 4
        while True:
            tail, head = a_ids[-k:], b_ids[:k]
            window = self.plain(b"".join(self.text_of[i] for i in tail + head).decode())
            left_ok = window[0] == tail[0] or k >= len(a_ids)
            right_ok = window[-1] == head[-1] or k >= len(b_ids)
            if left_ok and right_ok:
                return a_ids[: len(a_ids) - len(tail)] + window + b_ids[len(head) :]
            k *= 2

    def tree(self, leaves: list[tuple[str, list[int]]]) -> list[int]:
        """Joins neighbours level by level."""
        while len(leaves) > 1:
            paired = [self.join(*leaves[k : k + 2]) for k in range(0, len(leaves) - 1, 2)]
            leaves = paired + leaves[len(paired) * 2 :]
        return leaves[0][1] if leaves else []


def _is_safe(text: str, at: int) -> bool:
    before, here = text[at - 1], text[at]
    return (here == " " and not before.isspace()) or (before.isalpha() and before < "ɐ" and here in _MARKS)


def _bounds_left(text: str, reach: int) -> list[int]:
    """The last two safe boundaries of the text, looked for in ever longer tails; none if there aren't."""
    while True:
        stop = max(1, len(text) - reach)
        found: list[int] = []
        # the last character's own end is unknown, so a boundary needs one more behind it
        for at in range(len(text) - 2, stop - 1, -1):
            if _is_safe(text, at):
                found.append(at)
                if len(found) == 2:
                    return found[::-1]
        if stop == 1:
            return []
        reach *= 4


def _bounds_right(text: str, reach: int) -> list[int]:
    """The second and the first safe boundary of the text, in this order; none if there aren't."""
    found: list[int] = []
    for at in range(1, len(text) - 1):
        if _is_safe(text, at):
            found.append(at)
            if len(found) == 2:
                return found[::-1]
    return []


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The codec of a vocabulary file, once per Python worker."""
    return Codec(path)


def _encode_rows(path: str, text: str):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [codec(path).packed(t) for t in batch.column(text).to_pylist()]
        sizes = [len(x) // 4 for x in found]
        flat = np.frombuffer(b"".join(found), np.int32)
        rest = [batch.column(c) for c in batch.schema.names if c != text]
        names = [c for c in batch.schema.names if c != text]
        return pa.RecordBatch.from_arrays([*rest, list_array(flat, sizes, pa.int32())], names=[*names, "ids"])

    return per_slice(work, text)


def _leaves(path: str, leaf_chars: int):
    """Rows (doc_id, key, piece, leaf, special, text) of the halves of each long text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        doc_ids = batch.column("doc_id")
        for row, (key, text) in enumerate(zip(batch.column("key").to_pylist(), batch.column("text").to_pylist())):
            for k, piece in enumerate(codec(path).pieces(text)):
                if isinstance(piece, int):
                    out.append((row, key, k, 0, piece, ""))
                    continue
                depth = (max(1, -(-len(piece) // leaf_chars)) - 1).bit_length()
                cuts = [len(piece) * j >> depth for j in range((1 << depth) + 1)]
                out += [(row, key, k, j, None, piece[s:e]) for j, (s, e) in enumerate(zip(cuts, cuts[1:]))]
        rows, *columns = zip(*out)
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays([doc_ids.take(pa.array(rows)), *arrays], names=["doc_id", "key", "piece", "leaf", "special", "text"])

    return per_slice(work, "text")


def _joined(path: str):
    def join(table: pa.Table) -> pa.Table:
        rows = table.select(["piece", "leaf", "special", "ids"]).to_pylist()
        copies = sum((r["piece"], r["leaf"]) == (0, 0) for r in rows)
        once = {(r["piece"], r["leaf"]): r for r in rows}
        ids: list[int] = []
        for k in sorted({piece for piece, _ in once}):
            own = [once[at] for at in sorted(once) if at[0] == k]
            if own[0]["special"] is not None:
                ids.append(own[0]["special"])
            else:
                ids += codec(path).tree([(codec(path).text(r["ids"]), r["ids"]) for r in own])
        return pa.table({"doc_id": table.column("doc_id").combine_chunks().slice(0, 1).take(pa.array([0] * copies)), "ids": pa.array([ids] * copies, pa.list_(pa.int32()))})

    return join


def bpe_encode(docs: DataFrame, vocab_path: str, doc_id: str = "doc_id", text: str = "text", leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """Token ids of every text: (doc_id, ids), one row for each row of ``docs``, in no special order.

    Ids are those of the tokenizers library for the same file, special tokens in a text included. Null
    and empty texts have no ids. Ids of documents may be null or repeat: the leaves of a
    long text find each other by id and sha-256, and a row that occurs several times comes out as often.
    Other columns are not looked at.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    is_long = F.length("text") > leaf_chars
    kind = dict(rows.dtypes)["doc_id"]
    short = rows.where(~is_long).mapInArrow(_encode_rows(vocab_path, "text"), f"doc_id {kind}, ids array<int>")

    leaf = f"doc_id {kind}, key string, piece int, leaf int, special int"
    leaves = rows.where(is_long).withColumn("key", F.sha2("text", 256)).mapInArrow(_leaves(vocab_path, leaf_chars), f"{leaf}, text string")
    encoded = leaves.repartition("doc_id", "key", "piece", "leaf").mapInArrow(_encode_rows(vocab_path, "text"), f"{leaf}, ids array<int>")
    long = encoded.groupBy("doc_id", "key").applyInArrow(_joined(vocab_path), f"doc_id {kind}, ids array<int>")
    return short.unionByName(long)


def bpe_decode(encoded: DataFrame, vocab_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text of the token ids as column ``text``; no ids give the empty text, null gives null.

    Bytes that are not UTF-8 become the replacement character. Ids outside the vocabulary raise.
    """
    schema = encoded.drop(text).schema.add(text, "string")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        decode = codec(vocab_path).decode
        column = batch.column(ids)
        flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *(len(x) if x.is_valid else 0 for x in column)])
        valid = column.is_valid().to_pylist()
        texts = [decode(flat[s:e].tolist()) if ok else None for s, e, ok in zip(ends, ends[1:], valid)]
        names = [c for c in batch.schema.names if c != text]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.string())], names=[*names, text])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                yield work(batch.slice(start, 1000))
        pa.default_memory_pool().release_unused()

    return encoded.drop(text).mapInArrow(run, schema)
