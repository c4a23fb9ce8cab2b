from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from martflow.llm.bpe import Codec, bpe_decode, bpe_encode

from . import cases

VOCAB = public_tokenizers.path("byte_bpe_50k.json")
#: Letters, white space of all kinds, contractions, special tokens, other scripts.
PARTS = ["a", "b", " ", "  ", "\n", " \n", "'s", "'re", "'", "e", "ß", "é", "1", "²", "½", ".", "!!", "\u0085", "\xa0", "\x1c", "漢", "字", "。", "🙂", "<|endoftext|>", "the ", " and", "\0", "\t", "_"]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(VOCAB)


def leaves(piece: str, leaf: int) -> list[str]:
    depth = (max(1, -(-len(piece) // leaf)) - 1).bit_length()
    cuts = [len(piece) * j >> depth for j in range((1 << depth) + 1)]
    return [piece[s:e] for s, e in zip(cuts, cuts[1:])]


def test_encoding_and_tree_equal_the_library(reference):
    codec, rng = Codec(VOCAB), random.Random(3)
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60)))
        want = reference.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == want, repr(text)
        leaf, got = rng.randint(1, 9), []
        for piece in codec.pieces(text):
            got += [piece] if isinstance(piece, int) else codec.tree([(p, codec.encode(p)) for p in leaves(piece, leaf)])
        assert got == want, (leaf, repr(text))
        assert codec.decode(got) == text


@pytest.mark.parametrize("size", [30, 400, 3000])
def test_tree_of_one_unsplit_run(reference, size):
    codec, rng = Codec(VOCAB), random.Random(size)
    text = "".join(rng.choice("ethingaorsd") for _ in range(size))
    assert codec.tree([(p, codec.encode(p)) for p in leaves(text, 7)]) == reference.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("leaf", [16, 32_768])
def test_rows_and_round_trip(spark, reference, leaf):
    docs = cases.clashing(spark)
    encoded = bpe_encode(docs, VOCAB, leaf_chars=leaf)
    decoded = bpe_decode(encoded, VOCAB)
    want = sorted(((i, reference.encode(t or "", add_special_tokens=False).ids, t or "") for i, t, *_ in cases.rows()), key=repr)
    assert sorted(((r["doc_id"], r["ids"], r["decoded"]) for r in decoded.collect()), key=repr) == want


def test_empty_table(spark):
    assert bpe_decode(bpe_encode(cases.frame(spark, []), VOCAB), VOCAB).count() == 0
