"""Token frames: ids against the library, files against the published layout, reading by id."""

from __future__ import annotations

import struct
import zlib
from pathlib import Path

import numpy as np
import pytest
import pyarrow as pa
import zstandard
from tokenizers import Tokenizer

from martflow.llm import queries, token_frames
from tests.conftest import SF_SMALL

from . import cases

TEXTS = [
    "it's I'LL we're 'sx a'Tb 12 3½ ²",
    "a\x0bb\x0cc\x1cd\x85e\xa0f g　h",
    "İstanbul ΣΑΣ σας Straße ǅ é ́x 가",
    "x<|endoftext|>y <|startoftext|> <|END|> <| endoftext |>",
    "漢字かな 한국어 🙂👩‍👩‍👧 ﻿​",
    "…—“quoted”—$5.00!!!??",
    "\0\x01 \x7f",
]


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(queries.WORD_VOCAB)
    found.no_padding()
    found.no_truncation()
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


def ids_of(packed, width=2):
    return np.frombuffer(packed, f"<u{width}").tolist()


def test_ids_are_the_library_s(library):
    rng = np.random.default_rng(5)
    marks = [chr(c) for c in (*range(0x250), 0x301, 0x3A3, 0x85, 0x2028, 0x3000, 0x1F642, 0xD7, 0x4E2D, 0x130)]
    texts = TEXTS + ["".join(rng.choice(marks, 40)) for _ in range(400)]
    codec = token_frames.word_codec(queries.WORD_VOCAB)
    assert [ids_of(x) for x in codec.encode([*(t.encode() for t in texts), None, b""])] == [*map(library, texts), [], []]


def test_both_ways_of_merging_agree(library):
    """Random letters, as only they reach unusual merges, and all tokens of the vocabulary themselves."""
    rng = np.random.default_rng(6)
    letters = list("eeettaaooiinnsshhrrddllcumwfgypbvkjxqz") + ["é", "ü", "ß", "ñ", "0", "7", ".", "'", "&"]
    texts = ["".join(rng.choice(letters, rng.integers(1, 30))) for _ in range(20_000)]
    texts += [t.removesuffix("</w>") for t in Tokenizer.from_file(queries.WORD_VOCAB).get_vocab() if t.isascii()]
    codec = token_frames.WordCodec(queries.WORD_VOCAB)
    assert codec.fast is not None
    assert [ids_of(x) for x in codec.encode([t.encode() for t in texts])] == [library(t) for t in texts]


def test_the_kept_chunks_start_anew(library, monkeypatch):
    monkeypatch.setattr(token_frames.WordCodec, "LIMIT", 20)
    codec = token_frames.WordCodec(queries.WORD_VOCAB)
    for k in range(5):
        text = cases.words(15, k) + " " + "long" * 40
        assert ids_of(codec.encode([text.encode()])[0]) == library(text) and len(codec) < 40
        assert all(len(chunk) <= codec.LONGEST for chunk in codec)


def rows():
    return [*cases.rows(), *((100 + k, t, "en", "s", 1) for k, t in enumerate(TEXTS))]


def test_files_hold_all_documents_in_order(spark, tmp_path, library):
    encoded = token_frames.encode_words(cases.frame(spark, rows()), queries.WORD_VOCAB)
    # tiny frames and files: long documents span several frames
    folder = token_frames.write_tokens(encoded, str(tmp_path / "out"), 2, frame_tokens=50, file_tokens=1500)
    assert len(list(Path(folder).glob("tokens-*.zst"))) > 2 and not list(Path(folder).glob(".tokens*"))
    found = token_frames.read_tokens(spark, folder).orderBy("start").collect()
    assert sorted(((r["doc_id"], ids_of(r["ids"], 4)) for r in found), key=repr) == sorted(((i, [*library(t), 2]) for i, t, *_ in rows()), key=repr)
    order = [r["doc_id"] for r in found]
    known = [d for d in order if d is not None]
    assert known == sorted(known) and order[len(known) :] == [None] * (len(order) - len(known))
    assert [r["start"] for r in found] == [0, *np.cumsum([r["n_tokens"] for r in found])[:-1].tolist()]


def test_reading_by_id_opens_only_what_it_needs(spark, tmp_path, library, monkeypatch):
    encoded = token_frames.encode_words(cases.frame(spark, rows()), queries.WORD_VOCAB)
    folder = token_frames.write_tokens(encoded, f"file://{tmp_path}/out", 2, frame_tokens=50, file_tokens=1500)
    wanted = [1, 12, 103, 999, 12]
    found = token_frames.read_tokens(spark, folder, wanted).collect()
    every = token_frames.read_tokens(spark, folder).collect()
    assert sorted(tuple(r) for r in found) == sorted(tuple(r) for r in every if r["doc_id"] in wanted)
    assert sum(r["doc_id"] == 1 for r in found) == 3
    assert token_frames.read_tokens(spark, folder, []).count() == 0
    for path in sorted((tmp_path / "out").glob("*.zst")):
        with pa.OSFile(str(path)) as source:
            reader = token_frames.FrameReader(source)
            read, frame = [], reader._frame
            monkeypatch.setattr(reader, "_frame", lambda k: read.append(k) or frame(k))
            wholly = list(reader.documents())
            assert read == list(range(reader.frames))
            read.clear()
            list(reader.documents(np.array([10, 16])))
            need = [k for k in range(reader.frames) if any(reader.first[k] <= i <= reader.last[k] for i in (10, 16))]
            assert read == need and wholly


def test_layout_is_that_of_seekable_zstandard(spark, tmp_path):
    encoded = token_frames.encode_words(cases.frame(spark, rows()), queries.WORD_VOCAB)
    folder = token_frames.write_tokens(encoded, str(tmp_path / "out"), 2, frame_tokens=64, file_tokens=1 << 30)
    (path,) = Path(folder).glob("*.zst")
    data = path.read_bytes()
    count, descriptor, magic = struct.unpack("<IBI", data[-9:])
    size = 12 * count + 9
    assert (descriptor, magic) == (0x80, 0x8F92EAB1) and struct.unpack("<II", data[-size - 8 : -size]) == (0x184D2A5E, size)
    entries = [struct.unpack("<III", data[-size:][12 * k : 12 * k + 12]) for k in range(count)]
    assert sum(e[0] for e in entries) + size + 8 == len(data)
    # an ordinary decompressor reads the frames one after another
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert len(whole) == sum(e[1] for e in entries)
    damaged = bytearray(data)
    damaged[-size + 8] ^= 1  # the first frame's checksum
    with pa.BufferReader(bytes(damaged)) as source, pytest.raises(ValueError, match="damaged"):
        list(token_frames.FrameReader(source).documents())


def test_clashing_columns_hot_ids_and_empty_tables(spark, tmp_path, library):
    encoded = token_frames.encode_words(cases.clashing(spark), queries.WORD_VOCAB)
    folder = token_frames.write_tokens(encoded, str(tmp_path / "a"), 2, file_tokens=500)
    assert token_frames.read_tokens(spark, folder).count() == len(cases.rows())
    hot = [(7, cases.words(30, k % 3), "en", "s", 1) for k in range(300)]
    folder = token_frames.write_tokens(token_frames.encode_words(cases.frame(spark, hot), queries.WORD_VOCAB), str(tmp_path / "b"), 2, file_tokens=2000)
    files = spark.read.parquet(f"{folder}/manifest").collect()
    assert len(files) > 5 and max(f["docs"] for f in files) < 100 and sum(f["docs"] for f in files) == 300
    assert token_frames.read_tokens(spark, folder, [7]).count() == 300
    folder = token_frames.write_tokens(token_frames.encode_words(cases.frame(spark, []), queries.WORD_VOCAB), str(tmp_path / "c"), 2)
    assert token_frames.read_tokens(spark, folder).count() == 0


def test_query_over_the_whole_table(spark, library):
    found = {r["doc_id"]: r for r in queries.op11_token_frames(spark, str(SF_SMALL)).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    start = 0
    for doc in docs:
        ids = [*library(doc["text"]), 2]
        assert tuple(found[doc["doc_id"]]) == (doc["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(found) == len(docs)


def test_a_repeated_chunk_is_looked_up_once(library):
    class Counting(token_frames.WordCodec):
        looked_up = 0

        def get(self, chunk, default=None):
            self.looked_up += 1
            return super().get(chunk, default)

        def __getitem__(self, chunk):
            self.looked_up += 1
            return super().__getitem__(chunk)

    codec = Counting(queries.WORD_VOCAB)
    texts = [" again\tand\x0bagain ", "", "\n", "and  again it's " * 500]
    assert [ids_of(x) for x in codec.encode([*(t.encode() for t in texts), None])] == [*map(library, texts), []]
    assert codec.looked_up < 20 and codec.encode([]) == []
