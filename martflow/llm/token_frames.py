"""Token ids as files of independent zstandard frames with a trailing seek table.

A file holds the documents of one range of ids, in ascending order:

    frame ... frame, directory frame, seek table

- A *frame* decompresses on its own to: number of pieces (uint32), their document ids (int64), their
  numbers of tokens (uint32), their flags (uint8: 1 the document began in an earlier frame, 2 it goes on in the next
  frame, 4 its id is null), then the token ids of all pieces, 2 or 4 bytes each. All numbers are little-endian.
- The *directory* frame holds, as a header of two uint32 (bytes of a token id, number of frames) and arrays, the
  first and the last document id of each frame (int64) and the tokens before it in the file (int64).
- The *seek table* is a skippable frame in the published layout for seekable zstandard files: compressed size,
  decompressed size and checksum (low 32 bits of XXH64) of each frame, then a footer of 9 bytes.

So the files are ordinary zstandard files too. A reader takes the footer, the seek table and the directory, and
decompresses the frames that hold the documents it was asked for. Each task writes its file under a name of
its own and renames it when it is whole, so that repeated and lost tasks leave no half files; the
manifest, written last, lists the files and the tokens before each.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martflow.llm.common import as_bytes, slices, written

#: Tokens of a frame, and of a file (about: a file ends between two documents).
FRAME_TOKENS = 1 << 17
FILE_TOKENS = 1 << 24
#: Small tables are still cut into files of about this size, as long as cores are idle.
LEAST_FILE_TOKENS = 1 << 20
LEVEL = 3
#: Fixed values of the seekable layout: magic numbers, and the descriptor bit for checksums.
_SKIPPABLE, _SEEKABLE, _WITH_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
_BEGAN, _GOES_ON, _NULL_ID = 1, 2, 4
#: Documents that the reader hands on at once hold about this many bytes of ids.
_READ_BYTES = 4 << 20


#: How this family of vocabularies cuts lower-cased text; what no branch matches is white space.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\xA0\p{L}\p{N}]+"
_CUT = regex.compile(_PIECES)
#: The mark of a word's end in the vocabulary file, and the byte that stands for it here.
_END, _END_BYTE = "</w>", b"\0"


def _byte_of_char() -> dict[str, int]:
    """Characters by which the vocabulary file writes bytes: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return {chr(b if b in plain else next(spare)): b for b in range(256)}


class WordCodec(dict):
    """Ids of white-space-separated chunks of text, as bytes. No token spans ASCII white space in vocabularies that
    drop it, so a text is encoded chunk by chunk; recent chunks are kept, and the table starts anew when full.

    Chunks of old Unicode blocks, about whose characters all libraries agree, are lower-cased and cut here, and
    the pieces of many chunks are merged in one call of the faster of two libraries; all others go through the
    tokenizers library one by one. The faster one merges two neighbours whenever their bytes are a token, the other
    one only by the file's list of merges. Both agree as long as every token is the encoding of its own bytes:
    neighbours that fill a token's bytes have come about by the same merges as in these bytes alone, hence are the two
    that the list has. Tokens for which this fails can never come about and are left out.
    """

    LIMIT, LONGEST = 600_000, 64

    def __init__(self, path: str):
        super().__init__()
        self.path = path
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.specials = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())

    @cached_property
    def fast(self) -> tiktoken.Encoding | None:
        """Merges pieces, each closed by the end byte; a newline is a token of its own. None if the vocabulary's ids
        are not in the order of its merges."""
        with open(self.path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        byte_of, vocab = _byte_of_char(), model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = [vocab[a + b] for a, b in merges]
        singles = [k for token, k in vocab.items() if len(token.removesuffix(_END)) == 1]
        if model.get("end_of_word_suffix") != _END or ids != sorted(set(ids)) or len(singles) != 512 or max(singles) > min(ids):
            return None
        order = {pair: k for k, pair in enumerate(merges)}
        found = {}
        for token, k in vocab.items():
            plain = token.removesuffix(_END)
            symbols = [*plain[:-1], plain[-1] + token[len(plain) :]]
            if _merged(symbols, order) == [token]:
                found[bytes(map(byte_of.__getitem__, plain)) + (_END_BYTE if plain != token else b"")] = k
        return tiktoken.Encoding("words", pat_str=r"[^\x00\n]+\x00|\n", mergeable_ranks=found, special_tokens={})

    def _packed(self, ids) -> bytes:
        return np.array(ids, f"<u{self.width}").tobytes()

    def _is_plain(self, text: str) -> bool:
        return self.fast is not None and (text.isascii() or max(text) < "ɐ") and "\0" not in text and not any(s in text for s in self.specials)

    def _learn(self, chunks: list[bytes]) -> None:
        """Encodes new chunks."""
        if not chunks:
            return
        text = b"\n".join(chunks).decode()
        if not self._is_plain(text):
            apart = [chunk for chunk in chunks if not self._is_plain(chunk.decode())]
            for chunk in apart:
                self[chunk] = np.array(self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids, f"<u{self.width}").tobytes()
            chunks = list(set(chunks).difference(apart))
            text = b"\n".join(chunks).decode()
        if chunks:
            # what no piece covers is white space and goes
            closed = _CUT.sub(r"\g<0>\0", text.lower()).replace("\x85", "").replace("\xa0", "")
            ids = np.array(self.fast.encode_ordinary(closed + "\n"), np.int64)
            (newline,) = self.fast.encode_ordinary("\n")
            ends = np.flatnonzero(ids == newline) * self.width
            starts = np.concatenate([[0], ends[:-1] + self.width])
            data = ids.astype(f"<u{self.width}").tobytes()
            self.update(zip(chunks, map(data.__getitem__, map(slice, starts.tolist(), ends.tolist()))))

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of several texts; null counts as empty."""
        # each different chunk is looked up once; Arrow numbers the chunks and puts their ids in the order of the texts
        chunks = pc.ascii_split_whitespace(pa.array([t or b"" for t in texts], pa.large_binary()).view(pa.large_string()))
        numbered = chunks.flatten().dictionary_encode()
        words = _listed(numbered.dictionary)
        if len(self) >= self.LIMIT:
            self.clear()
        found = list(map(self.get, words))
        new = [k for k, ids in enumerate(found) if ids is None]
        # splitting gives an empty chunk beside white space at the ends
        self._learn([words[k] for k in new if words[k]])
        for k in new:
            word = words[k]
            found[k] = (self[word] if len(word) <= self.LONGEST else self.pop(word)) if word else b""
        ids = pa.array(found, pa.large_binary()).take(numbered.indices)
        _, ends, data = ids.buffers()
        bounds = np.frombuffer(ends, np.int64, len(ids) + 1)[chunks.offsets.to_numpy()].tolist() if len(ids) else [0] * (len(texts) + 1)
        return [data[start:end].to_pybytes() for start, end in zip(bounds, bounds[1:])]


def _listed(words: pa.LargeStringArray) -> list[bytes]:
    """Words without white space as bytes; joined and split, which is faster than one by one."""
    if not len(words):
        return []
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words.cast(pa.string())), "\n")
    return joined[0].as_buffer().to_pybytes().split(b"\n")


def _merged(symbols: list[str], order: dict[tuple[str, str], int]) -> list[str]:
    """Byte-pair merging from the definition, for checking a vocabulary."""
    while len(symbols) > 1:
        known = [(order[pair], k) for k, pair in enumerate(zip(symbols, symbols[1:])) if pair in order]
        if not known:
            break
        k = min(known)[1]
        symbols = [*symbols[:k], symbols[k] + symbols[k + 1], *symbols[k + 2 :]]
    return symbols


@lru_cache(maxsize=2)
def word_codec(path: str) -> WordCodec:
    """The codec of a vocabulary file, once per Python worker."""
    return WordCodec(path)


def encode_words(docs: DataFrame, vocab_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, n_tokens, ids), one row for each row of ``docs``, written once; ids are packed, 2 or 4 bytes each.

    ``vocab_path`` names a vocabulary that drops white space. Null and empty texts have no ids. ``row`` tells
    rows of equal ids apart and spreads them evenly. Other columns are not looked at.
    """

    def work(batches):
        base, k = TaskContext.get().partitionId() << 40, 0
        for batch in slices(batches, "text"):
            ids = word_codec(vocab_path).encode(as_bytes(batch.column("text")))
            width = word_codec(vocab_path).width
            columns = [batch.column("doc_id"), pa.array(range(base + k, base + k + len(ids)), pa.int64()), pa.array([len(x) // width for x in ids], pa.int64())]
            k += len(ids)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.binary())], names=["doc_id", "row", "n_tokens", "ids"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return written(rows.mapInArrow(work, "doc_id bigint, row bigint, n_tokens bigint, ids binary"), "token-ids")


class FrameWriter:
    """Packs documents into frames of one open file."""

    def __init__(self, out, width: int, frame_tokens: int):
        self.out, self.width, self.room = out, width, frame_tokens
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self.pieces: list[tuple[int, int, bytes]] = []  # (document id, flags, ids)
        self.held = self.tokens = self.docs = 0
        self.entries: list[tuple[int, int, int]] = []  # (compressed, decompressed, checksum)
        self.directory: list[tuple[int, int, int]] = []  # (first id, last id, tokens before)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        step, at, size = self.room * self.width, 0, len(ids)
        self.docs += 1
        while True:
            stop = min(size, at + step - self.held * self.width)
            flags = _BEGAN * (at > 0) + _GOES_ON * (stop < size) + _NULL_ID * (doc_id is None)
            self.pieces.append((doc_id or 0, flags, ids[at:stop]))
            self.held += (stop - at) // self.width
            if self.held >= self.room:
                self._flush()
            at = stop
            if at >= size:
                return

    def _frame(self, raw: bytes) -> None:
        packed = self.compressor.compress(raw)
        self.out.write(packed)
        self.entries.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def _flush(self) -> None:
        doc_ids, flags, ids = zip(*self.pieces)
        sizes = np.array([len(x) // self.width for x in ids], "<u4")
        head = struct.pack("<I", len(ids)) + np.array(doc_ids, "<i8").tobytes() + sizes.tobytes() + bytes(flags)
        # null ids come last of all, so they are no bounds for a search
        known = [d for d, f in zip(doc_ids, flags) if not f & _NULL_ID]
        self.directory.append((known[0] if known else np.iinfo(np.int64).max, known[-1] if known else np.iinfo(np.int64).min, self.tokens))
        self.tokens += self.held
        self._frame(head + b"".join(ids))
        self.pieces, self.held = [], 0

    def close(self) -> None:
        if self.pieces:
            self._flush()
        bounds = np.array(self.directory, "<i8").reshape(-1, 3)
        self._frame(struct.pack("<II", self.width, len(self.directory)) + bounds.T.tobytes())
        table = b"".join(struct.pack("<III", *e) for e in self.entries) + struct.pack("<IBI", len(self.entries), _WITH_CHECKSUMS, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(table)) + table)


def write_tokens(encoded: DataFrame, folder: str, end_id: int, frame_tokens: int = FRAME_TOKENS, file_tokens: int = FILE_TOKENS) -> str:
    """Writes the frames of ``encoded`` (see ``encode_words``) with ``end_id`` after each document; returns the folder.

    Documents are in ascending order of their ids, rows of equal ids in a fixed order and null ids last. ``folder`` is
    a path or URI that all executors reach and pyarrow's file systems know. An empty table gives an empty manifest.
    """
    spark = encoded.sparkSession
    total = encoded.agg(F.coalesce(F.sum(F.col("n_tokens") + 1), F.lit(0))).first()[0]
    cores = spark.sparkContext.defaultParallelism
    files = max(1, -(-total // file_tokens), min(cores, total // LEAST_FILE_TOKENS))
    folder = folder.rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (b.slice(k, 1) for b in batches for k in range(b.num_rows))
        first = next(rows, None)
        if first is None:
            return
        part = TaskContext.get().partitionId()
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        name = f"tokens-{part:06d}.zst"
        draft = f"{path}/.{name}.{uuid.uuid4().hex}"
        first_id = last_id = None
        with store.open_output_stream(draft) as out:
            writer: FrameWriter | None = None
            for row in (r for source in ([first], rows) for r in source):
                doc_id, n, ids = (row.column(c)[0].as_py() for c in ("doc_id", "n_tokens", "ids"))
                width = row.column("width")[0].as_py()
                if writer is None:
                    writer, first_id = FrameWriter(out, width, frame_tokens), doc_id
                last_id = doc_id if doc_id is not None else last_id
                writer.add(doc_id, ids + end_id.to_bytes(width, "little"))
            writer.close()
        store.move(draft, f"{path}/{name}")
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "file": f"{folder}/{name}", "docs": writer.docs, "tokens": writer.tokens, "first_id": first_id, "last_id": last_id}]
        )

    # one width for the whole table: that of its first non-empty text, else the smaller one
    sample = encoded.where("n_tokens > 0").select((F.length("ids") / F.col("n_tokens")).cast("int")).first()
    wide = encoded.withColumn("width", F.lit(sample[0] if sample else 2))
    ordered = wide.repartitionByRange(files, F.col("doc_id").asc_nulls_last(), "row").sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "row")
    manifest = written(ordered.mapInArrow(write, "part bigint, file string, docs bigint, tokens bigint, first_id bigint, last_id bigint"), "token-manifest")
    # one row a file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    manifest.write.parquet(f"{folder}/manifest")
    return folder


class FrameReader:
    """Random access to one file."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        count, _, magic = struct.unpack("<IBI", self._bytes(size - 9, 9))
        if magic != _SEEKABLE:
            raise ValueError("no seek table at the end of the file")
        table = self._bytes(size - 9 - 12 * count, 12 * count)
        self.entries = np.frombuffer(table, "<u4").reshape(-1, 3).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.entries[:, 0])])
        directory = self._frame(count - 1)
        self.width, self.frames = struct.unpack_from("<II", directory)
        self.first, self.last, self.before = np.frombuffer(directory, "<i8", offset=8).reshape(3, -1)

    def _bytes(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def _frame(self, k: int) -> bytes:
        packed, size, checksum = self.entries[k].tolist()
        raw = zstandard.ZstdDecompressor().decompress(self._bytes(int(self.offsets[k]), packed), max_output_size=size)
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} is damaged")
        return raw

    def documents(self, wanted: np.ndarray | None = None) -> Iterator[tuple[int | None, int, bytes]]:
        """(document id, tokens before it in the file, its packed ids): all, or those whose id is in ``wanted`` (sorted)."""
        if wanted is None:
            chosen = np.ones(self.frames, bool)
        else:
            # a frame is needed if a wanted id lies between its first and its last one
            chosen = np.searchsorted(wanted, self.first) < np.searchsorted(wanted, self.last, "right")
        parts: list[bytes] = []
        began = 0
        for k in np.flatnonzero(chosen).tolist():
            raw = self._frame(k)
            (count,) = struct.unpack_from("<I", raw)
            doc_ids = np.frombuffer(raw, "<i8", count, 4)
            sizes = np.frombuffer(raw, "<u4", count, 4 + 8 * count).astype(np.int64)
            flags = np.frombuffer(raw, np.uint8, count, 4 + 12 * count)
            ends = 4 + 13 * count + np.cumsum(sizes) * self.width
            starts = self.before[k] + np.cumsum(sizes) - sizes
            take = np.ones(count, bool) if wanted is None else np.isin(doc_ids, wanted) & (flags & _NULL_ID == 0)
            for j in np.flatnonzero(take).tolist():
                flag = int(flags[j])
                if not flag & _BEGAN:
                    parts, began = [], int(starts[j])
                parts.append(raw[ends[j] - sizes[j] * self.width : ends[j]])
                if not flag & _GOES_ON:
                    yield (None if flag & _NULL_ID else int(doc_ids[j])), began, b"".join(parts)


def read_tokens(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the documents in ``folder``: all, or those with the given ids.

    ``start`` counts the tokens of all documents before, ``ids`` has 4 bytes a token, little-endian. With ``doc_ids``
    (a list that fits the driver) only their files are opened and only their frames are decompressed; unknown
    ids give no rows, repeated ones the same rows as one. A damaged frame raises an error.
    """
    manifest = spark.read.parquet(f"{folder.rstrip('/')}/manifest")
    wanted = None if doc_ids is None else np.unique(np.array(doc_ids, np.int64))
    if wanted is not None:
        low, high = (int(wanted[0]), int(wanted[-1])) if len(wanted) else (1, 0)
        manifest = manifest.where((F.col("first_id") <= high) & (F.col("last_id") >= low))
    files = manifest.count()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                store, path = fs.FileSystem.from_uri(file)
                with store.open_input_file(path) as source:
                    held, size = [], 0
                    reader = FrameReader(source)
                    for doc_id, before, ids in reader.documents(wanted):
                        wide = np.frombuffer(ids, f"<u{reader.width}").astype("<u4").tobytes()
                        held.append((doc_id, start + before, len(wide) // 4, wide))
                        size += len(wide)
                        if size >= _READ_BYTES:
                            yield _documents(held)
                            held, size = [], 0
                    if held:
                        yield _documents(held)

    # a task a file
    return manifest.select("file", "start").repartition(max(1, files)).mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "start", "n_tokens", "ids"])
