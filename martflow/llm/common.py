"""Helpers that several training-data operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from martflow.session import in_bytes

#: Texts of a batch that are worked on at once take about this many bytes at most.
SLICE_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Give the workers this package, in case it isn't installed where they run."""
    sc = spark.sparkContext
    if getattr(sc, "_martflow_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    # the driver serves this file to the workers as long as it runs
    folder = tempfile.mkdtemp(prefix="martflow-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/{root.name}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    sc.addPyFile(path)
    sc._martflow_shipped = True


def small_batches(spark: SparkSession) -> None:
    """Let the session's rows travel to and from Python workers in batches of ``SLICE_BYTES`` at most.

    Executor and worker each hold the whole batch of a task, up to 64 MB by Spark's default, however small the slices are
    that it is worked on in. A smaller size that the session has stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if in_bytes(spark.conf.get(key)) > SLICE_BYTES:
        spark.conf.set(key, str(SLICE_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; a temporary one only for local runs without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="martflow-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, what: str) -> DataFrame:
    """The frame, written once as Parquet to the shared folder and read again.

    This cuts the lineage in a way that survives lost executors. Whoever owns the folder removes it.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold_of(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")), F.lit(folds))


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of about ``size`` bytes of ``column``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes.astype(np.int64)) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start)


def per_slice(work: Callable[[pa.RecordBatch], pa.RecordBatch | None], column: str, size: int = SLICE_BYTES):
    """A function for mapInArrow that applies ``work`` to slices of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column, size):
            out = work(batch)
            if out is not None:
                yield out
        # workers are used again and again: what this task has freed goes back to the system
        pa.default_memory_pool().release_unused()

    return run


class WordHashes(dict):
    """64-bit hashes of words (bytes). Kept words are bounded; the table starts anew when full."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values; other seeds give independent-looking orders."""
    x = values + np.uint64((seed * 0xD1B54A32D192ED03 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive word hashes; empty if there are fewer words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = words[:n].copy()
    for j in range(1, size):
        h *= _ODD
        h += words[j : j + n]
    return mixed(h)


def list_array(values: np.ndarray | pa.Array, lengths: list[int] | np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each row."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values if isinstance(values, pa.Array) else pa.array(values, kind))


def with_computed(df: DataFrame, text: str, ddl: str, work: Callable[[list[bytes | None]], list], size: int = SLICE_BYTES) -> DataFrame:
    """Adds the columns of ``ddl`` to every row, computed from the bytes of column ``text``.

    ``work`` gets the texts of a slice and returns one sequence (or Arrow array) a column. Columns of
    the same name are replaced; all others, whatever their names, are passed through.
    """
    new = T.StructType.fromDDL(ddl)
    kept = [c for c in df.columns if c not in new.names]
    source = df if text in kept else df.withColumn(kept_text := f"{text}__in", F.col(text))
    column = text if text in kept else kept_text
    kinds = [to_arrow_type(f.dataType) for f in new]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = work(as_bytes(batch.column(column)))
        made = [x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(found, kinds)]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], names=[*kept, *new.names])

    schema = T.StructType([*(f for f in df.schema if f.name in kept), *new])
    return source.mapInArrow(per_slice(one, column, size), schema)
