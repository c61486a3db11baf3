"""Helpers shared by the training-data operators.

Words are the maximal runs matching ``[^\\x20\\x09-\\x0D]+``, which is exactly
what ``bytes.split()`` yields on UTF-8 text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import ensure_checkpoint_dir

SLICE_BYTES = 4 << 20
CACHE_ENTRIES = 1_000_000
_MULT = np.uint64(0x9E3779B97F4A7C15)


# -- Spark side ---------------------------------------------------------------

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: lineage ends there and survives lost executors. The files go when
    the driver's JVM exits, or earlier with :func:`drop_staged`."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shelfwise-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows, for jobs run inside whose rows may
    be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def drop_staged(df: DataFrame) -> None:
    """Delete a staged table that nothing will read any more (others stay)."""
    path = getattr(df, "_staged_path", None)
    if path is None:
        return
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """The columns ``id`` and ``text``. No alias or cast where none is needed:
    it would keep Spark from seeing that two uses of a table are the same."""
    is_text = text_col == "text" and docs.schema[text_col].dataType.simpleString() == "string"
    return [F.col(id_col).alias("id"), F.col("text") if is_text else F.col(text_col).cast("string").alias("text")]


def id_fold(id_col: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds))


# -- inside tasks -------------------------------------------------------------

def binary_values(column: pa.Array) -> list[bytes]:
    """Text column as UTF-8 bytes; nulls become the empty text."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def byte_slices(batches: Iterable[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES, row_bytes: int = 0) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows of about ``limit`` text bytes (a
    longer text is a slice of its own), so memory does not follow row counts.
    A row counts ``row_bytes`` besides its text, for what is made of each row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False) + row_bytes
        group = np.cumsum(sizes, dtype=np.int64) // limit
        edges = np.flatnonzero(np.diff(group)) + 1
        for lo, hi in zip([0, *edges], [*edges, batch.num_rows]):
            yield batch.slice(int(lo), int(hi - lo))


class BoundedCache(dict):
    """A dict that starts over once it holds ``entries`` entries."""

    entries = CACHE_ENTRIES

    def trim(self) -> None:
        if len(self) > self.entries:
            self.clear()


class _WordHashes(BoundedCache):
    entries = 50_000  # the frequent words; a hash costs little

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_word_hashes = _WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    _word_hashes.trim()
    return np.fromiter(map(_word_hashes.__getitem__, words), np.uint64, len(words))


def encoded_words(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of texts whose words are joined by one space: their number in each
    text, each word's code, and by code the 64-bit hash of the distinct words.
    Arrow splits and encodes, so Python sees a distinct word once."""
    sizes = np.zeros(len(lines), np.int64)
    some = np.asarray([len(line) > 0 for line in lines], bool)
    if not some.any():
        return sizes, np.empty(0, np.int64), np.empty(0, np.uint64)
    split = pc.split_pattern(pa.array([line for line in lines if line], pa.binary()), pattern=" ")
    sizes[some] = pc.list_value_length(split).to_numpy()
    words = split.flatten().dictionary_encode()
    distinct = words.dictionary.to_numpy(zero_copy_only=False)
    return sizes, words.indices.to_numpy(), np.fromiter(
        map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))


def distinct_index(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique(values, return_inverse=True)`` of 64-bit hashes in less
    time: sorts the leading bits of a hash with its position behind them, and the
    hashes themselves only if those bits leave some of them out of order."""
    bits = np.uint64(max(len(values) - 1, 1).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    order = (np.sort(values & ~low | np.arange(len(values), dtype=np.uint64)) & low).astype(np.int64)
    ordered = values[order]
    if (ordered[1:] < ordered[:-1]).any():
        return np.unique(values, return_inverse=True)
    starts = run_starts(ordered)
    new = np.zeros(len(values), np.int64)
    new[starts[1:]] = 1
    index = np.empty(len(values), np.int64)
    index[order] = np.cumsum(new)
    return ordered[starts], index


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (a bijection with good avalanche)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def ngram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position; ``len(h) - k + 1`` of them."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        acc = h[:n].copy()
        for j in range(1, k):
            acc *= _MULT
            acc += h[j:j + n]
    return mix(acc)


def run_starts(values: np.ndarray) -> np.ndarray:
    """Indexes at which a new run of equal values begins."""
    if len(values) == 0:
        return np.empty(0, np.int64)
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])


def flat_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All words of the texts in one list, and each text's first index (with
    the total as last entry)."""
    words: list[bytes] = []
    starts = np.zeros(len(texts) + 1, np.int64)
    for i, t in enumerate(texts):
        words += t.split()
        starts[i + 1] = len(words)
    return words, starts
