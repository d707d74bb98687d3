"""Helpers shared by the text operators: whole texts as flat byte arrays, word bounds, rolling hashes."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Inside a task, texts are worked on in slices of about so many bytes; one longer text is a slice of its own.
SLICE_BYTES = 4_000_000
#: Stands for a NULL doc_id inside an operator; it sorts below every other.
NULL_ID = -(2**63)
MULTIPLIER = 0x9E3779B97F4A7C15
# [^\x20\x09-\x0D]+ as SQL: what separates words
SEPARATORS = r"[\x20\x09-\x0D]+"


class Slice(NamedTuple):
    """Some rows of a batch: row `i` of `batch` has the bytes `data[offsets[i]:offsets[i + 1]]`."""

    batch: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray


def narrowed(docs: DataFrame, *more: str | Column) -> DataFrame:
    """`doc_id` (never NULL) and `text` (NULL as empty); other columns stay behind, whatever their names."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        *more,
    )


def public_id(name: str = "doc_id") -> Column:
    """`name` with the stand-in for NULL turned back."""
    return F.when(F.col(name) != NULL_ID, F.col(name)).alias(name)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[Slice]:
    for batch in batches:
        texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None and len(raw) else np.zeros(0, np.uint8)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield Slice(batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
            at = to


_IS_SEPARATOR = np.zeros(256, bool)
_IS_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and past-the-last byte of every word, and how many words each row has."""
    inside = ~_IS_SEPARATOR[data]
    cut = np.zeros(len(data) + 1, bool)  # a row begins at this byte
    cut[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1 : len(data)]
    last = inside
    last[:-1] &= ~inside[1:] | cut[1 : len(data)]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


@functools.cache
def _byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits; equal ones stay equal, others differ."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=4)
def _powers(size: int, base: int) -> np.ndarray:
    out = np.full(size, base % 2**64, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(size: int, base: int) -> np.ndarray:
    return _powers(1 << max(16, (size - 1).bit_length()), base)[:size]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp: the polynomial of `values[start:end]` modulo 2**64 for every span, from one prefix sum."""
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values) + 1, MULTIPLIER)[:-1], out=prefix[1:])
    back = powers(len(values) + 1, pow(MULTIPLIER, -1, 2**64))
    return mixed((prefix[ends] - prefix[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(_byte_values()[data], starts, ends)


def packed(array: np.ndarray, level: int = 1) -> bytes:
    """An integer array as compressed bytes."""
    return zstandard.ZstdCompressor(level=level).compress(np.ascontiguousarray(array).tobytes())


def unpacked(raw: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype)


@functools.cache
def _malloc_trim():
    """The C library's, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return lambda pad: 0


def give_back() -> None:
    """Unused memory goes back to the system: a Python worker waits for its next task, often beside others, with all it holds."""
    pa.default_memory_pool().release_unused()
    _malloc_trim()(0)


def tidy(run):
    """A pass over batches that gives back what memory it can at its end."""

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return passed


def group_starts(*columns: np.ndarray) -> np.ndarray:
    """Where a new run of equal rows begins; the columns are sorted."""
    new = np.ones(len(columns[0]), bool)
    if len(new) > 1:
        new[1:] = functools.reduce(np.logical_or, (c[1:] != c[:-1] for c in columns))
    return np.flatnonzero(new)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
