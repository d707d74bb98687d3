"""Substring dedup by Rabin-Karp hashes of every window of a fixed number of words.

Each slice of documents rolls one 64-bit hash over its words and deals all of them out by hash: a row of the
shuffle is one bucket of one slice, with the hashes and where they start as packed arrays. A bucket counts its
hashes; of a repeated one every start but the first is marked. The marks of a document come together again,
merge into maximal intervals, and are cut from its text.

A hash that collides by chance (N*N / 2**65 pairs expected among N windows) would remove a window too many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from smogway.llm.common import (
    group_starts,
    narrowed,
    packed,
    shuffle_partitions,
    span_hashes,
    text_slices,
    unpacked,
    word_bounds,
    word_hashes,
)
from smogway.llm.spans import MARKS, cut_documents, marked_rows

WINDOW_WORDS = 20


def _window_hashes(parts: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches):
            starts, ends, count = word_bounds(piece.data, piece.offsets)
            hashes = word_hashes(piece.data, starts, ends)
            row = np.repeat(np.arange(len(count)), count)
            first = np.cumsum(count) - count
            nth = np.arange(len(row)) - first[row]
            at = np.flatnonzero(nth + words <= count[row])
            if not len(at):
                continue
            windows = span_hashes(hashes, at, at + words)
            bucket = ((windows >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(parts + 1))
            ids = piece.batch.column("doc_id").to_numpy(zero_copy_only=False)
            for b in np.flatnonzero(np.diff(cuts)):
                own = order[cuts[b] : cuts[b + 1]]
                rows = row[at[own]]
                begin = group_starts(rows)
                yield pa.RecordBatch.from_pydict({
                    "bucket": [b],
                    "docs": [packed(np.stack([ids[rows[begin]], np.diff(np.append(begin, len(rows)))]))],
                    "at": [packed(nth[at[own]].astype(np.uint32))],
                    "hashes": [windows[own].tobytes()],
                })

    return run


def _repeats(parts: int, words: int):
    """Of each hash, all starts but the first (smallest doc_id, then position), by document."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        docs, at, hashes = [], [], []
        for d, a, h in zip(*(table.column(c) for c in ("docs", "at", "hashes"))):
            ids, times = unpacked(d.as_py(), np.int64).reshape(2, -1)
            docs.append(np.repeat(ids, times))
            at.append(unpacked(a.as_py(), np.uint32))
            hashes.append(np.frombuffer(h.as_py(), np.uint64))
        docs, at, hashes = map(np.concatenate, (docs, at, hashes))
        order = np.argsort(hashes)
        hashes = hashes[order]
        same = hashes[1:] == hashes[:-1]
        repeated = np.append(False, same) | np.append(same, False)
        order, hashes = order[repeated], hashes[repeated]
        docs, at = docs[order], at[order]
        order = np.lexsort((at, docs, hashes))
        docs, at, hashes = docs[order], at[order], hashes[order]
        later = np.ones(len(hashes), bool)
        later[group_starts(hashes)] = False
        docs, at = docs[later], at[later].astype(np.int64)
        return marked_rows(docs, at, at + words, parts)

    return run


def remove_repeated_windows(docs: DataFrame, words: int = WINDOW_WORDS) -> DataFrame:
    """`doc_id, n_words, n_removed, n_spans, spans, kept_text` for every row of `docs`.

    A word goes when a window of `words` words that covers it also starts earlier: in a smaller doc_id, or
    sooner in the same document. Windows are judged on the input. `spans` are the maximal removed runs
    (first word, word past the last); kept words are joined by one space. NULL texts have no words; a text
    shorter than a window stays whole. NULL doc_ids come before all others. doc_id names a document: rows that
    repeat one are each cut where any of them is marked.
    """
    narrow = narrowed(docs)
    parts = shuffle_partitions(docs)
    marks = (
        narrow.mapInArrow(_window_hashes(parts, words), "bucket long, docs binary, at binary, hashes binary")
        .groupBy("bucket")
        .applyInArrow(_repeats(parts, words), MARKS)
    )
    return cut_documents(narrow, marks, parts, "word")
