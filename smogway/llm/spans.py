"""Bringing marked intervals back to their documents and cutting them out.

Intervals and whole texts are dealt by document into the same buckets; both travel compressed, many to a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogway.llm.common import give_back, group_starts, packed, public_id, text_slices, tidy, unpacked, word_bounds

MARKS = "deal long, docs binary, first binary, size binary"
_TEXTS = "deal long, docs binary, size binary, text binary"


def _deal(docs: np.ndarray, parts: int) -> np.ndarray:
    spread = docs.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return ((spread >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def marked_rows(docs: np.ndarray, first: np.ndarray, past: np.ndarray, parts: int) -> pa.Table:
    """Intervals of documents as MARKS, those that touch joined."""
    docs = np.ascontiguousarray(docs, np.int64)
    order = np.lexsort((first, docs, _deal(docs, parts)))
    docs, first, past = docs[order], first[order], past[order]
    if len(docs):  # starts ascend within a document, so the furthest end so far decides
        begin = np.zeros(len(docs), bool)
        begin[group_starts(docs)] = True
        base = np.cumsum(begin) * (int(past.max()) + 1)
        furthest = np.maximum.accumulate(base + past)
        begin[1:] |= (base + first)[1:] > furthest[:-1]
        at = np.flatnonzero(begin)
        past = (furthest - base)[np.append(at[1:], len(docs)) - 1]
        docs, first = docs[at], first[at]
    deal = _deal(docs, parts)
    at = group_starts(deal)
    cut = np.append(at, len(deal))
    rows = [(packed(docs[a:b]), packed(first[a:b].astype(np.uint32)), packed((past - first)[a:b].astype(np.uint32)))
            for a, b in zip(cut, cut[1:])]
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.table([pa.array(deal[at], pa.int64()), *(pa.array(c, pa.binary()) for c in columns)],
                    ["deal", "docs", "first", "size"])


def _texts(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches):
            ids = np.ascontiguousarray(piece.batch.column("doc_id").to_numpy(zero_copy_only=False), np.int64)
            deal = _deal(ids, parts)
            order = np.argsort(deal, kind="stable")
            at = group_starts(deal[order])
            cut = np.append(at, len(order))
            size = np.diff(piece.offsets)
            for a, b in zip(cut, cut[1:]):
                own = order[a:b]
                text = np.concatenate([piece.data[piece.offsets[i] : piece.offsets[i + 1]] for i in own])
                yield pa.RecordBatch.from_pydict({
                    "deal": [deal[own[0]]], "docs": [packed(ids[own])], "size": [packed(size[own])],
                    "text": [packed(text, level=3)],
                })

    return run


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for each size in turn."""
    total = int(size.sum())
    small = total < 2**31 and len(first) > 0 and int(first.max()) < 2**30
    out = np.repeat((first - (np.cumsum(size) - size)).astype(np.int32 if small else np.int64), size)
    out += np.arange(total, dtype=out.dtype)
    return out


def _cut(unit: str):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        marks, texts = [], []
        for d, f, s, t in zip(*(table.column(c).to_pylist() for c in ("docs", "first", "size", "text"))):
            if t is None:
                marks.append((unpacked(d, np.int64), unpacked(f, np.uint32), unpacked(s, np.uint32)))
            else:
                texts.append((unpacked(d, np.int64), unpacked(s, np.int64), t))
        if marks:
            m_docs, m_first, m_size = (np.concatenate(x) for x in zip(*marks))
            order = np.argsort(m_docs, kind="stable")
            m_docs, m_first = m_docs[order], m_first[order].astype(np.int64)
            m_past = m_first + m_size[order]
        else:
            m_docs = m_first = m_past = np.zeros(0, np.int64)
        out: dict[str, list] = {k: [] for k in ("doc_id", "n_units", "n_removed", "spans", "kept")}
        for ids, size, raw in texts:
            data = unpacked(raw, np.uint8)
            offsets = np.append(0, np.cumsum(size))
            if unit == "word":
                starts, ends, count = word_bounds(data, offsets)
            else:
                count = size
            base = np.append(0, np.cumsum(count))
            lo, hi = np.searchsorted(m_docs, ids, "left"), np.searchsorted(m_docs, ids, "right")
            row, of = np.repeat(np.arange(len(ids)), hi - lo), _ranges(lo, hi - lo)
            step = np.zeros(base[-1] + 1, np.int64)
            np.add.at(step, base[row] + np.minimum(m_first[of], count[row]), 1)
            np.add.at(step, base[row] + np.minimum(m_past[of], count[row]), -1)
            gone = np.cumsum(step)[:-1] > 0
            edge = gone.copy()  # a removed run begins or ends here, never across documents
            new = np.zeros(base[-1] + 1, bool)
            new[base] = True
            edge[1:] &= ~gone[:-1] | new[1:-1]
            final = gone.copy()
            final[:-1] &= ~gone[1:] | new[1:-1]
            runs = np.flatnonzero(edge), np.flatnonzero(final) + 1
            of_row = np.searchsorted(runs[0], base)
            sums = np.append(0, np.cumsum(gone))
            removed = sums[base[1:]] - sums[base[:-1]]
            if unit == "word":
                stay = np.flatnonzero(~gone)
                long = ends[stay] - starts[stay] + 1
                kept = np.append(data, np.uint8(32))[np.minimum(_ranges(starts[stay], long), len(data))]
                kept[np.cumsum(long) - 1] = 32
                cuts = np.append(0, np.cumsum(long))[base - sums[base]]
                tail = 1
            else:
                kept, cuts, tail = data[~gone], base - sums[base], 0
            whole = kept.tobytes()
            for i, doc in enumerate(ids.tolist()):
                r = slice(of_row[i], of_row[i + 1])
                out["doc_id"].append(doc)
                out["n_units"].append(int(count[i]))
                out["n_removed"].append(int(removed[i]))
                out["spans"].append([{"first": a, "past": b} for a, b in zip((runs[0][r] - base[i]).tolist(), (runs[1][r] - base[i]).tolist())])
                out["kept"].append(whole[cuts[i] : max(cuts[i], cuts[i + 1] - tail)])
        spans = pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))
        give_back()
        return pa.table({
            "doc_id": pa.array(out["doc_id"], pa.int64()), "n_units": pa.array(out["n_units"], pa.int64()),
            "n_removed": pa.array(out["n_removed"], pa.int64()), "spans": pa.array(out["spans"], spans),
            "kept": pa.array(out["kept"], pa.binary()),
        })

    return run


def cut_documents(narrow: DataFrame, marks: DataFrame, parts: int, unit: str) -> DataFrame:
    """`doc_id, n_<unit>s, n_removed, n_spans, spans, kept_text` (kept_bytes for bytes), a row per row of `narrow`."""
    texts = narrow.mapInArrow(tidy(_texts(parts)), _TEXTS)
    both = texts.withColumn("first", F.lit(None).cast("binary")).unionByName(
        marks.withColumn("text", F.lit(None).cast("binary"))
    )
    spans = "array<struct<first:bigint,past:bigint>>"
    done = both.groupBy("deal").applyInArrow(
        _cut(unit), f"doc_id long, n_units long, n_removed long, spans {spans}, kept binary"
    )
    kept = F.col("kept").cast("string").alias("kept_text") if unit == "word" else F.col("kept").alias("kept_bytes")
    return done.select(
        public_id(), F.col("n_units").alias(f"n_{unit}s"), "n_removed",
        F.size("spans").cast("long").alias("n_spans"), "spans", kept,
    )
