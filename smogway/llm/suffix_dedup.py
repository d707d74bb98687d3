"""Removing byte strings that an earlier document already has, by sorting suffixes.

Suffixes that begin with the same `length` bytes must meet. The smallest hash among the 20-byte grams of those
bytes (the anchor) depends on them alone, so all suffixes with one anchor go to one bucket, and a run of
neighbouring suffixes with one anchor travels as a single piece of text, about 16 suffixes long. In a bucket,
equal pieces need no sorting. Where an anchor has several pieces, their suffixes are sorted deep-shallow: multikey
quicksort on eight-byte characters to a shallow depth, then blind tries, built breadth-first for all
remaining groups at once, on the rest of the compared length. Anchors are sorted so many at a time that a worker's
memory does not depend on how many of a bucket's anchors have several pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogway.llm.common import (
    Slice,
    give_back,
    group_starts,
    mixed,
    narrowed,
    packed,
    shuffle_partitions,
    span_hashes,
    text_slices,
    tidy,
    unpacked,
)
from smogway.llm.spans import MARKS, _ranges, cut_documents, marked_rows

LENGTH = 50
_GRAM = 20
#: Bytes that multikey quicksort compares, eight at a time; blind tries take over below.
_SHALLOW = 32
#: A task gathers the pieces of about so many bytes of text before it deals them out; longer rows compress better.
_HELD_BYTES = 32_000_000
#: What a bucket gets the pieces of, in bytes of text; there are as many buckets as shuffle partitions at least.
BUCKET_BYTES = 20_000_000
#: A bucket sorts about so many suffixes at a time.
_SUFFIXES = 200_000


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as one big-endian number; zeros follow the end. A view: it takes no more room."""
    return np.ndarray(len(data), ">u8", np.append(data, np.zeros(8, np.uint8)), 0, (1,))


def _gram_hashes(eights: np.ndarray, at: np.ndarray | slice, size: int) -> np.ndarray:
    """Hashes of the 20 bytes from each position, from three overlapping loads."""
    e = lambda k: eights[k : k + size][at].astype(np.uint64)
    return mixed(mixed(mixed(e(0)) + e(8)) + e(12))


def _pack(x: np.ndarray) -> bytes:
    """Numbers as one plane of bytes after the other."""
    return packed(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T)


def _unpack(raw: bytes | pa.Buffer, dtype: type) -> np.ndarray:
    return np.ascontiguousarray(unpacked(raw, np.uint8).reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, span = values, 1
    while span < width:
        step = min(span, width - span)
        out = np.minimum(out[:-step], out[step:])
        span += step
    return out


class _Held(NamedTuple):
    """Pieces of some documents: `data` is their bytes, `begin` and `long` lie in it, `start` in document `ids[row]`."""

    data: np.ndarray
    ids: np.ndarray
    begin: np.ndarray
    long: np.ndarray
    anchor: np.ndarray
    same: np.ndarray
    bucket: np.ndarray
    row: np.ndarray
    start: np.ndarray


def _held(piece: Slice, parts: int, length: int) -> _Held | None:
    grams = length - _GRAM + 1
    data, offsets = piece.data, piece.offsets
    if len(data) < length:
        return None
    ids = np.ascontiguousarray(piece.batch.column("doc_id").to_numpy(zero_copy_only=False), np.int64)
    hashes = _gram_hashes(_eights(data), slice(None), len(data) - _GRAM + 1)
    low = _sliding_min(hashes, grams)  # the anchor of the suffix from each byte
    size = np.diff(offsets)
    usable = np.zeros(len(data) + 1, np.int32)
    np.add.at(usable, offsets[:-1], size >= length)
    np.add.at(usable, offsets[:-1] + np.maximum(size - length + 1, 0), -(size >= length).astype(np.int32))
    usable = np.cumsum(usable, dtype=np.int32)[: len(low)] > 0
    row = np.repeat(np.arange(len(size), dtype=np.int32), size)[: len(low)]
    begin = group_starts(low, usable, row)
    past = np.append(begin[1:], len(low))
    begin, past = begin[usable[begin]], past[usable[begin]]
    if not len(begin):
        return None
    spread = mixed(low[begin])
    rows = row[begin]
    return _Held(
        data, ids, begin.astype(np.uint32), (past - begin + length - 1).astype(np.uint32),
        hashes[begin[:, None] + np.arange(grams)].argmin(1).astype(np.uint8),
        span_hashes(hashes, begin, past + grams - 1),
        ((spread >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32),
        rows, (begin - offsets[rows]).astype(np.uint32),
    )


def _joined(held: list[_Held]) -> _Held:
    """All as one; `held` is left empty, so that no field stands there twice for long."""
    fields = [list(x) for x in zip(*held)]
    held.clear()
    for name, lists in (("begin", fields[0]), ("row", fields[1])):  # they count from the first document of all
        own = fields[_Held._fields.index(name)]
        for i, at in enumerate(np.cumsum([0, *map(len, lists)])[:-1]):
            own[i] = own[i] + own[i].dtype.type(at)
    for i, lists in enumerate(fields):
        fields[i] = np.concatenate(lists)
        lists.clear()
    return _Held(*fields)


def _dealt(held: list[_Held], parts: int) -> Iterator[pa.RecordBatch]:
    """A row per bucket: equal pieces share one text. Takes everything out of `held`."""
    data, ids, begin, long, anchor, same, bucket, row, start = _joined(held)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(parts + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        own = order[cuts[b] : cuts[b + 1]]
        _, first, nth = np.unique(same[own], return_index=True, return_inverse=True)
        new = np.zeros(len(own), bool)
        new[first] = True
        age = np.argsort(first)  # texts in the order of their first piece
        nth = np.argsort(age)[nth]
        kinds = own[first[age]]
        doc = ids[row[own]]
        at = group_starts(doc)
        since = np.diff(start[own], prepend=np.uint32(0))
        since[at] = start[own][at]
        yield pa.RecordBatch.from_pydict({
            "bucket": [b],
            "docs": [_pack(np.diff(doc[at].view(np.uint64), prepend=np.uint64(0)))],
            "times": [_pack(np.diff(np.append(at, len(own))).astype(np.uint32))],
            "start": [_pack(since)],
            "kind": [_pack((np.cumsum(new) - new - nth).astype(np.uint32))],  # 0 where a text is new
            "long": [_pack(long[kinds])],
            "anchor": [packed(anchor[kinds])],
            "text": [packed(data[_ranges(begin[kinds].astype(np.int64), long[kinds].astype(np.int64))], level=5)],
        })


def _pieces(parts: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[_Held] = []
        for piece in text_slices(batches, limit=500_000):
            if (more := _held(piece, parts, length)) is not None:
                held.append(more)
            if sum(len(h.data) for h in held) >= _HELD_BYTES:
                yield from _dealt(held, parts)
        if held:
            yield from _dealt(held, parts)

    return run


def sorted_classes(group: np.ndarray, at: np.ndarray, data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Deep-shallow sort of the strings data[at : at + length], within groups.

    Returns the order of those that are not alone, and the number of each one's class of equal strings in
    that order. Multikey quicksort steps drop a string as soon as nothing else shares its prefix.
    """
    eights = _eights(data)
    live, rank = np.arange(len(at)), group
    for depth in range(0, min(_SHALLOW, length - 7), 8):
        key = eights[at[live] + depth].astype(np.uint64)
        order = np.lexsort((key, rank))
        live, rank, key = live[order], rank[order], key[order]
        live, rank = _tied(live, rank, key)
    depth = min(_SHALLOW, length // 8 * 8)
    classes: list[np.ndarray] = []
    members: list[np.ndarray] = []
    # Blind tries: a group's first string is a path; every other leaves it at its first differing byte, known
    # only by (where, which byte). Those that leave alike form a subtree and take the next round.
    while len(live):
        begin = group_starts(rank)
        head = np.repeat(live[begin], np.diff(np.append(begin, len(live))))
        where = np.full(len(live), length)
        for d in range(depth, length, 8):
            keep = np.uint64(0xFFFFFFFFFFFFFFFF) << np.uint64(8 * max(0, d + 8 - length))
            differ = (eights[at[live] + d] ^ eights[at[head] + d]).astype(np.uint64) & keep
            new = np.flatnonzero((differ != 0) & (where == length))
            rest = differ[new]
            leading = np.zeros(len(new), np.int64)
            for bytes_ in (4, 2, 1):  # whole equal bytes at the front
                none = rest >> np.uint64(64 - 8 * bytes_) == 0
                leading += bytes_ * none
                rest = np.where(none, rest << np.uint64(8 * bytes_), rest)
            where[new] = d + leading
        equal = where == length
        members.append(live[equal])
        classes.append(head[equal])
        live, rank, where, head = live[~equal], rank[~equal], where[~equal], head[~equal]
        byte = data[at[live] + where].astype(np.int64)
        after = byte > data[at[head] + where]
        # in text order: what sorts before the path leaves it top-down, what sorts after it bottom-up
        order = np.lexsort((byte, np.where(after, -where, where), after, rank))
        live, rank, where, byte, after = live[order], rank[order], where[order], byte[order], after[order]
        live, rank = _tied(live, rank, where * 512 + byte * 2 + after)
    if not members:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found, heads = np.concatenate(members), np.concatenate(classes)
    order = np.argsort(heads, kind="stable")
    return found[order], heads[order]


def _tied(live: np.ndarray, rank: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of strings sorted by (rank, key), those that share both with another, ranked anew."""
    begin = group_starts(rank, key)
    size = np.diff(np.append(begin, len(live)))
    keep = np.repeat(size > 1, size)
    return live[keep], np.repeat(np.arange(len(begin)), size)[keep]


def _batches(sizes: np.ndarray, limit: int) -> Iterator[slice]:
    """Neighbours whose sizes add up to `limit` at most; a larger one is alone."""
    past, at = np.cumsum(sizes), 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(past, past[at] - sizes[at] + limit, "right")))
        yield slice(at, to)
        at = to


class _Bucket(NamedTuple):
    """Pieces that met: of an occurrence its document, `start` and the number `of` its text, of a text the `oldest` document
    and its `group`, the texts with its anchor, where it has several (else -1). Texts are in order of their anchors;
    `model` is a kind with that text. Kinds lie in the rows one after another: `sizes` says how many each row begins after,
    `longs` how long they are, `raws` has their packed bytes."""

    docs: np.ndarray
    start: np.ndarray
    of: np.ndarray
    oldest: np.ndarray
    group: np.ndarray
    model: np.ndarray
    long: np.ndarray
    sizes: np.ndarray
    raws: list[pa.Buffer]


def _bucket(table: pa.Table) -> _Bucket:
    docs, start, kind, anchors, sames, longs, raws = [], [], [], [], [], [], []
    before = 0
    columns = ("docs", "times", "start", "kind", "long", "anchor", "text")
    for d, n, s, k, g, a, t in zip(*(table.column(c) for c in columns)):
        times = _unpack(n.as_buffer(), np.uint32).astype(np.int64)
        docs.append(np.repeat(np.cumsum(_unpack(d.as_buffer(), np.uint64), dtype=np.uint64).view(np.int64), times))
        since, at = _unpack(s.as_buffer(), np.uint32), np.cumsum(times) - times
        total = np.cumsum(since, dtype=np.uint32)
        start.append(total - np.repeat(total[at] - since[at], times))
        back = _unpack(k.as_buffer(), np.uint32).astype(np.int64)
        new = back == 0
        kind.append((np.cumsum(new) - new - back + before).astype(np.int32))
        long, raw = _unpack(g.as_buffer(), np.uint32), t.as_buffer()
        data = unpacked(raw, np.uint8)
        edge, anchor = np.append(0, np.cumsum(long, dtype=np.int64)), unpacked(a.as_buffer(), np.uint8)
        for lo in range(0, len(long), 10_000):
            e = edge[lo : lo + 10_001]
            own, e = data[e[0] : e[-1]], e - e[0]
            anchors.append(_gram_hashes(_eights(own), e[:-1] + anchor[lo : lo + 10_000], len(own) - _GRAM + 1))
            sames.append(span_hashes(own.astype(np.uint64) + np.uint64(1), e[:-1], e[1:]))
        longs.append(long)
        raws.append(raw)
        before += len(long)
    sizes = np.cumsum([0, *map(len, longs)])
    anchor, same = np.concatenate(anchors), np.concatenate(sames)
    anchors.clear(), sames.clear()
    order = np.lexsort((same, anchor))
    begin = group_starts(anchor[order], same[order])
    text = np.empty(len(order), np.int32)  # of each kind, the number of its text
    text[order] = np.repeat(np.arange(len(begin), dtype=np.int32), np.diff(np.append(begin, len(order))))
    model = order[begin]
    group_at = group_starts(anchor[model])
    texts = np.diff(np.append(group_at, len(model)))
    group = np.repeat(np.where(texts > 1, np.arange(len(texts)), -1), texts)
    del anchor, same, order
    of = text[np.concatenate(kind)]
    docs = np.concatenate(docs)
    oldest = np.full(len(model), np.iinfo(np.int64).max)
    np.minimum.at(oldest, of, docs)
    return _Bucket(docs, np.concatenate(start), of, oldest, group, model, np.concatenate(longs), sizes, raws)


Marks = tuple[np.ndarray, np.ndarray, np.ndarray]


def _marks(found: _Bucket, length: int) -> Iterator[Marks]:
    """Documents, first bytes and ends of what an earlier document has too."""
    docs, start, of = found.docs, found.start, found.of
    several = found.group >= 0
    later = np.flatnonzero((docs > found.oldest[of]) & ~several[of])
    first = start[later].astype(np.int64)
    yield docs[later], first, first + found.long[found.model[of[later]]]
    del later, first
    chosen = np.flatnonzero(several)
    data, at = _texts_of(found.model[chosen], found)
    count = found.long[found.model[chosen]].astype(np.int64) - length + 1
    group, oldest = found.group[chosen], found.oldest[chosen]
    occurrences = np.flatnonzero(several[of])
    nth_text = np.searchsorted(chosen, of[occurrences])
    order = np.argsort(nth_text, kind="stable")
    occurrences, nth_text = occurrences[order], nth_text[order]
    begin = group_starts(group)
    edge = np.append(begin, len(group))
    for some in _batches(np.add.reduceat(count, begin) if len(begin) else begin, _SUFFIXES):
        a, b = edge[some.start], edge[some.stop]
        own = slice(*np.searchsorted(nth_text, (a, b)))
        earliest = _earliest(group[a:b], oldest[a:b], at[a:b] - at[a], count[a:b], data[at[a] : at[b]], length)
        yield from _later(earliest, count[a:b], nth_text[own] - a, docs[occurrences[own]], start[occurrences[own]], length)


def _earliest(
    group: np.ndarray, oldest: np.ndarray, at: np.ndarray, count: np.ndarray, data: np.ndarray, length: int
) -> np.ndarray:
    """The first document with each suffix of some texts; those of one group are all among them."""
    suffix, owner = _ranges(at, count), np.repeat(np.arange(len(count), dtype=np.int32), count)
    out = oldest[owner]
    shares = -(-len(suffix) // (2 * _SUFFIXES))  # above 1 for a single group: its suffixes are dealt by their first eight bytes
    if shares > 1:
        eights = _eights(data)
        share = np.concatenate([
            (mixed(eights[x].astype(np.uint64)) % np.uint64(shares)).astype(np.uint32)
            for x in np.array_split(suffix, shares)
        ])
    for i in range(shares):
        own = np.flatnonzero(share == i) if shares > 1 else np.arange(len(suffix))
        who, cls = sorted_classes(group[owner[own]], suffix[own], data, length)
        if len(who):
            who, at_cls = own[who], group_starts(cls)
            least = np.minimum.reduceat(out[who], at_cls)
            out[who] = np.repeat(least, np.diff(np.append(at_cls, len(cls))))
    return out


def _later(
    earliest: np.ndarray, count: np.ndarray, nth_text: np.ndarray, docs: np.ndarray, start: np.ndarray, length: int
) -> Iterator[Marks]:
    """Of texts with `count` suffixes each, the runs that occur after their earliest document."""
    base = np.cumsum(count) - count
    for some in _batches(count[nth_text], _SUFFIXES):
        texts = nth_text[some]
        n = count[texts]
        w = _ranges(base[texts], n)
        nth_of = np.repeat(np.arange(len(n), dtype=np.int32), n)
        hit = np.flatnonzero(earliest[w] < docs[some][nth_of])
        if not len(hit):
            continue
        row = nth_of[hit]
        nth = w[hit] - base[texts][row] + start[some][row].astype(np.int64)
        first = np.flatnonzero(np.append(True, (np.diff(nth) != 1) | (np.diff(row) != 0)))
        final = np.append(first[1:], len(hit)) - 1
        yield docs[some][row[first]], nth[first], nth[final] + length


def _texts_of(kinds: np.ndarray, found: _Bucket) -> tuple[np.ndarray, np.ndarray]:
    """The texts of some kinds, one after the other, and where each begins and the last ends."""
    size = found.long[kinds].astype(np.int64)
    at = np.append(0, np.cumsum(size))
    out = np.empty(at[-1], np.uint8)
    chunk = np.searchsorted(found.sizes, kinds, "right") - 1
    order = np.argsort(chunk, kind="stable")
    cut = np.append(group_starts(chunk[order]), len(order))
    for a, b in zip(cut, cut[1:]):
        own, c = order[a:b], chunk[order[a]]
        past = np.cumsum(found.long[found.sizes[c] : found.sizes[c + 1]], dtype=np.int64)
        begin = past[kinds[own] - found.sizes[c]] - size[own]
        out[_ranges(at[own], size[own])] = unpacked(found.raws[c], np.uint8)[_ranges(begin, size[own])]
    return out, at


def _repeats(parts: int, length: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        out = marked_rows(*(np.concatenate(x) for x in zip(*_marks(_bucket(table), length))), parts)
        give_back()
        return out

    return run


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`doc_id, n_bytes, n_removed, n_spans, spans, kept_bytes` for every row of `docs`.

    A byte goes when a string of `length` UTF-8 bytes that covers it also starts in a document with a smaller
    doc_id. Strings are judged on the input and never cross documents; repeats within a document stay. `spans`
    are the maximal removed runs (first byte, byte past the last). NULL texts are empty; a text shorter than
    `length` stays whole. NULL doc_ids count as one document before all others. doc_id names a document: rows
    that repeat one do not remove each other's bytes, and are each cut where any of them is marked. The bytes of all
    texts are added up first, so that no bucket grows with the input.
    """
    if length < 32:
        raise ValueError("length must be at least 32 bytes")
    narrow = narrowed(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(shuffle_partitions(docs), -(-size // BUCKET_BYTES))
    schema = "bucket long, docs binary, times binary, start binary, kind binary, long binary, anchor binary, text binary"
    pieces = narrow.mapInArrow(tidy(_pieces(parts, length)), schema)
    marks = pieces.groupBy("bucket").applyInArrow(_repeats(parts, length), MARKS)
    return cut_documents(narrow, marks, parts, "byte")
