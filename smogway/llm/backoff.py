"""Katz backoff scores: Good-Turing discounted word pairs that back off to discounted words and on to an unknown word.

`P(w | u)` is d_r * r / c(u) where the pair (u, w) was seen r times, else alpha(u) * P(w); `P(w)` is d_c * c / N where w
was seen, else what the discounts leave over, as one unknown word. alpha(u) makes the probabilities after u add up to
one exactly: what the discounts leave over after u, divided by the P(w) of all words never seen after u.

The counts are tables partitioned by word, then by first word of a pair. Every block of documents sends its distinct
words (later its distinct pairs) to the partitions as packed rows, in which equal keys of all blocks are added up, and
gets the counts of just those keys back. So a word or pair has one entry per block, however common it is; pairs after a
hot word are dealt by both words, and the few numbers of such a word are added up by a Spark aggregate. Nothing is
approximate: words travel as their bytes, pairs as the numbers of their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogway.llm.common import packed, shuffle_partitions, span_hashes, text_slices, unpacked, word_bounds
from smogway.sources.staging import stage

#: Counts above this are trusted as they are.
CUTOFF = 5
#: Text of a block, and of what meets in one bucket, in bytes.
BLOCK_BYTES, BUCKET_BYTES = 6_000_000, 32_000_000
#: Words with more than a bucket's share of all tokens over this are hot; there are never more hot words than HOT_WORDS.
HOT_SHARE, HOT_WORDS = 4, 65_536
#: Fixed values of the base score.
ADDED = 0.1
_END = b" "  # the end of a text as a word; no word has a space


def _pack(x: np.ndarray) -> bytes:
    """Whole numbers below 2**32, one plane of bytes after the other."""
    return packed(np.ascontiguousarray(x, np.uint32).view(np.uint8).reshape(-1, 4).T, level=3)


def _unpack(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(unpacked(raw, np.uint8).reshape(4, -1).T).view(np.uint32).ravel().astype(np.int64)


def _pack_rising(x: np.ndarray) -> bytes:
    return _pack(np.diff(x, prepend=0))


def _unpack_rising(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpack(raw))


def good_turing(n: np.ndarray) -> np.ndarray:
    """Discounts `d[0..CUTOFF + 1]`, the last for all larger counts, from how many keys were seen 1, ..., CUTOFF + 1 times.

    With fewer or odd counts of counts the cutoff is lowered until every discount lies in (0, 1]; if none does, 0.9 or
    less is taken from every count up to CUTOFF.
    """
    out = np.ones(CUTOFF + 2)
    n = np.concatenate([[0.0], np.asarray(n, np.float64)])
    for k in range(CUTOFF, 0, -1):
        if (n[1 : k + 2] <= 0).any():
            continue
        r = np.arange(1, k + 1)
        lost = (k + 1) * n[k + 1] / n[1]
        d = ((r + 1) * n[r + 1] / (r * n[r]) - lost) / (1 - lost) if lost < 1 else np.zeros(k)
        if ((d > 0) & (d <= 1)).all():
            out[1 : k + 1] = d
            return out
    taken = min(n[1] / (n[1] + 2 * n[2]), 0.9) if n[1] else 0.0
    r = np.arange(1, CUTOFF + 1)
    out[1 : CUTOFF + 1] = (r - taken) / r
    return out


class Words(NamedTuple):
    """Totals of the words: tokens N, distinct words V, discounts, what they are shares of, and the unknown word's share."""

    tokens: int
    distinct: int
    discounts: np.ndarray
    total: int
    unknown: float

    @staticmethod
    def of(tokens: int, distinct: int, n: np.ndarray) -> Words:
        d = good_turing(n)
        r = np.arange(1, CUTOFF + 1)
        left = float(((1 - d[r]) * r * n[:CUTOFF]).sum())
        if left > 0:
            return Words(tokens, distinct, d, tokens, left / tokens)
        return Words(tokens, distinct, d, tokens + 1, 1 / (tokens + 1))  # no count to discount: one more token, unknown

    def probability(self, c: np.ndarray) -> np.ndarray:
        """P(w) by count; 0 is the unknown word."""
        return np.where(c > 0, self.discounts[np.minimum(c, CUTOFF + 1)] * c / self.total, self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + ADDED) / (self.tokens + ADDED * (self.distinct + 1)))


# ---------------------------------------------------------------- words


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _flat(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some words and their offsets, from 0."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    raw = words.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _sorted_words(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The order of distinct words by their hashes, and the hashes so ordered."""
    data, offsets = _flat(words)
    hashes = span_hashes(data.astype(np.uint64) + np.uint64(1), offsets[:-1], offsets[1:])
    order = np.argsort(hashes, kind="stable")
    return order, hashes[order]


class _Block:
    """Documents of a task until they are enough for a row."""

    def __init__(self):
        self.dictionaries = [pa.array([_END], pa.large_binary())]
        self.codes, self.sizes, self.ids, self.held, self.bytes = [], [], [], [], 0

    def add(self, piece) -> None:
        data = piece.data + ((piece.data >= 65) & (piece.data <= 90)).astype(np.uint8) * np.uint8(32)
        starts, ends, count = word_bounds(data, piece.offsets)
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts] = 1
        np.add.at(inside, ends, -1)
        words = _binary(data[np.cumsum(inside[:-1], dtype=np.int8) > 0], ends - starts).dictionary_encode()
        base = sum(map(len, self.dictionaries))
        self.dictionaries.append(words.dictionary)
        codes = np.zeros(len(starts) + len(count), np.int64)
        is_word = np.ones(len(codes), bool)
        is_word[np.cumsum(count + 1) - 1] = False
        codes[is_word] = words.indices.to_numpy().astype(np.int64) + base
        self.codes.append(codes)
        self.sizes.append(count + 1)
        self.ids += piece.batch.column("doc_id").to_pylist()
        self.held += piece.batch.column("held_out").to_pylist()
        self.bytes += len(data)

    def row(self, key: int, buckets: int) -> pa.RecordBatch:
        merged = pa.concat_arrays(self.dictionaries).dictionary_encode()
        order, hashes = _sorted_words(merged.dictionary)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        codes = rank[merged.indices.to_numpy()][np.concatenate(self.codes)]
        sizes, held = np.concatenate(self.sizes), np.array(self.held, bool)
        trained = np.bincount(codes[np.repeat(~held, sizes)], minlength=len(order))
        words = merged.dictionary.take(pa.array(order))
        data, offsets = _flat(words)
        deal = _bucket_of(hashes, buckets)
        cuts = np.searchsorted(deal, np.arange(buckets + 1)).tolist()
        parts = [
            {"bucket": k, "words": packed(data[offsets[x] : offsets[y]], 3), "sizes": _pack(np.diff(offsets[x : y + 1])), "n": _pack(trained[x:y])}
            for k, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x
        ]
        return pa.RecordBatch.from_pylist([{
            "block": key, "end": int(rank[0]), "doc_id": self.ids, "held_out": self.held, "sizes": _pack(sizes), "codes": _pack(codes),
            "part_sizes": [p - q for q, p in zip(cuts, cuts[1:])], "parts": parts,
        }], _BLOCK_ARROW)


_BLOCK_ARROW = pa.schema([
    ("block", pa.int64()), ("end", pa.int32()), ("doc_id", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())),
    ("sizes", pa.binary()), ("codes", pa.binary()), ("part_sizes", pa.list_(pa.int32())),
    ("parts", pa.list_(pa.struct([("bucket", pa.int32()), ("words", pa.binary()), ("sizes", pa.binary()), ("n", pa.binary())]))),
])
_BLOCKS = (
    "block long, end int, doc_id array<bigint>, held_out array<boolean>, sizes binary, codes binary, part_sizes array<int>, "
    "parts array<struct<bucket:int,words:binary,sizes:binary,n:binary>>"
)


def _blocks(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = TaskContext.get().partitionId() << 32, _Block()
        for piece in text_slices(batches):
            block.add(piece)
            if block.bytes >= BLOCK_BYTES:
                yield block.row(key, buckets)
                key, block = key + 1, _Block()
        if block.ids:
            yield block.row(key, buckets)

    return run


_WORD_REPLIES = "block long, bucket int, ranks binary, counts binary, stats array<bigint>"
_STATS = -1  # stands for the block in the row of a bucket's own figures


def _counts_of_counts(c: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(c, CUTOFF + 2), minlength=CUTOFF + 3)[1 : CUTOFF + 2].tolist()


def _count_words(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Adds up the words of a bucket and answers every block: the words' numbers within the bucket, and their counts."""
    sizes = [_unpack(x) for x in table.column("sizes").to_pylist()]
    arrays = [_binary(unpacked(w, np.uint8), s) for w, s in zip(table.column("words").to_pylist(), sizes)]
    merged = pa.concat_arrays(arrays).dictionary_encode()
    which = merged.indices.to_numpy().astype(np.int64)
    order, _ = _sorted_words(merged.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    which = rank[which]
    count = np.zeros(len(order), np.int64)
    np.add.at(count, which, np.concatenate([_unpack(x) for x in table.column("n").to_pylist()]))
    cuts = np.append(0, np.cumsum(list(map(len, sizes))))
    stats = [int(count.sum()), int((count > 0).sum()), len(count), *_counts_of_counts(count)]
    replies = [(b, _pack_rising(which[x:y]), _pack_counts(count[which[x:y]]), None)
               for b, x, y in zip(table.column("block").to_pylist(), cuts, cuts[1:])]
    block, ranks, counts, figures = zip(*replies, (_STATS, None, None, stats))
    return pa.table({
        "block": pa.array(block, pa.int64()), "bucket": pa.array([key[0].as_py()] * len(block), pa.int32()),
        "ranks": pa.array(ranks, pa.binary()), "counts": pa.array(counts, pa.binary()), "stats": pa.array(figures, pa.list_(pa.int64())),
    })


def _pack_counts(c: np.ndarray) -> bytes:
    """Counts of any size, two words each where some need it."""
    return _pack(c) if not len(c) or c.max() < 2**32 else b"+" + _pack(np.concatenate([c & 0xFFFFFFFF, c >> 32]))


def _unpack_counts(raw: bytes) -> np.ndarray:
    if raw[:1] != b"+":
        return _unpack(raw)
    low, high = _unpack(raw[1:]).reshape(2, -1)
    return low + (high << 32)


# ---------------------------------------------------------------- pairs


class _Known:
    """A block read back, with the numbers and counts of its words."""

    def __init__(self, row: dict, buckets: int, stride: int, hot_above: int):
        self.sizes, self.codes = _unpack(row["sizes"]), _unpack(row["codes"])
        self.held = np.array(row["held_out"], bool)
        word_parts = np.array(row["part_sizes"], np.int64)
        self.word_bucket = np.repeat(np.arange(len(word_parts)), word_parts)
        replies = sorted(row["known"], key=lambda r: r["bucket"])
        self.id = np.concatenate([_unpack_rising(r["ranks"]) + r["bucket"] * stride for r in replies])
        self.count = np.concatenate([_unpack_counts(r["counts"]) for r in replies])
        previous = np.empty_like(self.codes)
        previous[1:] = self.codes[:-1]
        previous[np.cumsum(self.sizes) - self.sizes] = row["end"]
        self.previous = previous
        self.hot = self.count > hot_above
        self.buckets = buckets

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct pairs of two trained words as codes (u, w), and which of them each token has (-1: none)."""
        both = (self.count[self.previous] > 0) & (self.count[self.codes] > 0)
        distinct, inverse = np.unique(self.previous[both] << 32 | self.codes[both], return_inverse=True)
        of_token = np.full(len(self.codes), -1)
        of_token[both] = inverse
        return distinct >> 32, distinct & 0xFFFFFFFF, of_token

    def dealt(self, u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order of the pairs by bucket, and where each bucket begins in it.

        A pair lies in the bucket of its first word, after a hot word in that of both.
        """
        mix = (self.id[u].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (self.id[w].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        bucket = np.where(self.hot[u], _bucket_of(mix * np.uint64(0xD6E8FEB86659FD93), self.buckets), self.word_bucket[u])
        order = np.argsort(bucket, kind="stable")
        return order, np.searchsorted(bucket[order], np.arange(self.buckets + 1))


def _runs(x: np.ndarray) -> np.ndarray:
    """Where a new run of equal values begins."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)


_REQUESTS = "bucket int, block long, first binary, runs binary, hot binary, second binary, n binary, count binary"


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _request_pairs(buckets: int, stride: int, hot_above: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _read_rows(batches):
            block = _Known(row, buckets, stride, hot_above)
            u, w, of_token = block.pairs()
            trained = of_token[(of_token >= 0) & np.repeat(~block.held, block.sizes)]
            n = np.bincount(trained, minlength=len(u))
            order, cuts = block.dealt(u, w)
            for k, (x, y) in enumerate(zip(cuts, cuts[1:])):
                if y == x:
                    continue
                own = order[x:y]
                at = _runs(u[own])
                first = u[own[at]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([row["block"]], pa.int64()), *(pa.array([v], pa.binary()) for v in (
                        _pack_rising(block.id[first]), _pack(np.diff(np.append(at, y - x))), packed(block.hot[first].astype(np.uint8)),
                        _pack(block.id[w[own]]), _pack(n[own]), _pack_counts(block.count[w[own]]),
                    ))],
                    ["bucket", "block", "first", "runs", "hot", "second", "n", "count"],
                )

    return run


_PAIR_REPLIES = (
    "block long, bucket int, r binary, m binary, seen binary, stats array<bigint>, "
    "hot array<struct<word:bigint,m:array<bigint>,seen:double>>"
)
_HOT = pa.list_(pa.struct([("word", pa.int64()), ("m", pa.list_(pa.int64())), ("seen", pa.float64())]))


def _count_pairs(words: Words):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Adds up the pairs of a bucket and answers every block: how often each of its pairs was seen, and for each first
        word how many pairs were seen 1, ..., CUTOFF times and the P(w) of all words seen after it."""
        read = lambda name, f: [f(x) for x in table.column(name).to_pylist()]
        firsts, runs, hots = read("first", _unpack_rising), read("runs", _unpack), read("hot", lambda x: unpacked(x, np.uint8))
        keys = np.concatenate([np.repeat(f, r) << 32 for f, r in zip(firsts, runs)])
        sizes = [int(r.sum()) for r in runs]
        keys |= np.concatenate(read("second", _unpack))
        order = np.argsort(keys, kind="stable")  # runs of sorted keys, one per block
        at = _runs(keys[order])
        pair = np.empty(len(keys), np.int64)
        pair[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(keys))))
        r = np.add.reduceat(np.concatenate(read("n", _unpack))[order], at)
        p = words.probability(np.concatenate(read("count", _unpack_counts))[order[at]]) * (r > 0)
        first = keys[order[at]] >> 32
        del keys, order
        begin = _runs(first)
        m = np.stack([np.add.reduceat((r == i).astype(np.int64), begin) for i in range(1, CUTOFF + 1)])
        seen = np.add.reduceat(p, begin)
        first = first[begin]
        is_hot = np.zeros(len(first), bool)
        rows, cuts = [], np.append(0, np.cumsum(sizes))
        for block, own, hot, x, y in zip(table.column("block").to_pylist(), firsts, hots, cuts, cuts[1:]):
            place = np.searchsorted(first, own)
            is_hot[place[hot > 0]] = True
            rows.append((block, _pack_counts(r[pair[x:y]]), _pack_counts(m[:, place].ravel()), packed(seen[place]), None, None))
        hot = [{"word": int(first[i]), "m": m[:, i].tolist(), "seen": float(seen[i])} for i in np.flatnonzero(is_hot)]
        rows.append((_STATS, None, None, None, _counts_of_counts(r), hot))
        block, *columns = zip(*rows)
        kinds = (pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), _HOT)
        return pa.table(
            [pa.array(block, pa.int64()), pa.array([key[0].as_py()] * len(block), pa.int32()), *(pa.array(c, k) for c, k in zip(columns, kinds))],
            ["block", "bucket", "r", "m", "seen", "stats", "hot"],
        )

    return run


# ---------------------------------------------------------------- scores


def backoff_weights(c: np.ndarray, m: np.ndarray, seen: np.ndarray, discounts: np.ndarray, unknown: float) -> tuple[np.ndarray, np.ndarray]:
    """For first words seen `c` times: what their counts are shares of, and alpha.

    m[i - 1] pairs were seen i times; `seen` is the P(w) of all words seen after it. Where no pair has a count to
    discount, one more token, never seen, is counted after the word.
    """
    i = np.arange(1, CUTOFF + 1)[:, None]
    left = ((1 - discounts[i]) * i * m).sum(0)
    total = np.where(left > 0, c, c + 1)
    left = np.where(left > 0, left, 1.0)
    return total, left / np.maximum(total, 1) / np.maximum(1 - seen, unknown)


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score(words: Words, discounts: np.ndarray, buckets: int, stride: int, hot_above: int, hot: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _read_rows(batches):
            block = _Known(row, buckets, stride, hot_above)
            u, w, of_token = block.pairs()
            order, cuts = block.dealt(u, w)
            r = np.zeros(len(u) + 1, np.int64)  # the last: no pair of trained words
            m, seen = np.zeros((CUTOFF, len(block.count)), np.int64), np.zeros(len(block.count))
            for reply in row["pairs"]:
                own = order[cuts[reply["bucket"]] : cuts[reply["bucket"] + 1]]
                r[own] = _unpack_counts(reply["r"])
                first = u[own[_runs(u[own])]]
                m[:, first] = _unpack_counts(reply["m"]).reshape(CUTOFF, -1)
                seen[first] = unpacked(reply["seen"], np.float64)
            for code in np.flatnonzero(block.hot):
                m[:, code], seen[code] = hot.get(int(block.id[code]), (0, 0.0))
            total, alpha = backoff_weights(block.count, m, seen, discounts, words.unknown)
            alpha = np.where(block.count > 0, alpha, 1.0)
            times, context, count = r[of_token], block.previous, block.count[block.codes]
            with np.errstate(divide="ignore"):
                direct = np.log10(discounts[np.minimum(times, CUTOFF + 1)] * times / np.maximum(total[context], 1))
            found = np.where(times > 0, direct, np.log10(alpha)[context] + np.log10(words.probability(count)))
            at = np.cumsum(block.sizes) - block.sizes
            n_known, base, score = (np.add.reduceat(x, at) for x in ((count > 0).astype(np.int64), words.base(count), found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_id"], pa.int64()), pa.array(row["held_out"], pa.bool_()), pa.array(block.sizes),
                 pa.array(n_known), pa.array(base), pa.array(score)],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
            )

    return run


def holdout(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 10; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def _gathered(replies: DataFrame, name: str, *columns: str) -> DataFrame:
    return replies.where(F.col("block") != _STATS).groupBy("block").agg(F.collect_list(F.struct("bucket", *columns)).alias(name))


def _total(replies: DataFrame, size: int) -> np.ndarray:
    """The buckets' figures added up: one row."""
    sums = replies.where(F.col("block") == _STATS).agg(*(F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(size))).first()
    return np.array([x or 0 for x in sums], np.int64)


def score(docs: DataFrame, held_out: Column | None = None, block_share: int = HOT_SHARE) -> DataFrame:
    """`doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score` for every row of `docs`.

    The model learns from the rows where `held_out` (a column of `docs`; by default `holdout`) is not true and scores all:
    log10 of the probability of the text's words, A-Z lower-cased, and of its end; the first word follows an end. NULL and
    empty texts are one token, the end. Every row is a document of its own, whatever its doc_id; a NULL doc_id stays NULL.
    Without any training rows every token is the unknown word, with probability 1. Other columns are ignored.

    A block holds some 6 MB of text, whole documents, and a bucket what 32 MB of text send there, so neither grows with
    the input, whose bytes are added up first; a longer text is a block of its own. Words that make up more than a fourth
    of a bucket's share of all tokens (or 1 / 65,536 of them, if that is more) are hot. To the driver come the totals and
    the six numbers of each hot word, 65,536 at most. More than 2**32 numbered words raise.
    """
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(holdout(F.col("doc_id")) if held_out is None else held_out, F.lit(False)).alias("held_out"),
    )
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(min(shuffle_partitions(docs), 64), -(-size // BUCKET_BYTES))
    blocks = stage(narrow.mapInArrow(_blocks(buckets), _BLOCKS), "lm-blocks")

    parts = blocks.select("block", F.explode("parts").alias("p")).select("block", "p.*")
    word_counts = stage(parts.groupBy("bucket").applyInArrow(_count_words, _WORD_REPLIES), "lm-words")
    tokens, distinct, _, *n = _total(word_counts, 4 + CUTOFF).tolist()
    words = Words.of(tokens, distinct, np.array(n))
    stride = 1 + (word_counts.agg(F.max(F.col("stats")[2])).first()[0] or 0)
    if stride * buckets > 2**32:
        raise ValueError("more than 2**32 numbered words")
    hot_above = max(tokens // (buckets * block_share), tokens // HOT_WORDS, 1)

    known = blocks.drop("parts").join(_gathered(word_counts, "known", "ranks", "counts"), "block")
    requests = known.mapInArrow(_request_pairs(buckets, stride, hot_above), _REQUESTS)
    pair_counts = stage(requests.groupBy("bucket").applyInArrow(_count_pairs(words), _PAIR_REPLIES), "lm-pairs")
    discounts = good_turing(_total(pair_counts, CUTOFF + 1))
    hot_sums = (
        pair_counts.select(F.explode("hot").alias("h")).groupBy("h.word")
        .agg(*(F.sum(F.col("h.m")[i]).alias(f"m{i}") for i in range(CUTOFF)), F.sum("h.seen").alias("seen")).collect()
    )
    hot = {r.word: (np.array(r[1 : 1 + CUTOFF]), r.seen) for r in hot_sums}

    replies = _gathered(pair_counts, "pairs", "r", "m", "seen")
    rows = known.join(replies, "block", "left").withColumn("pairs", F.coalesce("pairs", F.expr(_NO_PAIRS)))
    scored = rows.mapInArrow(_score(words, discounts, buckets, stride, hot_above, hot), _SCORES)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


_NO_PAIRS = "cast(array() as array<struct<bucket:int,r:binary,m:binary,seen:binary>>)"
