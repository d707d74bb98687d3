"""SentencePiece encoding and decoding through a relational lattice.

Only distinct words pass through the lattice: texts are cut where no piece can span, and nowhere else. A task turns its documents into blocks: the distinct words of some
documents, dealt out to buckets by a hash, and each document as indices into them. A bucket meets the words of all
blocks, so each is there once; its substrings, up to the longest piece that may begin there, are exploded and equi-joined to the piece
table, the edges found are grouped by word again, and a higher-order aggregate folds them into the best path (Viterbi).
Exploding and joining with a broadcast table keep the order of rows, so the edges of a word, and the words of a bucket,
arrive together and are grouped as they come. The paths go back to their blocks, which read their documents off them.

Blocks are staged, as their numbering must not change when a task is run again, in a table that is bucketed by block. So
the documents stay where they are: what is shuffled is one packed row for each block and bucket, twice.

The path of least cost wins; of equal ones, that whose last piece is longest, and so on backwards. A unigram model's
scores are log-probabilities as they are. A BPE model has ranks instead; piece number r is then given Zipf's
probability, in proportion to 1 / (r + 2).
"""

from __future__ import annotations

import functools
import math
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogway.llm.common import give_back, group_starts, narrowed, packed, public_id, shuffle_partitions, text_slices, tidy, unpacked
from smogway.llm.spans import _ranges
from smogway.sources.staging import fresh_path, stage

SPACE = "▁"
#: Substrings of longer words are found in segments of so many characters, with as many more as a piece may reach;
#: edges pack an end within its segment into eight bits. The best path goes on from segment to segment.
SEGMENT = 96
BLOCK_WORDS = 1 << 18
BLOCK_TOKENS = 2_000_000
#: Words are cut so many at a time.
CUT_WORDS = 1 << 14
#: A bucket gets the distinct words of as many bytes of text, whatever the size of the input.
BUCKET_BYTES = 4_000_000
#: Substrings are exploded up to the longest piece with so many first characters in common.
PREFIX = 4
#: So many words of documents are written out at once.
OUT_TOKENS = 200_000
_BIAS = 1 << 21  # packed ids are shifted by this: below it stand characters to be written as bytes


@dataclass
class Pieces:
    """`table` has (piece, id, cost in thousandths of a nat); `bytes_of` what each id decodes to."""

    table: list[tuple[str, int, int]]
    bytes_of: list[bytes]
    byte_ids: list[int]
    byte_cost: int

    @property
    def spaced(self) -> list[tuple[str, int, int]]:
        """`table` with spaces for marks, as in texts; so a mark that is literally in a text is no piece and falls back to bytes."""
        return [(p.replace(SPACE, " "), i, c) for p, i, c in self.table]

    @property
    def pairs(self) -> np.ndarray:
        """Neighbouring characters of all pieces, as sorted numbers. No piece spans a pair that is not among them."""
        return np.unique(np.array([ord(a) << 32 | ord(b) for p, _, _ in self.spaced for a, b in zip(p, p[1:])], np.uint64))

    @property
    def longest(self) -> int:
        return max(len(p) for p, _, _ in self.table)

    @property
    def longest_by_prefix(self) -> dict[str, int]:
        """How long pieces with the same first characters get."""
        out: dict[str, int] = {}
        for p, _, _ in self.spaced:
            if len(p) >= PREFIX:
                out[p[:PREFIX]] = max(len(p), out.get(p[:PREFIX], 0))
        return out


def read_pieces(path: str) -> Pieces:
    """The pieces of a SentencePiece model file with byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.vocab_size()
    ordinary = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    scores = {i: model.get_score(i) for i in ordinary}
    ranked = all(s == int(s) for s in scores.values())
    first = min(ordinary)
    cost = {i: math.log(i - first + 2) if ranked else -s for i, s in scores.items()}
    worst = max(cost.values())
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    bytes_of = [b""] * n
    for i in ordinary:
        bytes_of[i] = model.id_to_piece(i).replace(SPACE, " ").encode()
    for b, i in enumerate(byte_ids):
        bytes_of[i] = bytes([b])
    low = min(0.0, min(cost.values()))
    return Pieces([(model.id_to_piece(i), i, round(1000 * (cost[i] - low))) for i in ordinary], bytes_of, byte_ids,
                  round(1000 * (worst - low + 2)))


_WHITE = "\x20\x09\x0A\x0B\x0C\x0D"


def _splitter(pairs: np.ndarray) -> Callable[[str], list[str]]:
    """Splits a text before a white space character, or after one, only where no piece has both neighbours.

    A first, coarse cut, so that few distinct words reach _cut.
    """
    both = [(chr(p >> 32), chr(p & 0xFFFFFFFF)) for p in pairs.tolist()]
    last = "".join(w for w in _WHITE if not any(a == w and b not in _WHITE for a, b in both))
    ways = [(f"(?<![{re.escape(last)}])" if last else "") + f"[^{_WHITE}]+"]
    for w in _WHITE:
        before = "".join(re.escape(a) for a, b in both if b == w)
        if before:
            ways.append(f"(?<=[{before}]){re.escape(w)}")
    return re.compile(f"(?s:.)(?:{'|'.join(ways)})*").findall


_BLOCKS = "block long, bucket int, body binary"


def _sealed(parts: list[bytes]) -> bytes:
    """Several byte strings as one; a column of lists with NULLs makes Spark's writer of Arrow batches slow."""
    return b"".join([np.array([len(parts), *map(len, parts)], np.int64).tobytes(), *parts])


def _opened(raw: bytes) -> list[bytes]:
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    to = 8 * (n + 1) + np.append(0, np.cumsum(np.frombuffer(raw, np.int64, n, 8)))
    return [raw[a:b] for a, b in zip(to, to[1:])]


def _rows(rows: list[tuple[int, int, list[bytes]]]) -> pa.RecordBatch:
    block, bucket, body = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(block, pa.int64()), pa.array(bucket, pa.int32()), pa.array([_sealed(b) for b in body], pa.binary())],
        ["block", "bucket", "body"],
    )


def _cut(words: list[str], pairs: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct parts of words, the parts of all words as indices, and how many each word has.

    Words are cut where no piece can span, which leaves their best paths as they are; some at a time, as their characters
    take many times the room of the words.
    """
    known: dict[str, int] = {}
    parts, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo in range(0, len(words), CUT_WORDS):
        own = words[lo : lo + CUT_WORDS]
        text = "".join(own)
        chars = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
        to = np.append(0, np.cumsum(np.fromiter(map(len, own), np.int64, len(own))))
        pair = chars[:-1] << np.uint64(32) | chars[1:]
        found = np.searchsorted(pairs, pair)
        edge = np.zeros(len(chars) + 1, bool)
        edge[1:-1] = np.append(pairs, np.uint64(0))[found] != pair
        edge[to] = True
        at = np.flatnonzero(edge)
        spans = zip(at.tolist(), at[1:].tolist())
        parts.append(np.fromiter((known.setdefault(text[x:y], len(known)) for x, y in spans), np.int64, len(at) - 1))
        sizes.append(np.diff(np.searchsorted(at, to)))
    return list(known), np.concatenate(parts), np.concatenate(sizes)


def _blocks(buckets: int, pairs: np.ndarray):
    """A block's documents as bucket -1: their ids, their words each, and the words as indices, byte plane by byte
    plane. Its words as one row for each bucket; the indices number them bucket by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        known: dict[str, int] = {}
        ids, sizes, tokens, total = [], [], [], 0
        split = _splitter(pairs)

        def flushed() -> Iterator[pa.RecordBatch]:
            parts, of_word, n_parts = _cut(list(known), pairs)
            words = [w.encode() for w in parts]
            bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
            order = np.argsort(bucket, kind="stable")
            number = np.empty(len(words), np.uint32)
            number[order] = np.arange(len(words), dtype=np.uint32)
            whole = np.concatenate([np.zeros(0, np.uint32), *tokens])
            indices = number[of_word[_ranges((np.cumsum(n_parts) - n_parts)[whole], n_parts[whole])]]
            wide = np.diff(np.append(0, np.cumsum(n_parts[whole]))[np.append(0, np.cumsum(np.array(sizes, np.int64)))])
            yield _rows([(at, -1, [packed(np.array(ids, np.int64)), packed(wide), _planes(indices)])])
            starts = group_starts(bucket[order])
            dealt = [
                # 0xFF is in no UTF-8 text
                (at, int(bucket[order[a]]), [packed(np.frombuffer(b"\xff".join(words[i] for i in order[a:b]), np.uint8))])
                for a, b in zip(starts, np.append(starts[1:], len(order)))
            ]
            if dealt:
                yield _rows(dealt)

        for piece in text_slices(batches, limit=500_000):
            raw, off = piece.data.tobytes(), piece.offsets.tolist()
            for doc, a, b in zip(piece.batch.column("doc_id").to_pylist(), off, off[1:]):
                own = [known.setdefault(w, len(known)) for w in split(raw[a:b].decode())]
                ids.append(doc)
                sizes.append(len(own))
                tokens.append(np.array(own, np.uint32))
                total += len(own)
                if len(known) >= BLOCK_WORDS or total >= BLOCK_TOKENS:
                    yield from flushed()
                    at += 1
                    known = {}
                    ids, sizes, tokens, total = [], [], [], 0
        if ids:
            yield from flushed()

    return run


def _staged_by_block(rows: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """`rows` written once; the second frame reads them as a table in `n` parts by block, which meets others by block unshuffled."""
    spark, path = rows.sparkSession, fresh_path(rows.sparkSession, "lattice-blocks")
    name = f"spark_catalog.default.lattice_blocks_{uuid.uuid4().hex}"
    rows.write.format("parquet").bucketBy(n, "block").option("path", path).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only the name: the files are external
    return spark.read.schema(rows.schema).parquet(path), table


def _planes(values: np.ndarray) -> bytes:
    return packed(values.astype(np.uint32).view(np.uint8).reshape(-1, 4).T)


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(unpacked(raw, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()


def _segments(words: list[str], reach: int) -> pa.Array:
    """Words in segments, numbered (word << 24 | segment); each has `own` characters and up to `reach` after them."""
    number, text, own = [], [], []
    for i, word in enumerate(words):
        for k, at in enumerate(range(0, len(word), SEGMENT)):
            number.append(i << 24 | k)
            text.append(word[at : at + SEGMENT + reach])
            own.append(min(SEGMENT, len(word) - at))
    return pa.StructArray.from_arrays([pa.array(number, pa.int64()), pa.array(text, pa.string()), pa.array(own, pa.int32())], ["word", "text", "own"])


_SEGMENTS = "block long, words array<struct<word:bigint,text:string,own:int>>, body binary"


def _distinct(reach: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each bucket, from its rows in order: its words, once each, and the words of every block as indices.

    Word 0 carries the blocks: the bucket, their numbers, their words each and the indices.
    """
    bucket, known = -1, {}
    blocks, sizes, tokens = [], [], []

    def flushed() -> pa.RecordBatch:
        body = [packed(np.array([bucket])), packed(np.array(blocks, np.int64)), packed(np.array(sizes, np.int64)),
                _planes(np.concatenate(tokens))]
        words = _segments(["\n", *(w.decode() for w in known)], reach)
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int64()), pa.ListArray.from_arrays([0, len(words)], words), pa.array([_sealed(body)], pa.binary())],
            ["block", "words", "body"],
        )

    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != bucket:
                if blocks:
                    yield flushed()
                bucket, known = row["bucket"], {}
                blocks, sizes, tokens = [], [], []
            words = unpacked(_opened(row["body"])[0], np.uint8).tobytes().split(b"\xff")
            tokens.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint32, len(words)))
            blocks.append(row["block"])
            sizes.append(len(words))
    if blocks:
        yield flushed()


def _edges(words: DataFrame, pieces: Pieces) -> DataFrame:
    """`block, word, edges, body` from (block, word, text, own, body): every piece in every word, by its end, packed into one number.

    An edge is its end in its segment (8 bits), 255 less its length (8), id (24, biased) and cost (23). A character that
    is no piece itself has an edge to its bytes, with -1 less its code point for an id. The edges of a word are
    grouped by end, the ends by SEGMENT.
    """
    spark = words.sparkSession
    table = spark.createDataFrame(pieces.spaced, "piece string, id int, cost int")
    bounds = spark.createDataFrame(list(pieces.longest_by_prefix.items()), "prefix string, longest int")
    chars = words.withColumn("n", F.char_length("text")).select(
        "block", "word", "text", "body", "n", F.explode(F.sequence(F.lit(1), F.col("own"))).alias("i")
    )
    # both tables have at most as many rows as the vocabulary
    bounded = chars.join(F.broadcast(bounds), F.substring("text", F.col("i"), F.lit(PREFIX)) == F.col("prefix"), "left")
    limit = F.least(F.coalesce("longest", F.lit(PREFIX - 1)), F.col("n") - F.col("i") + 1)
    found = bounded.select(
        "block", "word", "text", "body", "i", F.explode(F.sequence(F.lit(1), limit)).alias("size")
    ).withColumn("part", F.substring("text", F.col("i"), F.col("size")))
    joined = found.join(F.broadcast(table), F.col("part") == F.col("piece"), "left").where("id IS NOT NULL OR size = 1")
    code = F.coalesce(F.col("id"), -1 - F.ascii("part"))
    cost = F.coalesce(F.col("cost"), F.octet_length("part") * pieces.byte_cost)
    edge = (
        F.shiftleft((F.col("i") + F.col("size") - 1).cast("long"), 55)
        .bitwiseOR(F.shiftleft((F.lit(255) - F.col("size")).cast("long"), 47))
        .bitwiseOR(F.shiftleft((code + _BIAS).cast("long"), 23))
        .bitwiseOR(cost.cast("long"))
    )
    return joined.select("block", "word", edge.alias("edge"), "body").mapInArrow(
        tidy(_grouped), "block long, word long, edges array<array<array<bigint>>>, body binary"
    )


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per word from rows of edges that come word by word; a word may go on in the next batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        block, word = batch.column("block").to_numpy(), batch.column("word").to_numpy() >> 24
        at = group_starts(block, word)
        if len(at) > 1 or held and (held[0].column("block")[-1].as_py(), held[0].column("word")[-1].as_py() >> 24) != (block[0], word[0]):
            rows = pa.Table.from_batches([*held, batch.slice(0, at[-1])])
            yield _words_of(rows)
            held = []
        held.append(batch.slice(at[-1]) if not held else batch)
    if held:
        yield _words_of(pa.Table.from_batches(held))


def _words_of(rows: pa.Table) -> pa.RecordBatch:
    rows = rows.combine_chunks()
    block, number, edge = (rows.column(c).to_numpy() for c in ("block", "word", "edge"))
    at = group_starts(block, number >> 24)
    word = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(rows))))
    end = (number & 0xFFFFFF) * SEGMENT + (edge >> 55)
    end += word * (int(end.max()) + 1)
    order = np.argsort(end, kind="stable")
    ends = group_starts(end[order])  # a character alone is always an edge, so every position ends one
    by_end = pa.ListArray.from_arrays(pa.array(np.append(ends, len(rows)), pa.int32()), pa.array(edge[order]))
    of_word = np.append(np.searchsorted(ends, at), len(ends))
    chunks = -(-np.diff(of_word) // SEGMENT)
    of_chunk = np.repeat(of_word[:-1], chunks) + SEGMENT * _ranges(np.zeros(len(chunks), np.int64), chunks)
    by_chunk = pa.ListArray.from_arrays(pa.array(np.append(of_chunk, len(ends)), pa.int32()), by_end)
    first = rows.take(pa.array(at)).combine_chunks().to_batches()[0]
    return pa.RecordBatch.from_arrays(
        [first.column("block"), pa.array(number[at] >> 24),
         pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(chunks)), pa.int32()), by_chunk), first.column("body")],
        ["block", "word", "edges", "body"],
    )


def _field(x: Column, low: int, bits: int) -> Column:
    return F.shiftrightunsigned(x, low).bitwiseAND(F.lit((1 << bits) - 1))


def _viterbi(edges: Column) -> Column:
    """For each position of a word, the best way to reach it: cost (31 bits), 255 less the length of its last piece (8)
    and biased id (24), packed.

    Costs count from the end of the chunk before, where a chunk follows another, so they stay small in words of any
    length. A piece is no longer than a chunk, so the ways of one chunk are all that the next needs.
    """
    cost_only = F.lit(-1 << 32)

    def way(best: Column, e: Column) -> Column:
        before = F.element_at(best, (_field(e, 47, 8) - 255).cast("int")).bitwiseAND(cost_only)
        # length and id stand together in an edge as they do in a way
        return before + F.shiftleft(_field(e, 0, 23), 32) + _field(e, 23, 32)

    def followed(chunks: Column, ends: Column) -> Column:
        last = F.element_at(chunks, -1)
        base = F.element_at(last, -1).bitwiseAND(cost_only)
        best = F.aggregate(
            ends, F.transform(last, lambda w: w.bitwiseAND(cost_only) - base),
            lambda best, ways: F.array_append(best, F.array_min(F.transform(ways, lambda e: way(best, e)))),
        )
        return F.array_append(chunks, F.slice(best, F.size(last) + 1, F.size(ends)))

    return F.flatten(F.aggregate(edges, F.array(F.array(F.lit(0).cast("long"))), followed))


def _read_back(pieces: Pieces):
    """Ids of each block's words, from the best ways of a bucket's words; of its documents; and the text they decode to."""
    lengths = np.array([len(b) for b in pieces.bytes_of], np.int64)
    joined = np.frombuffer(b"".join(pieces.bytes_of), np.uint8)
    begins = np.cumsum(lengths) - lengths
    byte_ids = np.array(pieces.byte_ids, np.int32)

    def of_block(table: pa.Table) -> pa.RecordBatch:
        word = table.column("word").to_numpy()
        best = table.column("best").combine_chunks()
        size = np.asarray(best.value_lengths()).astype(np.int64)
        flat = best.flatten().to_numpy()
        first = np.cumsum(size) - size
        at, rows, found = size - 1, np.arange(len(word)), []
        live = np.flatnonzero(at > 0)
        while len(live):  # one step back along the best path of every word at once
            way = flat[first[live] + at[live]]
            found.append((live, (way & 0xFFFFFF) - _BIAS))
            at[live] -= 255 - ((way >> 24) & 0xFF)
            live = live[at[live] > 0]
        who = np.concatenate([np.zeros(0, np.int64)] + [w for w, _ in found])[::-1]
        ids = np.concatenate([np.zeros(0, np.int64)] + [i for _, i in found])[::-1]
        order = np.argsort(word[who], kind="stable")  # the reversed steps of a word are its path from the front
        who, ids = word[who][order], ids[order]
        codes = np.flatnonzero(ids < 0)
        if len(codes):  # characters that become bytes
            chars, nth = np.unique(-1 - ids[codes], return_inverse=True)
            raw = [chr(c).encode() for c in chars.tolist()]
            wide = np.array([len(r) for r in raw])
            times = np.ones(len(ids), np.int64)
            times[codes] = wide[nth]
            put = np.repeat(np.cumsum(times) - times, times)
            out = np.repeat(ids, times)
            step = np.arange(len(out)) - put
            lookup = np.zeros((len(raw), 4), np.int64)
            for k, r in enumerate(raw):
                lookup[k, : len(r)] = byte_ids[list(r)]
            kind = np.zeros(len(ids), np.int64)
            kind[codes] = nth
            kind = np.repeat(kind, times)
            ids, who = np.where(out < 0, lookup[kind, np.minimum(step, 3)], out), np.repeat(who, times)
        per_word = np.bincount(who, minlength=int(word.max()) + 1)
        starts = np.cumsum(per_word) - per_word
        body = _opened(table.column("body")[0].as_py())  # word 0 comes first
        bucket, blocks, sizes = (unpacked(x, np.int64) for x in body[:3])
        words = _from_planes(body[3]).astype(np.int64) + 1
        to = np.cumsum(sizes)
        out = []
        for block, a, b in zip(blocks.tolist(), to - sizes, to):
            own = words[a:b]
            out.append((block, int(bucket[0]), [_planes(per_word[own]), _planes(ids[_ranges(starts[own], per_word[own])])]))
        return _rows(out)

    def documents(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        """From a block's row of documents and its rows of paths, in the order of their buckets."""
        first, *rest = (_opened(r["body"]) for r in rows)
        docs, sizes = (unpacked(x, np.int64) for x in first[:2])
        words = _from_planes(first[2])
        per_word = np.concatenate([np.zeros(0, np.uint32), *(_from_planes(x[0]) for x in rest)]).astype(np.int64)
        ids = np.concatenate([np.zeros(0, np.uint32), *(_from_planes(x[1]) for x in rest)]).astype(np.int32)
        starts = np.cumsum(per_word) - per_word
        to = np.append(0, np.cumsum(sizes))
        at = 0
        while at < len(docs):
            end = max(at + 1, int(np.searchsorted(to, to[at] + OUT_TOKENS, "right")) - 1)
            own = words[to[at] : to[end]]
            token_ids = ids[_ranges(starts[own], per_word[own])]
            ends = np.append(0, np.cumsum(per_word[own]))[to[at : end + 1] - to[at]]
            ids_of = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(token_ids))
            yield pa.RecordBatch.from_arrays([pa.array(docs[at:end]), ids_of], ["doc_id", "ids"])
            at = end

    def assembled(docs: pa.Table, paths: pa.Table) -> pa.Table:
        rows = [*docs.to_pylist(), *sorted(paths.to_pylist(), key=lambda row: row["bucket"])]
        return pa.Table.from_batches(documents(rows))

    def both(docs: pa.Table, paths: pa.Table) -> pa.Table:
        out = pa.Table.from_batches(decode(iter(assembled(docs, paths).to_batches())))
        give_back()
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            block = batch.column("block").to_numpy()
            at = group_starts(block)
            for a, b in zip(at, np.append(at[1:], len(block))):
                if held and held[0].column("block")[0].as_py() != block[a]:
                    yield of_block(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield of_block(pa.Table.from_batches(held))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("ids").fill_null([]) if batch.column("ids").null_count else batch.column("ids")
            for lo in range(0, batch.num_rows, 500):
                part = own.slice(lo, 500)
                ids = part.flatten().to_numpy(zero_copy_only=False)
                ends = np.append(0, np.cumsum(lengths[ids]))[np.append(0, np.cumsum(np.asarray(part.value_lengths())))]
                text = joined[_ranges(begins[ids], lengths[ids])].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, 500) for c in batch.columns), pa.array([text[a:b] for a, b in zip(ends, ends[1:])], pa.binary())],
                    [*batch.schema.names, "decoded"],
                )

    return run, decode, assembled, both


@contextmanager
def _small_batches(docs: DataFrame) -> Iterator[None]:
    """Texts go to Python by a thousand rows: a batch stands in both processes, beside the words of a block."""
    conf, setting = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(setting)
    conf.set(setting, str(min(int(before), 1000) if int(before) > 0 else 1000))
    try:
        yield
    finally:
        conf.set(setting, before)


def encode(docs: DataFrame, pieces: Pieces, decoded: bool = False) -> DataFrame:
    """`doc_id, ids` for every row of `docs`; decode() gives back exactly the text.

    `decoded` adds what decode() would, in the same Python worker.

    There is no normalisation and no mark before the first word. NULL and empty texts have no ids. Repeated rows get the
    same ids; NULL doc_ids are kept.
    """
    if pieces.longest > SEGMENT:
        raise ValueError(f"pieces have at most {SEGMENT} characters")
    n = shuffle_partitions(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(n, -(-size // BUCKET_BYTES))
    run, _, assembled, both = _read_back(pieces)
    with _small_batches(docs):
        blocks, by_block = _staged_by_block(narrowed(docs).mapInArrow(tidy(_blocks(n_buckets, pieces.pairs)), _BLOCKS), n)
    buckets = blocks.where("bucket >= 0").repartition(n_buckets, "bucket").sortWithinPartitions("bucket", "block")
    # written, so that no task has three Python workers one after the other
    distinct = stage(buckets.mapInArrow(tidy(functools.partial(_distinct, pieces.longest - 1)), _SEGMENTS), "lattice-words")
    words = (
        distinct.select("block", F.inline("words"), "body")
        .withColumn("body", F.when(F.col("word") == 0, F.col("body")).otherwise(F.lit(b"")))
    )
    paths = _edges(words, pieces).select("word", "block", _viterbi(F.col("edges")).alias("best"), "body").mapInArrow(tidy(run), _BLOCKS)
    # a block whose texts are all empty has no paths
    whole = by_block.where("bucket = -1").groupBy("block").cogroup(paths.groupBy("block"))
    if decoded:
        return whole.applyInArrow(both, "doc_id long, ids array<int>, decoded binary").select(public_id(), "ids", "decoded")
    return whole.applyInArrow(assembled, "doc_id long, ids array<int>").select(public_id(), "ids")


def decode(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """`encoded` with `decoded`, the bytes that `ids` stand for; NULL ids decode to nothing."""
    _, run, _, _ = _read_back(pieces)
    return encoded.mapInArrow(run, T.StructType([*encoded.schema, T.StructField("decoded", T.BinaryType())]))
