"""Which tokens of two tokenizers overlap in the same text, and how common each overlapping pair of ids is.

Token starts and ends are byte offsets of the text with a space before it. Per batch and keyed by document,
`pandas.merge_asof` finds for every token start of one side the token of the other side that covers it. Two ranges
overlap exactly when one of them covers the start of the other, so the union of both directions is all overlaps.
Where two tokens end at the same byte, a group ends.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogway.llm.common import packed, text_slices, unpacked
from smogway.sources.staging import stage

#: Texts are aligned in slices of about so many bytes, and their id pairs gathered over blocks of so many.
ALIGNED_BYTES, BLOCK_BYTES = 1_000_000, 8_000_000
#: Fixed value: the pattern by which this family of byte-level vocabularies splits texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: For some texts: the ids of all of them, one after another, and how many each has.
Encoder = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


class Side(NamedTuple):
    """A tokenizer as it travels to the tasks: its file's bytes; `build` makes the encoder and the bytes of every id."""

    data: bytes
    build: Callable[[bytes], tuple[Encoder, list[bytes]]]


def _joined(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((i for ids in lists for i in ids), np.int64, int(sizes.sum())), sizes


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _byte_level(data: bytes) -> tuple[Encoder, list[bytes]]:
    """A byte-level BPE from its JSON file; the text is encoded with a space before it.

    The file's merges are in the order of their results' ids, so ids are ranks, and an encoder that merges by rank gives
    the same ids several times faster. Files for which that does not hold are refused.
    """
    file = json.loads(data)
    alphabet = _byte_alphabet()
    special = {t["content"] for t in file["added_tokens"] if t["special"]}
    ranks = {bytes(map(alphabet.__getitem__, t)): i for t, i in file["model"]["vocab"].items() if t not in special}
    made = [ranks[bytes(map(alphabet.__getitem__, "".join(m if isinstance(m, list) else m.split(" "))))] for m in file["model"]["merges"]]
    if made != sorted(made) or file["normalizer"] is not None or file["pre_tokenizer"]["type"] != "ByteLevel":
        raise ValueError("not a plain byte-level BPE whose merges are ordered by id")
    by_rank = tiktoken.Encoding("byte level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    table = [b""] * (max(ranks.values()) + 1)
    for t, i in ranks.items():
        table[i] = t
    return lambda texts: _joined([by_rank.encode_ordinary(" " + t) for t in texts]), table


def _pieces(data: bytes) -> tuple[Encoder, list[bytes]]:
    """A SentencePiece model, which puts a space before the text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=data)
    table = []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        table.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return lambda texts: _joined(model.encode(texts, num_threads=1)), table


def read_byte_level(path: str) -> Side:
    with open(path, "rb") as file:
        return Side(file.read(), _byte_level)


def read_pieces(path: str) -> Side:
    with open(path, "rb") as file:
        return Side(file.read(), _pieces)


def overlaps(doc_a: np.ndarray, start_a: np.ndarray, doc_b: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (index of a, index of b) of overlapping tokens, sorted.

    Starts ascend and both sides cover the same bytes of each document without gaps, so the token that covers a byte
    is the last one that starts at or before it.
    """
    if not len(start_a):
        return start_a, start_b
    a = pd.DataFrame({"at": start_a, "doc": doc_a, "a": np.arange(len(start_a))})
    b = pd.DataFrame({"at": start_b, "doc": doc_b, "b": np.arange(len(start_b))})
    b_at_a = pd.merge_asof(a, b, on="at", by="doc")["b"].to_numpy()
    a_at_b = pd.merge_asof(b, a, on="at", by="doc")["a"].to_numpy()
    inner = start_a[a_at_b] != start_b  # equal starts are found from both sides
    first = np.concatenate([a["a"].to_numpy(), a_at_b[inner]])
    second = np.concatenate([b_at_a, b["b"].to_numpy()[inner]])
    order = np.argsort(first + second, kind="stable")  # from one overlap to the next at least one index grows, none shrinks
    return first[order], second[order]


class _Texts(NamedTuple):
    """What alignment says of some documents: per document, and per distinct linked pair of a document."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str | None]
    pair_doc: np.ndarray
    pair: np.ndarray
    pair_links: np.ndarray


class Aligner:
    """Both tokenizers, ready in a task."""

    def __init__(self, a: Side, b: Side):
        (self.encode_a, table_a), (self.encode_b, table_b) = a.build(a.data), b.build(b.data)
        self.bytes_a, self.bytes_b = pa.array(table_a, pa.large_binary()), pa.array(table_b, pa.large_binary())
        self.size_a, self.size_b = (np.fromiter(map(len, t), np.int64, len(t)) for t in (table_a, table_b))
        ids = range(max(len(table_a), len(table_b)))
        self.names = pa.array([f"{i}{end}" for end in ",|;" for i in ids], pa.large_string())
        self.n_names, self.n_b = len(ids), len(table_b)

    def _agrees(self, ids: np.ndarray, sizes: np.ndarray, table: pa.Array, lengths: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """Whether the tokens of each text join to a space and the text."""
        raw = memoryview(table.take(pa.array(ids)).buffers()[2] or b"").cast("B")
        ends = np.append(0, np.cumsum(lengths[ids]))[np.append(0, np.cumsum(sizes))].tolist()
        return np.fromiter((raw[x:y] == b" " + t for x, y, t in zip(ends, ends[1:], texts)), bool, len(texts))

    def align(self, texts: list[bytes]) -> _Texts:
        """Texts as UTF-8. Empty ones, and those that a tokenizer does not give back byte by byte, have no tokens."""
        n = len(texts)
        words = [t.decode("utf-8", "replace") for t in texts]
        ids_a, count_a = self.encode_a(words)
        ids_b, count_b = self.encode_b(words)
        good = self._agrees(ids_a, count_a, self.bytes_a, self.size_a, texts)
        good &= self._agrees(ids_b, count_b, self.bytes_b, self.size_b, texts)
        good &= np.fromiter(map(len, texts), np.int64, n) > 0
        ids_a, ids_b = ids_a[np.repeat(good, count_a)], ids_b[np.repeat(good, count_b)]
        count_a, count_b = np.where(good, count_a, 0), np.where(good, count_b, 0)
        doc_a, doc_b = np.repeat(np.arange(n), count_a), np.repeat(np.arange(n), count_b)
        # documents lie one behind the other, both sides on the same bytes
        end_a, end_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        i, j = overlaps(doc_a, end_a - self.size_a[ids_a], doc_b, end_b - self.size_b[ids_b])
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        last_a, last_b = np.searchsorted(end_a, cuts), np.searchsorted(end_b, cuts)
        of_group = doc_a[last_a]
        n_groups = np.bincount(of_group, minlength=n)
        links = self._counted(doc_a[i], ids_a[i] * self.n_b + ids_b[j])
        return _Texts(
            count_a, count_b, n_groups, np.bincount(doc_a[i], minlength=n),
            self._groups(ids_a, ids_b, last_a, last_b, of_group, count_a + count_b), *links,
        )

    @staticmethod
    def _counted(doc: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, pair and number of links of every distinct pair of a document."""
        if not len(doc):
            return doc, pair, doc
        order = np.lexsort((pair, doc))
        doc, pair = doc[order], pair[order]
        new = np.append(True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1]))
        at = np.flatnonzero(new)
        return doc[at], pair[at], np.diff(np.append(at, len(doc)))

    def _groups(self, ids_a, ids_b, last_a, last_b, of_group, sizes) -> list[str | None]:
        """`a1,a2|b1;a3|b2,b3` per document: every id is written with what follows it."""
        a_in, b_in = np.diff(np.append(-1, last_a)), np.diff(np.append(-1, last_b))
        place_a = np.arange(len(ids_a)) + np.repeat(np.cumsum(b_in) - b_in, a_in)
        place_b = np.arange(len(ids_b)) + np.repeat(np.cumsum(a_in), b_in)
        names = np.zeros(len(ids_a) + len(ids_b), np.int64)
        names[place_a], names[place_b] = ids_a, ids_b
        names[place_a[last_a]] += self.n_names
        names[place_b[last_b]] += 2 * self.n_names
        written = self.names.take(pa.array(names))
        raw = memoryview(written.buffers()[2] or b"")
        at = np.frombuffer(written.buffers()[1], np.int64)[np.append(0, np.cumsum(sizes))].tolist()
        return [str(raw[x : y - 1], "ascii") if y > x else None for x, y in zip(at, at[1:])]


_BLOCKS = (
    "block long, slots array<struct<pair:bigint,docs:int>>, doc_id array<bigint>, n_a array<int>, n_b array<int>, "
    "n_groups array<int>, n_links array<int>, groups_sha256 array<string>, pairs_in binary, pair_slot binary, pair_links binary"
)


def _block(key: int, rows: list[tuple[list, _Texts]]) -> pa.RecordBatch:
    """One row for some documents: their figures, and the distinct pairs of all of them with the documents that hold each."""
    ids = [i for some, _ in rows for i in some]
    whole = {k: np.concatenate([getattr(t, k) for _, t in rows]) for k in ("n_a", "n_b", "n_groups", "n_links", "pair", "pair_links")}
    inside = np.concatenate([np.bincount(t.pair_doc, minlength=len(t.n_a)) for _, t in rows])
    pairs, slot, docs = np.unique(whole["pair"], return_inverse=True, return_counts=True)
    digests = [g for _, t in rows for g in t.groups]
    slots = pa.StructArray.from_arrays([pa.array(pairs, pa.int64()), pa.array(docs, pa.int32())], ["pair", "docs"])
    lists = lambda x, kind: pa.array([x], pa.list_(kind))
    return pa.RecordBatch.from_arrays(
        [pa.array([key], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), slots),
         lists(ids, pa.int64()), *(lists(whole[k], pa.int32()) for k in ("n_a", "n_b", "n_groups", "n_links")),
         lists(digests, pa.string()), *(pa.array([packed(x.astype(np.uint32))], pa.binary()) for x in (inside, slot, whole["pair_links"]))],
        ["block", "slots", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs_in", "pair_slot", "pair_links"],
    )


def _aligned(a, b, groups: Callable[[str | None], str | None]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, task = Aligner(a.value, b.value), TaskContext.get().partitionId() << 32
        rows, size = [], 0
        for piece in text_slices(batches, limit=ALIGNED_BYTES):
            raw, off = piece.data.tobytes(), piece.offsets.tolist()
            found = aligner.align([raw[x:y] for x, y in zip(off, off[1:])])
            rows.append((piece.batch.column("doc_id").to_pylist(), found._replace(groups=list(map(groups, found.groups)))))
            size += off[-1]
            if size >= BLOCK_BYTES:
                yield _block(task, rows)
                task, rows, size = task + 1, [], 0
        if rows:
            yield _block(task, rows)

    return run


_SCORED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = {name: batch.column(name)[at] for name in batch.schema.names}
            slots = row["known"].values
            docs, best = np.zeros(len(slots), np.int64), np.zeros(len(slots), np.int64)
            if len(slots):
                place = pc.struct_field(slots, "slot").to_numpy()
                docs[place] = pc.struct_field(slots, "docs").to_numpy()
                best[place] = pc.struct_field(slots, "best").to_numpy(zero_copy_only=False)
            inside, slot, links = (unpacked(row[k].as_py(), np.uint32).astype(np.int64) for k in ("pairs_in", "pair_slot", "pair_links"))
            cuts = np.append(0, np.cumsum(inside))
            sums = [np.append(0, np.cumsum(x[slot] * links)) for x in (best, docs)]
            n_best, count_sum = (s[cuts[1:]] - s[cuts[:-1]] for s in sums)
            plain = [row[k].values.cast(pa.int64()) for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
            yield pa.RecordBatch.from_arrays(
                [*plain, pa.array(n_best), pa.array(count_sum), row["groups_sha256"].values],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )


def _digest(groups: str | None) -> str:
    return hashlib.sha256(groups.encode()).hexdigest() if groups is not None else ""


def linked_pairs(blocks: DataFrame, n_b: int) -> DataFrame:
    """`pair, docs, best`: in how many documents an id pair is linked, and whether no other pair of its A id is in more."""
    counts = blocks.select(F.explode("slots").alias("s")).groupBy(F.col("s.pair").alias("pair")).agg(F.sum("s.docs").alias("docs"))
    counts = stage(counts.withColumn("a", F.expr(f"pair div {n_b}")), "linked-pairs")
    highest = stage(counts.groupBy("a").agg(F.max("docs").alias("most")), "best-links")
    return counts.join(highest, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def aligned_groups(docs: DataFrame, a: Side, b: Side) -> DataFrame:
    """`doc_id, groups`: the groups of every text as `a1,a2|b1;a3|b2,b3`, NULL for a text without tokens."""
    spark = docs.sparkSession
    sides = spark.sparkContext.broadcast(a), spark.sparkContext.broadcast(b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(sides[0].value, sides[1].value)
        for piece in text_slices(batches, limit=ALIGNED_BYTES):
            raw, off = piece.data.tobytes(), piece.offsets.tolist()
            groups = aligner.align([raw[x:y] for x, y in zip(off, off[1:])]).groups
            yield pa.RecordBatch.from_arrays([piece.batch.column("doc_id"), pa.array(groups, pa.string())], ["doc_id", "groups"])

    return _plain(docs).mapInArrow(run, "doc_id long, groups string")


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def align(docs: DataFrame, a: Side, b: Side) -> DataFrame:
    """`doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256` for every row of `docs`.

    Every row is a document of its own, whatever its doc_id: repeated rows count once each, a NULL doc_id stays NULL.
    NULL and empty texts, and texts that one of the tokenizers does not give back byte by byte, have no tokens: zeros
    and ''. `n_best` counts the links whose pair is in the most documents among the pairs of its A id, ties included.
    Other columns of `docs` are ignored.

    Each text is encoded once. A staged table holds a row per block of documents with its distinct id pairs; those are
    counted over all blocks by a Spark aggregate, joined back by pair, and gathered by block. A pair has at most one row
    per block, however common it is, and a block's list is bounded by its bytes. The tokenizer files, whose size does
    not depend on the data, are all that is broadcast to Python.
    """
    spark = docs.sparkSession
    sides = spark.sparkContext.broadcast(a), spark.sparkContext.broadcast(b)
    n_b = len(b.build(b.data)[1])
    blocks = stage(_plain(docs).mapInArrow(_aligned(*sides, _digest), _BLOCKS), "aligned-blocks")
    asked = blocks.select("block", F.posexplode("slots").alias("slot", "s")).select("block", "slot", "s.pair")
    known = asked.join(linked_pairs(blocks, n_b), "pair").groupBy("block").agg(
        F.collect_list(F.struct("slot", F.col("docs"), F.col("best").cast("int").alias("best"))).alias("known")
    )
    none = F.expr("cast(array() as array<struct<slot:int,docs:bigint,best:int>>)")
    rows = blocks.drop("slots").join(known, "block", "left").withColumn("known", F.coalesce("known", none))
    return rows.mapInArrow(_scored, _SCORED)
