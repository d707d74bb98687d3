"""Near duplicates by SimHash, found over segment popcounts.

A fingerprint of 64 bits is embedded as the bit counts of its 32 two-bit segments. The Manhattan distance of
two embeddings is at most their Hamming distance, so fingerprints within 4 bits are within 4 there, and in one of
three groups of segments within 1. Each group is a grid of base-3 cells: a fingerprint stands in its home cell
and reaches into every cell one step up. Fingerprints that meet in a cell are verified by their exact distance.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogway.llm.common import (
    NULL_ID,
    group_starts,
    mixed,
    narrowed,
    packed,
    public_id,
    shuffle_partitions,
    text_slices,
    tidy,
    unpacked,
    word_bounds,
)
from smogway.llm.components import components
from smogway.llm.spans import _ranges
from smogway.sources.staging import stage

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
_GROUPS = ((0, 11), (11, 22), (22, 32))  # of segments
_CELLS = 3**11
#: A cell with more fingerprints is dealt out as pairs of tiles of about this size.
TILE = 8192

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _shingle_hashes(data: np.ndarray, offsets: np.ndarray, words: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle, and how many each row has."""
    starts, ends, count = word_bounds(data, offsets)
    size = ends - starts + 1
    past = np.cumsum(size)  # of a word and the space after it, in the words joined by single spaces
    joined = np.append(data, np.uint8(32))[np.minimum(_ranges(starts, size), len(data))]
    joined[past - 1] = 32
    shingles = np.where(count > 0, np.maximum(count - words + 1, 1), 0)
    first = _ranges(np.cumsum(count) - count, shingles)
    final = first + np.repeat(np.minimum(count, words), shingles) - 1
    view, digest = memoryview(joined.tobytes()), xxhash.xxh64_intdigest
    begin, end = (past - size)[first].tolist(), (past[final] - 1).tolist()
    return np.fromiter((digest(view[a:b], seed) for a, b in zip(begin, end)), np.uint64, len(begin)), shingles


def _fingerprints(words: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches, limit=250_000):
            hashes, shingles = _shingle_hashes(_LOWER[piece.data], piece.offsets, words, seed)
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            some = np.flatnonzero(shingles)
            out = np.zeros(len(shingles), np.uint64)
            if len(some):
                ones = np.add.reduceat(bits, (np.cumsum(shingles) - shingles)[some], axis=0, dtype=np.int64)
                major = np.packbits(2 * ones > shingles[some, None], axis=1, bitorder="little")
                out[some] = major.view(np.uint64).ravel()
            more = [name for name in piece.batch.schema.names if name not in ("doc_id", "text")]
            yield pa.RecordBatch.from_arrays(
                [piece.batch.column("doc_id"), pa.array(out.view(np.int64)), *map(piece.batch.column, more)],
                ["doc_id", "fingerprint", *more],
            )

    return run


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, seed: int = SEED, keep: Sequence[Column] = ()) -> DataFrame:
    """`doc_id, fingerprint` (64 bits as a long) and the `text_key` in `keep`, for every row: the majority bit of all
    shingles' hashes.

    Words are lower-cased in A-Z. Fewer words than a shingle make one; no words, or NULL, make the fingerprint 0.
    """
    more = ", text_key long" if keep else ""
    return narrowed(docs, *keep).mapInArrow(tidy(_fingerprints(words, seed)), f"doc_id long, fingerprint long{more}")


def _cell_rows(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell, index of the fingerprint, and whether the cell is its home, for home cells and those one step up."""
    x = prints.view(np.uint64)
    two = np.uint64(0x5555555555555555)
    counts = (x & two) + ((x >> np.uint64(1)) & two)
    cells, rows, homes = [], [], []
    for g, (lo, hi) in enumerate(_GROUPS):
        digits = [((counts >> np.uint64(2 * s)) & np.uint64(3)).astype(np.int64) for s in range(lo, hi)]
        home = g * _CELLS + sum(d * 3**i for i, d in enumerate(digits))
        cells.append(home)
        rows.append(np.arange(len(x)))
        homes.append(np.ones(len(x), bool))
        for i, d in enumerate(digits):
            up = np.flatnonzero(d < 2)
            cells.append(home[up] + 3**i)
            rows.append(up)
            homes.append(np.zeros(len(up), bool))
    return np.concatenate(cells), np.concatenate(rows), np.concatenate(homes)


def _cell_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(len(_GROUPS) * _CELLS, np.int64)
    for batch in batches:
        prints = batch.column("fingerprint").to_numpy()
        for at in range(0, len(prints), 50_000):
            total += np.bincount(_cell_rows(prints[at : at + 50_000])[0], minlength=len(total))
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"cell": some, "n": total[some]})


def _dealt(parts: int, tiles: dict[int, int]):
    """Packed (cell, tile pair, fingerprint, home) by bucket."""
    split = np.ones(len(_GROUPS) * _CELLS, np.int64)
    split[list(tiles)] = list(tiles.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.ascontiguousarray(batch.column("fingerprint").to_numpy())
            for lo in range(0, len(prints), 20_000):
                own = prints[lo : lo + 20_000]
                cell, row, home = _cell_rows(own)
                n = split[cell]
                tile = (mixed(own.view(np.uint64))[row] % n.astype(np.uint64)).astype(np.int64)
                other = _ranges(np.zeros(len(n), np.int64), n)  # a row goes to each pair of tiles with its own
                cell, row, home, tile, n = (np.repeat(v, n) for v in (cell, row, home, tile, n))
                key = (cell << 40) | (np.minimum(tile, other) << 20) | np.maximum(tile, other)
                bucket = (mixed(key.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
                order = np.lexsort((~home, key, bucket))
                cut = np.searchsorted(bucket[order], np.arange(parts + 1))
                for b in np.flatnonzero(np.diff(cut)):
                    at = order[cut[b] : cut[b + 1]]
                    yield pa.RecordBatch.from_pydict({
                        "bucket": [b], "keys": [packed(key[at])], "homes": [packed(home[at])],
                        "prints": [packed(own[row[at]])],
                    })

    return run


def _linked(bits: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        column = lambda name, kind: np.concatenate([unpacked(x.as_py(), kind) for x in table.column(name)])
        keys, homes, prints = column("keys", np.int64), column("homes", bool), column("prints", np.uint64)
        order = np.lexsort((~homes, keys))
        keys, homes, prints = keys[order], homes[order], prints[order]
        begin = group_starts(keys)
        past = np.append(begin[1:], len(keys))
        links = [np.zeros((2, 0), np.uint64)]
        large = past - begin > 256
        for a, b in zip(begin[large], past[large]):
            links.append(_explored(prints[a:b], int(homes[a:b].sum()), bits))
        end = np.repeat(past, past - begin)
        left = np.flatnonzero(homes & ~np.repeat(large, past - begin))
        count = end[left] - left - 1
        for part in np.split(np.arange(len(left)), np.flatnonzero(np.diff(np.cumsum(count) // 2_000_000)) + 1):
            i = np.repeat(left[part], count[part])
            j = _ranges(left[part] + 1, count[part])
            hit = np.bitwise_count(prints[i] ^ prints[j]) <= bits
            links.append(np.stack([prints[i[hit]], prints[j[hit]]]))
        a, b = _forest(np.concatenate(links, axis=1))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return run


def _explored(prints: np.ndarray, homes: int, bits: int) -> np.ndarray:
    """Links that connect what is connected in one large cell, by search from each home; each print is left once."""
    rest = np.arange(len(prints))
    found, waiting = [np.zeros((2, 0), np.uint64)], []
    seed = 0
    gone = np.zeros(len(prints), bool)
    while True:
        if waiting:
            at = waiting.pop()
        else:
            while seed < homes and gone[seed]:
                seed += 1
            if seed >= homes:
                return np.concatenate(found, axis=1)
            at = seed
            gone[at] = True
        near = np.bitwise_count(prints[rest] ^ prints[at]) <= bits
        if near.any():
            new = rest[near]
            rest = rest[~near]
            new = new[new != at]
            gone[new] = True
            waiting.extend(new.tolist())
            found.append(np.stack([np.full(len(new), prints[at]), prints[new]]))


def _forest(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components as stars: each print with the smallest of its component."""
    nodes, at = np.unique(links.ravel(), return_inverse=True)
    a, b = at.reshape(2, -1)
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(jump := new[new], new):
            new = jump
        if np.array_equal(new, root):
            break
        root = new
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def print_links(prints: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect all within `bits` (at most 4) of each other."""
    if bits > 4:
        raise ValueError("three groups of segments find at most 4 differing bits")
    parts = shuffle_partitions(prints)
    # At most 3 * 3**11 = 531,441 cells exist; the driver holds those that need tiles.
    crowded = (
        prints.mapInArrow(_cell_counts, "cell long, n long")
        .groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") > TILE).collect()
    )
    tiles = {r.cell: -(-r.n // TILE) for r in crowded}
    return (
        prints.mapInArrow(_dealt(parts, tiles), "bucket long, keys binary, homes binary, prints binary")
        .groupBy("bucket")
        .applyInArrow(_linked(bits), "a long, b long")
    )


def _named(rows: DataFrame, bits: int) -> DataFrame:
    """`rows` (doc_id, fingerprint, ...) with the component_id of their fingerprints."""
    distinct = stage(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "distinct-prints")
    member = components(print_links(distinct.select("fingerprint"), bits))
    rooted = distinct.join(member, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = stage(rooted.join(least, "root").select("fingerprint", "component_id"), "print-components")
    return rows.join(named, "fingerprint")


def near_duplicates(docs: DataFrame, bits: int = MAX_BITS, words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """`doc_id, fingerprint, component_id` for every row of `docs`; fingerprint as 16 hex digits.

    Documents link at `bits` or fewer differing bits; component_id is the smallest doc_id reachable. Documents
    without words share the fingerprint 0 and so link. Repeated rows get equal results; NULL doc_ids are the
    smallest. No rows give no rows.
    """
    rows = stage(fingerprints(docs, words, seed), "fingerprints")
    return _named(rows, bits).select(
        public_id(), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), public_id("component_id")
    )


def keep_one_of_each(docs: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """The rows of `docs` that have the smallest doc_id of their component; columns as given.

    Rows are told apart by doc_id and text: of rows that share a doc_id only those whose text is in a component with a
    smaller doc_id go, rows that are equal in both stay or go together. A NULL doc_id is the smallest. No rows give none.
    """
    text_key = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")
    rows = stage(fingerprints(docs, keep=[text_key]), "fingerprints")
    later = _named(rows, bits).where(F.col("doc_id") != F.col("component_id"))
    drop = stage(later.select(F.col("doc_id").alias("drop_id"), F.col("text_key").alias("drop_key")).distinct(), "near-copies")
    own_id, own_text = F.coalesce(F.col("d.doc_id").cast("long"), F.lit(NULL_ID)), F.coalesce("d.text", F.lit(""))
    same = (own_id == F.col("x.drop_id")) & (F.xxhash64(own_text) == F.col("x.drop_key"))
    return docs.alias("d").join(drop.alias("x"), same, "left_anti")
