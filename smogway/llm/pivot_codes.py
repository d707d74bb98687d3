"""Product codes of integer vectors, assigned by LAESA: distances to fixed pivots give bounds that order and prune.

Every part of every vector is measured once against a few pivots, fixed entries of the first codebook of its position,
and the distances are stored beside it. In each round only the entries are measured against the pivots again: the
largest difference of two such distances is a lower bound of the distance between part and entry (triangle
inequality). Entries are tried in the order of their bounds with exact integer arithmetic, and a part is settled once
the next bound exceeds what it has found. Bounds are rounded down by more than their error, so the result is that of
trying every entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogway.sources.staging import stage

PARTS, ENTRIES, ROUNDS, SCALE, PIVOTS = 16, 64, 2, 256, 3
#: Components beyond this leave no room for exact sums of squares in 64 bits.
LARGEST = 2**26
#: Rows worked on together inside a task.
BLOCK = 4096


class Codes(NamedTuple):
    """`rows`: vec_id, label, code (a byte per part), error; `codebooks[part, entry, position]`."""

    rows: DataFrame
    codebooks: np.ndarray


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of rows to rows, exact: (n, d), (m, d) -> (n, m)."""
    return ((x[:, None, :] - y[None, :, :]) ** 2).sum(2)


def _pivots(book: np.ndarray, count: int) -> np.ndarray:
    """Entries far from each other: the first, then each time the one farthest from those chosen."""
    chosen = [0]
    while len(chosen) < min(count, len(book)):
        chosen.append(int(_distances(book, book[chosen]).min(1).argmax()))
    return book[chosen]


def _bounds(to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Lower bounds (n, m) of the distance between parts and entries, safe against rounding."""
    of_entries = np.sqrt(_distances(entries, pivots).astype(np.float64))
    out = np.zeros((len(to_pivots), len(entries)))
    for p in range(pivots.shape[0]):
        a, b = to_pivots[:, p, None].astype(np.float64), of_entries[None, :, p]
        np.maximum(out, np.abs(a - b) - (a + b) * 1e-6, out=out)  # stored distances are 32-bit floats
    return out


def nearest(x: np.ndarray, to_pivots: np.ndarray, book: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each row of `x` the nearest entry (ties to the lower index), its squared distance, and all distances evaluated."""
    bounds = _bounds(to_pivots, book, pivots)
    order = np.argsort(bounds, 1, kind="stable")
    best = np.full(len(x), np.iinfo(np.int64).max)
    found = np.zeros(len(x), np.int64)
    open_, tried = np.arange(len(x)), 0
    for rank in range(len(book)):
        entry = order[open_, rank]
        low = np.maximum(bounds[open_, entry], 0.0)
        stay = low * low <= best[open_]
        open_, entry = open_[stay], entry[stay]
        if not len(open_):
            break
        tried += len(open_)
        d = ((x[open_] - book[entry]) ** 2).sum(1)
        better = (d < best[open_]) | ((d == best[open_]) & (entry < found[open_]))
        at = open_[better]
        best[at], found[at] = d[better], entry[better]
    return found, best, tried


def _integers(batch: pa.Array, scale: int, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are vectors (of `size` finite components), and their scaled floors."""
    lengths = pc.fill_null(pc.list_value_length(batch), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(pc.cast(pc.list_flatten(batch), pa.float64()), np.nan).to_numpy(zero_copy_only=False)
    cuts = np.append(0, np.cumsum(np.maximum(lengths, 0)))
    bad = np.append(0, np.cumsum(~np.isfinite(flat)))
    good = (lengths > 0) & (bad[cuts[1:]] == bad[cuts[:-1]])
    if size is not None:
        good &= lengths == size
    inside = np.repeat(good, np.maximum(lengths, 0))
    values = np.floor(flat[inside] * scale)
    if len(values) and np.abs(values).max() >= LARGEST:
        raise ValueError(f"vectors hold components of {LARGEST / scale:g} or more, beyond exact 64-bit distances")
    return good, values.astype(np.int64)


def _parts_of(values: np.ndarray, size: int, parts: int) -> np.ndarray:
    """(rows, parts, positions); a length that does not divide is filled up with zeros."""
    rows, each = len(values) // max(size, 1), -(-size // parts)
    out = np.zeros((rows, parts * each), np.int64)
    out[:, :size] = values.reshape(rows, size)
    return out.reshape(rows, parts, each)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield batch.slice(at, BLOCK)


def _binary(rows: np.ndarray) -> pa.Array:
    """One binary value per row of a contiguous array."""
    rows = np.ascontiguousarray(rows)
    width = rows.nbytes // max(len(rows), 1)
    offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int64) * width)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, offsets.buffers()[1], pa.py_buffer(rows)]).cast(pa.binary())


def _read(column: pa.Array, dtype, shape: tuple[int, ...]) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), *shape)


def product_codes(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
    pivots: int = PIVOTS,
) -> Codes:
    """Codes of the column `embedding` of `vectors` (with `vec_id`, `label`; other columns are ignored).

    Rows whose vector is NULL, empty or holds a NULL or non-finite component are dropped. Components become
    floor(scale * x) and are cut into `parts` equal runs, filled up with zeros where the length does not divide. The
    first codebook is that of the `entries` smallest vec_ids (NULL after all others, equal ids by their components);
    with fewer vectors it is that much smaller. Vectors of another length than the first of those are dropped as well.
    Each of the `rounds` assigns all parts and moves every used entry to the floor of the mean of its parts; a last
    assignment follows. An empty table gives no rows and empty codebooks. Components of 2**26 / scale or more raise.

    Vectors are read and measured against the pivots once and staged; a round is one pass over them, in which every
    task sends at most one sum per entry and position. Only those sums, parts * entries rows, come to the driver.
    """
    source = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    finite = "size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    first = source.where(finite).orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    if not first:
        empty = source.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))
        return Codes(empty.limit(0), np.zeros((parts, 0, 0), np.int64))
    size = len(first[0].embedding)
    start = [x for r in first if len(r.embedding) == size for x in r.embedding]
    books = _parts_of(np.floor(np.array(start) * scale).astype(np.int64), size, parts).transpose(1, 0, 2).copy()
    if np.abs(books).max() >= LARGEST:
        raise ValueError(f"vectors hold components of {LARGEST / scale:g} or more, beyond exact 64-bit distances")
    each = books.shape[2]
    fixed = np.stack([_pivots(book, pivots) for book in books])
    n_pivots = fixed.shape[1]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            good, values = _integers(batch.column("embedding"), scale, size)
            x = _parts_of(values, size, parts)
            far = np.stack([np.sqrt(_distances(x[:, j], fixed[j])) for j in range(parts)], 1) if len(x) else np.zeros((0, parts, n_pivots))
            kept = batch.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays(
                [kept.column("vec_id"), kept.column("label"), _binary(x.astype(np.int32)), _binary(far.astype(np.float32))],
                ["vec_id", "label", "components", "far"],
            )

    measured = stage(source.mapInArrow(measure, "vec_id long, label long, components binary, far binary"), "pivot-distances")

    def assigned(batch: pa.RecordBatch, books: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        x = _read(batch.column("components"), np.int32, (parts, each)).astype(np.int64)
        far = _read(batch.column("far"), np.float32, (parts, n_pivots))
        for j in range(parts):
            yield j, x[:, j], *nearest(x[:, j], far[:, j], books[j], fixed[j])[:2]

    def sums(books: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
            for batch in _blocks(batches):
                for j, x, found, _ in assigned(batch, books):
                    np.add.at(total[j], found, x)
                    count[j] += np.bincount(found, minlength=books.shape[1])
            part, entry = np.nonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(entry), pa.array(count[part, entry]),
                 pa.array(total[part, entry].tolist(), pa.list_(pa.int64()))],
                ["part", "entry", "n", "total"],
            )

        return run

    for _ in range(rounds):
        each_sum = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(each)]
        used = (
            measured.mapInArrow(sums(books), "part long, entry long, n long, total array<long>")
            .groupBy("part", "entry").agg(F.sum("n").alias("n"), *each_sum).collect()
        )
        books = books.copy()
        for row in used:
            books[row.part, row.entry] = [row[f"s{i}"] // row.n for i in range(each)]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            code, error = np.zeros((batch.num_rows, parts), np.uint8 if entries <= 256 else np.uint16), np.zeros(batch.num_rows, np.int64)
            for j, _, found, best in assigned(batch, books):
                code[:, j] = found
                error += best
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), _binary(code), pa.array(error)],
                ["vec_id", "label", "code", "error"],
            )

    return Codes(measured.mapInArrow(encode, "vec_id long, label long, code binary, error long"), books)


def codebook_digest(books: np.ndarray) -> str:
    """SHA-256 of all decimal components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_errors(codes: Codes) -> DataFrame:
    """`vec_id, code, error, label_error, codebooks_sha256`: label_error adds up the errors of equal labels, NULLs as one.

    The sums are one small row per label, combined before the shuffle, and are joined back as a written table whose
    size Spark knows; where there are too many labels to broadcast, Spark splits hot labels of the join.
    """
    rows = stage(codes.rows, "pivot-codes")
    per_label = stage(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    both = rows.alias("r").join(per_label.alias("s"), F.col("r.label").eqNullSafe(F.col("s.label")), "left")
    return both.select(
        "r.vec_id", F.lower(F.hex("r.code")).alias("code"), "r.error", "s.label_error",
        F.lit(codebook_digest(codes.codebooks)).alias("codebooks_sha256"),
    )
