"""Exact duplicates by two-pass Bloom filtering.

Pass one counts, for every text hash, two cells of a fixed-size filter, saturating at two. Pass two tests
each row against the cells hit twice: a row that misses is alone and passes straight through; only rows that
may be repeated are shuffled and compared by their full SHA-256.

The filter has about eight cells a row and at most `max_cells` (a documented bound: 2**28 cells are 32 MB on
the driver and on each worker). Beyond the bound it lets more single rows through to the shuffle; results stay exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smogway.llm.common import NULL_ID, group_starts, mixed, public_id
from smogway.sources.staging import stage

MAX_CELLS = 1 << 28
#: Groups above this share of all rows are joined by broadcast: at most so many exist.
HOT_GROUPS = 1000
_BLOCK = 16


def _cells(hashes: np.ndarray, cells: int) -> np.ndarray:
    """Two cells for each hash, one in either half of the filter."""
    half = np.uint64(cells // 2)
    x = hashes.view(np.uint64)
    return np.concatenate([mixed(x) % half, half + mixed(x ^ np.uint64(0x5851F42D4C957F2D)) % half]).astype(np.int64)


def build_filter(hashed: DataFrame, rows: int, max_cells: int = MAX_CELLS) -> tuple[np.ndarray, int]:
    """Pass one over the column `hash`: a bit for each cell that two rows or more have hit."""
    cells = min(max_cells, max(1 << (_BLOCK + 1), 1 << (8 * rows).bit_length()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit, times = np.unique(_cells(batch.column(0).to_numpy(), cells), return_counts=True)
            hit = np.repeat(hit, np.minimum(times, 2))  # copies within a batch count twice, not a thousand times
            if len(hit):
                at = group_starts(hit >> _BLOCK)
                lows = np.split((hit & 0xFFFF).astype(np.uint16), at[1:])
                yield pa.RecordBatch.from_pydict(
                    {"block": (hit[at] >> _BLOCK), "lows": [x.tobytes() for x in lows]}
                )

    def twice(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        times = np.zeros(1 << _BLOCK, np.int64)
        for raw in table.column("lows"):
            times += np.bincount(np.frombuffer(raw.as_py(), np.uint16), minlength=1 << _BLOCK)
        return pa.table({"block": [key[0].as_py()], "bits": [np.packbits(times > 1).tobytes()]})

    blocks = (
        hashed.select("hash")
        .mapInArrow(count, "block long, lows binary")
        .groupBy("block")
        .applyInArrow(twice, "block long, bits binary")
    )
    bits = np.zeros(cells >> 3, np.uint8)
    for row in blocks.toLocalIterator():  # cells / 65536 rows of 8 KB each: bounded by max_cells
        bits[row.block << (_BLOCK - 3) : (row.block + 1) << (_BLOCK - 3)] = np.frombuffer(row.bits, np.uint8)
    return bits, cells


def maybe_repeated(spark: SparkSession, bits: np.ndarray, cells: int) -> Callable[[Column], Column]:
    """Pass two: false for a hash that is surely alone."""
    shared = spark.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def test(hashes: pd.Series) -> pd.Series:
        at = _cells(hashes.to_numpy(np.int64), cells)
        hit = (shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
        return pd.Series((hit[: len(hashes)] & hit[len(hashes) :]).astype(bool))

    return test


def _hashes(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
        F.xxhash64(text).alias("hash"),
        F.sha2(text.cast("binary"), 256).alias("text_sha256"),
    )


def exact_groups(docs: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """One row per document: `doc_id, keep_id, group_size, kept, text_sha256`.

    Texts are equal when identical; NULL counts as empty. Of equal texts the row with the largest doc_id
    stays (NULL ids are smallest); of rows repeated with that id too, one. No rows give no rows.
    """
    rows = stage(_hashes(docs).withColumn("row", F.monotonically_increasing_id()), "exact-hashes")
    total = rows.count()
    test = maybe_repeated(docs.sparkSession, *build_filter(rows, total, max_cells))
    tested = stage(rows.withColumn("maybe", test("hash")), "exact-tested")
    alone = tested.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    maybe = tested.where("maybe")
    groups = stage(
        maybe.groupBy("text_sha256").agg(
            F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")
        ),
        "exact-groups",
    )
    # Rows of very large groups find theirs in a broadcast table of at most HOT_GROUPS rows, all others by a shuffle.
    hot = groups.where(F.col("group_size") > F.lit(total // HOT_GROUPS))
    large = maybe.join(F.broadcast(hot), "text_sha256")
    rest = maybe.join(F.broadcast(hot.select("text_sha256")), "text_sha256", "left_anti").join(
        groups.where(F.col("group_size") <= F.lit(total // HOT_GROUPS)), "text_sha256"
    )
    joined = large.select(*rest.columns).union(rest).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256",
    )
    return alone.union(joined).select(public_id(), public_id("keep_id"), "group_size", "kept", "text_sha256")


def drop_exact_copies(docs: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """The rows of `docs` without all but the last (largest doc_id) of equal texts; columns as given.

    Rows that the filter clears are not shuffled. Candidates combine before their shuffle, so a hot group
    leaves one row per task. Of repeated rows with that id too, the last in JSON order stays.
    """
    text = F.coalesce("text", F.lit(""))
    hashes = stage(docs.select(F.xxhash64(text).alias("hash")), "exact-hashes")
    test = maybe_repeated(docs.sparkSession, *build_filter(hashes, hashes.count(), max_cells))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    tested = docs.select(
        F.struct(*docs.columns).alias("whole"),
        F.sha2(text.cast("binary"), 256).alias("text_sha256"),
        F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)),
                 F.to_json(F.struct(*others)) if others else F.lit("")).alias("order"),
        test(F.xxhash64(text)).alias("maybe"),
    )
    last = tested.where("maybe").groupBy("text_sha256").agg(F.max_by("whole", "order").alias("whole"))
    return tested.where(~F.col("maybe")).select("whole").union(last.select("whole")).select("whole.*")
