"""Document fingerprints: a homomorphic multiset hash of paragraphs, in DataFrame functions alone.

A paragraph (a line) stands for a wide vector. Eight lanes are halves of its 64-bit hashes, for equality. 64 lanes
count, for each bit, the blocks of up to eight words from the paragraph's start whose hash has it set, for likeness.
A document's fingerprint is the number of its blocks and the sum of these vectors modulo 2**32: the order of
paragraphs does not matter, and adding or removing a paragraph adds or subtracts its vector.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogway.llm.common import narrowed, public_id, shuffle_partitions
from smogway.sources.staging import stage

#: A block is up to eight words of a paragraph, each with the white space after it.
BLOCK = r"[^\n\S]*+(?:[^\s]++[^\n\S]*+){1,8}+"
_EQUAL_LANES = 8
_PAIRS = 32  # of bit counts, two to a number
_MODULUS = 1 << 32


def _sums(paragraph: Column, unit: Column) -> list[Column]:
    """Aggregates over exploded units: lanes of the paragraphs, then counted bits of the blocks, then the blocks."""
    out = []
    for k in range(_EQUAL_LANES // 2):
        h = F.xxhash64(unit, F.lit(k))
        for half in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(_MODULUS - 1))):
            out.append(F.sum(F.when(paragraph, half).otherwise(F.lit(0).cast("long"))))
    h = F.xxhash64(unit)
    pair = F.lit((1 << 32) | 1)  # bits j and j + 32 are counted in one number
    for j in range(_PAIRS):
        out.append(F.sum(F.when(~paragraph, F.shiftrightunsigned(h, j).bitwiseAND(pair)).otherwise(F.lit(0).cast("long"))))
    out.append(F.sum(F.when(~paragraph, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))))
    return out


def lanes(rows: DataFrame, keys: list[str], text: str, weight: str | None = None) -> DataFrame:
    """The fingerprint of the texts of each key: the keys, `lanes` (eight sums, 64 bit counts) and `blocks`.

    `weight`, one of the keys, is how often the rows of a key repeat the same text; sums are divided by it.
    """
    body = F.col(text)
    paragraphs = F.filter(F.split(body, "\n"), lambda p: p != "")
    units = F.concat(
        F.array(F.struct(F.lit(None).cast("boolean").alias("paragraph"), F.lit("").alias("unit"))),  # a row for empty texts
        F.transform(paragraphs, lambda p: F.struct(F.lit(True).alias("paragraph"), p.alias("unit"))),
        F.transform(
            F.regexp_extract_all(body, F.lit(BLOCK), F.lit(0)),
            lambda b: F.struct(F.lit(False).alias("paragraph"), b.alias("unit")),
        ),
    )
    exploded = rows.select(*keys, F.inline(units))
    sums = _sums(F.col("paragraph"), F.col("unit"))
    names = [f"s{i}" for i in range(len(sums))]
    summed = exploded.groupBy(*keys).agg(*(c.alias(n) for c, n in zip(sums, names)))
    once = {n: F.expr(f"{n} div {weight}") if weight else F.col(n) for n in names}
    equal = [F.pmod(once[n], F.lit(_MODULUS)) for n in names[:_EQUAL_LANES]]
    counted = names[_EQUAL_LANES : _EQUAL_LANES + _PAIRS]
    low = [F.expr(f"(s & {_MODULUS - 1}) div {weight or 1}".replace("(s ", f"({n} ")) for n in counted]
    high = [F.expr(f"shiftrightunsigned({n}, 32) div {weight or 1}") for n in counted]
    return summed.select(*keys, F.array(*equal, *low, *high).alias("lanes"), once[names[-1]].alias("blocks"))


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint lanes of the union of two multisets of paragraphs, or of their difference with sign -1."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + sign * y, F.lit(_MODULUS)))


def hex_fingerprint(vector: Column, blocks: Column) -> Column:
    """All lanes and the number of blocks as hex digits, eight each."""
    return F.array_join(
        F.transform(F.concat(vector, F.array(F.pmod(blocks, F.lit(_MODULUS)))), lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), ""
    )


def likeness(a: Column, a_blocks: Column, b: Column, b_blocks: Column) -> Column:
    """Estimated share of blocks in common, 2|A and B| / (|A| + |B|): from 0 to 1, and 1 for equal fingerprints.

    A bit's surplus 2 * count - blocks is a random +-1 sum over the blocks, so products of the surpluses of two
    documents average to the number of blocks that both have.
    """
    def surplus(v: Column, n: Column) -> Column:
        return F.transform(F.slice(v, _EQUAL_LANES + 1, 2 * _PAIRS), lambda x: (2 * x - n).cast("double"))

    def total(products: Column) -> Column:
        return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)

    x, y = surplus(a, a_blocks), surplus(b, b_blocks)
    dot = total(F.zip_with(x, y, lambda p, q: p * q))
    size = total(F.zip_with(x, x, lambda p, q: p * q)) + total(F.zip_with(y, y, lambda p, q: p * q))
    near = F.when(size > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * dot / size))).otherwise(0.0)
    return F.when((a == b) & (a_blocks == b_blocks), 1.0).otherwise(near)


def neighbours(docs: DataFrame) -> DataFrame:
    """Each document's key and size, and the keys of the documents before and after it by doc_id, in a ring.

    Only keys and sizes are sorted: by ranges first, then within each range; a row per range, on one task, joins
    the ends. Rows that repeat a doc_id and its text are one, with their number in `copies`.
    """
    key = F.struct("doc_id", F.xxhash64("text").alias("hash"))
    narrow = docs.select(key.alias("key"), F.char_length("text").cast("long").alias("n_chars"))
    narrow = narrow.groupBy("key", "n_chars").agg(F.count(F.lit(1)).alias("copies"))
    ranged = narrow.repartitionByRange(shuffle_partitions(docs), "key").withColumn("range", F.spark_partition_id())
    ranged = stage(ranged, "document-order")
    inner = Window.partitionBy("range").orderBy("key")
    me = F.struct("key", "n_chars", "copies")
    ends = ranged.groupBy("range").agg(F.min(me).alias("first"), F.max(me).alias("last"))
    ring = Window.orderBy("range")  # as many rows as ranges
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        F.col("range").alias("of"),
        F.coalesce(F.lag("last").over(ring), F.max("last").over(every)).alias("last_before"),
        F.coalesce(F.lead("first").over(ring), F.min("first").over(every)).alias("first_after"),
    )
    linked = ranged.select(
        "key", "n_chars", "copies", "range", F.lag(me).over(inner).alias("before"), F.lead(me).over(inner).alias("after")
    ).join(F.broadcast(ends), F.col("range") == F.col("of"))  # a row per range
    linked = linked.withColumns(
        {"before": F.coalesce("before", "last_before"), "after": F.coalesce("after", "first_after")}
    )
    return stage(
        linked.select(
            "key", "n_chars", "copies", F.col("before.key").alias("prev_key"), F.col("before.n_chars").alias("prev_chars"),
            F.col("after.key").alias("next_key"),
        ),
        "neighbours",
    )


def edited_texts(docs: DataFrame, around: DataFrame) -> DataFrame:
    """`around` with `text` and `edited`: the last quarter of the text replaced by the next document's beginning.

    Texts move once; beginnings, a quarter as long and one of each document, move on to the document before. As many
    rows as `copies` says are alike.
    """
    keyed = docs.select(F.struct("doc_id", F.xxhash64("text").alias("hash")).alias("key"), "text")
    whole = keyed.join(around, "key")
    head = F.substring("text", F.lit(1), F.floor(F.col("prev_chars") / 4).cast("int")).alias("head")
    beginnings = whole.select(F.col("prev_key").alias("key"), head).groupBy("key").agg(F.first("head").alias("head"))
    keep = (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int")
    return whole.join(beginnings, "key").withColumn("edited", F.concat(F.substring("text", F.lit(1), keep), "head"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """`doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next` per row of `docs`.

    The edited text is the document with its last floor(n_chars / 4) characters replaced by the first as many of the
    next document by doc_id (the first after the last). NULL texts are empty, NULL doc_ids come first; rows
    that share a doc_id follow each other by a hash of their text, and repeated rows get the same result. Empty
    texts are alike; an empty and another are not. A single document is its own next.
    """
    narrow = narrowed(docs)
    texts = edited_texts(narrow, neighbours(narrow))
    digest = F.sha2(F.col("edited").cast("binary"), 256)
    versions = texts.select(
        "key", "n_chars", "copies", "next_key",
        F.inline(F.array(
            F.struct(F.lit("").alias("edited_sha256"), F.col("text").alias("body")),
            F.struct(digest.alias("edited_sha256"), F.col("edited").alias("body")),
        )),
    )
    keys = ["key", "n_chars", "copies", "next_key", "edited_sha256"]
    both = stage(lanes(versions, keys, "body", "copies"), "lanes")
    own = both.where("edited_sha256 = ''").drop("edited_sha256")
    edited = both.where("edited_sha256 <> ''").select(
        F.col("key").alias("e_key"), "edited_sha256", F.col("lanes").alias("e_lanes"), F.col("blocks").alias("e_blocks")
    )
    following = own.select(F.col("key").alias("n_key"), F.col("lanes").alias("n_lanes"), F.col("blocks").alias("n_blocks"))
    joined = own.join(edited, F.col("key") == F.col("e_key")).join(following, F.col("next_key") == F.col("n_key"))
    result = joined.select(
        F.col("key.doc_id").alias("doc_id"), "n_chars", "edited_sha256",
        hex_fingerprint(F.col("lanes"), F.col("blocks")).alias("fingerprint"),
        hex_fingerprint(F.col("e_lanes"), F.col("e_blocks")).alias("edited_fingerprint"),
        likeness(*map(F.col, ("lanes", "blocks", "e_lanes", "e_blocks"))).alias("near_edited"),
        likeness(*map(F.col, ("lanes", "blocks", "n_lanes", "n_blocks"))).alias("near_next"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    )
    return result.drop("copy").withColumn("doc_id", public_id())
