"""A corpus pipeline over `documents`: quality, exact copies, near copies, mixture, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogway.llm import quality
from smogway.llm.exact_dedup import drop_exact_copies
from smogway.llm.lattice import encode, read_pieces
from smogway.llm.mixing import repeat_by_mix
from smogway.llm.queries import PIECES
from smogway.llm.simhash import keep_one_of_each
from smogway.sources.staging import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on `labels`, scores at least 0.3."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id."""
    return drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints, the document with the smallest doc_id."""
    return keep_one_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources have their target weights."""
    return repeat_by_mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id, n_tokens, ids, decoded_sha256` for every row, copies of the mixture included."""
    pieces = read_pieces(PIECES)
    both = encode(docs, pieces, decoded=True)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixture", mixed_sources),
    ("encoding", encoded),
]

#: Quality, fingerprints and rates have no SQL form. Operator tests compare with brute force where they can; the test of
#: the stages checks columns, that ids come from the stage before and that decoding restores texts, not which ids stay.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage_function in STAGES[:-1]:
        docs = stage(stage_function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
