"""URL verdicts: host and path rules first, then the ratio of two character language models.

The models are smoothed variable-order Markov models over the bytes of host and path: a character's probability in a
context is that in the shorter context, corrected by what the longer one has counted. One model is of the URLs that
rules allow, one of those they block; all such URLs are counted. A character and the five before it are one exact
number, a window of six symbols of nine bits; its low bits are the shorter contexts. Windows are counted in Spark, in a
staged table that grows with the pages, and the distinct windows of all URLs are joined to it. The verdict compares the log-likelihood difference per character with a threshold set on a fifth of
the ruled URLs that the models have not counted.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogway.llm.common import group_starts, mixed, text_slices
from smogway.sources.staging import stage

# Fixed list: the rules, as host and path with their verdicts.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
ORDERS = 6  # context lengths 0 to 5
STRENGTH = 2.0
_SLOTS = 1 << 16
_SYMBOL = 9  # bits: a byte, the end mark or what stands before the start
_BINS = 2000
_REACH = 10.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(text, pattern, 1), upper, upper.lower()), F.regexp_extract(text, pattern, 2)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; NULL where none does."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):  # the last that fits is the longest
        own_host, _, own_path = text.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith("/" + own_path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _slots(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each order, the slot of every context and of every context with its character; and characters per row.

    A row is its bytes and an end mark; contexts do not reach before its start.
    """
    size = np.diff(offsets) + 1
    begin = np.cumsum(size) - size
    text = np.full(int(size.sum()), 256, np.uint64)
    row = np.repeat(np.arange(len(size)), size)
    nth = np.arange(len(text)) - begin[row]
    inside = nth < (size - 1)[row]
    text[inside] = data
    contexts, pairs = [], []
    context = np.zeros(len(text), np.uint64)
    for order in range(ORDERS):
        if order:
            before = np.full(len(text), 257, np.uint64)
            before[order:] = np.where(nth[order:] >= order, text[:-order], np.uint64(257))
            context = mixed(context * np.uint64(1009) + before + np.uint64(order))
        contexts.append((context >> np.uint64(48)).astype(np.int64) + order * _SLOTS)
        pairs.append((mixed(context ^ (text * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(48)).astype(np.int64) + order * _SLOTS)
    return np.stack(contexts), np.stack(pairs), size


@dataclass
class Ratio:
    """The models of a few URLs in hashed arrays of fixed size, for comparison; judge() counts exact windows instead.

    Counts are by [model, context or pair, slot]; `trained` if both models have counted URLs.
    """

    counts: np.ndarray
    trained: bool

    def difference(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Log-likelihood as allowed less that as blocked, per character."""
        if not self.trained:
            return np.zeros(len(offsets) - 1)
        contexts, pairs, size = _slots(data, offsets)
        logs = []
        for seen, with_char in self.counts:
            p = np.full(contexts.shape[1], 1 / 257)
            for order in range(ORDERS):
                p = (with_char[pairs[order]] + STRENGTH * p) / (seen[contexts[order]] + STRENGTH)
            logs.append(np.log(p))
        return np.add.reduceat(logs[0] - logs[1], np.cumsum(size) - size) / size


def _windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The window of every character, end marks included, and how many each row has."""
    size = np.diff(offsets) + 1
    begin = np.cumsum(size) - size
    text = np.full(int(size.sum()), 256, np.int64)
    nth = np.arange(len(text)) - np.repeat(begin, size)
    text[nth < np.repeat(size - 1, size)] = data
    window = text.copy()
    for back in range(1, ORDERS):
        before = np.full(len(text), 257, np.int64)
        before[back:] = np.where(nth[back:] >= back, text[:-back], 257)
        window |= before << (_SYMBOL * back)
    return window, size


def _windows(key: str):
    """Rows (key, window, n) from rows (key, body); rows of equal key are added up within a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches, "body", limit=200_000):
            window, size = _windows_of(piece.data, piece.offsets)
            owner = np.repeat(piece.batch.column(key).to_numpy(), size)
            order = np.lexsort((window, owner))
            at = group_starts(owner[order], window[order])
            first = order[at]
            yield pa.RecordBatch.from_pydict({key: owner[first], "window": window[first], "n": np.diff(np.append(at, len(order)))})

    return run


def window_counts(bodies: DataFrame) -> DataFrame:
    """`window, allowed, blocked`: how often each window is in the bodies of either model (0 allows, 1 blocks)."""
    rows = bodies.select("model", "body").mapInArrow(_windows("model"), "model long, window long, n long")
    return rows.groupBy("window").agg(
        *(F.sum(F.when(F.col("model") == m, F.col("n")).otherwise(0)).alias(name) for m, name in enumerate(("allowed", "blocked")))
    )


def window_scores(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """`window, score` for distinct windows: log-likelihood as allowed less that as blocked, in units of 2**-32."""
    tails = F.explode(F.array(*(
        F.struct(F.lit(o).alias("order"), F.col("window").bitwiseAND(F.lit((1 << _SYMBOL * (o + 1)) - 1)).alias("pair")) for o in range(ORDERS)
    ))).alias("t")
    pairs = stage(
        counts.select(tails, "allowed", "blocked").groupBy("t.order", "t.pair").agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b")),
        "url-pairs",
    )
    context = F.shiftright("pair", _SYMBOL).alias("context")
    contexts = pairs.groupBy("order", context).agg(F.sum("a").alias("in_a"), F.sum("b").alias("in_b"))
    asked = windows.select("window", tails).select("window", "t.order", "t.pair").select("*", context)
    known = asked.join(pairs, ["order", "pair"], "left").join(contexts, ["order", "context"], "left").na.fill(0, ["a", "b", "in_a", "in_b"])
    by_order = known.groupBy("window").agg(F.array_sort(F.collect_list(F.struct("order", "a", "b", "in_a", "in_b"))).alias("steps"))

    def log_likelihood(n: str, seen: str) -> Column:
        return F.log(F.aggregate("steps", F.lit(1 / 257), lambda p, s: (s[n] + STRENGTH * p) / (s[seen] + STRENGTH)))

    return by_order.select("window", F.round((log_likelihood("a", "in_a") - log_likelihood("b", "in_b")) * 2.0**32).cast("long").alias("score"))


def differences(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """`row, difference` for rows of (row, body): the mean score of the windows. Sums are of integers, so they do not
    depend on the order of rows."""
    own = stage(rows.select("row", "body").mapInArrow(_windows("row"), "row long, window long, n long"), "url-windows-of-rows")
    scores = window_scores(own.select("window").distinct(), counts)
    return own.join(scores, "window").groupBy("row").agg((F.sum(F.col("score") * F.col("n")) / F.sum("n") / 2.0**32).alias("difference"))


def _threshold(scored: DataFrame) -> float:
    bins = F.floor(F.greatest(F.lit(-_REACH), F.least(F.lit(_REACH), F.col("difference"))) * (_BINS / 2 / _REACH))
    tally = scored.where("calibrates").groupBy("model", bins.alias("bin")).count().collect()  # at most 2 * (_BINS + 1) rows
    # share of the allowed below, and of the blocked at or above, each possible threshold
    by_bin = np.zeros((2, _BINS + 2))
    for r in tally:
        by_bin[r.model, r.bin + _BINS // 2] += r["count"]
    if not by_bin.sum(1).all():
        return 0.0
    share = by_bin / by_bin.sum(1, keepdims=True)
    wrong = np.append(0, np.cumsum(share[0])) + 1 - np.append(0, np.cumsum(share[1]))
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    at = best[np.argmin(np.abs(best - _BINS // 2))]  # of equally good thresholds, the one nearest 0
    return float((at - _BINS // 2) * (2 * _REACH / _BINS))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """`page_id, host, path, rule, verdict, difference` for every row of `pages`.

    The longest rule that fits decides; else the models do: allow at or above the threshold. A NULL url, or one without
    `://`, has an empty host and path and is judged as such. If rules allow none or block none, the models
    cannot differ and allow.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, says = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = stage(
        parsed.withColumns({"rule": rule, "says": says}).withColumns({
            "row": F.monotonically_increasing_id(),
            "model": F.when(F.col("says") == "allow", 0).when(F.col("says").isNotNull(), 1).cast("long"),
            "calibrates": F.col("says").isNotNull() & (F.pmod(F.xxhash64("host", "path"), F.lit(5)) == 0),
        }),
        "url-rows",
    )
    bodies = ruled.withColumn("body", F.concat("host", "path"))
    counts = stage(window_counts(bodies.where("model IS NOT NULL AND NOT calibrates")), "url-windows")
    total = counts.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b")).first()
    if total.a and total.b:
        scored = stage(ruled.join(differences(bodies, counts), "row"), "url-scores")
        threshold = _threshold(scored)
    else:
        scored, threshold = ruled.withColumn("difference", F.lit(0.0)), 0.0
    method = F.when(F.col("difference") >= threshold, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("says", method).alias("verdict"), "difference")
