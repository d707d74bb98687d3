"""Rates of the mixture against a dense Newton iteration, and targets met by very uneven sources."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest

from smogway.llm.mixing import CAP, mix

SCHEMA = "doc_id long, text string, source string, size int, rate int, copies string, target double"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, 2, "c", 0.0) for i, t, s in rows], SCHEMA)


def solved(sizes, target):
    """Rates of one source by bisection on the whole line: cap / (1 + (cap - 1) * exp(-dual * size))."""
    if target >= CAP * sum(sizes) * (1 - 1e-9):
        return [CAP] * len(sizes)
    if target <= 0:
        return [0.0] * len(sizes)

    def rates(dual):
        return [CAP / (1 + (CAP - 1) * math.exp(min(-dual * s, 700))) for s in sizes]

    lo, hi = -750 / min(filter(None, sizes)), 750 / min(filter(None, sizes))
    for _ in range(300):
        mid = (lo + hi) / 2
        if sum(r * s for r, s in zip(rates(mid), sizes)) > target:
            hi = mid
        else:
            lo = mid
    return rates(lo)


def test_a_long_document_beside_short_ones(spark):
    """Sizes of 10 and 20,000 words, where exp(dual * size) would overflow; the target can be met by the short ones."""
    rows = [(i, "w " * 10, "a") for i in range(1000)] + [(5000, "w " * 20_000, "a")]
    rows += [(10_000 + i, "w " * 100, "b") for i in range(940)]
    out = [r for r in mix(frame(spark, rows)).collect() if r.source == "a"]
    assert abs(sum(r.taken for r in out) - out[0].target) <= 10
    assert out[0].target < 3 * 30_000 and max(r.taken / r["size"] for r in out) <= 3


@pytest.mark.parametrize("seed", range(2))
def test_rates_match_a_dense_solution(spark, seed):
    rng = random.Random(seed)
    rows = []
    for k, source in enumerate(["a", "b", "c", None]):
        for i in range(rng.randint(30, 120)):
            n = 0 if rng.random() < 0.05 else int(10 ** rng.uniform(0, 3.7 if k % 2 else 2))
            rows.append((1000 * k + i, "w " * n, source))
    by_source = defaultdict(list)
    for r in mix(frame(spark, rows).repartition(3)).collect():
        by_source[r.source].append(r)
    assert len(by_source) == 4
    for rows_of in by_source.values():
        sizes, target = [r["size"] for r in rows_of], rows_of[0].target
        for r, want in zip(rows_of, solved(sizes, target)):
            assert r["size"] == 0 or abs(r.rate - want) < 1e-5
            assert math.floor(r.rate + 1e-9) <= r.copies <= math.ceil(r.rate - 1e-9) or r.copies in (math.floor(r.rate), math.floor(r.rate) + 1)
        assert abs(sum(r.taken for r in rows_of) - target) <= max(sizes)
