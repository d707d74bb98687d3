"""Product codes against trying every entry."""

from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from smogway.llm import pivot_codes

SCHEMA = "vec_id long, embedding array<float>, label int, part int, code string, far double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "c", 0.0) for i, v, label in rows], SCHEMA)


def expected(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    each = -(-len(kept[0][1]) // parts)
    kept = [(i, v + [0] * (each * parts - len(v)), label) for i, v, label in kept if len(v) == len(kept[0][1])]
    cut = lambda v, j: v[j * each : (j + 1) * each]
    books = [[cut(v, j) for _, v, _ in kept[:entries]] for j in range(parts)]

    def assign(v, j):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, j), e)), k) for k, e in enumerate(books[j]))

    for _ in range(rounds):
        for j in range(parts):
            own = defaultdict(list)
            for _, v, _ in kept:
                own[assign(v, j)[1]].append(cut(v, j))
            books[j] = [[sum(c) // len(own[k]) for c in zip(*own[k])] if k in own else e for k, e in enumerate(books[j])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = []
    for i, v, label in kept:
        found = [assign(v, j) for j in range(parts)]
        coded.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    sums = defaultdict(int)
    for *_, error, label in coded:
        sums[label] += error
    return sorted(((i, c, e, sums[label], digest) for i, c, e, label in coded), key=str)


def found(codes):
    return sorted(map(tuple, pivot_codes.with_label_errors(codes).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    """Bad vectors, NULL ids and labels, equal vectors and ids, ties, one label for a third of the rows, another length."""
    rng = random.Random(4)
    vector = lambda: [rng.choice((rng.uniform(-1, 1), 0.5, -0.25)) for _ in range(32)]
    out = [(i, vector(), None if i % 5 == 0 else 7 if i % 3 == 0 else i % 4) for i in range(200)]
    out += [(300, None, 1), (-5, [], 1), (-4, [None] * 32, 1), (-3, [float("nan")] * 32, 1), (-2, [float("inf"), *[0.0] * 31], 1)]
    out += [(None, vector(), 1), (None, vector(), None), (400, [0.0] * 16, 2), (3, vector(), 2), (17, out[17][1], 2)]
    return out + [(i, [0.5] * 32, 9) for i in range(500, 540)]


def test_codes_match_trying_every_entry(spark, rows):
    assert found(pivot_codes.product_codes(frame(spark, rows).repartition(4))) == expected(rows)


def test_few_vectors_and_lengths_that_do_not_divide(spark):
    rows = [(i, [0.1 * i, -0.2, 0.3 * i, 0.01, 1.0], i % 2) for i in range(9)]
    assert found(pivot_codes.product_codes(frame(spark, rows), parts=2, entries=4)) == expected(rows, parts=2, entries=4)


def test_no_vectors(spark):
    codes = pivot_codes.product_codes(frame(spark, [(1, None, 1), (2, [float("nan")], 1)]))
    assert found(codes) == [] and codes.codebooks.shape == (16, 0, 0)


def test_components_beyond_exact_distances_are_refused(spark):
    with pytest.raises(ValueError):
        pivot_codes.product_codes(frame(spark, [(1, [1e9] * 16, 1)]))


def test_bounds_prune_and_keep_the_nearest():
    rng = np.random.default_rng(1)
    book = rng.integers(-300, 300, (64, 4))
    x = book[rng.integers(0, 64, 500)] + rng.integers(-5, 6, (500, 4))
    pivots = pivot_codes._pivots(book, 3)
    far = np.sqrt(pivot_codes._distances(x, pivots)).astype(np.float32)
    found_, best, tried = pivot_codes.nearest(x, far, book, pivots)
    exact = pivot_codes._distances(x, book)
    assert (found_ == exact.argmin(1)).all() and (best == exact.min(1)).all()
    assert tried < exact.size / 4
