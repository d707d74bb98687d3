"""Katz backoff scores against plain dictionaries, and that probabilities add up to one."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from smogway.llm import backoff

SCHEMA = "doc_id long, text string, block int, score double, parts string, held string"
WORDS = re.compile(rb"[^\x20\x09-\x0D]+").findall


def tokens(text: str | None) -> list[bytes]:
    return WORDS((text or "").encode().lower()) + [b" "]


def discounts(counts: Counter) -> dict[int, float]:
    n = Counter(counts.values())
    for k in (5, 4, 3, 2, 1):
        if all(n[i] for i in range(1, k + 2)) and (lost := (k + 1) * n[k + 1] / n[1]) < 1:
            d = {r: ((r + 1) * n[r + 1] / (r * n[r]) - lost) / (1 - lost) for r in range(1, k + 1)}
            if all(0 < x <= 1 for x in d.values()):
                return d
    taken = min(n[1] / (n[1] + 2 * n[2]), 0.9) if n[1] else 0.0
    return {r: (r - taken) / r for r in range(1, 6)}


class Plain:
    """The same model from its definition."""

    def __init__(self, texts: list[str | None]):
        self.c, self.pairs = Counter(), Counter()
        for t in texts:
            words = tokens(t)
            self.c.update(words)
            self.pairs.update(zip([b" ", *words], words))
        self.n = sum(self.c.values())
        self.d1, self.d2 = discounts(self.c), discounts(self.pairs)
        left = sum((1 - self.d1.get(x, 1.0)) * x for x in self.c.values())
        self.total, self.unknown = (self.n, left / self.n) if left > 0 else (self.n + 1, 1 / (self.n + 1))
        self.after = defaultdict(dict)
        for (u, w), r in self.pairs.items():
            self.after[u][w] = r

    def word(self, w: bytes) -> float:
        return self.d1.get(self.c[w], 1.0) * self.c[w] / self.total if self.c[w] else self.unknown

    def pair(self, u: bytes, w: bytes) -> float:
        if not self.c[u]:
            return self.word(w)
        after = self.after[u]
        left = sum((1 - self.d2.get(r, 1.0)) * r for r in after.values())
        total, left = (self.c[u], left) if left > 0 else (self.c[u] + 1, 1.0)
        if w in after:
            return self.d2.get(after[w], 1.0) * after[w] / total
        return left / total / (1 - sum(self.word(x) for x in after)) * self.word(w)

    def base(self, w: bytes) -> float:
        return (self.c[w] + 0.1) / (self.n + 0.1 * (len(self.c) + 1))


def is_held(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


@pytest.fixture(scope="module")
def rows():
    """NULL id, NULL, empty and white texts, odd characters, copies, repeated rows, one long text, one word everywhere."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdE") for _ in range(rng.randint(1, 4))) for _ in range(250)]
    prose = lambda n: " ".join("the" if rng.random() < 0.34 else rng.choice(vocabulary) for _ in range(n))
    out = [(None, "A b"), (None, None), (1, None), (2, ""), (3, " \t\n"), (4, "The\x0bTHE \x00 \x85é É the"), (4, "the other")]
    out += [(i, prose(rng.randint(0, 60))) for i in range(10, 160)]
    out += [(i, out[i - 140][1]) for i in range(160, 180)]
    out += [(5, "of of of of")] * 3
    out += [(200, prose(6000)), (201, "unseen words " + "x" * 5000)]
    return out


def expected(rows):
    model = Plain([t for i, t in rows if not is_held(i)])
    out = []
    for i, t in rows:
        words = tokens(t)
        score = sum(math.log10(model.pair(u, w)) for u, w in zip([b" ", *words], words))
        base = sum(math.log10(model.base(w)) for w in words)
        out.append((i, is_held(i), len(words), sum(w in model.c for w in words), model.n, round(base, 6), round(score, 6)))
    return Counter(out)


def found(df):
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    return Counter((*(r[n] for n in names), round(r.base_score, 6), round(r.score, 6)) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 0.5, "p", "h") for i, t in rows], SCHEMA)


def test_scores_match_plain_counts(spark, rows):
    assert found(backoff.score(frame(spark, rows).repartition(5))) == expected(rows)


def test_hot_words_dealt_by_both_words_score_alike(spark, rows, monkeypatch):
    """Every word seen twice is hot, and blocks are small."""
    monkeypatch.setattr(backoff, "BLOCK_BYTES", 2000)
    assert found(backoff.score(frame(spark, rows).repartition(2), block_share=10**9)) == expected(rows)


def test_probabilities_add_up_to_one(rows):
    model = Plain([t for i, t in rows if not is_held(i)])
    for u in [b" ", b"the", b"nowhere", *list(model.c)[:40]]:
        assert abs(sum(model.pair(u, w) for w in [*model.c, b"nowhere either"]) - 1) < 1e-9
    assert abs(sum(map(model.base, [*model.c, b"nowhere"])) - 1) < 1e-9


def test_held_out_texts_score_above_the_base(spark):
    """Text with order in it: what follows a word is known better than the word alone."""
    rng = random.Random(3)
    follow = {w: [rng.randrange(80) for _ in range(3)] for w in range(80)}

    def prose():
        w, out = rng.randrange(80), []
        for _ in range(50):
            out.append(f"w{w}")
            w = rng.choice(follow[w])
        return " ".join(out)

    df = backoff.score(frame(spark, [(i, prose()) for i in range(300)])).where("held_out")
    sums = df.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert (sums.s - sums.b) / sums.n > 0.5


def test_empty_and_untrained(spark):
    assert backoff.score(frame(spark, [(1, "a")]).limit(0)).collect() == []
    ids = [i for i in range(200) if is_held(i)]
    (row,) = backoff.score(frame(spark, [(ids[0], "a b")])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)


def test_own_holdout_column(spark):
    rows = frame(spark, [(1, "a b"), (2, "a b")])
    out = {r.doc_id: r for r in backoff.score(rows, held_out=F.col("doc_id") == 2).collect()}
    assert out[1].train_tokens == 3 and out[2].held_out and out[1].score == out[2].score


@pytest.mark.parametrize("n", [[10, 4, 2, 1, 1, 1], [5, 5, 5, 5, 5, 5], [0, 3, 0, 0, 0, 0], [7, 0, 0, 0, 0, 0], [0] * 6, [100, 40, 20, 12, 8, 5]])
def test_discounts_are_proper(n):
    d = backoff.good_turing(np.array(n))
    assert ((d[1:] > 0) & (d[1:] <= 1)).all() and d[-1] == 1
    assert n[0] == 0 or d[1] < 1
