"""Token alignment against every pair of tokens, with the tokenizers' own libraries."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from smogway.llm import alignment
from smogway.llm.queries import BYTE_LEVEL, PIECES

SCHEMA = "doc_id long, text string, block long, pair string, n_a int, slots string"
NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def rows():
    """NULL id, NULL, empty, white space, special strings, odd characters, copies, repeated rows, a long text."""
    rng = random.Random(2)
    words = ["the", "Straße", "naïve", "日本語", "\U0001F600", "x" * 30, "and", "hello,", "don't", "  ", "\n", "\t", "▁", "1234567", "́"]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    out = [(None, "a b"), (1, None), (2, ""), (3, " "), (4, "<|endoftext|> <s></s> <0x41>"), (5, "a\x00b﷐﻿"), (6, "\r\n \r")]
    out += [(i, prose(rng.randint(0, 40))) for i in range(10, 70)]
    out += [(i, out[i - 50][1]) for i in range(70, 80)]
    return [*out, (4, "same id"), (7, "the the the"), (7, "the the the"), (90, prose(3000))]


@pytest.fixture(scope="module")
def sides():
    return alignment.read_byte_level(BYTE_LEVEL), alignment.read_pieces(PIECES)


def tokenizations(text):
    a, b = Tokenizer.from_file(BYTE_LEVEL), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    alphabet = alignment._byte_alphabet()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(map(alphabet.__getitem__, a.id_to_token(i))) for i in ids_a]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
    whole = b" " + text.encode()
    if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return [], []
    return list(zip(ids_a, bytes_a)), list(zip(ids_b, bytes_b))


def spans(side):
    at, out = 0, []
    for i, raw in side:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def expected(rows):
    docs = []
    for doc_id, text in rows:
        a, b = map(spans, tokenizations(text or ""))
        links = [(i, j) for i, x, y in a for j, s, t in b if x < t and s < y] if len(a) < 500 else None
        if links is None:  # the same over two ascending lists
            links, k = [], 0
            for i, x, y in a:
                while k and b[k][1] >= x:
                    k -= 1
                while b[k][2] <= x:
                    k += 1
                m = k
                while m < len(b) and b[m][1] < y:
                    links.append((i, b[m][0]))
                    m += 1
        cuts = sorted({y for _, _, y in a} & {t for _, _, t in b})
        groups = []
        for low, high in zip([0, *cuts], cuts):
            inside = [",".join(str(i) for i, x, y in side if low <= x and y <= high) for side in (a, b)]
            groups.append("|".join(inside))
        docs.append((doc_id, len(a), len(b), len(cuts), links, ";".join(groups)))
    count = Counter(p for d in docs for p in set(d[4]))
    best = {}
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    return Counter(
        (doc_id, n_a, n_b, n_groups, len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
         hashlib.sha256(groups.encode()).hexdigest() if n_a else "")
        for doc_id, n_a, n_b, n_groups, links, groups in docs
    )


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "p", 2, "s") for i, t in rows], SCHEMA)


def found(df):
    return Counter(tuple(r[n] for n in NAMES) for r in df.collect())


def test_alignment_matches_all_pairs(spark, rows, sides):
    assert found(alignment.align(frame(spark, rows).repartition(3), *sides)) == expected(rows)


def test_small_blocks_give_the_same(spark, rows, sides, monkeypatch):
    monkeypatch.setattr(alignment, "ALIGNED_BYTES", 300)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 1000)
    assert found(alignment.align(frame(spark, rows[:60]).repartition(2), *sides)) == expected(rows[:60])


def test_texts_without_tokens(spark, sides):
    out = alignment.align(frame(spark, [(1, None), (2, "")]), *sides)
    assert found(out) == Counter({(1, 0, 0, 0, 0, 0, 0, ""): 1, (2, 0, 0, 0, 0, 0, 0, ""): 1})
    assert alignment.align(frame(spark, [(1, "a")]).limit(0), *sides).collect() == []


def test_groups_of_a_text(spark, sides):
    text = "Hello naïve 日本"
    (row,) = alignment.aligned_groups(frame(spark, [(1, text)]), *sides).collect()
    a, b = tokenizations(text)
    left = [i for g in row.groups.split(";") for i in g.split("|")[0].split(",")]
    right = [i for g in row.groups.split(";") for i in g.split("|")[1].split(",")]
    assert left == [str(i) for i, _ in a] and right == [str(i) for i, _ in b]


def test_files_of_another_kind_are_refused(sides):
    import json

    file = json.loads(sides[0].data)
    file["model"]["merges"].reverse()
    with pytest.raises(ValueError):
        alignment._byte_level(json.dumps(file).encode())
