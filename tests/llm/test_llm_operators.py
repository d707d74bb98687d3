"""The training-data operators against brute force, on odd and random small tables."""

from __future__ import annotations

import dataclasses
import hashlib
import os
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from smogway.llm import quality, suffix_dedup, url_filter
from smogway.llm.components import components
from smogway.llm.exact_dedup import drop_exact_copies, exact_groups
from smogway.llm.common import NULL_ID, narrowed, tidy, unpacked
from smogway.llm.fingerprints import combined, edited_texts, fingerprint_edits, lanes, neighbours
from smogway.llm.lattice import decode, encode, read_pieces
from smogway.llm.mixing import mix, repeat_by_mix, source_targets
from smogway.llm.queries import PIECES
from smogway.llm.simhash import keep_one_of_each, near_duplicates, print_links
from smogway.llm.suffix_dedup import remove_repeated_bytes, sorted_classes
from smogway.llm.windows import remove_repeated_windows
from smogway.llm.wordpiece import Automaton, token_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, word int, hash string, size int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


@pytest.fixture(scope="module")
def texts():
    """By doc_id: NULL, empty, white space, copies, near copies, shared passages, repeats, one long text, odd characters."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = prose(60)
    out = {1: None, 2: "", 3: " \t\n ", 4: "One", 5: "one", 6: "x " * 90, 7: "x " * 95, 8: "▁ 日本語\U0001F600\u0085q\n\n"}
    for i in range(10, 40):
        out[i] = f"{prose(rng.randint(0, 120))}\n{passage if i % 3 == 0 else prose(15)}\n{prose(rng.randint(0, 50))}"
    for i in range(40, 50):
        out[i] = out[i - 25]
    for i in range(50, 60):
        words = out[i - 30].split(" ")
        out[i] = " ".join(words[:-1] + ["changed"]) if i % 2 else out[i - 30].upper()
    out[60] = prose(20_000)
    out[61] = out[60][:9000] + "!" + out[60][9001:]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    """With columns whose names the operators use themselves."""
    rows = [(k, t, "en", None if k % 7 == 0 else f"s{k % 4}", 0, 1, "h", 2) for k, t in texts.items()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def repeated(spark):
    rows = [(None, "a b c", None, None, None, None, None, None), (None, "a b c", None, None, None, None, None, None),
            (1, None, "en", "s", 0, 0, "", 0), (1, None, "en", "s", 0, 0, "", 0), (2, "a b c", "en", "s", 0, 0, "", 0)]
    return spark.createDataFrame(rows, SCHEMA)


def sha(raw: bytes | str) -> str:
    return hashlib.sha256(raw.encode() if isinstance(raw, str) else raw).hexdigest()


def test_fingerprints(spark, docs, texts, empty, repeated):
    got = {r.doc_id: r for r in fingerprint_edits(docs).collect()}
    ids = sorted(texts)
    for i, k in enumerate(ids):
        own, following = texts[k] or "", texts[ids[(i + 1) % len(ids)]] or ""
        q = len(own) // 4
        assert (got[k].n_chars, got[k].edited_sha256) == (len(own), sha(own[: len(own) - q] + following[:q]))
        assert 0 <= got[k].near_edited <= 1 and 0 <= got[k].near_next <= 1
    prints = defaultdict(set)
    for k in ids:
        prints[texts[k] or ""].add(got[k].fingerprint)
    assert all(len(v) == 1 for v in prints.values())
    assert got[60].near_edited > 0.5 > got[4].near_next and got[1].near_next == 1  # NULL is followed by empty
    assert fingerprint_edits(empty).count() == 0
    assert Counter(r.doc_id for r in fingerprint_edits(repeated).collect()) == {None: 2, 1: 2, 2: 1}
    again = fingerprint_edits(repeated).where("doc_id = 2 OR doc_id IS NULL")
    assert again.select("fingerprint").distinct().count() == 1


def test_fingerprints_are_a_homomorphism(spark):
    rows = [("a", "one two\nthree"), ("b", "four\nthree"), ("ab", "three\nfour\none two\nthree"), ("ba", "four\nthree\nthree\none two")]
    got = {r.k: r for r in lanes(spark.createDataFrame(rows, "k string, t string"), ["k"], "t").collect()}
    assert got["ab"].lanes == got["ba"].lanes
    pair = spark.createDataFrame([(got["a"].lanes, got["b"].lanes, got["ab"].lanes)], "a array<bigint>, b array<bigint>, ab array<bigint>")
    both, less = pair.select(combined(F.col("a"), F.col("b")), combined(F.col("ab"), F.col("b"), -1)).first()
    assert both == got["ab"].lanes and less == got["a"].lanes


def brute_bytes(texts: dict, length: int = 50) -> dict:
    seen, out = set(), {}
    for k in sorted(texts):
        raw = (texts[k] or "").encode()
        gone, mine = bytearray(len(raw)), set()
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            mine.add(s)
            if s in seen:
                gone[i : i + length] = b"\1" * length
        seen |= mine
        runs = [r for r in bytes(gone).split(b"\0") if r]
        out[k] = (len(raw), sum(gone), len(runs), bytes(b for b, g in zip(raw, gone) if not g))
    return out


def test_suffix_dedup(docs, texts, empty, repeated):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in remove_repeated_bytes(docs).collect()}
    assert got == brute_bytes(texts)
    assert remove_repeated_bytes(empty).count() == 0
    assert {r.n_removed for r in remove_repeated_bytes(repeated).collect()} == {0}


def buckets_of(rows, parts):
    """The pieces of (doc_id, text), as the buckets get them."""
    ids, texts = zip(*rows)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "text": list(texts)})
    dealt = defaultdict(list)
    for row in suffix_dedup._pieces(parts, 50)(iter([batch])):
        dealt[row.column("bucket")[0].as_py()].append(row)
    return [pa.Table.from_batches(x) for x in dealt.values()]


def marked(buckets, parts):
    """The bytes that they mark, as (doc_id, byte)."""
    out = set()
    for bucket in buckets:
        for row in suffix_dedup._repeats(parts, 50)((), bucket).to_pylist():
            for d, f, s in zip(unpacked(row["docs"], np.int64), unpacked(row["first"], np.uint32), unpacked(row["size"], np.uint32)):
                out |= {(int(d), int(f) + i) for i in range(s)}
    return out


def brute_marked(rows):
    first, out = {}, set()
    windows = [(i, d, t.encode()[i : i + 50]) for d, t in rows for i in range(len(t.encode()) - 49)]
    for _, d, w in windows:
        first[w] = min(d, first.get(w, d))
    for i, d, w in windows:
        if first[w] < d:
            out |= {(d, i + k) for k in range(50)}
    return out


@pytest.mark.parametrize("suffixes", [1, 40, 10**6])
def test_suffixes_are_sorted_some_at_a_time(monkeypatch, suffixes):
    monkeypatch.setattr(suffix_dedup, "_SUFFIXES", suffixes)
    monkeypatch.setattr(suffix_dedup, "_HELD_BYTES", 3000)
    rng = random.Random(8)
    base = "".join(rng.choice("abc ") for _ in range(700))
    rows = [(NULL_ID, base[:300]), (NULL_ID, base[100:500]), (-7, "ab" * 150), (2**62, "ba" * 140 + base[600:]), (-7, base[50:130])]
    for i in range(40):  # texts that share an anchor but no string of 50 bytes, beside some that share longer ones
        cut = rng.randint(0, 500)
        text = base[cut : cut + rng.choice((35, 45, 120))]
        rows.append((900 - 20 * i, "".join(rng.choice("xyz") for _ in range(30)) + text + "".join(rng.choice("xyz") for _ in range(30))))
    for parts in (1, 9):
        assert marked(buckets_of(rows, parts), parts) == brute_marked(rows)


def varied(copies, size):
    """Texts of which most strings of 20 bytes stand in all others, but none of 50 bytes in any."""
    rng = np.random.default_rng(4)
    base = rng.integers(97, 123, size).astype(np.uint8)
    out = []
    for i in range(copies):
        own = base.copy()
        own[i::45] = 48 + i
        out.append((i, own.tobytes().decode()))
    return out


def test_sorting_suffixes_takes_little_room():
    (bucket,) = buckets_of([(i, text + "=" + "0123456789" * 6) for i, text in varied(20, 120_000)], 1)
    tracemalloc.start()
    found = suffix_dedup._repeats(1, 50)((), bucket)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.num_rows == 1
    assert set(unpacked(found.column("docs")[0].as_py(), np.int64)) == set(range(1, 20))
    assert most < 150e6


def test_texts_that_share_anchors_only():
    (bucket,) = buckets_of(varied(3, 4000), 1)
    assert suffix_dedup._repeats(1, 50)((), bucket).num_rows == 0


def test_pieces_travel_in_few_bytes():
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(3000))) for i in range(300)]
    buckets = buckets_of(rows, 40)
    sent = sum(len(x) for b in buckets for name in b.column_names if name not in ("bucket", "text") for x in b.column(name).to_pylist())
    pieces = sum(int(unpacked(x, np.uint8).reshape(4, -1).sum(1) @ 256 ** np.arange(4)) for b in buckets for x in b.column("times").to_pylist())
    assert sent < 5 * pieces


def test_suffix_buckets_follow_the_bytes(docs, texts, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 3000)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in remove_repeated_bytes(docs).collect()}
    assert got == brute_bytes(texts)


def test_deep_shallow_sort_finds_equal_strings():
    rng = np.random.default_rng(3)
    data = rng.choice(np.frombuffer(b"ab", np.uint8), 400)
    data[200:300] = data[50:150]
    data = np.append(data, np.zeros(60, np.uint8))
    at, group = np.tile(np.arange(350), 2), np.repeat([0, 1], 350)
    who, classes = sorted_classes(group, at, data, 50)
    expected = defaultdict(list)
    for i, (g, a) in enumerate(zip(group, at)):
        expected[g, data[a : a + 50].tobytes()].append(i)
    found = defaultdict(list)
    for i, c in zip(who, classes):
        found[c].append(i)
    assert sorted(sorted(v) for v in found.values() if len(v) > 1) == sorted(v for v in expected.values() if len(v) > 1)


def test_window_dedup(docs, texts, empty, repeated):
    seen, expected = set(), {}
    for k in sorted(texts):
        words = WORDS(texts[k] or "")
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        expected[k] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in remove_repeated_windows(docs).collect()}
    assert got == expected
    assert remove_repeated_windows(empty).count() == 0
    assert len(remove_repeated_windows(repeated).collect()) == 5


def simhash(text: str) -> int:
    words = WORDS("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def roots(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash(docs, texts, empty, repeated):
    prints = {k: simhash(t or "") for k, t in texts.items()}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    expected = roots(prints, links)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == {k: (f"{prints[k]:016x}", expected[k]) for k in prints}
    assert near_duplicates(empty).count() == 0
    assert {r.component_id for r in near_duplicates(repeated).collect()} == {None, 1}
    assert sorted(r.doc_id for r in keep_one_of_each(docs).collect()) == sorted(set(expected.values()))


def test_near_copies_go_by_id_and_text(spark):
    """A document that shares its doc_id with a copy of another, but not its text, stays; so do equal rows of the first."""
    a, b = "one two three four five six seven eight", "nothing of the other one is to be found in here at all"
    rows = spark.createDataFrame([(1, a, 0), (5, a, 0), (5, b, 0), (1, a, 0), (None, "x y z", 0), (7, None, 0)], "doc_id long, text string, drop_id int")
    kept = sorted(((r.doc_id, r.text) for r in keep_one_of_each(rows).collect()), key=str)
    assert kept == sorted([(1, a), (1, a), (5, b), (None, "x y z"), (7, None)], key=str)
    assert keep_one_of_each(rows.limit(0)).collect() == []


@pytest.mark.parametrize("tile", [8192, 40])
def test_links_of_dense_and_tiled_cells(spark, monkeypatch, tile):
    """Balls of prints within few bits, large enough for searched cells and for tiles."""
    monkeypatch.setattr("smogway.llm.simhash.TILE", tile)
    rng = random.Random(9)
    prints = set()
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(350):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    prints = [p - (p >> 63 << 64) for p in prints]
    links = print_links(spark.createDataFrame([(p,) for p in prints], "fingerprint long")).collect()
    array = np.array(prints).view(np.uint64)
    near = np.bitwise_count(array[:, None] ^ array) <= 4
    expected = roots(prints, [(prints[i], prints[j]) for i, j in zip(*np.nonzero(near)) if i < j])
    assert roots(prints, [(r.a, r.b) for r in links]) == expected


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (201, 200), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = roots({n for a, b in links if a != b for n in (a, b)}, links)
    assert got == expected


def test_exact_dedup(docs, texts, empty, repeated):
    groups = defaultdict(list)
    for k, t in texts.items():
        groups[t or ""].append(k)
    expected = {k: (max(v), len(v), k == max(v), sha(t)) for t, v in groups.items() for k in v}
    for cells in (1 << 28, 1 << 17):
        got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_groups(docs, cells).collect()}
        assert got == expected
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(max(v) for v in groups.values())
    assert exact_groups(empty).count() == 0 and drop_exact_copies(empty).count() == 0
    flags = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_groups(repeated).collect()]
    assert Counter(flags) == Counter([(None, 2, 3, False)] * 2 + [(2, 2, 3, True), (1, 1, 2, True), (1, 1, 2, False)])
    assert sorted(r.doc_id for r in drop_exact_copies(repeated).collect()) == [1, 2]


def test_mixture(docs, texts, empty, repeated):
    got = mix(docs).collect()
    assert {r.doc_id: r["size"] for r in got} == {k: len(WORDS(t or "")) for k, t in texts.items()}
    total = sum(r["size"] for r in got)
    assert sum(s.target for s in {r.source: r for r in got}.values()) == pytest.approx(total)
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert own[0].target <= 3 * own[0].source_size + 1e-6
        largest = max(r["size"] for r in own)
        assert abs(sum(r.taken for r in own) - own[0].target) <= largest
    assert all(r.taken <= 3 * r["size"] for r in got)
    assert sorted(map(tuple, mix(docs.repartition(2)).select("doc_id", "taken").collect())) == sorted((r.doc_id, r.taken) for r in got)
    copies = Counter(r.doc_id for r in repeat_by_mix(docs).collect())
    assert copies == {r.doc_id: r.copies for r in got if r.copies}
    assert mix(empty).count() == 0 and repeat_by_mix(empty).count() == 0
    assert mix(repeated).count() == 5


def test_targets_reshare_what_caps_leave(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 5), (None, 0), ("d", 200)], "source string, size long")
    got = {r.source: r.target for r in source_targets(sizes).collect()}
    weight = {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}
    size = {"a": 10, "b": 1000, "c": 5, "d": 200, None: 0}
    expected, open_, rest = {}, set(size), 1215.0
    while True:
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * size[s]}
        if not over:
            break
        for s in over:
            expected[s] = 3.0 * size[s]
            rest -= expected[s]
        open_ -= over
    assert got == pytest.approx(expected | share)


def test_quality(spark, empty):
    rng = random.Random(2)
    good = lambda: " ".join("".join(rng.choice("aeinrst") for _ in range(5)) for _ in range(60)) + "."
    bad = lambda: " ".join("".join(rng.choice("AEINRST") for _ in range(5)) + "!!" for _ in range(60))
    rows = [(i, good() if i % 3 else bad(), None, None, None, None, None, None) for i in range(600)]
    rows += [(1000, None, None, None, None, None, None, None), (None, "abc", None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(600)] + [(5, None), (None, 1), (9999, 0)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert len(got) == 602 and all(0 <= r.score <= 1 for r in got.values())
    held = [k for k in range(600) if got[k].held_out]
    assert 60 < len(held) < 200
    assert np.mean([got[k].predicted == (k % 3 > 0) for k in held]) > 0.95
    plain = quality.fit(docs, labels.where("false"))
    assert {r.score for r in quality.score(docs, plain).collect()} == {0.5}
    assert quality.score(empty, plain).count() == 0
    assert quality.keep_good(docs, plain).columns == docs.columns
    one_sided = quality.fit(docs, labels.where("quality = 1"))
    assert quality.score(docs, one_sided).where("predicted = 1").count() == 602


def test_context_sums_are_those_of_all_batches():
    texts = ["ab cd ab", None, "", "Cd x. ab cd cd cd e"]
    batches = [pa.RecordBatch.from_arrays([pa.array([t], pa.string())], ["text"]) for t in texts * 2]
    expected = defaultdict(lambda: np.zeros(32))
    for text in filter(None, texts * 2):
        data = np.frombuffer(text.encode(), np.uint8)
        words, shapes, _, _ = quality._terms(data, np.array([0, len(data)]))
        own = quality._index_vectors(words) + quality._index_vectors(shapes)
        for i in range(len(words)):
            for j in range(max(0, i - 2), min(len(words), i + 3)):
                for term in (words[i : i + 1], shapes[i : i + 1]):
                    expected[int(quality._rows_of(term)[0])] += own[j] * (i != j)
    got = [r for b in quality._contexts(iter(batches)) for r in b.to_pylist()]
    assert [r["at"] for r in got] == sorted(expected)
    assert all(np.array_equal(np.frombuffer(r["sum"]), expected[r["at"]]) for r in got)


def test_context_sums_take_little_room():
    texts = pa.array([" ".join(f"w{(i * 7919 + k * k) % 5000}" for k in range(2000)) for i in range(100)])
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    tracemalloc.start()
    rows = pa.Table.from_batches(list(quality._contexts(iter([batch, batch, batch]))))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    at = rows.column("at").to_pylist()
    assert len(at) == len(set(at)) > 4000
    assert most < 100e6


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="no figures of memory")
def test_a_pass_gives_memory_back():
    def held():
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"\nAnonymous:\s+(\d+)", f.read())[1]) / 1024

    pinned = []

    def run(batches):
        some = [np.ones(50_000, np.uint8) for _ in range(4000)]
        pinned.append(np.ones(50_000, np.uint8))  # above what is freed
        del some
        yield from batches

    before = held()
    assert list(tidy(run)(iter([]))) == []
    assert held() - before < 100


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = (None, None)
    for rule, verdict in url_filter.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and len(rule) > len(best[0] or ""):
            best = (rule, verdict)
    return host, path, *best


def test_url_filter(spark):
    urls = [None, "", "no scheme", "://", "http://EXAMPLE.com/en/1?x#y", "https://www.example.com/en/2", "x://a.www.example.com/en/3",
            "http://notexample.net/es/1", "http://net/es/", "http://a.net/esx", "http://a.com", "http://a.com?/en/", "http://É.com/a\nb#c"]
    urls += [f"http://good{i}.com/{i}" for i in range(60)] + [f"http://spam{i}.net/es/{i}" for i in range(60)]
    urls += ["http://good5.org/7", "http://spam7.org/es/9"]
    pages = spark.createDataFrame([(i, u, "host") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = {r.page_id: r for r in url_filter.judge(pages).collect()}
    for i, url in enumerate(urls):
        host, path, rule, verdict = brute_rule(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == (verdict or got[i].verdict) and got[i].verdict in ("allow", "block")
    assert got[len(urls) - 2].difference > got[len(urls) - 1].difference
    assert (got[len(urls) - 2].verdict, got[len(urls) - 1].verdict) == ("allow", "block")
    assert url_filter.judge(pages.where("false")).count() == 0
    assert {r.verdict for r in url_filter.judge(pages.where("page_id < 3")).collect()} == {"allow"}


def test_character_model_probabilities_match_plain_counts():
    texts = [b"aab", b"abab", b"b"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.array([0, 3, 7, 8])
    contexts, pairs, size = url_filter._slots(data, offsets)
    counts = np.stack([np.bincount(x.ravel(), minlength=url_filter.ORDERS * url_filter._SLOTS).astype(float) for x in (contexts, pairs)])
    ratio = url_filter.Ratio(np.stack([counts, np.zeros_like(counts)]), True)
    seen, pair = Counter(), Counter()
    padded = [[257] * 5 + list(t) + [256] for t in texts]
    for t in padded:
        for i in range(5, len(t)):
            for o in range(url_filter.ORDERS):
                seen[tuple(t[i - o : i])] += 1
                pair[tuple(t[i - o : i + 1])] += 1
    expected = []
    for t in padded:
        total = 0.0
        for i in range(5, len(t)):
            p = 1 / 257
            for o in range(url_filter.ORDERS):
                p = (pair[tuple(t[i - o : i + 1])] + 2 * p) / (seen[tuple(t[i - o : i])] + 2)
            total += np.log(p) - np.log(1 / 257)
        expected.append(total / (len(t) - 5))
    assert ratio.difference(data, offsets) == pytest.approx(expected)


def test_url_models_are_exact_for_many_contexts(spark):
    """More distinct contexts than 2**16 slots per order hold apart; scores are still those of plain counts."""
    rng = random.Random(8)
    urls = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40)) for _ in range(4000)] + ["", "é"]
    rows = [(i, u, i % 2) for i, u in enumerate(urls)]
    seen, pair = Counter(), Counter()
    padded = [[257] * 5 + list(u.encode()) + [256] for u in urls]
    for t, (_, _, model) in zip(padded, rows):
        for i in range(5, len(t)):
            for o in range(url_filter.ORDERS):
                seen[model, tuple(t[i - o : i])] += 1
                pair[model, tuple(t[i - o : i + 1])] += 1
    assert sum(len(k[1]) == 5 for k in seen) > 1 << 16
    table = spark.createDataFrame(rows, "row long, body string, model long")
    counts = url_filter.window_counts(table)
    got = {r.row: r.difference for r in url_filter.differences(table, counts).collect()}
    assert len(got) == len(urls)
    for k in [*range(0, 4000, 200), 1, 4000, 4001]:
        total, t = 0.0, padded[k]
        for i in range(5, len(t)):
            p = [1 / 257, 1 / 257]
            for m in (0, 1):
                for o in range(url_filter.ORDERS):
                    p[m] = (pair[m, tuple(t[i - o : i + 1])] + 2 * p[m]) / (seen[m, tuple(t[i - o : i])] + 2)
            total += np.log(p[0]) - np.log(p[1])
        assert got[k] == pytest.approx(total / (len(t) - 5), abs=1e-8)


def greedy(word: str, pieces: set[str]) -> int:
    at = n = 0
    while at < len(word):
        size = next((s for s in range(len(word) - at, 0, -1) if word[at : at + s] in pieces), 0)
        n += 1 if size else len(word[at].encode())
        at += size or 1
    return n


def test_token_counts(docs, texts, empty):
    rng = random.Random(1)
    for _ in range(20):
        pieces = {"".join(rng.choice("abc▁") for _ in range(rng.randint(1, 5))) for _ in range(12)}
        automaton = Automaton(pieces)
        for _ in range(200):
            word = "▁" + "".join(rng.choice("abcé") for _ in range(rng.randint(0, 12)))
            assert automaton.count(word) == greedy(word, pieces)
    pieces = {"▁", "a", "b", "ab", "abc", "▁on", "e"}
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in token_counts(docs, pieces).collect()}
    assert got == {k: (len(WORDS(t or "")), sum(greedy("▁" + w, pieces) for w in WORDS(t or ""))) for k, t in texts.items()}
    assert token_counts(empty, pieces).count() == 0


def test_encoding(docs, texts, empty, repeated):
    pieces = read_pieces(PIECES)
    table = {p: (i, c) for p, i, c in pieces.table}
    longest = pieces.longest

    def best(word: str) -> list[int]:
        ways = [(0, 0, [])]
        for j in range(1, len(word) + 1):
            found = []
            for i in range(max(0, j - longest), j):
                if word[i:j] in table:
                    found.append((ways[i][0] + table[word[i:j]][1], i, [table[word[i:j]][0]]))
                elif j - i == 1:
                    raw = ("▁" if word[i] == "\uFDD0" else word[i]).encode()
                    found.append((ways[i][0] + len(raw) * pieces.byte_cost, i, [pieces.byte_ids[b] for b in raw]))
            ways.append(min(found, key=lambda w: w[:2]))
        ids, j = [], len(word)
        while j:
            ids, j = ways[j][2] + ids, ways[j][1]
        return ids

    got = {r.doc_id: r for r in decode(encode(docs, pieces), pieces).collect()}
    assert {k: bytes(r.decoded).decode() for k, r in got.items()} == {k: t or "" for k, t in texts.items()}
    for k in (1, 2, 3, 4, 6, 8, 12, 40, 55):
        words = re.findall(r"\x20?[^\x20\x09-\x0D]+|[\x20\x09-\x0D]", (texts[k] or "").replace("▁", "\uFDD0"))
        assert list(got[k].ids) == [i for w in words for i in best(w.replace(" ", "▁"))]
    assert decode(encode(empty, pieces), pieces).count() == 0
    assert sorted(encode(docs, pieces, decoded=True).collect()) == sorted(got.values())
    assert Counter(r.doc_id for r in encode(repeated, pieces).collect()) == {None: 2, 1: 2, 2: 1}


def whole_path(text: str, pieces) -> list[int]:
    """Viterbi over the whole text, cut nowhere; a literal space mark is no piece."""
    table = {p.replace("▁", " "): (i, c) for p, i, c in pieces.table}
    ways = [(0, 0, [])]
    for j in range(1, len(text) + 1):
        found = []
        for i in range(max(0, j - pieces.longest), j):
            if text[i:j] in table:
                found.append((ways[i][0] + table[text[i:j]][1], i, [table[text[i:j]][0]]))
            elif j - i == 1:
                raw = text[i].encode()
                found.append((ways[i][0] + len(raw) * pieces.byte_cost, i, [pieces.byte_ids[b] for b in raw]))
        ways.append(min(found, key=lambda w: w[:2]))
    ids, j = [], len(text)
    while j:
        ids, j = ways[j][2] + ids, ways[j][1]
    return ids


def assert_whole_paths(spark, texts: list[str]) -> None:
    pieces = read_pieces(PIECES)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in encode(rows, pieces, decoded=True).collect()}
    assert {i: bytes(got[i].decoded).decode() for i in got} == dict(enumerate(texts))
    assert {i: list(got[i].ids) for i in got} == {i: whole_path(t, pieces) for i, t in enumerate(texts)}


def test_encoding_across_white_space(spark):
    rng = random.Random(4)
    mixed = ["".join(rng.choice(" \t\n\r\x0b;)}ax") for _ in range(60)) for _ in range(30)]
    assert_whole_paths(spark, ["if x:\n        y  =   1\n" + " " * 37 + "z", "f(a);\r\n  }\r\n\r\n", "  ", "\t \n  \r", *mixed])


def test_encoding_of_space_marks_and_noncharacters(spark):
    assert_whole_paths(spark, ["\uFDD0", "a\uFDD0b ▁\uFDD0▁ c", "▁▁ ▁a▁b", "\uFDD1\uFFFE\U0010FFFF x", "\x00 \x00a"])


def test_encoding_of_long_words(spark):
    rng = random.Random(6)
    letters = "".join(rng.choice("etaoinsr") for _ in range(2000))
    texts = ["a" * n for n in (95, 96, 97, 112, 191, 192, 193, 1000)]
    texts += [" " * 700 + "x", letters, "x " + "the" * 300 + " y", "=" * 500 + letters[:150] + "é\U0001F600" * 90, "日本語の文章" * 60]
    assert_whole_paths(spark, texts)


def test_documents_stay_where_their_blocks_are_written(spark):
    """Only the paths of words go by block; the documents of a block are read in the task that needs them."""
    pieces = read_pieces(PIECES)
    rows = spark.createDataFrame([(1, "a b"), (2, ""), (3, None), (None, "a b c")], "doc_id long, text string").repartition(3)
    names = {t.name for t in spark.catalog.listTables()}
    encoded = encode(rows, pieces)
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(block") == 1 and "Bucketed: true" in plan
    assert {t.name for t in spark.catalog.listTables()} == names
    expected = {1: whole_path("a b", pieces), 2: [], 3: [], None: whole_path("a b c", pieces)}
    assert {r.doc_id: list(r.ids) for r in encoded.collect()} == expected
    assert [(r.doc_id, list(r.ids)) for r in encode(rows.where("doc_id = 2"), pieces).collect()] == [(2, [])]


def test_costs_stay_small_in_long_words(spark):
    """Counted from the start of the word, the costs of this path would pass 31 bits."""
    pieces = read_pieces(PIECES)
    dear = dataclasses.replace(pieces, table=[(p, i, 100 * c) for p, i, c in pieces.table], byte_cost=100 * pieces.byte_cost)
    text = "a" * 20_003
    row = encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), dear).first()
    assert list(row.ids) == whole_path(text, dear)


def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline

    docs.drop("word", "hash", "size").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1) for k in range(20)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    before = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = function(spark, before, str(tmp_path))
        assert after.columns == before.columns
        ids = {r.doc_id for r in before.collect()}
        assert {r.doc_id for r in after.collect()} <= ids
        path = f"{tmp_path}/{name}"
        after.write.parquet(path)
        before = spark.read.parquet(path)
    last = corpus_pipeline.STAGES[-1][1](spark, before, str(tmp_path)).collect()
    expected = Counter((r.doc_id, sha(r.text or "")) for r in before.collect())
    assert Counter((r.doc_id, r.decoded_sha256) for r in last) == expected
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == Counter(r.doc_id for r in last)


def test_repeated_rows_are_joined_once(spark):
    """Forty copies of one row beside thirty of the next: as many rows with texts, not their product."""
    rows = [(1, "a b\nc d e f")] * 40 + [(2, "x y z")] * 30 + [(3, "q")]
    docs = narrowed(spark.createDataFrame(rows, "doc_id long, text string"))
    assert edited_texts(docs, neighbours(docs)).count() == 71
    assert fingerprint_edits(docs).groupBy("doc_id").count().orderBy("doc_id").collect() == [(1, 40), (2, 30), (3, 1)]
