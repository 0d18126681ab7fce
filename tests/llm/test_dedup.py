import hashlib
import os
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from torqueframe.llm import exactdedup, fuse, ngramjoin, suffixdedup
from torqueframe.llm.components import components

WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


@pytest.mark.parametrize("n", [0, 1, 2, 10, 1000, 30_000])
def test_fuse_filter(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(-2 ** 63, 2 ** 63, n, dtype=np.int64)
    data = fuse.build(keys)
    assert fuse.contains(data, keys).all()
    other = rng.integers(-2 ** 63, 2 ** 63, 20_000, dtype=np.int64)
    assert fuse.contains(data, other).mean() < 0.02 and len(data) < 2 * n + 200


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_dedup(make_docs, odd_rows):
    rows = odd_rows + [(i, f"copy  \n{i % 5}", None) for i in range(20, 60)] + [(i, f"copy {i % 5}", None) for i in range(90, 99)]
    classes = defaultdict(list)
    for i, t, _ in rows:
        classes[normal(t)].append(i)
    got = exactdedup.dedup(make_docs(rows)).collect()
    want = Counter()
    for i, t, _ in rows:
        own = classes[normal(t)]
        keep = min((x for x in own if x is not None), default=None)
        want[i, keep, len(own), i == keep, hashlib.sha256(normal(t).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in got) == want
    kept = exactdedup.keep_rows(make_docs(rows))
    assert kept.columns == make_docs([]).columns
    assert Counter(normal(r.text) for r in kept.collect()) == Counter(classes.keys())
    assert exactdedup.dedup(make_docs([])).count() == 0 and exactdedup.keep_rows(make_docs([])).count() == 0


def test_exact_dedup_needs_equal_bytes(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a  b"), (3, "ab")], "doc_id long, text string")
    pairs = spark.createDataFrame([(hashlib.sha256(b"a b").hexdigest(), 2, 1), (hashlib.sha256(b"a b").hexdigest(), 3, 1)],
                                  "text_sha256 string, first_id long, old_id long")
    assert exactdedup.same_bytes(docs, pairs.limit(1), "doc_id", "text").count() == 1
    assert exactdedup.same_bytes(docs, pairs.where("first_id = 3"), "doc_id", "text").count() == 0


def near_classes(rows, k=5, t=0.8):
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").lower())
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and len(sets[i] & sets[j]) >= t * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, least.get(find(i)) if sets[i] else d, links[i], len(sets[i])) for i, (d, _) in enumerate(rows)]


def near_rows(seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(12):
        base = [f"w{x}" for x in rng.integers(0, 5000, 90)]
        for _ in range(int(rng.integers(1, 12))):
            w = list(base)
            for p in rng.integers(0, 90, int(rng.integers(0, 5))):
                w[p] = f"e{rng.integers(0, 10 ** 6)}"
            rows.append((len(rows) + 10, " ".join(w)))
    return rows


@pytest.mark.parametrize("block", [512, 3])
def test_ngram_join(make_docs, odd_rows, monkeypatch, block):
    monkeypatch.setattr(ngramjoin, "BLOCK_SETS", block)
    rows = near_rows() + [r[:2] for r in odd_rows]
    got = ngramjoin.classes(make_docs([(*r, None) for r in rows])).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links, r.n_shingles) for r in got) == Counter(near_classes(rows))


def test_ngram_join_keeps_one_of_each_class(make_docs, odd_rows):
    rows = near_rows(2)
    docs = make_docs([(*r, None) for r in rows])
    kept = ngramjoin.keep_rows(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _, _ in near_classes(rows)})
    odd = ngramjoin.keep_rows(make_docs(odd_rows)).collect()
    empty = sum(not WORD.findall((t or "").lower()) for _, t, _ in odd_rows)
    words = {t for _, t, _ in odd_rows if WORD.findall((t or "").lower())}
    assert len(odd) == empty + len(words)
    assert ngramjoin.classes(make_docs([])).count() == 0 and ngramjoin.keep_rows(make_docs([])).count() == 0


def test_bands_reach_the_recall():
    assert 1 - (1 - 0.8 ** 5) ** ngramjoin.bands_for(0.8, 0.9999, 5) >= 0.9999


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1060)]
    parent = {x: x for e in edges for x in e}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)} | {x: got[x] for x in ()}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=1, max_size=30), min_size=1, max_size=4), st.integers(1, 14),
       st.integers(1, 14))
def test_longest_previous_factor(texts, size, depth):
    depth = min(size, depth)
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    length = np.array([len(t) for t in texts])
    count = np.maximum(0, length - size + 1)
    begin = np.cumsum(length) - length
    rank = suffixdedup.suffix_ranks(data, begin, count, depth)
    windows = [t[i:i + size] for t in texts for i in range(len(t) - size + 1)]
    assert len(rank) == len(windows)
    for i, a in enumerate(windows):
        for j, b in enumerate(windows):
            assert (rank[i] < rank[j]) == (a[:depth] < b[:depth])
    names = np.array([sorted(set(windows)).index(w) for w in windows], dtype=np.int64)
    lpf, source = suffixdedup.longest_previous(rank, names[::1] * 7919 % 101, np.arange(len(windows)), size)
    for p, w in enumerate(windows):
        earlier = [q for q in range(p) if windows[q] == w]
        assert (lpf[p] >= size) == bool(earlier)
        if earlier:
            assert source[p] in earlier


def covered(texts, size, keep_first):
    seen = Counter(t[i:i + size] for t in texts for i in range(len(t) - size + 1))
    first, out = set(), []
    for t in texts:
        cover = [False] * len(t)
        for i in range(len(t) - size + 1):
            w = t[i:i + size]
            if seen[w] > 1 and not (keep_first and w not in first):
                cover[i:i + size] = [True] * size
            first.add(w)
        out.append(cover)
    return out


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("block", [8192, 2])
def test_suffix_dedup(make_docs, monkeypatch, keep_first, block):
    monkeypatch.setattr(suffixdedup, "BLOCK", block)
    rng = np.random.default_rng(3)
    word = lambda n: "".join(rng.choice(list("abcdé \n"), n))
    shared = [word(n) for n in (60, 45, 90, 39, 41)]
    texts = [word(30) + shared[i % 5] + word(int(rng.integers(0, 50))) + shared[(i * 3) % 5] for i in range(14)]
    texts += ["x" * 130, "ab" * 70, word(20), "", None, texts[0], texts[0]]
    docs = make_docs([(i, t, None) for i, t in enumerate(texts)] + [(0, texts[0], None)])
    raw = [(t or "").encode() for t in texts]
    order = [raw[0], *raw]  # the repeated row of id 0 comes beside it
    found = suffixdedup.repeats(docs, size=40, gram=12, keep_first=keep_first)
    got = Counter(tuple(r) for r in suffixdedup.digest(docs, found).collect())
    if keep_first:  # which of two equal rows is first cannot be told: both stay whole
        cover = dict(zip(range(len(texts)), covered(raw, 40, True)))
        got = {r[0]: r for r in got if r[0] != 0}
        for i in range(1, len(texts)):
            kept = bytes(b for b, c in zip(raw[i], cover[i]) if not c)
            assert got[i][4] == hashlib.sha256(kept).hexdigest(), i
        return
    want = Counter()
    for i, (t, c) in enumerate(zip(order, covered(order, 40, False))):
        kept = bytes(b for b, x in zip(t, c) if not x)
        runs = len([r for r in "".join("1" if x else " " for x in c).split()])
        want[max(0, i - 1), len(t), sum(c), runs, hashlib.sha256(kept).hexdigest()] += 1
    assert got == want


def test_suffix_dedup_of_long_texts_in_pieces(monkeypatch):
    rng = np.random.default_rng(9)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    whole = suffixdedup.text_anchors(data, np.array([0, 3000]), 40, 12)
    monkeypatch.setattr(suffixdedup, "PIECE", 170)
    for a, b in zip(whole, suffixdedup.text_anchors(data, np.array([0, 3000]), 40, 12)):
        assert (a == b).all()


def test_suffix_dedup_of_odd_and_empty_tables(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    got = suffixdedup.digest(docs, suffixdedup.repeats(docs)).collect()
    assert len(got) == len(odd_rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[6].n_removed == by[6].n_bytes and by[7].n_removed == by[7].n_bytes and by[8].n_removed == 0
    assert suffixdedup.digest(make_docs([]), suffixdedup.repeats(make_docs([]))).count() == 0


def removed_by_hash(raws, size):
    """Per text the bytes that a window of ``size`` found elsewhere covers: all
    windows of all texts, compared by a 64-bit polynomial hash."""
    rng = np.random.default_rng(1)
    code = rng.integers(0, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = np.uint64(0x9E3779B97F4A7C15)
    most = max(map(len, raws), default=0) + 1
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(most, base)]))
        inverse = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(most, np.uint64(pow(int(base), -1, 2 ** 64)))]))
        hashes = []
        for raw in raws:
            v = code[np.frombuffer(raw, dtype=np.uint8)] * power[:len(raw)]
            p = np.concatenate([[np.uint64(0)], np.add.accumulate(v)]) if len(raw) else np.zeros(1, np.uint64)
            n = max(0, len(raw) - size + 1)
            hashes.append((p[size:size + n] - p[:n]) * inverse[:n])
    every, counts = np.unique(np.concatenate(hashes) if hashes else np.empty(0, np.uint64), return_counts=True)
    twice = every[counts > 1]
    for raw, own in zip(raws, hashes):
        cover = np.zeros(len(raw) + 1, dtype=np.int64)
        starts = np.flatnonzero(np.isin(own, twice))
        np.add.at(cover, starts, 1)
        np.add.at(cover, np.minimum(starts + size, len(raw)), -1)
        yield np.cumsum(cover[:-1]) > 0


def expected_digests(rows, size=400):
    raws = [(t or "").encode() for _, t in rows]
    for (i, _), raw, gone in zip(rows, raws, removed_by_hash(raws, size)):
        edge = np.diff(np.concatenate([[0], gone.astype(np.int8)]))
        kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
        yield i, len(raw), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(kept).hexdigest()


def test_suffix_dedup_of_a_test_table(spark):
    """The contract's 400 bytes, on every document of a given table."""
    path = "/root/testdata/sf0.001/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test table")
    docs = spark.read.parquet(path)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = Counter(tuple(r) for r in suffixdedup.digest(docs, suffixdedup.repeats(docs)).collect())
    assert got == Counter(expected_digests(rows))


def test_suffix_dedup_of_many_equal_rows(make_docs):
    """Rows that repeat a text under one id: a text's spans do not grow with them."""
    text = " ".join(f"word{i * 7919 % 1013}" for i in range(300))
    rows = [(None, text)] * 1500 + [(7, text + " tail"), (8, "another " * 3)]
    docs = make_docs([(i, t, None) for i, t in rows])
    found = suffixdedup.repeats(docs)
    assert max(r[0] for r in found.selectExpr("size(spans)").collect()) < 40
    assert Counter(tuple(r) for r in suffixdedup.digest(docs, found).collect()) == Counter(expected_digests(rows))
