"""The audit of sources against a plain version of the contract."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.types import LongType, StringType, StructField, StructType

from torqueframe.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
ROWS = StructType([StructField("text", StringType()), StructField("lang", StringType()),
                   StructField("source", StringType()), StructField("term", StringType()),
                   StructField("n", LongType()), StructField("word", StringType())])


def split(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(rows, min_docs, top):
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        own = split(text)
        groups[lang or "", source or ""].update(own)
        docs[lang or ""].update(set(own))
    out = set()
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(kept)

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10 ** 9 * (count[t] + 5) // (total + 5 * v) for t in kept}

        own = {s: c for (g, s), c in groups.items() if g == lang}
        p = {s: shares(c) for s, c in own.items()}
        q = shares(sum(own.values(), Counter()))
        for s in own:
            pair = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in own if o != s]
            term = [(p[s][t] - q[t], t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])}
    return out


def check(spark, rows, min_docs=30, top=50):
    df = spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], ROWS)
    got = [tuple(r) for r in divergence.audit(df, min_docs, top).collect()]
    want = plain(rows, min_docs, top)
    assert len(got) == len(want) and set(got) == want
    return want


def corpus(seed, n, n_terms, sources):
    rng = np.random.default_rng(seed)
    words = [f"{'wörtÉ' if i % 9 == 0 else 'Term'}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(n_terms)]
    p = 1 / np.arange(1, n_terms + 1)
    rows = []
    for _ in range(n):
        source = "hot" if rng.random() < 0.4 else f"s{rng.integers(sources)}"
        own = rng.choice(words, size=rng.integers(0, 60), p=p / p.sum())
        rows.append((" ".join(own), ["en", "de", None][rng.integers(3)], source if rng.random() < 0.95 else None))
    return rows


def test_many_terms_and_sources(spark):
    want = check(spark, corpus(1, 900, 400, 6), top=20)
    assert sum(r[2] == "pair" and r[4] > 0 for r in want) > 50 and max(r[5] for r in want if r[2] == "term") == 20


def test_words_of_more_than_64_ids(spark, monkeypatch):
    monkeypatch.setattr(divergence, "WORD_TERMS", 500)
    check(spark, corpus(2, 300, 300, 3), min_docs=2)


def test_odd_rows(spark):
    rows = [(None, None, None), ("", "en", "a"), ("12 _ 345", "en", "b"), ("A a ÀÀ à", "en", "c"), ("only here", "xx", "c"),
            ("a" * 3_000_000 + " b", "en", "long"), ("Word wOrd " * 200_000, "en", "long"), (None, "zz", "no terms"),
            ("x", "zz", None), ("x", "zz", None), ("[x]^y`z{|}~\x7f", "en", "\U0001F600"), ("\u0085 ", "en", "é")]
    check(spark, rows, min_docs=1)
    check(spark, rows, min_docs=2)
    check(spark, rows, min_docs=99)


def test_empty_table(spark):
    assert check(spark, []) == set()


def test_large_counts_are_exact(spark):
    df = spark.sql("select 4000000000000 as c, 9000000000000 as t, 7L as v")
    got = df.select(divergence.share("c", "t", "v")).first()[0]
    assert got == 1 + 10 ** 9 * (4 * 10 ** 12 + 5) // (9 * 10 ** 12 + 35)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x17f), st.sampled_from("AZaz \n\x85é\U0001F600")), max_size=60),
       st.sampled_from([3, 7, 1 << 20]))
def test_terms(text, piece):
    keep, divergence.PIECE = divergence.PIECE, piece
    try:
        got = [t.decode() for own in divergence.terms(text.encode()) for t in own]
    finally:
        divergence.PIECE = keep
    assert got == split(text)


def test_tasks_hand_counts_on(spark, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(divergence, "HELD", 10)
    n = 600
    batch = pa.record_batch({"lang": ["en"] * n, "source": ["s"] * n, "text": [f"w{chr(97 + i % 26)} x".encode() for i in range(n)]})
    total = Counter()
    out = list(divergence._tallied([batch]))
    for b in out:
        for t, c in zip(b.column("term").to_pylist(), b.column("n").to_pylist()):
            total[t] += c
    assert len(out) > 1 and total["x"] == n and total["wa"] == 24


@pytest.fixture(autouse=True)
def _small_tasks(monkeypatch):
    monkeypatch.setattr(divergence, "TASK_CELLS", 1000)
