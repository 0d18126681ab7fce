import hashlib
import itertools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from torqueframe.llm import decontam, langid, pii, stages, toxicity
from torqueframe.llm import textops as T

WORDS = {"en": "the of and that with this from have which people", "de": "der die und nicht mit eine auch sich werden",
         "fr": "le la et des que dans pour une avec sur", "es": "el los y que con para una por del como"}


def speech(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang].split(), n))


@pytest.fixture(scope="module")
def spoken():
    rng = np.random.default_rng(4)
    return [(i, speech(rng, lang, int(rng.integers(4, 30))), lang) for i, lang in
            enumerate(rng.choice(list(WORDS), 240))]


def test_language_id(make_docs, spoken, odd_rows):
    model = langid.fit(make_docs(spoken[:180]), max_iter=20)
    assert [f for f, _ in model.families] == ["germanic", "romance"] and set(model.duels) == {
        ("germanic", "romance"), ("de", "en"), ("es", "fr")}
    got = {r.doc_id: r.language for r in langid.identify(make_docs(spoken), model).collect()}
    held = [got[i].lang_pred == lang for i, _, lang in spoken[180:]]
    assert np.mean(held) > 0.95 and all(0 <= x.score <= 1 for x in got.values())
    odd = langid.identify(make_docs(odd_rows), model).select("doc_id", "text", "language.*").collect()
    assert len(odd) == len(odd_rows)
    for r in odd:
        assert (r.lang_pred == "und") == (not re.search(r"[^\W\d_]", r.text or ""))
        assert r.lang_pred != "und" or r.score == 0


def test_language_id_with_little_to_learn_from(make_docs, spoken):
    assert langid.fit(make_docs([(1, "abc", None), (2, None, "en")])) is None
    assert langid.fit(make_docs([])) is None
    one = langid.fit(make_docs([r for r in spoken if r[2] == "de"]))
    assert {r.p for r in make_docs(spoken).select(langid.predicted(F.col("text"), one)["lang_pred"].alias("p")).collect()} == {"de"}
    none = make_docs(spoken).select(langid.predicted(F.col("text"), None).alias("p")).collect()
    assert {r.p.lang_pred for r in none} == {"und"}
    model = langid.fit(make_docs([*spoken, (900, "completely other letters xx", "zz")]), max_iter=5)
    assert [m for _, m in model.families] == [["zz"], ["de", "en"], ["es", "fr"]]


def test_transducers():
    lex = toxicity.Lexicon({"idiot": 2.0}, {"vejut": 1.5}, {"kill": 3.0})
    out = lambda s: toxicity.clause_outputs(s, lex)
    assert out("an idiot here") == [("insult", 2.0)]
    assert out("you idiot") == out("idiot you are") == [("insult/aimed", 2.0)]
    assert out("not a big idiot") == [("insult/negated", 2.0)]
    assert out("not at all any longer idiot") == [("insult", 2.0)]
    assert out("someone said idiot") == [("insult/reported", 2.0)]
    assert out('a "idiot" b idiot') == [("insult/reported", 2.0), ("insult", 2.0)]
    assert out("he wrote you are never idiot") == [("insult/negated/reported/aimed", 2.0)]
    assert out("we kill vejutaire") == [("threat", 3.0), ("insult", 1.5)]
    sums = toxicity.text_outputs("Nothing. You idiot! idiotic.\nxidiot idiot", lex, lex.automaton())
    assert {o: v for o, v in zip(toxicity.OUTPUTS, sums) if v} == {"insult/aimed": 2.0, "insult": 2.0}


def test_toxicity_learns_terms_and_stems(spark, make_docs, odd_rows):
    rng = np.random.default_rng(8)
    rows, labels = [], []
    for i in range(400):
        w = list(rng.choice([f"w{x}" for x in range(300)] + ["the", "you", "said", "not"], 40))
        toxic = i % 5 == 0
        if toxic:
            w[int(rng.integers(40))] = str(rng.choice(["grumblo", f"snarkol{rng.choice(list('abcdefgh'))}x"]))
        rows.append((i, " ".join(w) + ".", "en"))
        labels.append((i, int(toxic)))
    lab = spark.createDataFrame([*labels, (0, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.fit(make_docs(rows), lab.where("doc_id < 300 or doc_id is null"))
    assert "grumblo" in model.lexicon.words and any("snarkol".startswith(s) for s in model.lexicon.stems)
    got = {r.doc_id: r.s for r in make_docs(rows).select("doc_id", toxicity.scored(F.col("text"), model).alias("s")).collect()}
    assert np.mean([(got[i] >= 0.5) == y for i, y in labels[300:]]) > 0.97
    odd = [r.s for r in make_docs(odd_rows).select(toxicity.scored(F.col("text"), model).alias("s")).collect()]
    assert len(odd) == len(odd_rows) and all(0 <= s < 0.5 for s in odd)
    for labels in (lab.where("false"), lab.where("toxic = 0")):
        assert toxicity.fit(make_docs(rows), labels).lexicon.words.keys() == set(toxicity.INSULTS)
    assert toxicity.fit(make_docs([]), lab).lexicon.stems == {}


REFERENCE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
             "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
             "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def reference_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(REFERENCE.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "phone": 9 <= len(d) <= 15, "card": 12 <= len(d) <= 19 and pii.luhn(d),
                  "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False}[kind]
            if ok:
                out.append((m.start(), rank, kind, m.end()))
    return [(s, k, e) for s, _, k, e in sorted(out)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a1@.+- ()0é25\n", max_size=40))
def test_base_spans_equal_the_patterns(text):
    assert [(s, k, e) for s, k, e, _ in pii.base_spans(text)] == reference_spans(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "a.b@c.d-e.f", "1.2.3.4", "255.256.1.1", "0010.1.1.1", "+49 (30) 1234-567",
                                 "x@y", "@", " ", "5500-0000-0000-0004", "999999999999999999999", ".", "+1"]), max_size=8))
def test_base_spans_of_real_looking_text(parts):
    text = "".join(parts)
    assert [(s, k, e) for s, k, e, _ in pii.base_spans(text)] == reference_spans(text)


def test_pii_terms_that_tell_of_an_entity(make_docs, odd_rows):
    rng = np.random.default_rng(2)
    filler = lambda: " ".join(f"w{x}" for x in rng.integers(0, 60, 30))
    rows = [(i, f"{filler()} Mallory writes from m@x.org w1 {filler()}", None) for i in range(5)]
    rows += [(100 + i, filler(), None) for i in range(60)]
    got = {r.doc_id: r for r in pii.digest(pii.find(make_docs(rows + odd_rows[:4]))).collect()}
    text = rows[0][1]
    spans = [x.split(":") for x in got[0].spans.split(",")]
    told = {text[int(a):int(b)]: k for k, a, b in spans}
    assert told["m@x.org"] == "email" and told["Mallory"] == told["writes"] == "remove" and "w1" not in told
    assert got[0].n_email == 1 and got[100].spans == "" and got[100].base_sha256 == hashlib.sha256(b"").hexdigest()
    at = text.index("m@x.org")
    assert got[0].base_sha256 == hashlib.sha256(f"email:{at}:{at + 7}".encode()).hexdigest()
    clean = pii.sanitise(text, [(int(a), k, int(b)) for k, a, b in spans])
    assert "Mallory" not in clean and "m@x.org" not in clean and "[EMAIL]" in clean
    assert pii.digest(pii.find(make_docs([]))).count() == 0
    assert pii.digest(pii.find(make_docs(odd_rows))).count() == len(odd_rows)


def test_pii_terms_far_from_their_entity_are_marked_too(make_docs):
    rng = np.random.default_rng(5)
    filler = lambda: " ".join(f"w{x}" for x in rng.integers(0, 60, 30))
    rows = [(i, f"Mallory heads {filler()} Mallory writes from m@x.org {filler()} MALLORY", None) for i in range(5)]
    rows += [(9, f"Mallory {filler()}", None)]  # no entity in it
    rows += [(100 + i, filler(), None) for i in range(60)]
    got = {r.doc_id: r.spans for r in pii.digest(pii.find(make_docs(rows))).collect()}
    for i, text, _ in rows[:5]:
        spans = [(k, text[int(a):int(b)]) for k, a, b in (x.split(":") for x in got[i].split(","))]
        assert [t for k, t in spans if k in ("generalise", "remove") and t.lower() == "mallory"] == ["Mallory", "Mallory", "MALLORY"]
    assert got[9] == ""


def brute_terms(rows, window=8, support=3, generalise=0.8, remove=0.95):
    """{doc_id: [(start, kind, end)]} of the terms that tell of an entity, by plain loops."""
    word = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
    texts = [t or "" for _, t, _ in rows]
    bases = [pii.base_spans(t) for t in texts]
    outside = [[m for m in word.finditer(t) if not any(m.start() < e and m.end() > s for s, _, e, _ in b)]
               for t, b in zip(texts, bases)]
    total = Counter(m.group().lower() for t in texts for m in word.finditer(t.lower()))
    n, seen, near = sum(total.values()), Counter(), Counter()
    for b, free in zip(bases, outside):
        seen.update(name for _, k, _, v in b for name in pii.levels(k, v))
        beside = {(name, m) for s, k, _, v in b for name in pii.levels(k, v) for m in
                  [m for m in free if m.start() < s][-window:] + [m for m in free if m.start() >= s][:window]}
        near.update((name, m.group().lower()) for name, m in beside)
    told = {}
    for (name, term), c in near.items():
        p = seen[name] / n
        share = math.log2(c / total[term] / p) / -math.log2(p)
        if c >= support and share >= generalise:
            told[name, term] = share
    out = {}
    for (i, _, _), b, free in zip(rows, bases, outside):
        names = {next((x for x in pii.levels(k, v) if seen[x] >= support), None) for _, k, _, v in b}
        shares = [(m, max((told[x, m.group().lower()] for x in names if (x, m.group().lower()) in told), default=0))
                  for m in free]
        out[i] = [(m.start(), "remove" if s >= remove else "generalise", m.end()) for m, s in shares if s]
    return out


def test_pii_terms_equal_plain_loops(make_docs):
    rng = np.random.default_rng(8)
    filler = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 90, n))
    rows = [(i, f"{filler(9)} Clerk desk {filler(2)} p{i}@acme.example answers {filler(20)}", None) for i in range(6)]
    rows += [(20 + i, f"{filler(5)} host rack 10.0.{i}.7 {filler(3)} or 10.0.{i}.8 rack {filler(9)}", None) for i in range(4)]
    rows += [(40 + i, f"ring Ada +49 30 1234567 {filler(4)} Ada and q@solo{i}.example {filler(8)}", None) for i in range(4)]
    rows += [(60, "lone card 4111 1111 1111 1111 here", None), (61, None, None), (62, "", None)]
    rows += [(100 + i, filler(30) + " desk" * (i % 2), None) for i in range(80)]
    found = {r.doc_id: r for r in pii.find(make_docs(rows)).collect()}
    want = brute_terms(rows)
    got = {i: [(x.start, x.kind, x.end) for x in r.terms or ()] for i, r in found.items()}
    assert got == want
    # a rare address is known by its domain, one of a rare domain by being an address
    marked = {i: {t[s:e] for s, _, e in want[i]} for i, t, _ in rows if t}
    assert "Clerk" in marked[0] and "answers" in marked[0] and "Ada" in marked[40] and not marked[60] and not marked[100]
    hashes = {r.doc_id: r.sanitised_sha256 for r in pii.digest(pii.find(make_docs(rows))).collect()}
    for i, t, _ in rows:
        spans = [(s, k, e) for s, k, e, _ in pii.base_spans(t or "")] + want[i]
        clean = pii.sanitise(t or "", spans)
        assert found[i].sanitised == (clean if pii.base_spans(t or "") else None)
        assert hashes[i] == hashlib.sha256(clean.encode()).hexdigest()


def test_term_totals(make_docs, odd_rows):
    want = Counter(w for _, t, _ in odd_rows for w in re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower()))
    got = pii.term_totals(make_docs(odd_rows), held=500).collect()
    assert sorted(r.term_n for r in got) == sorted(want.values())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB1é .", max_size=25), max_size=6))
def test_words_and_shingles(texts):
    hashes = {}
    for row, data, offsets in T.runs(pa.array(texts, pa.string()), 16, lower=True):
        words, start, end, at = T.word_hashes(data, offsets)
        sh, first = T.shingle_hashes(words, at, 3)
        for i in range(len(offsets) - 1):
            w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", texts[row + i].lower())
            assert len(w) == at[i + 1] - at[i]
            for a, b in zip(w, words[at[i]:at[i + 1]].tolist()):
                assert hashes.setdefault(a, b) == b
            grams = [tuple(w[j:j + 3]) for j in range(max(1, len(w) - 2))] if w else []
            for a, b in zip(grams, sh[first[i]:first[i + 1]].tolist()):
                assert hashes.setdefault(a, b) == b
            assert len(grams) == first[i + 1] - first[i]
    assert len(set(hashes.values())) == len(hashes)


def test_simhash_counts_every_bit(spark):
    rng = np.random.default_rng(1)
    bags = [rng.integers(-2 ** 63, 2 ** 63, n).tolist() for n in (1, 2, 3, 10, 301)]
    rows = decontam.with_simhash(spark.createDataFrame([(i, b) for i, b in enumerate(bags)], "i int, bag array<long>"), "p")
    for r in rows.collect():
        for bit in range(64):
            n = sum(h >> bit & 1 for h in bags[r.i])
            assert (r.p >> bit & 1) == (n > len(bags[r.i]) / 2)


def test_simhash_is_the_same_in_wider_lanes(spark):
    rng = np.random.default_rng(2)
    bags = [rng.integers(-2 ** 63, 2 ** 63, n).tolist() for n in (1, 2, 301)] + [[-1] * 40_000, [-1] * 20_000 + [0] * 20_001]
    rows = spark.createDataFrame([(i, b) for i, b in enumerate(bags)], "i int, bag array<long>")
    wide = {r.i: r.p for r in decontam.with_simhash(rows, "p", lane=32).collect()}
    narrow = {r.i: r.p for r in decontam.with_simhash(rows.where("i < 3"), "p").collect()}
    assert wide == narrow | {3: -1, 4: 0}


def test_blocks_tile_the_fingerprint():
    for radius in (0, 3, 19, 63):
        blocks = decontam.blocks_of(radius)
        assert len(blocks) == radius + 1 and [b for at, n in blocks for b in range(at, at + n)] == list(range(64))


def brute_leaks(docs, items, k=5, t=0.8):
    sh = lambda s: [tuple(w[i:i + k]) for w in [re.findall(r"[0-9a-z\x80-\U0010ffff]+", (s or "").lower())]
                    for i in range(len(w) - k + 1)]
    out = {}
    for (i, text), (j, item) in itertools.product(docs, items):
        g, bag = sh(text), sh(item)
        for p in range(len(g)):
            w = g[p:p + len(bag)]
            both = sum((Counter(w) & Counter(bag)).values())
            if bag and both >= t * (len(w) + len(bag) - both):
                out[i, j] = max(out.get((i, j), 0), both / (len(w) + len(bag) - both))
    return out


def test_decontamination(spark, make_docs, odd_rows):
    rng = np.random.default_rng(6)
    text = lambda n: " ".join(f"V{x}" for x in rng.integers(0, 3000, n))
    items = [(j, text(int(rng.integers(13, 60)))) for j in range(20)] + [(50, "too short here"), (51, None), (52, ""),
                                                                        (53, "la " * 30)]
    docs = []
    for i in range(60):
        item = items[i % 20][1].split()
        kind = i % 4
        if kind == 1:
            item = item[1:]
        if kind == 2:
            item[len(item) // 2] = "changed"
        if kind == 3:
            item = item[:len(item) // 2]
        docs.append((i, f"{text(25)}. {' '.join(item).lower()}, {text(12)}"))
    docs += [(70, "la " * 29), (71, "la " * 12 + text(20)), (72, items[3][1]), (72, items[3][1]), (None, items[4][1])]
    docs += [r[:2] for r in odd_rows if r[0] is not None]
    bench = spark.createDataFrame([(*r, "x") for r in [*items, items[0]]], "item_id long, text string, p string")
    frame = make_docs([(*r, None) for r in docs])
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.leaks(frame, bench).collect()}
    want = brute_leaks(docs, items)
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-9 for x in want)
    kept = decontam.clean_rows(frame, bench)
    assert kept.columns == frame.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _ in docs if i not in {i for i, _ in want})
    assert decontam.leaks(make_docs([]), bench).count() == 0
    assert decontam.leaks(frame, bench.where("false")).count() == 0
    assert decontam.clean_rows(frame, bench.where("false")).count() == len(docs)


def test_decontamination_stage_drops_only_the_rows_that_leak(spark, make_docs, tmp_path):
    item = " ".join(f"v{i}" for i in range(20))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = "nothing of the benchmark is in this text"
    docs = make_docs([(None, item), (None, clean), (None, None), (7, item), (7, clean), (7, clean), (8, item)])
    kept = stages.decontamination(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == {(None, clean): 1, (None, None): 1, (7, clean): 2}


def test_long_benchmark_items_are_compared_whole(spark, make_docs, monkeypatch):
    words = [f"v{i}" for i in range(8193 + 4)]  # 8193 shingles
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    assert decontam.leaks(make_docs([(1, " ".join(words[-5:]), None), (2, "v1 v2 v3 v4 v5 v6", None)]), bench).count() == 0
    monkeypatch.setattr(decontam, "NARROW", 20)
    items = [(1, " ".join(words[:54])), (2, "la " * 70)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(1, items[0][1]), (2, " ".join(words[20:50])), (3, " ".join(words[3:54])), (4, "la " * 66), (5, "la " * 40)]
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.leaks(make_docs(docs), bench).collect()}
    want = brute_leaks(docs, items)
    assert got.keys() == want.keys() == {(1, 1), (3, 1), (4, 2)} and all(abs(got[x] - want[x]) < 1e-9 for x in want)


def test_long_benchmark_items_are_searched_in_parts(spark, make_docs, monkeypatch):
    monkeypatch.setattr(decontam, "MAX_ITEM", 20)
    item = " ".join(f"v{i}" for i in range(54))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = make_docs([(1, item, None), (2, " ".join(f"v{i}" for i in range(20, 50)), None), (3, "v1 v2 v3 v4 v5 v6", None)])
    assert {r.doc_id for r in decontam.leaks(docs, bench).collect()} == {1, 2}


def test_windows_are_listed_without_the_shingles_of_their_document(spark, make_docs, monkeypatch):
    # an explode holds all its rows at once: thousands of windows with a long document each do not fit
    plans, write = {}, decontam.written

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(decontam, "written", watched)
    items = [(j, " ".join(f"v{j}x{i}" for i in range(14 + 9 * j))) for j in range(4)]
    docs = [(d, " ".join(f"{items[(d + n) % 4][1]} u{n} t{d} {items[n % 4][1]}" for n in range(8))) for d in range(3)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.leaks(make_docs([(*r, None) for r in docs]), bench).collect()}
    want = brute_leaks(docs, items)
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-9 for x in want)
    listed = [line for line in plans["window-prints"].splitlines() if "Generate explode" in line]
    assert listed and not any(re.search(r"\bsh#\d+", line) for line in listed)
