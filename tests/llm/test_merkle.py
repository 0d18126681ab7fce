"""The manifest against a plain version of the contract."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from torqueframe.llm import merkle
from torqueframe.llm.queries import tampered_leaves

ROWS = StructType([StructField("doc_id", LongType()), StructField("source", StringType()),
                   StructField("lang", StringType()), StructField("n_chars", LongType()),
                   StructField("text", StringType()), StructField("leaf", StringType()), StructField("pos", LongType())])


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def coded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, at):
    for level in levels[:-1]:
        lo = at // 16 * 16
        yield level[lo:at], level[at + 1:lo + 16]
        at //= 16


def plain(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[1]].append((r, h(*map(coded, r[:5]))))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by_source[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[s] = tree([leaf for _, leaf in by_source[s]])
    top = tree([trees[s][-1][0] for s in order])
    out = Counter()
    for i, s in enumerate(order):
        for at, (r, leaf) in enumerate(by_source[s]):
            steps = [*path(trees[s], at), *path(top, i)]
            value = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
                value = h(*map(coded, (*r[:4], low)))
            for left, right in steps:
                value = h(*left, value, *right)
            proof = h(*[x for left, right in steps for x in (*left, *right)])
            out[r[0], leaf, trees[s][-1][0], top[-1][0], proof, value, value == top[-1][0]] += 1
    return out


def check(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 3) for r in rows], ROWS)
    got = merkle.audit(merkle.build(tampered_leaves(docs)))
    got = got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    assert Counter(map(tuple, got)) == plain(rows)
    return got


def row(i, source, text="Some Text"):
    return (i, source, None if i is not None and i % 7 == 0 else "en", i, text)


def test_sources_of_many_sizes(spark):
    rows = [row(i * 10 + s, f"s{n:05d}", f"Text {i} of {n}" if i % 3 else f"text {i}")
            for s, n in enumerate([1, 2, 15, 16, 17, 255, 256, 257]) for i in range(n)]
    got = check(spark, rows)
    assert not all(r["verified"] for r in got) and sum(r["verified"] for r in got) > 500


def test_odd_rows(spark):
    rows = [row(5, None), row(6, None, None), row(7, ""), row(None, ""), row(None, "", ""), row(9, "é"), row(10, "z"),
            row(11, "z", "ÄÖ Üx"), row(-12, "z", ""), row(20, "z", "A" * 300_000)]
    check(spark, rows + [row(11, "z", "other")])


def test_repeated_rows_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 500)
    rows = [row(i, "big", f"T{i}") for i in range(4096 + 300)] + [row(3, "same", "Again")] * 700
    rows += [row(i, f"src{i}", "One") for i in range(40)]
    got = check(spark, rows)
    assert len(got) == len(rows)


@pytest.mark.parametrize("rows", [[], [row(1, "a")], [row(20, None, "Lone Leaf")]])
def test_none_and_one(spark, rows):
    check(spark, rows)


def test_states_resume(spark):
    children = [h(str(i)).encode() for i in range(16)]
    run = merkle.Run(children)
    assert run.digest.decode() == h(*[c.decode() for c in children])
    for slot in range(16):
        new = h("new").encode()
        want = h(*[(new if i == slot else c).decode() for i, c in enumerate(children)])
        assert merkle.resumed(run.before[slot], new, run.right(slot)).decode() == want
        assert run.left(slot) + children[slot] + run.right(slot) == run.children


def test_positions(spark):
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("k"), (-F.col("id")).alias("o"))
    got = {(r["k"], r["o"]): (r["pos"], r["n"]) for r in merkle.positions(df, ["k"], ["o"]).collect()}
    for k in "012":
        own = sorted(o for kk, o in got if kk == k)
        assert [got[k, o] for o in own] == [(i, len(own)) for i in range(len(own))]
