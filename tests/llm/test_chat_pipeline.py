import heapq
import random
from collections import Counter

import pytest

import corpus_pipeline
from torqueframe.llm import chatformat as C

SCHEMA = "conv_id long, turn long, role string, text string, pos string, cost string"


def least_cost(roles):
    """Dijkstra over single steps: take a turn (merged or not, relabelled or not) or insert one."""
    best, heap = {}, [(0, 0, "start")]
    while heap:
        cost, i, s = heapq.heappop(heap)
        if (i, s) in best:
            continue
        best[i, s] = cost
        if i == len(roles) and s in C.FINAL:
            return cost
        for r in C.NEXT[s]:
            heapq.heappush(heap, (cost + 3, i, r))
            if i < len(roles):
                heapq.heappush(heap, (cost + 5 * (r != roles[i]), i + 1, r))
        if i < len(roles) and s != "start":
            heapq.heappush(heap, (cost + 2 + 5 * (s != roles[i]), i + 1, s))
    raise AssertionError


def conversations():
    rng = random.Random(3)
    rows = []
    for c in range(40):
        rows += [(c, t, rng.choice(["user", "assistant", "system", "tool", " Human", "GPT", "weird", None]), f"t{t}")
                 for t in range(rng.randint(1, 9))]
    rows += [(500, t % 3, "user", "same") for t in range(30)]  # ties and repeated rows
    rows += [(None, 1, "user", "hi"), (None, 2, "assistant", None), (501, None, "user", ""), (501, None, "assistant", "")]
    return rows


@pytest.mark.parametrize("block", [1000, 3])
def test_repair(spark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    rows = conversations()
    frame = spark.createDataFrame([(*r, "p", "c") for r in rows], SCHEMA)
    out = {}
    for r in C.repair(frame).collect():
        out.setdefault(r.conv_id, []).append(r)
    assert out.keys() == {r[0] for r in rows}
    for conv, turns in out.items():
        turns.sort(key=lambda r: (r.pos, r.sub))
        mine = [r for r in rows if r[0] == conv]
        kept = [r for r in turns if r.action != "insert"]
        assert Counter((r.turn, r.role, r.text) for r in kept) == Counter((t, role, x or "") for _, t, role, x in mine)
        assert [r.pos for r in kept] == list(range(len(mine)))
        state, cost = "start", 0
        for i, r in enumerate(turns):
            merge = r.action.startswith("merge")
            assert r.new_role == state if merge else r.new_role in C.NEXT[state]
            assert r.head == ("\n" if merge else f"<|{r.new_role}|>\n")
            goes_on = i + 1 < len(turns) and turns[i + 1].action.startswith("merge")
            assert r.tail == ("" if goes_on else "<|end|>\n")
            cost += 3 * (r.action == "insert") + 2 * merge + 5 * ("relabel" in r.action)
            state = r.new_role
        assert state in C.FINAL and {r.cost for r in turns} == {cost}
        roles = [C.ALIASES.get((r.role or "").strip().lower(), (r.role or "").strip().lower()) for r in kept]
        assert cost == least_cost(roles)


def test_repair_of_an_empty_table(spark):
    assert C.repair(spark.createDataFrame([], SCHEMA)).count() == 0


def test_stages_take_odd_and_empty_tables(spark, make_docs, odd_rows, tmp_path):
    spark.createDataFrame([(1, "words that no document has in it"), (2, None)], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    for rows in (odd_rows, []):
        docs = make_docs(rows)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name != "packing":
                assert out.columns == docs.columns
            assert (out.count() > 0) == bool(rows)
            docs = spark.createDataFrame(out.collect(), out.schema) if name != "packing" else docs
        if rows:
            left = {r.doc_id for r in docs.collect()}
            assert 4 in left and 7 not in left and 2 not in left and None in left


def test_pipeline_drops_what_its_stages_find(spark, make_docs, tmp_path):
    say = lambda n, k: " ".join(f"word{chr(97 + (i * k) % 26)}{chr(97 + (i // 3) % 26)}" for i in range(n))
    leak = " ".join(f"bench{chr(97 + i % 26)}" for i in range(30))
    rows = [(1, say(80, 3), "en"), (2, say(80, 3), "en"), (3, say(80, 3) + " one more", "en"), (4, "1234 56", "en"),
            (5, say(40, 7) + " " + leak, "en"), (6, say(60, 11), "de"), (7, say(60, 11).replace(" ", "  ", 3), "de")]
    make_docs(rows).drop("n", "th", "key", "language").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in out.collect()} == {1, 6}
