import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from torqueframe.llm import packing, tokenids
from torqueframe.llm.common import scratch_path
from torqueframe.llm.tokens import tokenizer

VOCABULARIES = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]
PLAIN = {name: Tokenizer.from_file(public_tokenizers.path(name)) for name, _ in VOCABULARIES}


def plain_ids(name, text):
    return PLAIN[name].encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name,spaced", VOCABULARIES)
def test_ids_equal_the_library(name, spaced):
    texts = ["a  b\n c", "<|endoftext|> x", "\n", "  ", "", None, "é ü x y", "foo's bar'll don't 12 345-67\n\nq\tz",
             "x.\ny. z! ,. é. Ünï?", "İstanbul ΑΣ. ſ", "á b ́c", "\x1c\x1d a b\x85c", "e\r\nf g", "“foo” bar… x",
             "ﬁ. Ǆx, 漢字。ab", "a b", " lead", "trail ", "x<|startoftext|>y"]
    got = [ids.tolist() for _, ids in tokenizer(public_tokenizers.path(name), spaced).documents(pa.array(texts))]
    assert got == [plain_ids(name, t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aäßÉ .,\n\t'!1x’ s<|é İ"), max_size=40), max_size=6))
def test_ids_equal_the_library_on_any_text(texts):
    for name, spaced in VOCABULARIES:
        got = [i.tolist() for _, i in tokenizer(public_tokenizers.path(name), spaced).documents(pa.array(texts, pa.string()))]
        assert got == [plain_ids(name, t) for t in texts]


@given(st.lists(st.integers(1, 2047), max_size=40))
def test_assign_fills_without_gaps(sizes):
    rows = packing.assign(sizes, 2048, 1.0, 0.001)
    seqs, done = {}, {i: [] for i in range(len(sizes))}
    for item, at, n, s, offset in rows:
        seqs.setdefault(s, []).append((offset, n))
        done[item].append((at, n))
    for item, parts in done.items():
        at = 0
        for a, n in sorted(parts):
            assert a == at
            at += n
        assert at == sizes[item]
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)


def test_largest_go_to_the_cheapest():
    rows = packing.assign([1500, 1500, 400, 300, 200, 196], 2048, 1.0, 0.0)
    first = {item: s for item, at, _, s, _ in rows if not at}
    assert first[0] != first[1] and len({s for *_, s, _ in rows}) == 2


def test_pack(spark, make_docs, odd_rows):
    rows = packing.pack(make_docs(odd_rows), public_tokenizers.path("byte_bpe_50k.json"), end_id=1, block_docs=3).collect()
    want = sorted(zlib.crc32(np.array([*plain_ids("byte_bpe_50k.json", t), 1], dtype="<u4")) for _, t, _ in odd_rows)
    whole = {(i, t): np.array([*plain_ids("byte_bpe_50k.json", t), 1], dtype="<u4") for i, t, _ in odd_rows}
    assert sum(r.length for r in rows) == sum(len(plain_ids("byte_bpe_50k.json", t)) + 1 for _, t, _ in odd_rows)
    assert len(want) == len(odd_rows)
    for r in rows:
        assert any(i == r.doc_id and len(x) == r.doc_tokens and zlib.crc32(x[r.start:r.start + r.length]) == r.ids_crc32
                   for (i, _), x in whole.items())
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048 and at & (at - 1) == 0
    assert packing.pack(make_docs([]), public_tokenizers.path("byte_bpe_50k.json"), end_id=1).count() == 0


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [1, 7, 64, 1000])
def test_planes_round_trip(kind, n):
    ids = np.random.default_rng(n).integers(0, 2 ** 32, n, dtype=np.uint32)
    assert (tokenids.join_planes(tokenids.shuffle_planes(ids, kind), n, kind) == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_token_files(spark, make_docs, odd_rows, kind):
    path = scratch_path(spark, "t")
    tokenids.write_ids(make_docs(odd_rows), path, public_tokenizers.path("word_bpe_49k.json"), 2, block_ids=64,
                       shard_docs=3, kind=kind)
    rows = sorted(tokenids.read_documents(spark, path).collect(), key=lambda r: r.start)
    want = {}
    for i, t, _ in odd_rows:
        x = np.array([*plain_ids("word_bpe_49k.json", t), 2], dtype="<u4")
        want.setdefault(i, []).append((len(x), zlib.crc32(x)))
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
        want[r.doc_id].remove((r.n_tokens, r.ids_crc32))
    assert not any(want.values())
    ids = [r.doc_id for r in rows]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])


def test_token_files_of_an_empty_table(spark, make_docs):
    path = scratch_path(spark, "t")
    tokenids.write_ids(make_docs([]), path, public_tokenizers.path("word_bpe_49k.json"), 2)
    assert tokenids.read_documents(spark, path).count() == 0
