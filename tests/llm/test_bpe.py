import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import bpe
from quire.llm.queries import vocabulary_path
from tests.llm.helpers import LONG, documents, rows_by_id

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def both():
    with open(vocabulary_path(), encoding="utf-8") as f:
        return bpe.Bpe(f.read()), tokenizers.Tokenizer.from_file(vocabulary_path())


TRICKY = ["", " ", "Hello, World! It's 1234", "<|startoftext|>a<|endoftext|>", "Straße ÉÈ ﬁ ΣΑΣ", "á é", "x" * 3000, "ab" * 800, "日本語 テキスト", "\x1c\x1d a\x85b\xa0c", "😀😀 !!??", "don't we'll I'VE"]


@pytest.mark.parametrize("text", TRICKY)
def test_same_ids_as_the_library(both, text):
    own, lib = both
    ids, decoded = own.encode(text)
    want = lib.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert decoded == lib.decode(want, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(both, text):
    own, lib = both
    assert np.frombuffer(own.encode(text)[0], "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids


def test_tree_gives_the_leftmost_lowest_rank():
    tree = bpe.PairTree([5, 3, 9, 3])
    assert tree.lowest() == (3, 1)
    tree.put(1, bpe.NONE)
    assert tree.lowest() == (3, 3)
    for k in (0, 2, 3):
        tree.put(k, bpe.NONE)
    assert tree.lowest()[0] == bpe.NONE


def test_table(spark, both):
    docs = documents(spark, [(1, None), (2, ""), (3, "same text"), (3, "same text"), (None, "no id"), (4, LONG)])
    got = rows_by_id(bpe.encode(docs, vocabulary_path(), ("n_tokens", "ids_sha256", "decoded")))
    assert got[1][0]["n_tokens"] == got[2][0]["n_tokens"] == 0 and got[1][0]["decoded"] == ""
    assert got[1][0]["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    assert len(got[3]) == 2 and got[3][0] == got[3][1] and got[None][0]["n_tokens"] == 2
    assert got[4][0]["n_tokens"] == len(both[1].encode(LONG, add_special_tokens=False).ids)
    assert bpe.encode(docs.limit(0), vocabulary_path()).collect() == []


def test_trees_side_by_side_are_the_single_tree(both):
    own, _ = both
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("aeinrst'é日-1"), rng.integers(1, 90))) for _ in range(3000)]
    ids, count = own.merge_many([w.encode() for w in words])
    ends = np.cumsum(count)
    for w, hi, n in zip(words, ends, count):
        assert ids[hi - n:hi].tolist() == own.encode_word(w)


def test_small_memory_and_small_runs_change_nothing(both, monkeypatch):
    with open(vocabulary_path(), encoding="utf-8") as f:
        own = bpe.Bpe(f.read())
    rng = np.random.default_rng(10)
    vocabulary = ["wort", "œuvre", "l'été", "x1y2", "<|endoftext|>", "Ärger.", "日本", "#", "the"] + [f"w{k}" for k in range(60)]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 200))) for _ in range(60)]
    want = [both[1].encode(t, add_special_tokens=False).ids for t in texts]
    for remembered, at_once, out in ((3, 7, 11), (40, 100, 1 << 21), (150_000, 1 << 18, 5)):
        monkeypatch.setattr(bpe, "REMEMBERED", remembered)
        monkeypatch.setattr(bpe, "WORDS_AT_ONCE", at_once)
        monkeypatch.setattr(bpe, "OUT_BYTES", out)
        got = own.encode_all(texts)
        assert [g.tolist() for g in got] == want
        assert [b"".join(own.decoded(g)).decode() for g in got] == [both[1].decode(w, skip_special_tokens=False) for w in want]
        assert len(own.young.number) <= remembered + at_once + 200
