import itertools
import re
import zlib

import numpy as np

from quire.llm import langcrf
from quire.llm.common import table
from quire.llm.queries import QUERIES
from tests.conftest import SF_CHECK
from tests.llm.helpers import LONG, documents


def by_paths(emit, word, start, moves, first):
    """Marginals, log normaliser and expected transitions by listing all label sequences of each text."""
    k = emit.shape[1]
    out, total, pairs = np.zeros((len(word), k)), 0.0, np.zeros((k, k))
    edges = [*np.flatnonzero(start), len(word)]
    for lo, hi in zip(edges, edges[1:]):
        weights, seqs = [], list(itertools.product(range(k), repeat=hi - lo))
        for s in seqs:
            w = np.exp(first[s[0]]) * np.prod([emit[word[lo + t], s[t]] for t in range(hi - lo)])
            weights.append(w * np.exp(sum(moves[a, b] for a, b in zip(s, s[1:]))))
        z = sum(weights)
        total += np.log(z)
        for s, w in zip(seqs, weights):
            for t, lang in enumerate(s):
                out[lo + t, lang] += w / z
            for a, b in zip(s, s[1:]):
                pairs[a, b] += w / z
    return out, total, pairs


def swept(emit, word, start, moves, first):
    out, pairs = np.zeros((len(word), emit.shape[1])), np.zeros((emit.shape[1],) * 2)

    def visit(lo, hi, marginals):
        out[lo:hi] = marginals

    return out, langcrf.sweep(emit, word, start, moves, first, visit, pairs), pairs


def test_forward_backward_is_the_sum_over_paths(monkeypatch):
    rng = np.random.default_rng(5)
    scores = rng.normal(0, 2, (9, 3))
    emit, moves, first = langcrf.chances(scores), rng.normal(0, 1, (3, 3)), rng.normal(0, 1, 3)
    word = rng.integers(0, 9, 31)
    start = np.isin(np.arange(31), [0, 1, 6, 12, 13, 20, 26])
    want = by_paths(emit, word, start, moves, first)
    for least, most, held in ((16, 256, 1 << 21), (1, 1, 9), (2, 2, 1 << 21), (3, 3, 20), (5, 5, 40), (40, 40, 1)):
        monkeypatch.setattr(langcrf, "LEAST_BLOCK", least)
        monkeypatch.setattr(langcrf, "MOST_BLOCK", most)
        monkeypatch.setattr(langcrf, "HELD", held)
        for a, b in zip(swept(emit, word, start, moves, first), want):
            assert np.allclose(a, b, rtol=1e-9, atol=1e-12)


def test_long_stream_stays_finite():
    rng = np.random.default_rng(6)
    emit = langcrf.chances(rng.normal(0, 40, (50, 4)))
    word, start = rng.integers(0, 50, 70_000), np.zeros(70_000, bool)
    start[0] = True
    out, total, _ = swept(emit, word, start, 8 * np.eye(4), np.zeros(4))
    assert np.isfinite(total) and np.allclose(out.sum(1), 1)


def test_words_and_features():
    codes, a, b = langcrf.find_words("Ça va, l'ÉTÉ ét 3x ́ 日本 naïve")
    assert ["".join(map(chr, codes[x:y])) for x, y in zip(a, b)] == ["ça", "va", "l", "été", "ét", "x", "日本", "naïve"]
    inner, first, affix = langcrf.features(codes, a, b)
    none = 1 << langcrf.BITS
    for w in range(len(a)):
        n = b[w] - a[w]
        mine = inner[first[w]:first[w] + n]
        for g in range(langcrf.GRAMS):
            assert (mine[:, g] < none).sum() == max(0, n - g)          # n-grams within the word
            assert (affix[w, g] < none) == (affix[w, langcrf.GRAMS + g] < none) == (n > g)
    keys = langcrf.word_keys(codes, a, b)
    again = langcrf.find_words("x été")
    assert set(langcrf.word_keys(*again)) == {keys[5], keys[3]} and len(set(keys)) == 8


def test_pieces_cut_between_words(monkeypatch):
    monkeypatch.setattr(langcrf, "PIECE", 7)
    text = "abc de fghijklmnopq rs, t́u vw"
    assert "".join(p for _, p in langcrf.pieces(text)) == text and all(text[lo:lo + len(p)] == p for lo, p in langcrf.pieces(text))
    found = [p[x:y] for _, p in langcrf.pieces(text) for x, y in zip(*langcrf.find_words(p)[1:])]
    assert found == ["abc", "de", "fghijkl", "mnopq", "rs", "t́u", "vw"]


def test_held_out_accuracy_on_the_given_table(spark):
    docs = {r["doc_id"]: r for r in table(spark, SF_CHECK, "documents").collect()}
    got = QUERIES["op13_langid"](spark, SF_CHECK).collect()
    assert len(got) == len(docs)
    right = [0, 0]
    for r in got:
        held = zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        text = docs[r["doc_id"]]["text"] or ""
        assert r["held_out"] == held and 0 <= r["score"] <= 1
        assert r["n_words"] == len(re.findall(r"[^\W\d_]+", text)) and (r["lang_pred"] == "und") == (r["n_words"] == 0)
        if held and r["n_words"]:
            right[r["lang_pred"] == docs[r["doc_id"]]["lang"]] += 1
    assert right[1] >= 0.97 * sum(right) and sum(right) > 100


def test_labels_are_never_inputs_of_a_prediction(spark):
    docs = table(spark, SF_CHECK, "documents")
    model = langcrf.fit(docs.filter("doc_id % 5 > 0"))
    a = {r["doc_id"]: tuple(r) for r in langcrf.identify(docs, model).collect()}
    b = langcrf.identify(docs.selectExpr("doc_id", "text", "'xx' as lang", "'yy' as source"), model).collect()
    assert {r["doc_id"]: tuple(r) for r in b} == a


def test_code_switched_text_is_cut_where_the_language_changes(spark):
    docs = table(spark, SF_CHECK, "documents")
    model = langcrf.fit(docs.filter("doc_id % 5 > 0"))
    plain = docs.filter("doc_id % 5 = 0 and length(text) > 400").select("lang", "text").collect()
    by = {}
    for r in plain:
        by.setdefault(r["lang"], []).append(" ".join(re.findall(r"[^\W\d_]+", r["text"])[:30]))
    rows, truth = [], {}
    for n, parts in enumerate(zip(*(by[lang] for lang in sorted(by)))):
        rows.append((n, " ".join(parts)))
        truth[n] = np.repeat(sorted(by), [len(p) + 1 for p in parts])
    same = total = 0
    for r in langcrf.label_spans(documents(spark, rows), model).collect():
        assert 4 <= len(r["spans"]) <= 12
        for s in r["spans"]:
            same += (truth[r["doc_id"]][s["start"]:s["end"]] == s["lang"]).sum()
            total += s["end"] - s["start"]
    assert len(rows) > 5 and same >= 0.93 * total


def test_awkward_rows(spark):
    rows = [(1, "the cat and the dog"), (1, "the cat and the dog"), (2, "der hund und die katze"), (3, None), (4, ""), (5, "12 !? 3"), (6, LONG), (None, "the cat"), (7, "z" * 100_000), (8, "猫")]
    docs = documents(spark, rows).selectExpr("*", "case doc_id when 1 then 'en' when 2 then 'de' when 3 then 'en' when 4 then 'fr' when 5 then 'es' end as lang")
    model = langcrf.fit(docs)
    assert model.langs == ["de", "en"]
    got = {}
    for r in langcrf.identify(docs, model).collect():
        got.setdefault(r["doc_id"], []).append((r["lang_pred"], r["n_words"]))
        assert (r["score"] == 0) == (r["lang_pred"] == "und")
    assert got[1] == [("en", 5)] * 2 and got[2] == [("de", 5)] and got[3] == got[4] == got[5] == [("und", 0)] and got[6][0][1] == 48_000
    assert got[None] == [("en", 2)] and got[7][0][1] == 1
    assert {r["doc_id"]: r["spans"] for r in langcrf.label_spans(docs, model).collect()}[5] == []
    assert langcrf.identify(docs.limit(0), model).collect() == [] and langcrf.fit(docs.limit(0)) is None
    assert {r["lang_pred"] for r in langcrf.identify(docs, None).collect()} == {"und"}
    one = langcrf.fit(docs.filter("doc_id = 1"))
    assert {(r["lang_pred"], r["score"]) for r in langcrf.identify(docs.filter("doc_id = 2"), one).collect()} == {("en", 1.0)}
