import random

import numpy as np

from quire.llm import jaccard
from tests.llm.helpers import LONG, documents, rows_by_id, words


def brute(rows):
    """class_id, n_links and n_copies of each id, by comparing all pairs of sets."""
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    texts = {}
    for i, s in sets.items():
        texts.setdefault(s if s else (i,), []).append(i)
    keys = list(texts)
    low = {k: min(texts[k]) for k in keys}
    near = {k: [o for o in keys if o != k and isinstance(k, frozenset) and isinstance(o, frozenset) and len(k & o) / len(k | o) >= 0.8] for k in keys}
    changed = True
    while changed:
        changed = False
        for k in keys:
            m = min([low[k], *(low[o] for o in near[k])])
            changed |= m < low[k]
            low[k] = m
    return {i: (low[k], len(near[k]), len(texts[k])) for k in keys for i in texts[k]}


def corpus(n_groups=6, seed=3):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    rows, i = [], 0
    for _ in range(n_groups):
        base = [rng.choice(vocab) for _ in range(150)]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5, 9])):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((i, " ".join(copy)))
            i += 1
    return rows + [(i + 1, "one two three"), (i + 2, "One, two three!"), (i + 3, "one two four"), (i + 4, ""), (i + 5, None), (i + 6, "...")]


def test_same_as_all_pairs(spark):
    rows = corpus()
    want = brute(rows)
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in jaccard.join(documents(spark, rows)).collect()}
    assert got == want
    assert sum(x[1] for x in want.values()) > 50


def test_small_chunks_lose_and_double_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK_TEXTS", 3)
    rows = corpus(2)
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in jaccard.join(documents(spark, rows)).collect()}
    assert got == brute(rows)
    linked = {tuple(sorted((r["a"], r["b"]))) for r in jaccard.pairs(documents(spark, rows)).collect()}
    assert len(linked) == jaccard.pairs(documents(spark, rows)).count()


def test_pairs_have_their_similarity(spark):
    rows = corpus(1)
    sets = {i: {tuple(words(t)[k:k + 5]) for k in range(len(words(t)) - 4)} for i, t in rows}
    for r in jaccard.pairs(documents(spark, rows)).collect():
        a, b = sets[r["a"]], sets[r["b"]]
        assert abs(r["similarity"] - len(a & b) / len(a | b)) < 1e-12


def test_awkward_rows(spark):
    docs = documents(spark, [(1, LONG), (1, LONG), (2, LONG + " end"), (None, LONG), (5, None), (6, "")])
    got = rows_by_id(jaccard.join(docs))
    assert len(got[1]) == 2 and got[1][0]["n_copies"] == 3 and got[1][0]["class_id"] == 1
    assert got[None][0]["class_id"] is None
    assert got[5][0]["class_id"] == 5 and got[6][0]["n_links"] == 0
    assert jaccard.join(docs.limit(0)).collect() == []
    kept = rows_by_id(jaccard.keep_one(docs))
    assert {k: len(v) for k, v in kept.items()} == {1: 1, None: 1, 5: 1, 6: 1} or len(kept[2]) == 1
    assert jaccard.keep_one(docs).columns == docs.columns


def test_pruning_keeps_pairs_at_the_threshold():
    least = jaccard.least_matches(0.8, 1e-5)
    rng = np.random.default_rng(0)
    matches = rng.random((20000, jaccard.HASHES)) < 0.8
    lost = sum((matches[:, :n].sum(1) < m) for n, m in least.items()) > 0
    assert lost.mean() < 1e-3
    assert (rng.random((20000, jaccard.STEP)) < 0.3).sum(1).max() and least[jaccard.STEP] >= 8


def test_matrix_and_merge_count_alike():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 30).astype(np.uint64)) for _ in range(12)]
    i, j = np.triu_indices(12, 1)
    want = [len(set(sets[a].tolist()) & set(sets[b].tolist())) for a, b in zip(i, j)]
    assert jaccard.common_sizes(sets, i, j).tolist() == want
    assert jaccard.common_sizes(sets, i[:5], j[:5]).tolist() == want[:5]
