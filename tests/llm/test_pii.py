import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import pii
from tests.llm.helpers import LONG, documents, rows_by_id


def plain_base(text):
    """The base patterns, as they are stated."""
    out = [(*m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(*m.span(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 14 <= len(d) <= 19 and sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(d[::-1])) % 10 == 0:
            out.append((*m.span(), "card"))
    out += [(*m.span(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2]), s[1]))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1234507.@+- ()%_é\n", max_size=60))
def test_base_is_as_stated(text):
    assert pii.base_spans(text) == plain_base(text)


@pytest.fixture(scope="module")
def model():
    return pii.trained()


@pytest.mark.parametrize("text, kind", [("write to jo.doe@mail.example.com now", "email"), ("host 10.2.33.4 is up", "ip"), ("card 4111 1111 1111 1111 ok", "card"),
                                        ("+1 (406) 555-0113 please", "phone"), ("call 406-555-0113 please", "phone"), ("jo.doe (at) mail.example.com", "email")])
def test_spans_of_each_kind(model, text, kind):
    _, spans = pii.all_spans(model, text)
    assert [k for _, _, k in spans] == [kind]


def test_held_out_examples(model):
    right = total = extra = 0
    for text, gold in pii.examples(300, 99):
        got = {(a, b, k) for a, b, k in pii.all_spans(model, text)[1]}
        right += len(got & set(gold))
        extra += len(got - set(gold))
        total += len(gold)
    assert right >= 0.9 * total and extra <= 0.1 * total


def test_best_segmentation_is_the_best_of_all(model):
    rng = random.Random(5)
    for text, _ in rng.sample(pii.examples(200, 4), 25):
        for lo, hi in pii.islands(text):
            borders, cands = model.lattice(text, lo, hi)
            n = len(borders) - 1
            if n > 9:
                continue
            options = [(i, j, k, s) for j in range(1, n + 1) for i, feats in cands[j] for k, s in enumerate(model.scores(feats))]

            def best(at, options=options, n=n):
                if at == n:
                    return 0.0
                return max([best(at + 1), *(s + best(j) for i, j, _, s in options if i == at)])

            at = {b: k for k, b in enumerate(borders)}
            got = sum(s for a, b, kind in model.decode(text, lo, hi) for i, j, k, s in options if (i, j, k) == (at[a], at[b], pii.ORDER[kind]))
            assert abs(got - best(0)) < 1e-6


def test_base_spans_always_stay(model):
    for text, _ in pii.examples(200, 5):
        base, spans = pii.all_spans(model, text)
        assert set(base) <= set(spans)


def test_awkward_rows(spark):
    docs = documents(spark, [(1, None), (2, ""), (3, "a@b.cc a@b.cc"), (3, "a@b.cc a@b.cc"), (None, "a@b.cc"), (4, LONG + " a@b.cc"), (5, "1" * 50_000), (6, "a." * 50_000)])
    got = rows_by_id(pii.detect(docs))
    assert got[1][0]["spans"] == [] and got[2][0]["base"] == []
    assert len(got[3]) == 2 and [s["start"] for s in got[3][0]["base"]] == [0, 7]
    assert len(got[4][0]["spans"]) == 1 and got[4][0]["spans"][0]["start"] == len(LONG) + 1
    masked = pii.mask(docs)
    assert masked.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert texts[3] == "<EMAIL> <EMAIL>" and texts[1] is None and texts[2] == ""
    assert pii.detect(docs.limit(0)).collect() == []
