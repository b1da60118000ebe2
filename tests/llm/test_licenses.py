import re

import pytest

from quire.llm import licenses
from quire.llm.license_rules import BASE, rules
from tests.llm.helpers import LONG, documents, rows_by_id


def brute(text):
    """Word by word, with Python's regular expressions and all pairs of intervals."""
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    base = [(k, label) for said, label in BASE for k in range(len(w)) if w[k:k + len(said.split())] == said.split()]
    joined = "".join(f" {x} " for x in w)
    spans = sorted({(m.start(), -m.end(), p, label, weight) for p, label, keyword, weight, pattern in rules() if keyword in joined for m in re.finditer(pattern, joined)})
    kept = [s for k, s in enumerate(spans) if not any(o[0] <= s[0] and o[1] <= s[1] for o in spans[:k])]
    labels = sorted({x for _, x in base} | {s[3] for s in kept})
    return len(w), len(base), min((k for k, _ in base), default=None), max((k for k, _ in base), default=None), sorted({x for _, x in base}), labels, max([s[4] for s in kept] + [0.5] * bool(base), default=0.0)


TEXTS = [None, "", "...", "\x00cc\x00\x1fby\x7f\x80 <>cc<by>", "cc  \t by\n\ncc-by", "ÀÉ cc by İ ſ", "All rights reserved.", "CC BY cc-by CC_BY", "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3 or later.",
         "Licensed under the Apache License, Version 2.0. All Rights Reserved", "Released under the MIT License. SPDX-License-Identifier: MIT", "mit freundlichen Grüßen",
         "Copyright 2020 Some Body. All rights reserved. " * 5, "the BSD 3-Clause \"New\" license", "Tous droits réservés", "general public licenses", "cc by", "x " * 50 + "public domain mark 1.0",
         "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "GPLv3 or LGPL-2.1; CC0 1.0 Universal", LONG + " cc by " + LONG + " cc by"]


def test_same_as_word_by_word(spark):
    got = rows_by_id(licenses.scan(documents(spark, list(enumerate(TEXTS)))))
    for k, text in enumerate(TEXTS):
        r = got[k][0]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"]) == brute(text), text


def test_longest_notice_wins(spark):
    r = licenses.scan(documents(spark, [(1, "Released under the MIT License.")])).collect()[0]
    assert r["labels"] == ["mit"] and len(r["detections"]) == 1 and r["score"] == 0.99


def test_every_match_holds_its_keyword():
    assert len(rules()) > 200 and len({r[4] for r in rules()}) > 190
    for _, _, keyword, _, pattern in rules():
        assert re.compile(pattern)
        assert re.sub(r"[^a-z0-9]", "", keyword)[:3] in re.sub(r"[^a-z0-9]", "", pattern) or "licen" in keyword


@pytest.mark.parametrize("n", [0, 2])
def test_awkward_rows(spark, n):
    docs = documents(spark, [(1, "cc by"), (1, "cc by")]).limit(n)
    got = licenses.scan(docs).collect()
    assert len(got) == n and all(r["labels"] == ["cc-by"] for r in got)
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
