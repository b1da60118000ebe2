import numpy as np

from quire.llm import toxicity
from quire.llm.common import table
from tests.conftest import SF_CHECK
from tests.llm.helpers import LONG, documents, rows_by_id


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF_CHECK, "documents"), table(spark, SF_CHECK, "labels")
    model = toxicity.fit(docs, labels.filter("doc_id % 4 <> 0"))
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    held = [(r["toxic"], got[r["doc_id"]]) for r in labels.filter("doc_id % 4 = 0").collect()]
    assert len(got) == docs.count()
    assert np.mean([bool(y) == r["toxic"] for y, r in held]) >= 0.95


def test_severity_grows_with_the_dose(spark):
    bad = [(i, "plain talk " * 20 + "vilevile " * (1 + i % 6)) for i in range(60)]
    good = [(100 + i, "plain talk goes on " * (10 + i % 5)) for i in range(60)]
    docs = documents(spark, bad + good)
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in bad + good] + [(None, 1), (5, None), (9999, 1)], "doc_id long, toxic int")
    # near copies are one sample document, so texts differ
    import random
    rng = random.Random(0)
    mixed = [(i, " ".join(rng.choice("abcdefghij") * 3 + str(rng.randrange(50)) for _ in range(40)) + " " + t) for i, t in bad + good]
    model = toxicity.fit(documents(spark, mixed), labels)
    said = [" clean words only", "vilevile", "vilevile " * 6]
    score = {r["doc_id"]: r for r in toxicity.score(documents(spark, list(enumerate(said))), model).collect()}
    assert not score[0]["toxic"] and score[1]["toxic"] and score[2]["toxic"]
    assert score[0]["severity"] < score[1]["severity"] < score[2]["severity"]
    assert docs.count() == 120


def test_probabilities_are_those_of_one_scale():
    model = toxicity.Ordinal(np.zeros(0, np.int64), np.zeros(0), np.array([0.0, 1.0, 2.5]))
    p = model.grades(np.array([-50.0, 0.0, 50.0]))
    assert np.allclose(p.sum(1), 1) and (p >= 0).all()
    assert p[0, 0] > 0.99 and p[2, 3] > 0.99 and abs(p[1, 0] - 0.5) < 1e-9


def test_awkward_rows(spark):
    docs = documents(spark, [(1, None), (2, ""), (3, LONG), (3, LONG), (None, "x")])
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)   # one kind of label only: nothing to learn
    got = rows_by_id(toxicity.score(docs, model))
    assert len(got[3]) == 2 and not any(r["toxic"] for rows in got.values() for r in rows)
    assert toxicity.keep_clean(docs, model).columns == docs.columns and toxicity.keep_clean(docs, model).count() == 5
    assert toxicity.score(docs.limit(0), model).collect() == []
    assert toxicity.fit(docs.limit(0), labels).markers.size == 0
