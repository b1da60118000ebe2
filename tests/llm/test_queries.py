"""Registered queries over whole tables, next to their SQL where there is any."""

import hashlib

import duckdb
import pytest

import corpus_pipeline
from quire.llm import jaccard, pii
from quire.llm.common import table
from quire.llm.queries import ORACLE, QUERIES, vocabulary_path
from quire.sources.tables import TABLES
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm.helpers import words


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    cur = con.execute(ORACLE[name])
    columns = [d[0] for d in cur.description]
    want = sorted(map(repr, cur.fetchall()))
    got = QUERIES[name](spark, SF_CHECK)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == want


def test_pii_query_digests(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF_SMALL, "documents").collect()}
    for r in QUERIES["op4_pii"](spark, SF_SMALL).collect():
        base = pii.base_spans(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in base).encode()).hexdigest()
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(sum(k == kind for _, _, k in base) for kind in pii.KINDS)
        assert {f"{k}:{a}:{b}" for a, b, k in base} <= set(r["spans"].split(","))


def test_pipeline_is_its_stages(spark):
    """Each stage held against a plain version of it, on its own input."""
    tokenizers = pytest.importorskip("tokenizers")
    docs = table(spark, SF_CHECK, "documents")
    before = {r["doc_id"]: r for r in docs.collect()}
    bench = [f" {' '.join(words(r['text']))} " for r in table(spark, SF_CHECK, "benchmark").collect()]
    toxic = {r["doc_id"]: r["toxic"] for r in table(spark, SF_CHECK, "labels").collect()}
    out = None
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_CHECK).persist()
        rows = out.collect()
        if name == "bpe":
            lib = tokenizers.Tokenizer.from_file(vocabulary_path())
            assert all(r["ids"] == lib.encode(before[r["doc_id"]]["text"] or "", add_special_tokens=False).ids for r in rows)
            assert {r["doc_id"] for r in rows} == set(before)
            break
        assert out.columns == docs.columns
        after = {r["doc_id"]: r for r in rows}
        assert len(rows) == len(after) and set(after) <= set(before)
        gone = set(before) - set(after)
        if name == "toxicity":
            told = [i for i in before if i in toxic]
            assert sum((i in gone) == bool(toxic[i]) for i in told) >= 0.97 * len(told)
        elif name == "jaccard":
            classes = {r["doc_id"]: r["class_id"] for r in jaccard.join(docs).collect()}
            assert gone == {i for i, c in classes.items() if c != i} and {classes[i] for i in gone} <= set(after)
        elif name == "decontamination":
            held = {i for i, r in before.items() if any(b in f" {' '.join(words(r['text']))} " for b in bench)}
            assert held <= gone and len(gone - held) <= 0.1 * len(held) + 1
        else:
            assert not gone and all(not pii.base_spans(r["text"] or "") for r in rows)
        docs, before = out, after
    got = corpus_pipeline.run(spark, SF_CHECK)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(r["doc_id"] for r in out.collect())
