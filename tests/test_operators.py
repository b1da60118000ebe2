"""Property and brute-force tests for operators without an SQL oracle."""

import math
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quire.operators import cluster as C
from quire.operators import keywords as K
from quire.operators import models as M
from quire.operators import neighbors as NB
from quire.operators import relational as R
from quire.operators import vectors as V
from quire.plans.models import meta_names
from quire.sources import html as H
from quire.sources import jsonl as J
from quire.streaming import ingest as ST


def vec_df(spark, X, ids=None):
    ids = list(range(len(X))) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(v) for v in x]) for i, x in zip(ids, X)], "id long, v array<double>")


# ------------------------------------------------------------- scans --

def test_jsonl_tolerant_statuses(spark):
    lines = ['{"text": "a"}', "   ", "bad", "{'text':\"q\"}", '{"x": 2}', '{"text":"b"} x', '{"text": null}']
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, line string")
    schema = StructType([StructField("text", StringType())])
    got = {r["i"]: (r["status"], r["text"]) for r in J.parse_json_lines(df, schema, "line", ["text"], ["i"]).collect()}
    assert got == {0: ("ok", "a"), 2: ("bad_json", None), 3: ("bad_json", None), 4: ("missing_key", None),
                   5: ("bad_json", None), 6: ("ok", None)}


def test_json_document_roundtrip(spark):
    from quire.session import scratch_path

    df = spark.createDataFrame([(1, "a", 3), (2, "č", 4)], "cluster_id int, keyword string, n long")
    p = scratch_path(spark, "doc")
    J.write_json_document(df, p)
    back = J.read_json_array(spark, p, df.schema)
    assert sorted(map(tuple, back.collect())) == [(1, "a", 3), (2, "č", 4)]


def test_html_extract_cases():
    h = ('<html><head><script>var t="</p>";</script><style>p{}</style></head><body>'
         '<div class="ad"><p>ad</p></div><article><h1>T &amp; x</h1><p><b>a<br><p>b c</p>'
         '<p> d <i>e</i></p></article><article><p>z</article></body></html>')
    recs = H.parse_records(h, H.FieldSpec("article"), {"title": H.FieldSpec("h1"), "p": H.FieldSpec("p")})
    assert recs == [{"title": ["T & x"], "p": ["a", "b c", "de"]}, {"title": [], "p": ["z"]}]


def test_html_record_inside_a_record():
    h = ('<div class="post"><p>a</p><div class="post"><p>b<p>c</div><p>d</div></i><p>out</p>'
         '<div class="post"><p>e<div>f</div></section>g')
    recs = H.parse_records(h, H.FieldSpec("div", "post"), {"p": H.FieldSpec("p")})
    assert recs == [{"p": ["a", "b", "c", "d"]}, {"p": ["b", "c"]}, {"p": ["efg"]}]


def test_html_class_and_id_prefix():
    h = ('<div class="post"><div class="post-text"> x <b>y</b> </div>'
         '<div class="post-value" id="approve-count-7">12</div>'
         '<div class="post-value" id="disapprove-count-7">3</div></div>')
    recs = H.parse_records(h, H.FieldSpec("div", "post"), {
        "text": H.FieldSpec("div", "post-text"),
        "approve": H.FieldSpec("div", "post-value", "approve-count-"),
        "disapprove": H.FieldSpec("div", "post-value", "disapprove-count-")})
    assert recs == [{"text": ["xy"], "approve": ["12"], "disapprove": ["3"]}]


# --------------------------------------------------------- relational --

def test_dedupe_first_idempotent_and_first(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (5, "b"), (4, "c")], "id long, h string")
    once = R.dedupe_first(df, "h", "id")
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 2), ("c", 4)]
    twice = R.dedupe_first(once.select("id", "h"), "h", "id")
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_dedupe_last_hot_key(spark):
    rows = [(i, "hot" if i % 3 else f"k{i}", i * 10) for i in range(3000)]
    df = spark.createDataFrame(rows, "ord long, k string, v long")
    got = {r["k"]: r["v"] for r in R.dedupe_last(df, "k", "ord").collect()}
    assert got["hot"] == 2999 * 10 and len(got) == 1 + 1000


def test_global_row_number_consecutive(spark):
    df = spark.range(0, 5000).withColumn("k", F.sha2(F.col("id").cast("string"), 256))
    got = R.global_row_number(df, [F.col("k")], "pos").orderBy("pos").collect()
    assert [r["pos"] for r in got] == list(range(1, 5001))
    ks = [r["k"] for r in got]
    assert ks == sorted(ks)


def test_sample_fixed_small(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")
    assert R.sample_fixed(df, "doc_id", 5).count() == 3


# ------------------------------------------------------------ keywords --

def _tfidf_brute(docs, stops, min_df, max_df, max_features, top_k):
    """Independent per-cluster TF-IDF (documented vectoriser defaults)."""
    import re
    from collections import Counter

    tok = [[t for t in re.findall(r"[^\W]{2,}", d.lower()) if t not in stops] for d in docs]
    grams = [t + [a + " " + b for a, b in zip(t, t[1:])] for t in tok]
    tf = [Counter(g) for g in grams]
    n = len(docs)
    df = Counter(term for c in tf for term in c)
    cf = Counter()
    for c in tf:
        cf.update(c)
    vocab = [t for t in df if df[t] >= min_df and (max_df is None or df[t] <= max_df * n)]
    vocab.sort(key=lambda t: (-cf[t], t))
    vocab = vocab[:max_features]
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in vocab}
    score = Counter()
    for c in tf:
        w = {t: c[t] * idf[t] for t in vocab if t in c}
        nrm = math.sqrt(sum(x * x for x in w.values())) or 1.0
        for t, x in w.items():
            score[t] += x / nrm / n
    return sorted(score, key=lambda t: (-round(score[t], 12), [-ord(ch) for ch in t]))[:top_k], score


def test_tfidf_matches_brute_force(spark):
    docs = ["mačka voli mleko i ribu", "pas voli kosti", "mačka i pas su prijatelji", "riba pliva u vodi",
            "mleko i riba za mačku", "pas laje na mačku"] * 2
    df = spark.createDataFrame([(0, i, d) for i, d in enumerate(docs)], "cluster_id int, doc_id long, text string")
    got = K.cluster_tfidf(df, stop_words=K.TAG_STOPWORDS, min_df=2, max_features=100, top_k=5).orderBy("rank")
    got = [(r["term"], r["score"]) for r in got.collect()]
    want, score = _tfidf_brute(docs, set(K.TAG_STOPWORDS), 2, None, 100, 5)
    assert [g[0] for g in got] == want
    for term, s in got:
        assert abs(s - score[term]) < 1e-9


def test_tfidf_small_cluster_fallbacks(spark):
    df = spark.createDataFrame([(7, 1, "jedan jedini tekst")], "cluster_id int, doc_id long, text string")
    assert K.inspect_keywords(df).count() == 0
    assert [tuple(r) for r in K.tag_keywords(df).collect()] == [(7, "TOPIC_7")]


def test_meta_names(spark):
    bk = spark.createDataFrame([(1, 0, "a_b", 1), (2, 0, "b_c", 2), (3, 4, "", 1)],
                               "base_id long, meta_id long, keyword string, crank int")
    got = {r["meta_id"]: r["meta_topic"] for r in meta_names(bk).collect()}
    assert got == {0: "TOPIC_B_A_C", 4: "TOPIC_4"}


# ------------------------------------------------------------- models --

def test_lm_encode_pad_and_truncate(spark):
    vocab = spark.createDataFrame([("aa", 1), ("bb", 2), ("cc", 3), ("dd", 4), ("ee", 5), ("ff", 6)],
                                  "term string, token_id long")
    docs = spark.createDataFrame([(1, "ee ff"), (2, "aa bb cc dd ee")], "id long, text string")
    got = {r["id"]: (r["input_ids"], r["attention_mask"], r["labels"])
           for r in M.lm_encode(docs, "id", "text", vocab, max_len=4).collect()}
    assert got[1] == ([5, 6, 0, 0], [1, 1, 0, 0], [5, 6, -100, -100])
    assert got[2] == ([1, 2, 3, 4], [1, 1, 1, 1], [1, 2, 3, 4])


def test_hash_embed_unit(spark):
    df = spark.createDataFrame([(1, "ab cd ef ab"), (2, "")], "id long, text string")
    got = {r["id"]: r["embedding"] for r in M.hash_embed(df, "id", "text", 16).collect()}
    assert abs(np.linalg.norm(got[1]) - 1) < 1e-12 and np.allclose(got[2], 0)


def test_generate_chunked_stops(spark):
    df = spark.createDataFrame([(1, "a b c")], "id long, p string")
    out = M.generate(df, "p", "id", chunked=True, total_tokens=10).first()
    assert len(out["continuation"].split()) >= 10


def test_mmr_select_properties():
    # two terms of the same posts are alike: diversity takes the other one later
    x = np.array([[4, 4, 0, 0], [4, 4, 0, 0], [0, 0, 3, 0], [0, 0, 0, 1]], float)
    terms = np.array(["b", "a", "c", "d"])
    assert [terms[i] for i in M.mmr_select(x, terms, 4, 0.0)] == ["a", "b", "c", "d"]
    assert [terms[i] for i in M.mmr_select(x, terms, 3, 0.5)] == ["a", "c", "d"]
    assert M.mmr_select(x[:0], terms[:0], 3, 0.5) == [] and len(M.mmr_select(x, terms, 9, 0.5)) == 4


# ------------------------------------------------------------ vectors --

def test_top_centroids_vs_numpy(spark):
    rng = np.random.default_rng(1)
    X, Cm = rng.normal(size=(200, 6)), rng.normal(size=(7, 6))
    cents = spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(Cm)], "cluster_id int, centroid array<double>")
    got = V.top_centroids(vec_df(spark, X), cents, 3).collect()
    sims = (X @ Cm.T) / np.outer(np.linalg.norm(X, axis=1), np.linalg.norm(Cm, axis=1))
    for r in got:
        want = np.argsort(-sims[r["id"]])[r["rank"] - 1]
        assert r["cluster_id"] == want
    assert len(got) == 600


def test_knn_exact_vs_numpy(spark):
    rng = np.random.default_rng(2)
    X = np.vstack([rng.normal(size=(300, 5)), rng.normal(scale=0.01, size=(400, 5)) + 3])  # one hot region
    got = NB.knn(vec_df(spark, X), 4, n_pivots=8, block_size=64).collect()
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(D, np.inf)
    want = {i: list(np.lexsort((np.arange(len(X)), D[i]))[:4]) for i in range(len(X))}
    have = {}
    for r in got:
        have.setdefault(r["id"], {})[r["rank"]] = r["nbr"]
    assert {i: [have[i][k] for k in range(1, 5)] for i in have} == want


def test_density_cluster_vs_numpy(spark):
    rng = np.random.default_rng(3)
    X = np.vstack([rng.normal(size=(40, 3)) * 0.05 + c for c in ([0, 0, 0], [1, 1, 1], [3, 0, 0])]
                  + [rng.uniform(-4, 4, size=(15, 3))])
    eps, mcs, ms = 0.3, 10, 3
    got = {r["id"]: r["cluster_id"] for r in C.density_cluster(vec_df(spark, X), eps, mcs, ms, n_pivots=4,
                                                                  block_size=32).collect()}
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    core = np.sort(D, axis=1)[:, ms - 1] <= eps
    comp = -np.ones(len(X), dtype=int)
    for s in np.where(core)[0]:
        if comp[s] >= 0:
            continue
        stack, comp[s] = [s], s
        while stack:
            u = stack.pop()
            for v in np.where(core & (D[u] <= eps) & (comp < 0))[0]:
                comp[v] = s
                stack.append(v)
    sizes = {c: (comp == c).sum() for c in set(comp[comp >= 0])}
    keep = sorted([c for c in sizes if sizes[c] >= mcs], key=lambda c: (-sizes[c], c))
    want = {i: (keep.index(comp[i]) if comp[i] in keep else -1) for i in range(len(X))}
    assert got == want


def test_connected_components_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001)], "src long, dst long")
    got = {r["node"]: r["component"] for r in C.connected_components(edges).collect()}
    assert set(got[i] for i in range(201)) == {0} and got[1001] == 1000


def test_average_linkage_vs_naive(spark):
    rng = np.random.default_rng(4)
    X = rng.normal(size=(14, 5))
    got = {r["id"]: r["meta_id"] for r in C.average_linkage(vec_df(spark, X), 4).collect()}
    U = X / np.linalg.norm(X, axis=1, keepdims=True)
    groups = [[i] for i in range(len(X))]
    while len(groups) > 4:
        best = None
        for a in range(len(groups)):
            for b in range(a + 1, len(groups)):
                d = np.mean([1 - U[i] @ U[j] for i in groups[a] for j in groups[b]])
                if best is None or d < best[0]:
                    best = (d, a, b)
        _, a, b = best
        groups[a] = groups[a] + groups[b]
        del groups[b]
    want = {}
    for gi, g in enumerate(sorted(groups, key=min)):
        for i in g:
            want[i] = gi
    assert got == want


# ----------------------------------------------------------- streaming --

def test_stream_ingest_equals_batch_and_restart_noop(spark):
    from quire.session import scratch_path

    src = tempfile.mkdtemp(prefix="quire-src-")
    a = spark.createDataFrame([(1, "x  y"), (2, "X y"), (3, "z")], "doc_id long, text string")
    b = spark.createDataFrame([(4, "z"), (5, "w")], "doc_id long, text string")
    a.coalesce(1).write.parquet(os.path.join(src, "a"))
    schema = a.schema
    sink, ck = scratch_path(spark, "s"), scratch_path(spark, "c")
    out = ST.ingest_stream(spark, src + "/a", "*.parquet", schema, sink, ck)
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3]
    out = ST.ingest_stream(spark, src + "/a", "*.parquet", schema, sink, ck)   # restart: nothing new
    assert out.count() == 2
    b.coalesce(1).write.mode("append").parquet(os.path.join(src, "a"))
    out = ST.ingest_stream(spark, src + "/a", "*.parquet", schema, sink, ck)   # new file: first-wins across runs
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3, 5]


@pytest.mark.parametrize("n", [1])
def test_kmeans_and_pca_shapes(spark, n):
    rng = np.random.default_rng(5)
    X = np.vstack([rng.normal(size=(30, 4)) + c for c in (0, 5, 10)])
    assign, centers, cost = C.kmeans_fit(vec_df(spark, X), 3, n_init=2)
    labels = [r["cluster"] for r in assign.orderBy("id").collect()]
    assert len(set(labels)) == 3 and cost > 0 and centers.count() == 3
    out, ev = C.pca_reduce(vec_df(spark, X), 2)
    assert out.count() == 90 and ev[0] >= ev[1]


def test_read_jsonl_files_and_text_blocks(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"text": "x", "n": 1}\n\nnot json\n{"n": 2}\n', encoding="utf-8")
    schema = StructType([StructField("text", StringType())])
    got = sorted((r["status"], r["text"]) for r in J.read_jsonl(spark, str(p), schema, ["text"]).collect())
    assert got == [("bad_json", None), ("missing_key", None), ("ok", "x")]
    from quire.sources import textfiles as TF

    q = tmp_path / "prompts.txt"
    q.write_text("[a] one\n\n\n[b] two\n\n", encoding="utf-8")
    blocks = [r["block"] for r in TF.blocks(TF.read_text_files(spark, str(q))).orderBy("block_no").collect()]
    assert blocks == ["[a] one", "[b] two"]


def test_global_row_number_reused_input(spark):
    """Regression: positions stay complete when the numbered frame is read twice."""
    from quire.session import cut_lineage

    df = cut_lineage(spark.range(0, 3000).withColumn("k", F.sha2(F.col("id").cast("string"), 256)))
    a = R.global_row_number(df, [F.col("k")], "pos")
    b = a.join(df.select("id"), "id")
    assert b.count() == 3000 and b.agg(F.countDistinct("pos")).first()[0] == 3000


def test_dedupe_stream_watermark(spark):
    import datetime

    from quire.session import scratch_path

    src = tempfile.mkdtemp(prefix="quire-ev-")
    t0 = datetime.datetime(2024, 1, 1)
    rows = [(i, t0 + datetime.timedelta(minutes=i), f"p{i % 5}") for i in range(20)]
    ev = spark.createDataFrame(rows, "event_id long, ts timestamp, props string")
    ev.coalesce(1).write.parquet(os.path.join(src, "e"))
    out = ST.dedupe_stream(spark, src + "/e", "*.parquet", ev.schema, ["props"], scratch_path(spark, "w"),
                           scratch_path(spark, "wc"), watermark=("ts", "1 hour"))
    assert sorted(r["props"] for r in out.collect()) == [f"p{i}" for i in range(5)]


def test_runtime_conf_applied(spark):
    from quire.session import apply_runtime_conf

    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    apply_runtime_conf(spark)
    assert int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")) >= 10000


def test_strict_scan_fails_on_bad_line(spark):
    df = spark.createDataFrame([(1, '{"text": "a"}'), (2, "oops")], "i int, line string")
    schema = StructType([StructField("text", StringType())])
    with pytest.raises(Exception):
        J.parse_json_lines_strict(df, schema, "line", ["i"]).collect()


def test_jsonl_sink_keeps_nulls_and_unicode(spark, tmp_path):
    df = spark.createDataFrame([(1, "čćž", None)], "id long, text string, topic string")
    out = str(tmp_path / "out")
    J.write_jsonl(df, out)
    import glob

    text = "".join(open(f, encoding="utf-8").read() for f in glob.glob(out + "/*.json"))
    assert '"topic":null' in text and "čćž" in text


def test_generate_factory_called_per_task(spark):
    df = spark.createDataFrame([(i, f"p {i}") for i in range(6)], "id long, p string").repartition(2)

    def factory():
        return lambda prompts: [p + " !" for p in prompts]

    out = {r["id"]: r["continuation"] for r in M.generate(df, "p", "id", factory=factory).collect()}
    assert out == {i: "!" for i in range(6)}


def test_cluster_conf_sizing():
    from quire.session import cluster_conf

    small = cluster_conf(15 << 20)
    assert small["spark.sql.shuffle.partitions"] == "200"
    big = cluster_conf(100 << 40)
    n, size = int(big["spark.sql.shuffle.partitions"]), int(big["spark.sql.adaptive.advisoryPartitionSizeInBytes"])
    assert n == 200_000 and n * size >= 2 * (100 << 40)
