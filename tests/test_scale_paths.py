"""Operators whose one-group or one-driver step was replaced: against plain versions."""

import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.operators import keywords as K
from quire.operators import models as M
from quire.operators import relational as R
from quire.operators import topics as TP
from quire.operators import trainset as TS
from quire.session import apply_runtime_conf, scratch_path
from quire.sources import fixtures as FX
from quire.sources import jsonl as J
from quire.sources.tables import SCAN_PARTITIONS, Tables, table

from .conftest import SF_SMALL


def fold(raws):
    used, out, now = set(), [], None
    for raw in raws:
        now = now + 1 if now is not None and raw in used else raw
        used.add(now)
        out.append(now)
    return out


@pytest.mark.parametrize("seed,size", [(0, 30), (1, 25), (2, 1000)])
def test_id_repair_in_blocks_is_the_fold(spark, seed, size):
    rng = np.random.default_rng(seed)
    raws = (rng.integers(0, 30, 120) if seed % 2 else np.sort(rng.integers(0, 60, 120))).tolist()
    df = spark.createDataFrame([(i, r, f"t{i}") for i, r in enumerate(raws)], "line_no long, raw_id long, topic string").repartition(5)
    got = sorted((r["line_no"], r["fixed_id"], r["topic"]) for r in TP.repair_topic_ids(df, size).collect())
    assert got == [(i, f, f"t{i}") for i, f in enumerate(fold(raws))]


def test_id_repair_of_many_lines(spark):
    rng = np.random.default_rng(5)
    raws = rng.integers(0, 90_000, 120_000)
    df = spark.createDataFrame([(i, int(r)) for i, r in enumerate(raws)], "line_no long, raw_id long").withColumn("topic", F.lit("t"))
    got = TP.repair_topic_ids(df).orderBy("line_no").select("fixed_id").toArrow()["fixed_id"].to_pylist()
    assert got == fold(raws.tolist())


def test_id_repair_of_nothing(spark):
    assert TP.repair_topic_ids(spark.createDataFrame([], "line_no long, raw_id long, topic string")).collect() == []


def test_late_row_number(spark):
    rows = [(3, "c"), (1, "b"), (1, "a"), (None, "n"), (2, "x"), (1, "a")]
    df = spark.createDataFrame(rows, "k long, text string").repartition(4)
    got = sorted(((r["pos"], r["k"], r["text"]) for r in R.late_row_number(df, ["k"], [F.col("k")], ties=[F.col("text")]).collect()))
    assert got == [(1, None, "n"), (2, 1, "a"), (3, 1, "a"), (4, 1, "b"), (5, 2, "x"), (6, 3, "c")]
    big = spark.range(0, 3000).withColumn("text", F.col("id").cast("string"))
    pos = R.shuffle_position(big, "id").orderBy("shuffle_pos").collect()
    assert [r["shuffle_pos"] for r in pos] == list(range(1, 3001)) and sorted(r["id"] for r in pos) == list(range(3000))


def test_texts_are_not_range_shuffled(spark):
    df = spark.range(0, 200).withColumn("text", F.repeat(F.lit("long "), 50))
    plan = R.shuffle_position(df, "id")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize("small", [0, 100])
def test_topics_joined_with_and_without_a_broadcast(spark, monkeypatch, small):
    monkeypatch.setattr(R, "SMALL_ROWS", small)
    corpus = spark.createDataFrame([(i, -999 if i % 5 == 0 else i % 7, f"t{i % 7}") for i in range(60)], "doc_id long, cluster int, cluster_topic string")
    lookup = spark.createDataFrame([(1, "one"), (4, "four")], "cluster int, manual_topic string")
    got = {r["doc_id"]: (r["cluster_topic"], r["topic_source"]) for r in TP.apply_manual_topics(corpus, lookup).collect()}
    assert got == {i: ("razno", "razno") if i % 5 == 0 else ({1: "one", 4: "four"}[i % 7], "manual") if i % 7 in (1, 4) else (f"t{i % 7}", "untouched") for i in range(60)}
    extra = TS.with_extra_topic(corpus, TS.topic_set(corpus)).collect()
    assert all(r["extra_topic"] != r["cluster_topic"] and r["extra_topic"] for r in extra) and len(extra) == 60


@pytest.mark.parametrize("keyed", [False, True])
def test_json_document_in_parts(spark, keyed):
    rows = [(i, f"k\"{i} č\n", None if i % 9 == 0 else i * 1.5) for i in range(40)]
    df = spark.createDataFrame(rows, "n long, name string, x double")
    path = scratch_path(spark, "doc")
    J.write_json_document(df.repartition(6), path, "name" if keyed else None, order=["n"])
    doc = json.loads("\n".join(J.document_lines(spark, path)))
    want = [{k: v for k, v in (("n", n), ("name", t), ("x", x)) if v is not None} for n, t, x in rows]
    assert doc == ({r.pop("name"): r for r in want} if keyed else want)
    if not keyed:
        back = J.read_json_array(spark, path, df.schema)
        assert sorted(map(tuple, back.collect())) == rows
    empty = scratch_path(spark, "doc")
    J.write_json_document(df.limit(0), empty)
    assert json.loads("\n".join(J.document_lines(spark, empty))) == [] and J.read_json_array(spark, empty, df.schema).count() == 0


def test_terms_counted_in_the_row(spark):
    docs = spark.createDataFrame([(0, 1, "aa bb aa bb cc"), (0, 2, ""), (0, 3, None), (1, 4, "x yy"), (1, 5, "Aa AA aa")], "c int, d long, t string")
    got = {(r["d"], r["term"]): r["tf"] for r in K.doc_terms(docs, "c", "d", "t").collect()}
    assert got == {(1, "aa"): 2, (1, "bb"): 2, (1, "cc"): 1, (1, "aa bb"): 2, (1, "bb aa"): 1, (1, "bb cc"): 1, (4, "yy"): 1, (5, "aa"): 3, (5, "aa aa"): 2}


def test_tfidf_by_tasks_and_by_join_agree(spark):
    rng = np.random.default_rng(6)
    words = [f"w{k:02d}" for k in range(60)]
    rows = [(int(rng.integers(0, 4)), i, " ".join(rng.choice(words, rng.integers(0, 30), p=np.arange(60, 0, -1) / 1830))) for i in range(300)] + [(9, 999, None)]
    docs = spark.createDataFrame(rows, "cluster_id int, doc_id long, text string").repartition(6)
    run = lambda n: {(r["cluster_id"], r["rank"]): (r["term"], round(r["score"], 10)) for r in K.cluster_tfidf(docs, min_df=2, max_df=0.9, max_features=50, top_k=12, vocab_rows=n).collect()}
    a, b = run(0), run(None)
    assert a == b and len(a) == 48
    assert K.cluster_tfidf(docs.limit(0)).collect() == []


def test_pairs_are_counted_only_where_they_can_matter(spark):
    """Two frequent words fill the vocabulary's first places; a pair of rarer words isn't counted, a pair that ties with the last place is."""
    docs = spark.createDataFrame([(1, i, "aa bb aa bb" if i < 6 else f"x{i}x y{i}y") for i in range(12)] + [(None, 99, "aa bb")], "cluster_id int, doc_id long, text string")
    path = scratch_path(spark, "pairs")
    docs.select(F.col("cluster_id").alias("c"), F.col("doc_id").alias("d"), K.spaced_words(F.col("text")).alias("t")).write.parquet(path)
    words = spark.read.parquet(path)
    singles = K._word_counts(words, ()).withColumn("n", F.lit(12)).filter("c is not null")
    able = K._pair_words(singles, None, 2)
    assert sorted((r["term"], r["least"]) for r in able.collect()) == [("aa", 12), ("bb", 12)]
    pairs = K._pair_counts(words, able.select("c", "term", "least").toArrow(), (), 2)
    assert [tuple(r) for r in pairs.collect()] == [(1, "aa bb", 6, 12)]
    got = K.cluster_tfidf(docs, min_df=2, max_features=3, top_k=9).collect()
    assert sorted(r["term"] for r in got) == ["aa", "aa bb", "bb"]


def test_texts_stay_out_of_a_join_that_needs_none(spark):
    plan = FX.clustered(Tables(spark, SF_SMALL)).groupBy("cluster_id").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "length(text" not in plan.split("Join")[0] and "length(text" in plan


def test_counts_of_a_task_are_added_up(spark, monkeypatch):
    monkeypatch.setattr(K, "KEPT_COUNTS", 3)
    batches = [pa.RecordBatch.from_pydict({"pair": [k % 4, 7], "df": [1, 1], "cf": [2, 3]}) for k in range(20)]
    out = pa.Table.from_batches(list(K._added_up(iter(batches), ["pair"]))).group_by("pair").aggregate([("df", "sum"), ("cf", "sum")]).sort_by("pair").to_pydict()
    assert out == {"pair": [0, 1, 2, 3, 7], "df_sum": [5, 5, 5, 5, 20], "cf_sum": [10, 10, 10, 10, 60]}


def test_top_per_group_in_two_levels(spark):
    df = spark.range(0, 500).select((F.col("id") % 3).alias("g"), F.col("id"), (F.col("id") * 7 % 11).alias("v"))
    got = sorted((r["g"], r["_r"], r["id"]) for r in K.top_per_group(df, "g", [F.col("v").desc(), F.col("id")], 4, F.col("id"), salts=5).collect())
    want = [(g, n + 1, i) for g in range(3) for n, i in enumerate(sorted((i for i in range(500) if i % 3 == g), key=lambda i: (-(i * 7 % 11), i))[:4])]
    assert got == want


@pytest.mark.parametrize("head", [0, 2, 100])
def test_lm_encode_head_and_tail(spark, head):
    docs = spark.createDataFrame([(1, "aa bb aa cc dd"), (2, "aa bb"), (3, "ee dd ee ff"), (4, ""), (5, None)], "id long, text string").repartition(3)
    vocab = M.build_vocab(docs, "text")
    ids = {r["term"]: r["token_id"] for r in vocab.collect()}
    got = {r["id"]: r["input_ids"] for r in M.lm_encode(docs, "id", "text", vocab, max_len=4, head_terms=head).collect()}
    want = {1: ["aa", "bb", "aa", "cc"], 2: ["aa", "bb"], 3: ["ee", "dd", "ee", "ff"], 4: [], 5: []}
    assert got == {k: [ids[t] for t in v] + [0] * (4 - len(v)) for k, v in want.items()}


def test_scan_partitions_keep_pushdown_and_rows(spark):
    plain = table(spark, SF_SMALL, "documents").filter("lang = 'de'").select("doc_id")
    spark.conf.set(SCAN_PARTITIONS, "5")
    try:
        dealt = table(spark, SF_SMALL, "documents").filter("lang = 'de'").select("doc_id")
        plan = dealt._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(lang,de)" in plan and "text" not in plan.split("ReadSchema")[1]
        assert dealt.rdd.getNumPartitions() == 5 and sorted(dealt.collect()) == sorted(plain.collect())
    finally:
        spark.conf.unset(SCAN_PARTITIONS)


def test_scratch_folders_can_be_dropped(tmp_path):
    """In a process of its own, so that no other test's folders go."""
    import subprocess
    import sys

    code = (f"from quire.session import drop_scratch, get_spark, scratch_path\n"
            f"s = get_spark('local[1]', 1, extra={{'spark.checkpoint.dir': {str(tmp_path)!r}}})\n"
            f"a, b = scratch_path(s, 'a'), scratch_path(s, 'b')\n"
            f"s.range(3).write.parquet(a)\n"
            f"assert drop_scratch(s) == 1 and drop_scratch(s) == 0\n")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
    assert not list(tmp_path.rglob("*.parquet"))


def test_batches_for_python_are_bounded_in_bytes(spark):
    apply_runtime_conf(spark)
    wide = spark.range(0, 40, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"mb": [batch.nbytes / 2 ** 20], "n": [batch.num_rows]})

    got = wide.mapInArrow(sizes, "mb double, n bigint").collect()
    assert sum(r["n"] for r in got) == 40 and max(r["mb"] for r in got) <= 10


def _long_texts(spark):
    """20 MB of text in one partition."""
    words = [F.sha2(F.concat(F.lit(f"{k}|"), F.col("id").cast("string")), 256) for k in range(16)]
    return spark.range(0, 20_000, 1, 1).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *words, F.lit("end")).alias("text"))


def _row_groups(folder):
    import glob

    import pyarrow.parquet as pq

    groups = [pq.ParquetFile(f).num_row_groups for f in glob.glob(f"{folder.removeprefix('file:')}/**/*.parquet", recursive=True)]
    return [n for n in groups if n]   # an empty task may leave an empty file


def test_stream_source_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    """an arrival that one task wrote was one row group, which one task hashed."""
    from quire.plans import io as plans

    _long_texts(spark).write.parquet(str(tmp_path / "documents.parquet"))
    seen = []

    def ingest(spark, source, *args, **kw):
        seen.append(source)
        return spark.read.parquet(source).withColumn("hash", F.lit(""))

    monkeypatch.setattr(plans.ST, "ingest_stream", ingest)
    monkeypatch.setattr(plans, "ARRIVALS", 1)
    assert plans.stream_ingest(spark, str(tmp_path)).count() == 40_000   # the first arrival comes again
    groups = _row_groups(seen[0])
    assert len(groups) == 2 and min(groups) > 1


def test_tfidf_words_are_read_by_many_tasks(spark, monkeypatch):
    """one row group for all words of a task made another task count them all."""
    folders = []
    monkeypatch.setattr(K, "scratch_path", lambda s, name: folders.append(scratch_path(s, name)) or folders[-1])
    docs = _long_texts(spark).withColumn("cluster_id", F.lit(1))
    top = K.cluster_tfidf(docs, min_df=2, max_features=5, top_k=1).collect()
    assert [(r["cluster_id"], r["term"]) for r in top] == [(1, "end")]
    assert max(_row_groups(folders[0])) > 1
