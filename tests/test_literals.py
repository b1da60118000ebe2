"""Literal inputs for cases that the fixtures don't hold."""


import pytest

from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from quire.functions import scores as S
from quire.operators import cluster as C
from quire.operators import models as M
from quire.operators import relational as R
from quire.sources import jsonl as J
from quire.sources import table as TB
from quire.sources.tables import table


def test_scan_sees_appended_rows(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    for n in (10, 20):
        spark.range(10).withColumnRenamed("id", "doc_id").write.mode("append").parquet(path)
        assert table(spark, str(tmp_path), "documents").count() == n


def test_scan_filter_is_pushed_down(spark):
    plan = table(spark, "/root/testdata/sf0.1", "documents").filter("doc_id < 10")._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(doc_id,10)" in plan and "Exchange" not in plan


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 1001)], "src long, dst long")
    got = {r["node"]: r["component"] for r in C.connected_components(edges).collect()}
    assert {got[k] for k in range(301)} == {0} and got[1001] == 1000


def test_posts_texts_are_stripped(spark, tmp_path):
    raw = spark.createDataFrame([("  a b \n", "1_000", " 3 ", None, 1), (None, None, "x", "t", 2)], "text string, approve string, disapprove string, timestamp string, ord long")
    got = [(r["text"], r["approve_count"], r["disapprove_count"]) for r in TB.ingest_posts(raw, str(tmp_path / "posts")).orderBy("id").collect()]
    assert got == [("a b", 1000, 3), ("", 0, 0)]


@pytest.mark.parametrize("value, kind, want", [(3.0, "double", 3), (-2.9, "double", -2), (float("nan"), "double", 0), ("3.0", "string", 0), ("1_000", "string", 1000), ("1__0", "string", 0), ("_1", "string", 0), (" +7 ", "string", 7), (None, "string", 0), (5, "int", 5)])
def test_parse_int(spark, value, kind, want):
    assert spark.createDataFrame([(value,)], f"v {kind}").select(S.parse_int("v")).first()[0] == want


def test_values_that_do_not_fit_leave_the_line_valid(spark):
    schema = StructType([StructField("k", LongType()), StructField("t", StringType()), StructField("x", ArrayType(DoubleType()))])
    lines = ['{"k":"x","t":"a"}', '{"k":1.5,"t":"b"}', '{"k":7,"t":"c","x":[1,2.5]}', '{"k":null}', '{"k":1', '{"t":1}']
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    got = {r["i"]: (r["status"], r["k"], r["t"], r["x"]) for r in J.parse_json_lines(df, schema, "line", ["k"], ["i"]).collect()}
    assert got == {0: ("ok", None, "a", None), 1: ("ok", None, "b", None), 2: ("ok", 7, "c", [1.0, 2.5]), 3: ("ok", None, None, None), 4: ("bad_json", None, None, None), 5: ("missing_key", None, None, None)}


def test_rows_without_an_order_are_not_lost(spark):
    df = spark.createDataFrame([("a", None, "x"), ("b", None, "y"), ("b", 2, "z"), ("b", 1, "w")], "k string, o int, v string")
    assert {r["k"]: (r["o"], r["v"]) for r in R.dedupe_first(df, "k", "o").collect()} == {"a": (None, "x"), "b": (1, "w")}
    assert {r["k"]: (r["o"], r["v"]) for r in R.dedupe_last(df, "k", "o").collect()} == {"a": (None, "x"), "b": (2, "z")}


def test_agglomeration_with_a_zero_vector_ends(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 0.0]), (4, [0.0, 1.0])], "id long, v array<double>")
    got = {r["id"]: r["meta_id"] for r in C.average_linkage(df, 3).collect()}
    assert got[1] == got[2] and len(set(got.values())) == 3


def test_long_replies_come_back_whole(spark):
    reply = "\n".join(" ".join(f"w{k}" for k in range(100)) for _ in range(5))
    out = M.generate(spark.createDataFrame([(1, "say")], "id long, p string"), "p", "id", generator=lambda ts: [t + reply for t in ts], chunked=True, total_tokens=400).first()
    assert out["continuation"].strip() == reply
