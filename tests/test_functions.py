"""Literal edge cases (hand-computed answers) for the column functions."""

from pyspark.sql import functions as F

from quire.functions import scores as S
from quire.functions import text as T
from quire.operators import keywords as K
from quire.operators import models as M
from quire.operators import topics as TP
from quire.sources import textfiles as TF


def col1(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_engagement_score_half_even(spark):
    df = spark.createDataFrame([("16", "15"), ("0", "0"), ("1", "0"), ("0", "1"), (None, "x")], "a string, d string")
    assert [r[0] for r in df.select(S.engagement_score("a", "d")).collect()] == [0.0312, 0.0, 0.5, -0.5, 0.0]


def test_parse_int(spark):
    got = col1(spark, ["7", " 5 ", "+5", "", "abc", "3.7", None], S.parse_int)
    assert got == [7, 5, 5, 0, 0, 0, 0]


def test_clean_text(spark):
    got = col1(spark, ["a ​b \n c", "ﬁ", "", None], T.clean_text)
    assert got == ["a b c", "fi", "", ""]


def test_clean_text_unicode_space_and_marks(spark):
    got = col1(spark, [" x‪y　\u001cz "], T.clean_text)
    assert got == ["xy z"]


def test_normalize_key(spark):
    got = col1(spark, ["Ispovest:\nA  B Ispovest:\nc", "č"], T.normalize_key)
    assert got == ["a b c", "č"]


def test_normalize_light(spark):
    assert col1(spark, ["  Ispovest:\nAbC  "], T.normalize_light) == ["abc"]


def test_content_hash_equal(spark):
    a, b = col1(spark, [" A  b\n", "a b"], T.content_hash)
    assert a == b and len(a) == 64


def test_topic_lines(spark):
    df = spark.createDataFrame([(1, "27 Posao i škola (šef)"), (2, "bez broja"), (3, "")], "line_no long, line string")
    rows = [tuple(r) for r in TP.parse_topic_lines(df).collect()]
    assert rows == [(1, 27, "Posao i škola")]


def test_repair_topic_ids(spark):
    for ids, want in (([26, 27, 27, 28], [26, 27, 28, 29]), ([5, 5, 3, 6], [5, 6, 3, 4])):
        df = spark.createDataFrame([(i + 1, v, f"t{i}") for i, v in enumerate(ids)], "line_no long, raw_id long, topic string")
        got = [r["fixed_id"] for r in TP.repair_topic_ids(df).orderBy("line_no").collect()]
        assert got == want


def test_strip_third_tag(spark):
    got = col1(spark, ["[e:1] [a] [b] T", "[e:1] [a] T", "[e:1] [a] [b] T [b]  U"], T.strip_third_tag)
    assert got == ["[e:1] [a] T", "[e:1] [a] T", "[e:1] [a] T U"]


def test_apply_manual_topics(spark):
    corpus = spark.createDataFrame([(1, -999, "x"), (2, 3, "y"), (3, 4, "x")], "doc_id long, cluster int, cluster_topic string")
    lookup = spark.createDataFrame([(3, "mapped")], "cluster int, manual_topic string")
    got = {r["doc_id"]: r["cluster_topic"] for r in TP.apply_manual_topics(corpus, lookup).collect()}
    assert got == {1: "razno", 2: "mapped", 3: "x"}


def test_label_parse(spark):
    df = spark.createDataFrame([("... Tema: a Tema: b ", ["z"]), ("Tema:", ["k"])], "o string, k array<string>")
    assert [r[0] for r in df.select(M.label_parse(F.col("o"), F.col("k"))).collect()] == ["b", "k"]


def test_prompt_pipe_parse(spark):
    df = spark.createDataFrame([("0.8 | razno",), ("-0.7|Mrzim ",)], "line string")
    _s, _t, prompt = TF.pipe_prompt("line")
    got = [r[0] for r in df.select(prompt).collect()]
    assert got == ["[engagement:0.8] [razno]\nIspovest:", "[engagement:-0.7] [Mrzim]\nIspovest:"]


def test_blocks(spark):
    df = spark.createDataFrame([("a\nb\n\n c\n\n\nd\n\n",)], "content string")
    assert [r["block"] for r in TF.blocks(df).orderBy("block_no").collect()] == ["a\nb", "c", "d"]


def test_lines_numbering(spark):
    df = spark.createDataFrame([(" x \n\n y\r\nz",)], "content string")
    assert [tuple(r) for r in TF.lines(df).collect()] == [(1, "x"), (3, "y"), (4, "z")]


def test_continuation(spark):
    df = spark.createDataFrame([("prompt", "prompt  answer \n")], "p string, g string")
    assert df.select(TF.continuation("g", "p")).first()[0] == "answer"


def test_tokens_and_ngrams(spark):
    df = spark.createDataFrame([("Ja sam Ana, a ti si x1 Ana!",)], "t string")
    toks = df.select(K.tokens(F.col("t"), K.INSPECT_STOPWORDS)).first()[0]
    assert toks == ["ana", "ti", "si", "x1", "ana"]
    grams = df.select(K.ngrams(K.tokens(F.col("t"), K.INSPECT_STOPWORDS))).first()[0]
    assert grams[5:] == ["ana ti", "ti si", "si x1", "x1 ana"]


def test_cluster_tags(spark):
    df = spark.createDataFrame([(-1, " t "), (4, "u")], "c int, t string")
    got = [r[0] for r in df.select(TP.cluster_tag(F.col("c"), F.col("t"))).collect()]
    assert got == ["<NO_TOPIC> t <NO_TOPIC>", "<CLUSTER_4> u <CLUSTER_4>"]
