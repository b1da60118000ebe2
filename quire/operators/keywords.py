"""Per-cluster keywords by TF-IDF, for all clusters in one job.

The studied pipeline loops over clusters and fits one vectoriser per
cluster in memory. Here three passes over the documents' words serve all clusters; no token
occurrence is shuffled:

    docs ─lower, spaces between words─▶ written once (c, doc, words)
      pass 1: words counted batch by batch ─▶ partial groupBy(c, word) → df, corpus count
      pass 2: pairs of neighbouring words, only of words that leave a pair a chance to get into the
              vocabulary, each pair one number ─▶ partial groupBy(pair) → df filters
              → top max_features per c, in two levels (c, salt), then c
      pass 3: each task looks its documents' terms up in the vocabulary, takes the
              norm inside the row and adds up w/‖doc‖ per (c, term) → one sum
              per task and vocabulary entry → top-k per c, in two levels

The vocabulary goes to the tasks as a broadcast only after a count shows at most
``VOCAB_ROWS`` entries; a larger one is joined by a shuffle on (c, term).

Formula (the vectoriser's documented defaults): raw tf; idf = ln((1+n)/(1+df)) + 1;
rows L2-normalised over the retained vocabulary; score = column mean over all
n documents of the cluster. Ranking ties: round(score, 12) desc, term desc;
max_features ties: corpus count desc, term asc.

Skew: a cluster that holds a third of the corpus sends, in the first level, at most
max_features rows per salt to its final task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import cut_lineage, scratch_path, write_rows

# ---- fixed values: stop-word lists of the two keyword profiles, as given ----
INSPECT_STOPWORDS = (
    "da", "je", "sam", "se", "mi", "ne", "na", "rođendan", "ispovest", "ispovijest",
    "za", "su", "ali", "me", "koji", "od", "nije", "to", "sve", "samo", "ili", "što", "sa",
    "ja", "kad", "kako", "jer", "kada", "znam", "ima", "iz", "mu", "smo",
)
TAG_STOPWORDS = (
    "i", "u", "na", "se", "je", "sam", "su", "sa", "za", "što", "ali",
    "od", "do", "koji", "kada", "će", "ne", "sve", "ili", "ako", "ja",
    "ti", "on", "ona", "oni", "one", "mi", "vi", "bio", "da", "je",
    "nije", "to", "samo", "kad", "kako", "jer", "znam", "ima", "iz",
    "smo", "bi", "bih", "bila", "biti", "bude", "bilo", "ni",
    "danas", "dan", "gde", "ovde", "imam", "godina", "godine", "ispovest", "me", "šta",
    "kao", "pa", "ga", "joj", "kod", "joj",
)
# Tokens: runs of two or more letters/digits/underscores (the vectoriser's
# default word pattern, written with Unicode classes valid in Java and RE2).
TOKEN_PATTERN = "([\\p{L}\\p{N}_]{2,})"
NO_TOPIC = "NO_TOPIC"
UNKNOWN = "UNKNOWN"


def tokens(text: Column, stop_words: Sequence[str] = ()) -> Column:
    """Lower-cased word tokens with stop words removed (array<string>)."""
    toks = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 1)
    if stop_words:
        stops = F.array(*[F.lit(w) for w in dict.fromkeys(stop_words)])
        toks = F.filter(toks, lambda x: ~F.array_contains(stops, x))
    return toks


def ngrams(toks: Column, n_max: int = 2) -> Column:
    """1-grams plus 2-grams of the surviving token sequence."""
    grams = toks
    if n_max >= 2:
        pairs = F.zip_with(toks, F.slice(toks, 2, 1 << 30), lambda a, b: F.concat(a, F.lit(" "), b))
        grams = F.concat(grams, F.filter(pairs, lambda x: x.isNotNull()))
    return grams


def doc_vectors(docs: DataFrame, cluster: str = "cluster_id", doc: str = "doc_id", text: str = "text",
                stop_words: Sequence[str] = (), n_max: int = 2) -> DataFrame:
    """M2: (c, d, terms array<string>, counts array<int>): the distinct terms of each document in
    order, counted inside the row (sorted, then the lengths of runs)."""
    # one column a step, so that no step is evaluated again inside the next one's lambda
    t = docs.select(F.col(cluster).alias("c"), F.col(doc).alias("d"), tokens(F.col(text), stop_words).alias("_tk"))
    g = t.select("c", "d", F.sort_array(ngrams(F.col("_tk"), n_max)).alias("_g"))
    begin = F.filter(F.sequence(F.lit(1), F.greatest(F.size("_g"), F.lit(1))),
                     lambda i: (i <= F.size("_g")) & ((i == 1) | (F.get("_g", i - 1) != F.get("_g", i - 2))))
    b = g.select("c", "d", "_g", begin.alias("_b"))
    after = F.concat(F.slice("_b", 2, 1 << 30), F.array(F.size("_g") + 1))
    return b.select("c", "d", F.transform("_b", lambda i: F.get("_g", i - 1)).alias("terms"),
                    F.when(F.size("_b") > 0, F.zip_with(after, "_b", lambda x, y: x - y)).otherwise(F.array().cast("array<int>")).alias("counts"))


def doc_terms(docs: DataFrame, cluster: str = "cluster_id", doc: str = "doc_id", text: str = "text",
              stop_words: Sequence[str] = (), n_max: int = 2) -> DataFrame:
    """M2 + A9: (cluster, doc, term, tf) in long form; nothing is shuffled."""
    v = doc_vectors(docs, cluster, doc, text, stop_words, n_max)
    return v.select("c", "d", F.explode(F.arrays_zip("terms", "counts")).alias("_x")).select(
        "c", "d", F.col("_x.terms").alias("term"), F.col("_x.counts").cast("bigint").alias("tf"))


def top_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int, salt: Column, rank: str = "_r",
                  salts: int = 16) -> DataFrame:
    """The first ``n`` rows of each group in ``order``, in two levels: of (group, salt), then of the group."""
    first = Window.partitionBy(group, "_salt").orderBy(*order)
    some = (df.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(salts)))
            .withColumn("_r0", F.row_number().over(first)).filter(F.col("_r0") <= n).drop("_salt", "_r0"))
    return some.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col(rank) <= n)


# vocabulary entries (cluster, term, idf) that may be broadcast to the tasks
VOCAB_ROWS = 1 << 20


def cluster_tfidf(docs: DataFrame, cluster: str = "cluster_id", doc: str = "doc_id", text: str = "text",
                  stop_words: Sequence[str] = (), min_df: int = 1, max_df: float | None = None,
                  max_features: int | None = None, top_k: int = 10, min_docs: int = 1,
                  vocab_rows: int | None = None) -> DataFrame:
    """M3: top-k terms per cluster by mean TF-IDF.

    Returns (cluster, rank, term, score) for every cluster that has at least
    ``min_docs`` documents and a non-empty vocabulary after the filters. The rows
    are written to the checkpoint folder, at most ``top_k`` a cluster.
    """
    spark, most = docs.sparkSession, VOCAB_ROWS if vocab_rows is None else vocab_rows
    path = scratch_path(spark, "tfidf-words")
    write_rows(docs.select(F.col(cluster).alias("c"), F.col(doc).alias("d"), spaced_words(F.col(text)).alias("t")), path)
    docs = spark.read.parquet(path)
    sizes = cut_lineage(docs.groupBy("c").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs))

    singles = cut_lineage(_word_counts(docs, stop_words).filter(F.col("df") >= min_df).join(sizes, "c"))
    words = _pair_words(singles, max_df, max_features)
    able = words.select("c", "term", "least")
    able = able.limit(most + 1).toArrow() if able.limit(most + 1).count() <= most else None
    if able is None:
        vectors = doc_vectors(docs, "c", "d", "t", stop_words)
        long = vectors.select("c", F.explode(F.arrays_zip("terms", "counts")).alias("_x"))
        stats = long.groupBy("c", F.col("_x.terms").alias("term")).agg(F.count(F.lit(1)).alias("df"), F.sum(F.col("_x.counts").cast("bigint")).alias("cf"))
        stats = stats.filter(F.col("df") >= min_df).join(sizes, "c")
    else:
        stats = words.drop("least").unionByName(_pair_counts(docs, able, stop_words, min_df).join(sizes, "c"))
    vocab = _within(stats, max_df)
    if max_features is not None:
        vocab = top_per_group(vocab, "c", [F.col("cf").desc(), F.col("term").asc()], max_features, F.col("term"))
    idf = F.log((F.lit(1.0) + F.col("n")) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    vocab = cut_lineage(vocab.select("c", "term", "n", idf.alias("idf")))

    rows = vocab.limit(most + 1).toArrow() if vocab.limit(most + 1).count() <= most else None
    sums = _sums_by_join(doc_vectors(docs, "c", "d", "t", stop_words), vocab) if rows is None else _sums_in_tasks(docs, rows, stop_words)
    n = vocab.groupBy("c").agg(F.max("n").alias("n"))
    scored = sums.groupBy("c", "term").agg(F.sum("part").alias("s")).join(n, "c").withColumn("score", F.col("s") / F.col("n"))
    order = [F.round("score", 12).desc(), F.col("term").desc()]
    top = top_per_group(scored.select("c", "term", "score"), "c", order, top_k, F.col("term"), "rank")
    return cut_lineage(top.select(F.col("c").alias(cluster), F.col("rank").cast("int").alias("rank"), "term", "score"))


def spaced_words(text: Column) -> Column:
    """The lower-cased text with a space for whatever stands between words (of one character, too)."""
    return F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}_]+", " ")


def _within(stats: DataFrame, max_df: float | None) -> DataFrame:
    return stats if max_df is None else stats.filter(F.col("df") <= F.lit(max_df) * F.col("n"))


def _coded_words(texts: pa.Array, stop_words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row, word, dictionary) of the words of spaced texts in their order, without stop words."""
    lists = pc.split_pattern(texts, " ")
    row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False))
    coded = pc.dictionary_encode(lists.flatten())
    words = coded.dictionary
    keep = pc.and_(pc.greater_equal(pc.utf8_length(words), 2), pc.invert(pc.is_in(words, pa.array(list(stop_words), pa.string()))))
    word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ok = keep.to_numpy(zero_copy_only=False)[word]
    return row[ok], word[ok], words


def _counts(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, rows that hold each, places of each)."""
    names, at = np.unique(key, return_inverse=True)
    held, tf = np.unique(row * max(1, len(names)) + at, return_counts=True)
    at = held % max(1, len(names))
    return names, np.bincount(at, minlength=len(names)), np.bincount(at, weights=tf, minlength=len(names)).astype(np.int64)


# rows of counts that a task keeps before it adds them up and hands them on
KEPT_COUNTS = 1 << 20


def _added_up(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The counts df and cf of a task, those of equal keys added up; handed on whenever they fill ``KEPT_COUNTS`` rows."""
    kept, rows = [], 0
    for batch in batches:
        kept.append(batch)
        rows += batch.num_rows
        if rows > 2 * KEPT_COUNTS:
            table = _sum_counts(kept, keys)
            kept, rows = [], table.num_rows
            if rows > KEPT_COUNTS:
                yield from table.to_batches(1 << 16)
                rows = 0
            else:
                kept = table.to_batches()
    if kept:
        yield from _sum_counts(kept, keys).to_batches(1 << 16)


def _sum_counts(batches: list[pa.RecordBatch], keys: list[str]) -> pa.Table:
    table = pa.Table.from_batches(batches).group_by(keys, use_threads=False).aggregate([("df", "sum"), ("cf", "sum")])
    return table.select([*keys, "df_sum", "cf_sum"]).rename_columns([*keys, "df", "cf"])


def _word_counts(docs: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    """(c, term, df, cf) of single words; a task counts batch by batch and adds the counts up."""
    kind = docs.schema["c"].dataType.simpleString()

    def count(batches):
        for batch in batches:
            row, word, words = _coded_words(batch.column("t"), stop_words)
            groups = pc.dictionary_encode(batch.column("c"))
            group = groups.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)[row]
            mine = group >= 0
            key, df, cf = _counts(row[mine], group[mine] * len(words) + word[mine])
            if len(key):
                yield pa.RecordBatch.from_arrays([groups.dictionary.take(pa.array(key // len(words))), words.take(pa.array(key % len(words))), pa.array(df), pa.array(cf)], names=["c", "term", "df", "cf"])

    run = lambda batches: _added_up(count(batches), ["c", "term"])
    return docs.select("c", "t").mapInArrow(run, f"c {kind}, term string, df bigint, cf bigint").groupBy("c", "term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def _pair_words(singles: DataFrame, max_df: float | None, max_features: int | None) -> DataFrame:
    """The words (c, term, df, cf, n, least) that, or whose pairs, can be in the vocabulary. A pair stands in no more documents and
    places than either of its words, so where single words alone fill the vocabulary, their last count is the ``least``
    for words and pairs; none that reaches it, or equals it, is left out."""
    if max_features is None:
        return singles.withColumn("least", F.lit(0).cast("bigint"))
    top = top_per_group(_within(singles, max_df), "c", [F.col("cf").desc(), F.col("term").asc()], max_features, F.col("term"))
    full = top.groupBy("c").agg(F.count(F.lit(1)).alias("_m"), F.min("cf").alias("_low")).select(
        "c", F.when(F.col("_m") >= max_features, F.col("_low")).otherwise(F.lit(0)).alias("least"))
    return cut_lineage(singles.join(full, "c", "left").withColumn("least", F.coalesce("least", F.lit(0)))
                       .filter(F.col("cf") >= F.col("least")))


class _Places:
    """Places of (cluster, word) in a table: words and clusters by number, sorted keys."""

    def __init__(self, c, term):
        self.words = pc.unique(term) if len(term) else pa.array([], pa.string())
        self.clusters = pc.unique(c)
        key = pc.index_in(c, self.clusters).to_numpy(zero_copy_only=False).astype(np.int64) * max(1, len(self.words)) + pc.index_in(term, self.words).to_numpy(zero_copy_only=False)
        self.order = np.argsort(key)
        self.key = key[self.order]

    def codes(self, clusters: pa.Array, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of a batch's clusters and words, -1 for others."""
        number = lambda x, of: pc.index_in(x, of).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        return number(clusters, self.clusters), number(words, self.words)

    def find(self, group: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The place of each (cluster, word) among the sorted keys, -1 if it isn't there."""
        return _found(self.key, np.where((group >= 0) & (word >= 0), group * max(1, len(self.words)) + word, -1))


def _found(keys: np.ndarray, key: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.full(len(key), -1)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return np.where(keys[at] == key, at, -1)


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _pair_counts(docs: DataFrame, able: pa.Table, stop_words: Sequence[str], min_df: int) -> DataFrame:
    """(c, term, df, cf) of neighbouring words that are both in ``able``. A pair is shuffled as one number, made of
    its words' places in the table; the words are put in after the filters."""
    c, term, least = (_one(able[x]) for x in ("c", "term", "least"))
    places = _Places(c, term)
    held = docs.sparkSession.sparkContext.broadcast((places, places.clusters.take(pa.array(places.key // max(1, len(places.words)))) if len(places.key) else c,
                                                     term.take(pa.array(places.order)), least.to_numpy()[places.order]))
    kind = docs.schema["c"].dataType.simpleString()

    def count(batches):
        places, size = held.value[0], len(held.value[0].key)
        for batch in batches:
            row, word, words = _coded_words(batch.column("t"), stop_words)
            group, number = places.codes(batch.column("c"), words)
            at = places.find(group[row], number[word])
            pair = np.flatnonzero((at[:-1] >= 0) & (at[1:] >= 0) & (row[:-1] == row[1:]))
            key, df, cf = _counts(row[pair], at[pair] * size + at[pair + 1])
            if len(key):
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(df), pa.array(cf)], names=["pair", "df", "cf"])

    def spell(batches):
        _, clusters, terms, least = held.value
        for batch in batches:
            key, cf = batch.column("pair").to_numpy(), batch.column("cf")
            a, b = key // max(1, len(least)), key % max(1, len(least))
            ok = cf.to_numpy() >= least[a] if len(key) else np.zeros(0, bool)
            a, b, ok = pa.array(a[ok]), pa.array(b[ok]), pa.array(ok)
            yield pa.RecordBatch.from_arrays([clusters.take(a), pc.binary_join_element_wise(terms.take(a), terms.take(b), " "), batch.column("df").filter(ok), cf.filter(ok)], names=["c", "term", "df", "cf"])

    run = lambda batches: _added_up(count(batches), ["pair"])
    pairs = docs.select("c", "t").mapInArrow(run, "pair bigint, df bigint, cf bigint").groupBy("pair").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    return pairs.filter(F.col("df") >= min_df).mapInArrow(spell, f"c {kind}, term string, df bigint, cf bigint")


def _sums_by_join(vectors: DataFrame, vocab: DataFrame) -> DataFrame:
    """(c, term, part): w/‖doc‖ of each document and vocabulary term, by a shuffle on (c, term)."""
    long = vectors.select("c", "d", F.explode(F.arrays_zip("terms", "counts")).alias("_x")).select("c", "d", F.col("_x.terms").alias("term"), F.col("_x.counts").alias("tf"))
    wt = long.join(vocab, ["c", "term"]).select("c", "d", "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("c", "d")))
    return wt.withColumn("norm", norm).select("c", "term", (F.col("w") / F.col("norm")).alias("part"))


def _sums_in_tasks(docs: DataFrame, vocab: pa.Table, stop_words: Sequence[str]) -> DataFrame:
    """(c, term, part): sums of w/‖doc‖ of each task's documents. A vocabulary term is its place in the table,
    found by the numbers of its cluster and of its one or two words."""
    c, term, idf = _one(vocab["c"]), _one(vocab["term"]), vocab["idf"].to_numpy()
    parts = pc.split_pattern(term, " ")
    first, second = pc.list_element(parts, 0), pc.fill_null(pc.list_slice(parts, 1, 2, return_fixed_size_list=False).cast(pa.list_(pa.string())), pa.scalar([], pa.list_(pa.string())))
    two = pc.list_value_length(second).to_numpy(zero_copy_only=False) > 0
    words = pc.unique(pa.chunked_array([first, second.flatten()])) if len(term) else pa.array([], pa.string())
    clusters = pc.unique(c)
    w, number = max(1, len(words)), lambda x, of: pc.index_in(x, of).to_numpy(zero_copy_only=False).astype(np.int64)
    single = number(c, clusters) * w + number(first, words)
    # a pair's key lies beyond all words' keys: (key of its first word + 1) * w + its second word
    key = single + 0
    key[two] = len(clusters) * w + single[two] * w + number(second.flatten(), words)
    order = np.argsort(key)
    held = docs.sparkSession.sparkContext.broadcast((words, clusters, key[order], idf[order], c.take(pa.array(order)), term.take(pa.array(order))))
    schema = f"c {docs.schema['c'].dataType.simpleString()}, term string, part double"

    def run(batches):
        words, clusters, keys, idf, c, term = held.value
        w, sums = max(1, len(words)), np.zeros(len(keys))
        code = lambda x, of: pc.index_in(x, of).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        for batch in batches:
            row, word, seen = _coded_words(batch.column("t"), stop_words)
            group, word = code(batch.column("c"), clusters)[row], code(seen, words)[word]
            one = np.where((group >= 0) & (word >= 0), group * w + word, -1)
            pair = np.flatnonzero((one[:-1] >= 0) & (word[1:] >= 0) & (row[:-1] == row[1:]))
            place = np.concatenate((_found(keys, one), _found(keys, len(clusters) * w + one[pair] * w + word[pair + 1])))
            of = np.concatenate((row, row[pair]))
            ok = place >= 0
            if not ok.any():
                continue
            at, tf = np.unique(of[ok] * len(keys) + place[ok], return_counts=True)
            of, place = at // len(keys), at % len(keys)
            x = tf * idf[place]
            norm = np.sqrt(np.bincount(of, weights=x * x))
            sums += np.bincount(place, weights=x / norm[of], minlength=len(keys))
        got = pa.array(np.flatnonzero(sums))
        if len(got):
            yield pa.RecordBatch.from_arrays([c.take(got), term.take(got), pa.array(sums[got.to_numpy()])], names=["c", "term", "part"])

    return docs.select("c", "t").mapInArrow(run, schema)


def inspect_keywords(clustered: DataFrame, top_k: int = 10, include_noise: bool = False) -> DataFrame:
    """M3a profile: n ≥ 20 docs, df ≥ 5, df ≤ 0.8·n, 8,000 features, top 10; noise
    excluded unless ``include_noise`` (then −1 is profiled like any cluster)."""
    docs = clustered if include_noise else clustered.filter(F.col("cluster_id") != -1)
    return cluster_tfidf(docs, stop_words=INSPECT_STOPWORDS, min_df=5, max_df=0.8, max_features=8000,
                         top_k=top_k, min_docs=20)


def tag_keywords(clustered: DataFrame, top_k: int = 3, text_col: str = "text") -> DataFrame:
    """M3b profile + F13: (cluster_id, keyword) — top-3 joined by '_',
    ``TOPIC_<id>`` when the vocabulary is empty, ``NO_TOPIC`` for noise."""
    from quire.functions.text import py_strip

    docs = clustered.select("cluster_id", "doc_id", py_strip(F.col(text_col)).alias("text"))
    real = docs.filter(F.col("cluster_id") != -1)
    top = cluster_tfidf(real, stop_words=TAG_STOPWORDS, min_df=2, max_features=100, top_k=top_k)
    joined = top.groupBy("cluster_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda s: s["term"]), "_")
        .alias("kw"))
    ids = docs.select("cluster_id").distinct()
    kw = (F.when(F.col("cluster_id") == -1, F.lit(NO_TOPIC))
          .when(F.col("kw").isNotNull() & (F.col("kw") != ""), F.col("kw"))
          .otherwise(F.concat(F.lit("TOPIC_"), F.col("cluster_id").cast("string"))))
    return ids.join(joined, "cluster_id", "left").select("cluster_id", kw.alias("keyword"))
