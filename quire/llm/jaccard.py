"""N-gram Jaccard join with Bayesian pruning of candidate pairs.

A document is the set of its runs of five words (``common`` has the word
model; a text of one to four words is one run). Links are pairs of different
sets with Jaccard similarity of at least ``THRESHOLD``.

1. Documents with equal sets form a text class (fingerprint, smallest id);
   only one of each goes on, so exact copies are never paired with each other.
2. MinHash signatures are cut into bands. All texts that share a band's bucket
   are sent to the group of the bucket's smallest text, its pivot; a text is in
   a group once, however many buckets lead there.
3. A group is dealt into chunks of bounded count and bytes, and each pair of
   chunks is a task of its own. In it MinHash values are compared ``STEP`` at
   a time; a pair is dropped when the posterior probability that its
   similarity reaches the threshold falls below ``TOLERANCE``. Every other
   pair is verified exactly on the sets. A pair that meets in several groups
   counts in that of the smallest common pivot.
4. A task returns one row for each of its texts: how many links it has there,
   and the smallest text that it is tied to. Rows grow with the texts, not
   with their pairs.

Steps 2 and 3 can lose links: of pairs at exactly 0.8, 7.3e-5 share no band and
up to 5.3e-5 more are pruned; of closer pairs fewer.

Defined results: null or empty texts, and texts without a word, have no links
and are a class of their own; repeated rows are exact copies of each other; a
null id stands for no document (its row is returned with null class); an empty
table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import bloom, in_bloom, mix64, only, row_slices, saved, text_buffer, word_table
from quire.operators.cluster import connected_components

N = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
HASHES = BANDS * ROWS
STEP = 24             # MinHash values compared at a time
TOLERANCE = 1e-5      # posterior probability below which a pair is dropped
CHUNK_TEXTS, CHUNK_BYTES = 512, 16 << 20
PIECE = 1 << 18       # shingles hashed at once

_C = np.uint64(0x9E3779B97F4A7C15)
_MULT = np.random.default_rng(8).integers(1, 1 << 63, size=HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array, n: int = N) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of n words."""
    raw, offs = text_buffer(texts)
    h, first = word_table(raw, offs)
    size = np.diff(first)
    runs = h[:max(0, len(h) - n + 1)].copy()
    for k in range(1, n):
        runs = mix64(runs * _C + h[k:len(runs) + k])
    out = []
    for r in range(len(size)):
        a, m = int(first[r]), int(size[r])
        if m >= n:
            out.append(np.unique(runs[a:a + m - n + 1]))
        elif m:
            s = np.array([m], np.uint64)
            for x in h[a:a + m]:
                s = mix64(s * _C + x)
            out.append(s)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit hashes of a set."""
    a = mix64(s + np.uint64(len(s))).sum(dtype=np.uint64)
    b = mix64(s ^ _C).sum(dtype=np.uint64)
    x = mix64(np.array([a, b], np.uint64)).view(np.int64)
    return int(x[0]), int(x[1])


def minhash(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES 16-bit values for each set (empty sets: zeros)."""
    out = np.zeros((len(sets), HASHES), np.uint16)
    at = [i for i, s in enumerate(sets) if len(s)]
    lo = 0
    while lo < len(at):
        hi, total = lo, 0
        while hi < len(at) and (hi == lo or total + len(sets[at[hi]]) <= PIECE):
            total += len(sets[at[hi]])
            hi += 1
        part = [sets[i] for i in at[lo:hi]]
        flat = np.concatenate(part)
        firsts = np.concatenate(([0], np.cumsum([len(s) for s in part])[:-1]))
        for k in range(HASHES):
            low = np.minimum.reduceat((flat * _MULT[k]) >> np.uint64(24), firsts)
            out[at[lo:hi], k] = low.astype(np.uint16)
        lo = hi
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, f1, f2, n, sig): fingerprint, number of runs, MinHash values of each row."""
    src = only(docs, id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "text"):
                sets = shingle_sets(part.column("text"))
                prints = [fingerprint(s) for s in sets]
                sig = minhash(sets)
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array([x.tobytes() for x in sig], pa.binary())], names=["id", "f1", "f2", "n", "sig"])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, f1 long, f2 long, n long, sig binary")


def buckets(reps: DataFrame) -> DataFrame:
    """(bucket, f1): the BANDS buckets of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(-1, HASHES).astype(np.uint64)
            keys = np.empty((len(sig), BANDS), np.uint64)
            for b in range(BANDS):
                k = np.full(len(sig), b + 1, np.uint64)
                for c in range(b * ROWS, (b + 1) * ROWS):
                    k = mix64(k * _C + sig[:, c])
                keys[:, b] = k
            f1 = np.repeat(batch.column("f1").to_numpy(zero_copy_only=False), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(f1)], names=["bucket", "f1"])

    return reps.select("f1", "sig").mapInArrow(run, "bucket long, f1 long")


def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """For n compared values the fewest matches with which a pair stays.

    With a uniform prior the similarity given m of n matches is
    Beta(m + 1, n - m + 1); its mass above x is P(Binomial(n + 1, x) <= m).
    """
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        mass, m = 0.0, -1
        while mass < tolerance and m < n:
            m += 1
            mass += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def survivors(a: np.ndarray, b: np.ndarray, same: bool, least: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs left by the incremental comparison of two blocks of signatures."""
    got = np.zeros((len(a), len(b)), np.int16)
    for k in range(STEP):
        got += a[:, k][:, None] == b[:, k][None, :]
    keep = got >= least[STEP]
    if same:
        keep = np.triu(keep, 1)
    i, j = np.nonzero(keep)
    m = got[i, j]
    for n in range(2 * STEP, HASHES + 1, STEP):
        for lo in range(0, len(i), 1 << 16):
            s = slice(lo, lo + (1 << 16))
            m[s] += (a[i[s], n - STEP:n] == b[j[s], n - STEP:n]).sum(1, dtype=np.int16)
        ok = m >= least[n]
        i, j, m = i[ok], j[ok], m[ok]
    return i, j


def common_sizes(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections sets[i] & sets[j]."""
    if len(i) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(i, j)], np.int64)
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1]))
    col = np.cumsum(new) - 1
    often = np.bincount(col)[col] > 1   # what one set alone has is in no intersection
    row, col = row[often], np.unique(col[often], return_inverse=True)[1]
    total = np.zeros((len(sets), len(sets)), np.float32)
    width, n = 4096, int(col[-1]) + 1 if len(col) else 0
    for lo in range(0, n, width):
        a, b = np.searchsorted(col, [lo, lo + width])
        part = np.zeros((len(sets), min(width, n - lo)), np.float32)
        part[row[a:b], col[a:b] - lo] = 1
        total += part @ part.T
    return total[i, j].astype(np.int64)


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node of its component."""
    up = np.arange(n)
    while True:
        low = np.minimum(up[i], up[j])
        old = up.copy()
        np.minimum.at(up, i, low)
        np.minimum.at(up, j, low)
        up = up[up]
        if (up == old).all():
            return up


def linked(members: DataFrame, threshold: float, tolerance: float, pairs: bool) -> DataFrame:
    """Verified links of each task's texts: (rep, links, leader), or the pairs themselves."""
    least = least_matches(threshold, tolerance)
    rep_type = members.schema["rep"].dataType

    def run(t: pa.Table) -> pa.Table:
        # chunk 0 first, then by text, so that the smallest index is the smallest text
        t = t.sort_by([("rep", "ascending"), ("f1", "ascending")])
        f1 = t["f1"].to_numpy()
        t = t.filter(pa.array(np.concatenate(([True], f1[1:] != f1[:-1])) if len(f1) else np.zeros(0, bool)))
        f1, side = t["f1"].to_numpy(), t["side"].to_numpy()
        reps = t["rep"].to_pylist()
        pivot = int(t["pivot"][0].as_py())
        sig = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint16).reshape(-1, HASHES)
        sets = [np.frombuffer(x, np.uint64) for x in t["runs"].to_pylist()]
        both = t["ci"][0].as_py() == t["cj"][0].as_py()
        left = np.arange(len(f1)) if both else np.flatnonzero(side == 0)
        right = left if both else np.flatnonzero(side == 1)
        i, j = survivors(sig[left], sig[right], both, least)
        i, j = left[i], right[j]
        size = np.array([len(s) for s in sets], np.int64)
        both_have = common_sizes(sets, i, j)
        union = size[i] + size[j] - both_have
        ok = both_have >= threshold * union - 1e-9
        i, j, both_have, union = i[ok], j[ok], both_have[ok], union[ok]
        # counted where the pivot is the smallest that both texts have
        lower = [[p for p in ps if p < pivot] for ps in t["pivots"].to_pylist()]
        names = {p: k for k, p in enumerate(sorted({p for ps in lower for p in ps}))}
        here = np.ones(len(i), bool)
        if names:
            m = np.zeros((len(f1), len(names)), bool)
            for r, ps in enumerate(lower):
                m[r, [names[p] for p in ps]] = True
            for lo in range(0, len(i), 1 << 14):
                s = slice(lo, lo + (1 << 14))
                here[s] = ~(m[i[s]] & m[j[s]]).any(1)
        if pairs:
            i, j, both_have, union = i[here], j[here], both_have[here], union[here]
            return pa.table({"a": pa.array([reps[x] for x in i], t["rep"].type), "b": pa.array([reps[x] for x in j], t["rep"].type),
                             "similarity": pa.array(both_have / np.maximum(union, 1), pa.float64())})
        count = np.bincount(np.concatenate((i[here], j[here])), minlength=len(f1))
        up = roots(len(f1), i, j)
        tied = np.zeros(len(f1), bool)
        tied[i] = tied[j] = True
        at = np.flatnonzero(tied)
        return pa.table({"f1": pa.array(f1[at]), "rep": pa.array([reps[x] for x in at], t["rep"].type), "links": pa.array(count[at], pa.int64()),
                         "leader": pa.array([reps[up[x]] for x in at], t["rep"].type)})

    kind = rep_type.simpleString()
    schema = f"a {kind}, b {kind}, similarity double" if pairs else f"f1 long, rep {kind}, links long, leader {kind}"
    return members.groupBy("pivot", "ci", "cj").applyInArrow(run, schema)


def _members(docs: DataFrame, sigs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of the pairwise tasks: each text of a group once for each chunk that its chunk meets."""
    reps = saved(sigs.filter("n > 0 and id is not null").groupBy("f1", "f2").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig")), "reps")
    places = saved(buckets(reps), "buckets")
    shared = places.groupBy("bucket").agg(F.min("f1").alias("pivot"), F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("bucket", "pivot")
    meets = places.join(shared, "bucket").groupBy("f1").agg(F.collect_set("pivot").alias("pivots"))  # BANDS at most
    meets = saved(meets.join(reps, "f1").select("f1", "rep", "n", "sig", "pivots"), "meets")
    groups = (meets.select(F.explode("pivots").alias("pivot"), "n").groupBy("pivot").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("runs"))
              .select("pivot", F.greatest(F.ceil(F.col("texts") / CHUNK_TEXTS), F.ceil(F.col("runs") * 8 / CHUNK_BYTES)).cast("int").alias("chunks")))
    # where each text goes, without its set
    tasks = (meets.select("f1", F.explode("pivots").alias("pivot")).join(groups, "pivot").withColumn("mine", F.pmod(F.xxhash64("f1"), F.col("chunks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("f1", F.struct("pivot", F.least("mine", "other").alias("ci"), F.greatest("mine", "other").alias("cj"), (F.col("mine") > F.col("other")).cast("int").alias("side")).alias("task")))

    # the sets of those texts only: a filter of their ids leaves few others, which the join drops
    wanted = docs.sparkSession.sparkContext.broadcast(bloom(meets.select(F.xxhash64("rep").alias("h")), "h", meets.count()))
    src = only(docs, rep=id_col, text=text_col).select("rep", "text", F.xxhash64("rep").alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(in_bloom(wanted.value, batch.column("h").to_numpy(zero_copy_only=False))))
            for part in row_slices(batch, "text"):
                sets = shingle_sets(part.column("text"))
                yield pa.RecordBatch.from_arrays([pa.array([fingerprint(s)[0] for s in sets], pa.int64()), part.column("rep"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["f1", "rep", "runs"])

    sets = src.mapInArrow(run, f"f1 long, rep {src.schema['rep'].dataType.simpleString()}, runs binary")
    return meets.join(sets, ["f1", "rep"]).join(tasks, "f1").select("task.*", "f1", "rep", "pivots", "sig", "runs")


def pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """(a, b, similarity): the links between the smallest ids of different texts."""
    sigs = saved(signatures(docs, id_col, text_col), "signatures")
    return linked(_members(docs, sigs, id_col, text_col), threshold, tolerance, True)


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: its id, ``class_id`` (smallest id of all documents tied
    to it by links or copies), ``n_links`` (other texts within the threshold of its
    own) and ``n_copies`` (documents with its very set, itself included)."""
    sigs = saved(signatures(docs, id_col, text_col), "signatures")
    found = saved(linked(_members(docs, sigs, id_col, text_col), threshold, tolerance, False), "links")
    links = found.groupBy("f1").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("rep").alias("src"), F.col("leader").alias("dst")))
    classes = (sigs.filter("n > 0").groupBy("f1", "f2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
               .join(links, "f1", "left").join(parts.select(F.col("node").alias("rep"), "component"), "rep", "left")
               .select("f1", "f2", F.coalesce("component", "rep").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"), "copies"))
    with_words = sigs.filter("n > 0").select("id", "f1", "f2").join(classes, ["f1", "f2"]).select(
        F.col("id").alias(id_col), F.when(F.col("id").isNotNull(), F.col("class_id")).alias("class_id"), F.col("links").alias("n_links"), F.col("copies").alias("n_copies"))
    wordless = sigs.filter("n = 0").select(F.col("id").alias(id_col), F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies"))
    return with_words.unionByName(wordless)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class (that of the smallest id), with all its columns;
    documents without an id stay."""
    kept = join(docs, id_col, text_col).filter(F.col(id_col) == F.col("class_id")).select(F.col(id_col).alias("kept_id")).distinct()
    firsts = docs.join(kept, docs[id_col] == kept["kept_id"], "left_semi")
    return firsts.dropDuplicates([id_col, text_col]).unionByName(docs.filter(docs[id_col].isNull()))
