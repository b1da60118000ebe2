"""Toxicity: cumulative-link ordinal regression on sparse text features.

Grades run from 0 (clean) to ``GRADES`` - 1. All thresholds share one weight
vector: P(grade <= k) = 1 / (1 + exp(w.x - t_k)), with t_0 < t_1 < ...; x holds
log(1 + count) of each marker feature of the whole text. Features are words and
the first four bytes of words; markers are those that occur in toxic documents
significantly more often than in clean ones.

The labels only say toxic or not. A toxic document's grade is its dose: the
number of markers it holds, cut at the terciles of all labelled toxic ones.

The model is fitted on a bounded sample of labelled documents (``SAMPLE_TOXIC``
and ``SAMPLE_CLEAN`` rows, smallest hash of the id first, one of each group of
near copies); counts of features are distributed, the fit itself sees only the
sample's marker counts. Scoring reads every whole text.

Defined results: null or empty text has no markers; null labels and labels of
absent documents count for nothing; of several labels of one document the
highest counts; without both kinds of labels no marker exists and every
document is clean; repeated rows give repeated results; other columns are kept
or not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import only, row_slices, saved, text_buffer, word_table
from quire.llm.jaccard import minhash, shingle_sets

GRADES = 4
SAMPLE_TOXIC, SAMPLE_CLEAN = 4096, 8192
HEAD = 4              # bytes of a word that make its stem feature
LEAST_SEEN = 2        # toxic sample documents that a marker needs
LEAST_Z = 3.5         # standard errors between its rates
LEAST_LIFT = 4.0      # times that its rate in toxic documents is that in clean ones
MARKERS = 50_000      # most markers kept, strongest first
SHRINK, STEPS = 1e-3, 300


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Signed feature hashes of all words and stems, and the row of each."""
    raw, offs = text_buffer(texts)
    out, rows = [], []
    for head in (0, HEAD):
        h, first = word_table(raw, offs, head)
        out.append(h ^ np.uint64(head))
        rows.append(np.repeat(np.arange(len(offs) - 1), np.diff(first)))
    return np.concatenate(out).view(np.int64), np.concatenate(rows)


@dataclass
class Ordinal:
    """Marker hashes (sorted) with their weights, and the thresholds."""

    markers: np.ndarray
    weights: np.ndarray
    cuts: np.ndarray

    def grades(self, scores: np.ndarray) -> np.ndarray:
        """P(grade = k) for each score, one row per document."""
        below = 1 / (1 + np.exp(np.clip(scores[:, None] - self.cuts[None, :], -60, 60)))
        return np.diff(np.concatenate((np.zeros((len(scores), 1)), below, np.ones((len(scores), 1))), axis=1), axis=1)

    def scores(self, texts: pa.Array) -> np.ndarray:
        f, row = features(texts)
        out = np.zeros(len(texts))
        if len(self.markers) and len(f):
            at = np.searchsorted(self.markers, f)
            at[at == len(self.markers)] = 0
            hit = self.markers[at] == f
            key, count = np.unique(row[hit].astype(np.int64) * len(self.markers) + at[hit], return_counts=True)
            np.add.at(out, key // len(self.markers), self.weights[key % len(self.markers)] * np.log1p(count))
        return out


def fit_ordinal(starts: np.ndarray, ids: np.ndarray, values: np.ndarray, grade: np.ndarray, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by penalised maximum likelihood (Adam on all rows).

    Row r has the features ids[starts[r]:starts[r + 1]].
    """
    rows = np.repeat(np.arange(len(grade)), np.diff(starts))
    w = np.zeros(n_features)
    # thresholds as a first value and the logs of the gaps, so they stay ordered
    t = np.concatenate(([1.0], np.zeros(GRADES - 2)))
    balance = np.where(grade > 0, 0.5 / max(1, (grade > 0).sum()), 0.5 / max(1, (grade == 0).sum()))
    mw, vw, mt, vt = np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    for step in range(1, STEPS + 1):
        gaps = np.exp(t[1:])
        cuts = np.concatenate(([t[0]], t[0] + np.cumsum(gaps)))
        eta = np.bincount(rows, weights=w[ids] * values, minlength=len(grade))
        edge = np.concatenate(([-60.0], cuts, [60.0]))
        up, low = edge[grade + 1] - eta, edge[grade] - eta
        hi = np.where(grade == GRADES - 1, 1.0, sig(up))
        lo = np.where(grade == 0, 0.0, sig(low))
        p = np.maximum(hi - lo, 1e-12)
        dhi = np.where(grade == GRADES - 1, 0.0, hi * (1 - hi)) / p * balance
        dlo = np.where(grade == 0, 0.0, lo * (1 - lo)) / p * balance
        g = dlo - dhi                                   # d log-likelihood / d eta
        gw = np.bincount(ids, weights=g[rows] * values, minlength=n_features) - SHRINK * w / max(1, n_features) * 10
        gc = np.bincount(np.where(grade < GRADES - 1, grade, 0), weights=dhi, minlength=GRADES - 1) - np.bincount(np.maximum(grade - 1, 0), weights=dlo, minlength=GRADES - 1)[:GRADES - 1]
        gt = np.concatenate(([gc.sum()], np.cumsum(gc[::-1])[::-1][1:] * gaps))
        for x, m, v, d in ((w, mw, vw, gw), (t, mt, vt, gt)):
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            x += 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return w, np.concatenate(([t[0]], t[0] + np.cumsum(np.exp(t[1:]))))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Ordinal:
    """The model, from documents and their labels (0 or 1)."""
    none = Ordinal(np.zeros(0, np.int64), np.zeros(0), np.arange(1.0, GRADES))
    known = (only(labels, id=id_col, toxic=label_col).filter("id is not null and toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic")))
    order = [F.xxhash64("id"), F.col("id")]
    chosen = (known.filter("toxic > 0").orderBy(*order).limit(SAMPLE_TOXIC).unionByName(known.filter("toxic <= 0").orderBy(*order).limit(SAMPLE_CLEAN))
              .select("id", (F.col("toxic") > 0).alias("toxic")))
    # the sample's size is fixed by the two limits
    sample = only(docs, id=id_col, text=text_col).join(F.broadcast(chosen), "id").select("id", "text", "toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "text"):
                near = minhash(shingle_sets(part.column("text")))[:, :4].astype(np.int64) @ np.array([1, 1 << 16, 1 << 32, 1 << 47])
                f, row = features(part.column("text"))
                key = np.lexsort((f, row))
                f, row = f[key], row[key]
                new = np.flatnonzero(np.concatenate(([True], (f[1:] != f[:-1]) | (row[1:] != row[:-1])))) if len(f) else np.zeros(0, np.int64)
                count = np.diff(np.append(new, len(f)))
                cut = np.searchsorted(row[new], np.arange(part.num_rows + 1))
                offsets = pa.array(cut, pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("toxic"), pa.array(near), pa.ListArray.from_arrays(offsets, pa.array(f[new])), pa.ListArray.from_arrays(offsets, pa.array(count, pa.int64()))],
                                                 names=["id", "toxic", "near", "f", "n"])

    kind = sample.schema["id"].dataType.simpleString()
    rows = saved(sample.mapInArrow(run, f"id {kind}, toxic boolean, near long, f array<long>, n array<long>"), "toxic-sample")
    firsts = rows.groupBy("near", "toxic").agg(F.min("id").alias("id"))
    rows = rows.join(F.broadcast(firsts), ["near", "toxic", "id"], "left_semi").dropDuplicates(["id"])
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return none
    pos, neg = sizes[True], sizes[False]
    seen = rows.select("toxic", F.explode("f").alias("f")).groupBy("f").agg(F.sum(F.col("toxic").cast("long")).alias("a"), F.sum((~F.col("toxic")).cast("long")).alias("b"))
    rate = (F.col("a") + F.col("b")) / F.lit(pos + neg)
    z = (F.col("a") / pos - F.col("b") / neg) / F.sqrt(rate * (1 - rate) * (1 / pos + 1 / neg) + 1e-12)
    best = seen.withColumn("z", z).filter((F.col("a") >= LEAST_SEEN) & (F.col("z") >= LEAST_Z) & (F.col("a") / pos >= LEAST_LIFT * F.col("b") / neg)).orderBy(F.desc("z"), "f").limit(MARKERS).select("f").collect()
    markers = np.sort(np.array([r["f"] for r in best], np.int64))
    if not len(markers):
        return none
    chosen_f = F.broadcast(docs.sparkSession.createDataFrame([(int(x), k) for k, x in enumerate(markers)], "f long, k int"))
    held = (rows.select("id", F.explode(F.arrays_zip("f", "n")).alias("x")).select("id", "x.f", "x.n").join(chosen_f, "f")
            .groupBy("id").agg(F.collect_list(F.struct("k", "n")).alias("held")))  # at most MARKERS of a document
    data = rows.select("id", "toxic").join(held, "id", "left").orderBy("id").collect()
    doses = [sum(x["n"] for x in r["held"] or []) for r in data]
    toxic = np.array([r["toxic"] for r in data])
    steps = np.quantile([d for d, y in zip(doses, toxic) if y], np.arange(1, GRADES - 1) / (GRADES - 1))
    grade = np.where(toxic, 1 + np.searchsorted(steps, doses, side="left"), 0).astype(np.int64)
    ids = np.array([x["k"] for r in data for x in r["held"] or []], np.int64)
    values = np.log1p(np.array([x["n"] for r in data for x in r["held"] or []], float))
    starts = np.concatenate(([0], np.cumsum([len(r["held"] or []) for r in data])))
    w, cuts = fit_ordinal(starts, ids, values, grade, len(markers))
    return Ordinal(markers, w, cuts)


def score(docs: DataFrame, model: Ordinal, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: grade (most probable), expected severity, probability
    of any toxicity, and whether that is one half or more."""
    src = only(docs, id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "text"):
                p = model.grades(model.scores(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(p.argmax(1).astype(np.int32)), pa.array(p @ np.arange(GRADES)), pa.array(1 - p[:, 0]), pa.array(p[:, 0] <= 0.5)],
                                                 names=[id_col, "grade", "severity", "p_toxic", "toxic"])

    return src.mapInArrow(run, f"`{id_col}` {src.schema['id'].dataType.simpleString()}, grade int, severity double, p_toxic double, toxic boolean")


def keep_clean(docs: DataFrame, model: Ordinal, text_col: str = "text") -> DataFrame:
    """The documents that aren't toxic, with all their columns."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = pa.RecordBatch.from_arrays(batch.columns, names=[str(k) for k in range(batch.num_columns)])
            for part in row_slices(named, str(place)):
                p = model.grades(model.scores(part.column(place)))
                yield pa.RecordBatch.from_arrays(part.filter(pa.array(p[:, 0] > 0.5)).columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
