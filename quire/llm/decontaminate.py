"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages of at most ``PASSAGE`` words. Passages of
the corpus (runs of as many words) are TF-IDF vectors over the terms that weigh
most in some benchmark passage (``HEAVY`` of each, so every one is
represented). A randomised SVD of that matrix, sketched in one pass of the
cluster over all documents, gives a latent space; in it every window of every
document is compared with the benchmark passages by cosine. Windows of
``LEAST_COSINE`` or more, which also hold ``LEAST_SHARE`` of the passage's weight
along its own direction, are candidates for its item (see ``retrieved``). So are windows
around which enough of the item's words stand (see ``counted``), which holds for every window
that the checks can accept, so no paraphrase is lost by the latent space. Around
candidates the longest common subsequence of words with the whole item is computed:

* at least ``COPY`` of the item's words: contaminated;
* at least ``PARAPHRASE``, and the item's last quarter (its answer) stands
  there with at least ``ANSWER`` of its words: contaminated, as a paraphrase.

Items of fewer than ``SHORT`` words must stand word for word; every run of words
is held against all of them at once (``Runs``).

The benchmark is a stated query set, taken in blocks of about ``BLOCK`` items
(a hash of the text chooses the block), each against all documents; at most
``SPACE`` passages share a latent space, which has a dimension for each of them. Only a
block's words, weights and latent vectors go to the driver and the executors.

Defined results: null or empty texts match nothing; repeated documents and
items give repeated or equal matches (one row for each document row and item
id); an item without a word matches nothing; an empty benchmark or corpus gives
no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import only, row_slices, saved, text_buffer, word_table

PASSAGE = 32          # words of a window; windows start every half
HEAVY = 16            # terms kept of each benchmark passage
SPACE, OVER = 384, 64  # benchmark passages in one latent space, and its dimensions beyond theirs
ITEM_WEIGHT = 9.0     # weight of the benchmark's passages against all the corpus's
COPY, PARAPHRASE, ANSWER = 0.8, 0.6, 0.75
LEAST_COSINE, LEAST_SHARE = 0.45, 0.25
SHORT = 8
BLOCK = 2000          # items searched at once
SEED = 20_111
CALM = 1 << 20        # words handled at once in a task


def lcs(masks: dict[int, int], n: int, words) -> int:
    """Length of the longest common subsequence, bit-parallel over the n words of an item."""
    full = (1 << n) - 1
    v = full
    get = masks.get
    for w in words:
        m = get(w)
        if m:
            u = v & m
            v = (v + u | v - u) & full
    return n - v.bit_count()


def masks_of(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << k
    return out


class Item:
    """Words of one benchmark item, ready for the checks."""

    def __init__(self, key, words: list[int]):
        self.key, self.words, self.n = key, words, len(words)
        self.masks = masks_of(words)
        answer = words[self.n - max(1, math.ceil(self.n / 4)):]
        self.answer, self.answer_masks = len(answer), masks_of(answer)
        # the masks once more as rows of 64-bit numbers, by ascending word
        self.keys, size = np.array(sorted(self.masks), np.int64), -(-self.n // 64) * 8
        self.bits = np.frombuffer(b"".join(self.masks[w].to_bytes(size, "little") for w in self.keys.tolist()), np.uint64).reshape(len(self.keys), -1)

    def found(self, around: list[int]) -> tuple[float, bool] | None:
        """Share of the item's words found in order, and whether its answer is there; None if too few."""
        if self.n < SHORT:
            w = self.words
            return (1.0, True) if any(around[k:k + self.n] == w for k in range(len(around) - self.n + 1)) else None
        most = 0
        for m in {w: self.masks[w] for w in around if w in self.masks}.values():
            most |= m
        if most.bit_count() < PARAPHRASE * self.n:
            return None
        share = lcs(self.masks, self.n, around) / self.n
        if share < PARAPHRASE:
            return None
        answer = lcs(self.answer_masks, self.answer, around) >= ANSWER * self.answer
        return (share, answer) if share >= COPY or answer else None

    def found_in(self, words: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[int, tuple[float, bool]]]:
        """Numbers of the spans of words (first, after the last; both ascending) in which ``found`` finds the item, and what it says;
        for items of SHORT words or more. Only spans are looked at in which enough of the item's words stand, in whatever order."""
        many = max(1, (1 << 20) // (self.bits.shape[1] * int((last - first).max(initial=1))))   # spans at once
        for lo in range(0, len(first), many):
            a, b = first[lo:lo + many], last[lo:lo + many]
            new = np.concatenate(([True], a[1:] > b[:-1]))   # spans that overlap are one run of words
            start, run = a[new], np.cumsum(new) - 1
            size = b[np.append(np.flatnonzero(new)[1:], len(a)) - 1] - start
            shift = start - (np.cumsum(size) - size)
            word = words[np.arange(int(size.sum())) + np.repeat(shift, size)]
            at = np.minimum(np.searchsorted(self.keys, word), len(self.keys) - 1)
            there = np.flatnonzero(self.keys[at] == word)
            held = np.zeros((len(word) + 1, self.bits.shape[1]), np.uint64)
            held[there] = self.bits[at[there]]
            borders = np.stack((a - shift[run], b - shift[run]), axis=1).ravel()
            present = np.bitwise_count(np.bitwise_or.reduceat(held, borders, axis=0)[::2]).sum(axis=1, dtype=np.int64)
            for k in np.flatnonzero(present >= PARAPHRASE * self.n).tolist():
                got = self.found(words[a[k]:b[k]].tolist())
                if got:
                    yield lo + k, got


def terms(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(id, words): for each document the place of each of its words in the sorted
    vocabulary, -1 for other words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "text"):
                h, first = word_table(*text_buffer(part.column("text")))
                at = np.searchsorted(vocabulary, h)
                at[at == len(vocabulary)] = 0
                at = np.where(vocabulary[at] == h, at, -1).astype(np.int32) if len(h) else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(at))], names=["id", "words"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, words array<int>")


def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut to a bounded number of words, with the words of all rows and the row borders."""
    for batch in batches:
        col = batch.column("words")
        borders = np.asarray(col.offsets, np.int64)
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(borders, borders[lo] + CALM, side="right")) - 1)
            yield batch.slice(lo, hi - lo), np.asarray(col.values)[borders[lo]:borders[hi]], borders[lo:hi + 1] - borders[lo]
            lo = hi


def passages(words: np.ndarray, borders: np.ndarray, weighty: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of ``size`` words that hold weighty terms: first word in ``term`` of
    each run, its row and its number in the row, and the terms in order.

    ``weighty`` maps a word to its term or -1 (its last entry is for other words).
    """
    term = weighty[words]
    at = np.flatnonzero(term >= 0)
    row = np.searchsorted(borders, at, side="right") - 1
    number = (at - borders[row]) // size
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (number[1:] != number[:-1]))) if len(at) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return first, row[first], number[first], term[at]


def passage_counts(table: DataFrame, n_words: int) -> tuple[int, np.ndarray]:
    """Number of passages of the corpus, and for each vocabulary word how many hold it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, every = 0, np.zeros(n_words, np.int64), np.append(np.arange(n_words), -1)
        side = max(1, (1 << 21) // n_words)   # passages at once
        last = np.zeros(side * n_words, np.int64)
        for _, words, borders in lists(batches):
            total += int((-(-np.diff(borders) // PASSAGE)).sum())
            first, _, _, word = passages(words, borders, every, PASSAGE)
            for lo in range(0, len(first), side):
                x, y = first[lo], first[lo + side] if lo + side < len(first) else len(word)
                w = word[x:y]
                place = np.repeat(np.arange(len(first[lo:lo + side])), np.diff(np.append(first[lo:lo + side], y))) * n_words + w
                mine = np.arange(len(w))
                last[place] = mine   # of equal words of a passage one stays, and that one counts
                held += np.bincount(w[last[place] == mine], minlength=n_words)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(held[at], total))], names=["word", "n"])

    got = table.select("words").mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()  # a row for each word of the block
    held = np.zeros(n_words, np.int64)
    total = 0
    for r in got:
        if r["word"] < 0:
            total = r["n"]
        else:
            held[r["word"]] = r["n"]
    return total, held


def sketch(table: DataFrame, weighty: np.ndarray, idf: np.ndarray, omega: np.ndarray) -> tuple[np.ndarray, int]:
    """A'A omega for the matrix A of all corpus passages, and the number of its rows.

    Each task adds up its own part of A'A, the products of the few terms of each
    passage, and sends that times omega, only rows of terms that it met; parts
    meet in two rounds of bounded groups.
    """
    spark = table.sparkSession
    sent = spark.sparkContext.broadcast((weighty, idf, omega))
    width, wide = omega.shape[1], 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weighty, idf, omega = sent.value
        part, count = np.zeros(omega.shape, np.float32), 0
        met = np.zeros(len(idf), bool)
        square = np.zeros((len(idf), len(idf)), np.float32) if len(idf) <= SPACE * HEAVY else None   # more only for an item longer than a space
        for _, words, borders in lists(batches):
            first, _, _, term = passages(words, borders, weighty, PASSAGE)
            count += len(first)
            for lo in range(0, len(first), 1024):
                starts = first[lo:lo + 1024]
                t = term[starts[0]:first[lo + 1024] if lo + 1024 < len(first) else len(term)]
                starts = starts - starts[0]
                per = np.diff(np.append(starts, len(t)))
                row = np.repeat(np.arange(len(starts)), per)
                # term frequencies: one entry for each term of a passage
                key, tf = np.unique(row * len(idf) + t, return_counts=True)
                row, t = key // len(idf), key % len(idf)
                x = tf * idf[t]
                norm = np.sqrt(np.bincount(row, weights=x * x, minlength=len(starts)))
                x = (x / norm[row]).astype(np.float32)
                met[t] = True
                if square is None:
                    y = np.add.reduceat(omega[t] * x[:, None], np.searchsorted(row, np.arange(len(starts))), axis=0)
                    np.add.at(part, t, y[row] * x[:, None])
                    continue
                many = np.bincount(row, minlength=len(starts))
                with_ = many[row]   # each term meets all of its passage
                left = np.repeat(np.arange(len(row)), with_)
                right = np.arange(len(left)) - np.repeat(np.cumsum(with_) - with_ - (np.cumsum(many) - many)[row], with_)
                np.add.at(square.ravel(), t[left] * len(idf) + t[right], x[left] * x[right])
        if square is not None:
            part = (square @ omega).astype(np.float32)
        at = np.flatnonzero(met)
        blocks = [(int(b), at[at // wide == b]) for b in np.unique(at // wide)]
        yield pa.RecordBatch.from_arrays([
            pa.array([-1, *(b for b, _ in blocks)], pa.int32()), pa.array([count] + [0] * len(blocks), pa.int64()),
            pa.array([b"", *(t.astype(np.int32).tobytes() for _, t in blocks)], pa.binary()), pa.array([b"", *(part[t].tobytes() for _, t in blocks)], pa.binary())],
            names=["block", "count", "terms", "sums"])

    def add(t: pa.Table) -> pa.Table:
        block, total = t["block"][0].as_py(), np.zeros((wide, width), np.float64)
        met = np.zeros(wide, bool)
        for terms, sums in zip(t["terms"], t["sums"]):
            k = np.frombuffer(terms.as_py(), np.int32) % wide
            total[k] += np.frombuffer(sums.as_py(), np.float32).reshape(-1, width)
            met[k] = True
        k = np.flatnonzero(met)
        return pa.table({"block": pa.array([block], pa.int32()), "count": pa.array([sum(t["count"].to_pylist())], pa.int64()),
                         "terms": pa.array([(k + max(block, 0) * wide).astype(np.int32).tobytes()], pa.binary()), "sums": pa.array([total[k].astype(np.float32).tobytes()], pa.binary())})

    schema = "block int, count long, terms binary, sums binary"
    parts = saved(table.select("words").mapInArrow(run, schema).withColumn("fold", F.pmod(F.spark_partition_id(), F.lit(max(1, math.isqrt(table.rdd.getNumPartitions()))))), "sketch")
    once = parts.groupBy("block", "fold").applyInArrow(lambda t: add(t), schema)
    out, count = np.zeros(omega.shape), 0
    for r in once.groupBy("block").applyInArrow(lambda t: add(t), schema).collect():   # as many bytes as omega
        count += r["count"]
        k = np.frombuffer(r["terms"], np.int32)
        out[k] = np.frombuffer(r["sums"], np.float32).reshape(-1, width)
    sent.unpersist()
    return out, count


def latent_space(table: DataFrame, weighty: np.ndarray, idf: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (terms x dimensions) and singular values of the TF-IDF matrix.

    The benchmark's passages (rows of ``queries``, of unit length) weigh
    ITEM_WEIGHT times as much as all the corpus's, so their directions stay. One
    pass: the sketch of A'A gives its Nystroem approximation.
    """
    n = len(idf)
    width = min(n, len(queries) + OVER)
    omega = np.linalg.qr(np.random.default_rng(SEED).standard_normal((n, width)))[0].astype(np.float32)
    z, count = sketch(table, weighty, idf.astype(np.float32), omega)
    z = z / max(count, 1) + ITEM_WEIGHT * queries.T @ (queries @ omega) / max(len(queries), 1)
    shift = np.finfo(np.float32).eps * np.linalg.norm(z)
    z = z + shift * omega
    core = omega.T.astype(np.float64) @ z
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    values = np.maximum(values, shift)
    u, s, _ = np.linalg.svd(z @ (vectors / np.sqrt(values)), full_matrices=False)
    return u, np.maximum(s ** 2 - shift, 0) ** 0.5


class Runs:
    """Items of fewer than SHORT words as a tree of words, to find where one stands word for word."""

    def __init__(self, items: list[Item], n_words: int):
        self.n_words, nodes, edges = n_words, 1, {}
        self.ends: dict[int, list[int]] = {}
        for i, item in enumerate(items):
            if item.n < SHORT:
                node = 0
                for w in item.words:
                    node = edges.setdefault(node * n_words + w, nodes)
                    nodes = max(nodes, node + 1)
                self.ends.setdefault(node, []).append(i)
        self.keys = np.array(sorted(edges), np.int64)
        self.next = np.array([edges[k] for k in self.keys.tolist()], np.int64)
        self.begins = np.zeros(n_words + 1, bool)   # its last entry is for other words
        self.begins[self.keys[self.keys < n_words]] = True
        self.ending = np.zeros(nodes, bool)
        self.ending[list(self.ends)] = True

    def found(self, words: np.ndarray, borders: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Row, item and first word in the row, where the item stands there for the first time."""
        at = np.flatnonzero(self.begins[words])
        row = np.searchsorted(borders, at, side="right") - 1
        node, depth = np.zeros(len(at), np.int64), 0
        while len(at):
            key = node * self.n_words + words[at + depth]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = (words[at + depth] >= 0) & (self.keys[place] == key)
            at, row, node, depth = at[on], row[on], self.next[place[on]], depth + 1
            end = np.flatnonzero(self.ending[node])
            _, first = np.unique(row[end] * len(self.ending) + node[end], return_index=True)
            for k in end[first]:
                for i in self.ends[int(node[k])]:
                    yield int(row[k]), i, int(at[k] - borders[row[k]])
            on = at + depth < borders[row + 1]
            at, row, node = at[on], row[on], node[on]


def counted(items: list[Item], held: np.ndarray, n_passages: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What a place needs to hold before it can hold an item of SHORT words or more.

    Where such an item is found, at most n - need of its n words are missing (need is
    the share PARAPHRASE of n). So of any n - need + k of them k are there. The rarest
    are taken, with the k that fewest other places should reach; nothing is lost by
    any k. Returns the items in order of their length, the row in ``shares`` of
    each vocabulary word or -1 (last entry: other words), ``shares`` (where a word's
    items begin, and the items, one as often as the word is among its taken ones), k and the
    half windows that an item reaches to either side.
    """
    order = sorted((i for i, item in enumerate(items) if item.n >= SHORT), key=lambda i: items[i].n)
    taken, least = [], []
    for i in order:
        item = items[i]
        word = np.array(item.words)
        word = word[np.lexsort((word, held[word]))]
        need = math.ceil(PARAPHRASE * item.n - 1e-9)
        k = np.arange(1, need + 1)
        by_chance = np.cumsum(held[word] + 0.5)[item.n - need:] / max(n_passages, 1) * (2 * item.n + PASSAGE) / PASSAGE
        rare = np.where(k > by_chance, k * np.log(k / by_chance) - (k - by_chance), k - by_chance)   # Chernoff's bound
        least.append(int(k[np.argmax(rare)]))
        taken.append(word[:item.n - need + least[-1]])
    used = np.unique(np.concatenate(taken)) if taken else np.zeros(0, np.int64)
    place = np.full(len(held) + 1, -1, np.int64)
    place[used] = np.arange(len(used))
    word = place[np.concatenate(taken)] if taken else used
    sort = np.argsort(word, kind="stable")
    shares = np.searchsorted(word[sort], np.arange(len(used) + 1)), np.repeat(np.arange(len(order)), np.array([len(t) for t in taken], np.int64))[sort]
    return np.array(order, np.int64), place, shares, np.array(least, np.int64), np.array([-(-items[i].n // (PASSAGE // 2)) for i in order], np.int64)


def candidates(words: np.ndarray, borders: np.ndarray, place: np.ndarray, shares: tuple[np.ndarray, np.ndarray], least: np.ndarray, reach: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row, item (its place in the order of ``counted``) and first word in the row of the windows around
    which ``least`` of the item's taken words stand; windows start every half."""
    half = PASSAGE // 2
    base = np.concatenate(([0], np.cumsum(-(-np.diff(borders) // half))))
    first, row, number, word = passages(words, borders, place, half)
    if not len(first):
        return
    at_half = base[row] + number
    begin, item = shares
    far = int(reach[-1]) + 2
    # the largest sum of an item's places: where it fits 16 bits, sums may run over, their differences stay right
    most = 2 * far * half * int(np.unique(np.repeat(np.arange(len(begin) - 1), np.diff(begin)) * len(least) + item, return_counts=True)[1].max())
    kind = np.uint16 if most < 1 << 16 else np.int32
    least = least.astype(kind)
    groups = np.flatnonzero(np.concatenate(([True], reach[1:] != reach[:-1], [True])))
    step = max(1024, 2 * far)
    for lo in range(0, int(base[-1]), step):
        hi = min(lo + step, int(base[-1]))
        a, b = max(0, lo - far), min(int(base[-1]), hi + far)
        x, y = np.searchsorted(at_half, (a, b))
        if x == y:
            continue
        ends = np.append(first[x:y], first[y] if y < len(first) else len(word))
        w = word[ends[0]:ends[-1]]
        many = begin[w + 1] - begin[w]
        after = np.cumsum(many)
        each = np.arange(after[-1]) + np.repeat(begin[w] - (after - many), many)   # a word's items
        place_of = np.repeat((np.repeat(at_half[x:y], np.diff(ends)) - a + 1) * len(least), many) + item[each]
        sums = np.bincount(place_of, minlength=(b - a + 1) * len(least)).astype(kind).reshape(-1, len(least))   # of all half windows before
        np.cumsum(sums, axis=0, dtype=kind, out=sums)
        at = np.arange(lo, hi)
        of = np.searchsorted(base, at, side="right") - 1
        for g, h in zip(groups[:-1], groups[1:]):
            left, right = np.maximum(at - reach[g], base[of]) - a, np.minimum(at + 2 + reach[g], base[of + 1]) - a
            k, i = np.divmod(np.flatnonzero(sums[right, g:h] - sums[left, g:h] >= least[g:h]), h - g)
            yield of[k], g + i, (at[k] - base[of[k]]) * half


def retrieved(words: np.ndarray, borders: np.ndarray, weighty: np.ndarray, weights: np.ndarray, latent: np.ndarray, length: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row, benchmark passage and first word in the row of the windows that are near a passage in the latent space: a cosine of
    LEAST_COSINE, and LEAST_SHARE of the passage's ``length`` along its direction; windows start every half."""
    half, least = PASSAGE // 2, LEAST_SHARE * length
    first, row, number, term = passages(words, borders, weighty, half)
    for lo in range(0, len(first), 2048):
        hi, more = min(lo + 2048, len(first)), min(lo + 2049, len(first))   # the half window after the last one
        starts = first[lo:more]
        sums = np.add.reduceat(weights[term[starts[0]:first[more] if more < len(first) else len(term)]], starts - starts[0], axis=0)
        on = np.flatnonzero((row[lo + 1:more] == row[lo:more - 1]) & (number[lo + 1:more] == number[lo:more - 1] + 1))
        full = sums[:hi - lo].copy()
        full[on] += sums[on + 1]
        size = np.linalg.norm(full, axis=1)
        long = np.flatnonzero(size >= least.min() * (1 - 1e-4))   # a shorter one holds too little of any passage
        along = full[long] @ latent.T
        w, q = np.nonzero((along >= LEAST_COSINE * size[long, None]) & (along >= least[None, :]))
        yield row[lo + long[w]], q, number[lo + long[w]] * half


def by_item(near: list[tuple[np.ndarray, np.ndarray, np.ndarray]], order: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each item with the rows and first words of its windows, ascending and once each, of what ``candidates`` and ``retrieved`` give."""
    if not near:
        return
    row, item, at = (np.concatenate(x) for x in zip(*near))
    sort = np.lexsort((at, row, item))
    row, item, at = row[sort], item[sort], at[sort]
    new = np.concatenate(([True], (item[1:] != item[:-1]) | (row[1:] != row[:-1]) | (at[1:] != at[:-1]))) if len(at) else np.zeros(0, bool)
    row, item, at = row[new], item[new], at[new]
    borders = np.searchsorted(item, np.arange(len(order) + 1))
    for x in np.flatnonzero(np.diff(borders)).tolist():
        own = slice(borders[x], borders[x + 1])
        yield int(order[x]), row[own], at[own]


def search(table: DataFrame, id_col: str, item_type: str, items: list[Item], counts: tuple, weighty: np.ndarray, weights: np.ndarray, latent: np.ndarray, length: np.ndarray, owner: np.ndarray) -> DataFrame:
    """Windows near a benchmark passage and windows that may hold an item, checked; the best for each document row and item.

    ``counts`` is what ``counted`` gives, ``weights`` (terms x dimensions) are the
    idf-weighted latent vectors of the terms, ``latent`` the unit latent vectors of the
    benchmark passages, ``length`` the lengths of their term vectors, ``owner`` their items.
    """
    sent = table.sparkSession.sparkContext.broadcast((items, counts, Runs(items, len(weighty) - 1), weighty, weights.astype(np.float32), latent.astype(np.float32), length.astype(np.float32), owner, np.searchsorted(owner, np.arange(len(items) + 1))))
    kind = table.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, (order, place, shares, least, reach), runs, weighty, weights, latent, length, owner, own = sent.value
        ordered = np.full(len(items), -1)   # short items have no place in the order
        ordered[order] = np.arange(len(order))

        def cosine(i: int, window: np.ndarray) -> float:
            """Of the window with the nearest passage of the item."""
            term = weighty[window]
            v = weights[term[term >= 0]].sum(axis=0)
            return float((latent[own[i]:own[i + 1]] @ v).max() / max(np.linalg.norm(v), 1e-9))

        for batch, words, borders in lists(batches):
            best: dict[tuple[int, int], tuple] = {}
            near = list(candidates(words, borders, place, shares, least, reach)) if len(order) else []
            for row, q, at in retrieved(words, borders, weighty, weights, latent, length):
                item = ordered[owner[q]]
                near.append((row[item >= 0], item[item >= 0], at[item >= 0]))
            hits = [(r, i, [((1.0, True), at // (PASSAGE // 2) * (PASSAGE // 2))]) for r, i, at in runs.found(words, borders)]
            for i, row, at in by_item(near, order):
                begin, n = borders[row], items[i].n
                got: dict[int, list[tuple]] = {}
                for k, g in items[i].found_in(words, np.maximum(begin, begin + at - n), np.minimum(borders[row + 1], begin + at + PASSAGE + n)):
                    got.setdefault(int(row[k]), []).append((g, int(at[k])))
                for r, places in got.items():
                    most = max(g[0] for g, _ in places)
                    hits.append((r, i, [(g, x) for g, x in places if g[0] == most]))
            for r, i, places in hits:
                a, b = borders[r], borders[r + 1]
                c, at, got = max(((cosine(i, words[a + at:min(b, a + at + PASSAGE)]), at, g) for g, at in places), key=lambda x: (x[0], -x[1]))
                best[r, i] = (*got, c, at)
            keys = sorted(best)
            ids = batch.column("id")
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array([r for r, _ in keys], pa.int64())), pa.array([items[i].key for _, i in keys], pa_item), pa.array([best[k][2] for k in keys], pa.float64()),
                pa.array([best[k][0] for k in keys], pa.float64()), pa.array([best[k][1] for k in keys], pa.bool_()), pa.array([best[k][3] for k in keys], pa.int64())],
                names=[id_col, "item_id", "cosine", "coverage", "answer", "near_word"])

    pa_item = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[item_type]
    return table.mapInArrow(run, f"`{id_col}` {kind}, item_id {item_type}, cosine double, coverage double, answer boolean, near_word long")


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
         block: int = BLOCK) -> DataFrame:
    """One row for each document and benchmark item that it holds: cosine of the
    nearest window, share of the item's words found in order (``coverage``),
    whether the answer stands there, and the word where the window starts."""
    src = only(docs, id=id_col, text=text_col)
    bench = only(benchmark, key=item_col, text=item_text)
    item_type = bench.schema["key"].dataType.simpleString()
    none = docs.sparkSession.createDataFrame([], f"`{id_col}` {src.schema['id'].dataType.simpleString()}, item_id {item_type}, cosine double, coverage double, answer boolean, near_word long")
    out = []
    blocks = math.ceil(bench.count() / block)
    for k in range(blocks):
        rows = bench.filter(F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(blocks)) == k).collect()
        h, first = word_table(*text_buffer(pa.array([r["text"] for r in rows], pa.string())))
        vocabulary, place = np.unique(h, return_inverse=True)
        items = [Item(r["key"], place[first[x]:first[x + 1]].tolist()) for x, r in enumerate(rows) if first[x + 1] > first[x]]
        if not items:
            continue
        table = saved(terms(src, vocabulary), "terms")
        n_passages, held = passage_counts(table, len(vocabulary))
        idf_all = np.log((1 + n_passages + len(items)) / (1 + held)) + 0.1
        # benchmark passages, and the heaviest terms of each
        spaces: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[]]
        for i, item in enumerate(items):
            size = math.ceil(item.n / math.ceil(item.n / PASSAGE))
            own = []
            for lo in range(0, item.n, size):
                word, tf = np.unique(item.words[lo:lo + size], return_counts=True)
                weight = tf * idf_all[word]
                top = np.lexsort((word, -weight))[:HEAVY]
                own.append((i, word[top], weight[top]))
            if spaces[-1] and len(spaces[-1]) + len(own) > SPACE:
                spaces.append([])
            spaces[-1] += own
        for parts in spaces:
            used = np.unique(np.concatenate([w for _, w, _ in parts]))
            weighty = np.full(len(vocabulary) + 1, -1, np.int64)
            weighty[used] = np.arange(len(used))
            queries, length = np.zeros((len(parts), len(used))), np.array([np.linalg.norm(weight) for _, _, weight in parts])
            for at, (_, word, weight) in enumerate(parts):
                queries[at, weighty[word]] = weight / length[at]
            v, _ = latent_space(table, weighty, idf_all[used], queries)
            latent = queries @ v
            latent /= np.maximum(np.linalg.norm(latent, axis=1), 1e-9)[:, None]
            owner = np.array([i for i, _, _ in parts])
            lo, hi = owner[0], owner[-1] + 1   # an item's passages share a space
            out.append(search(table, id_col, item_type, items[lo:hi], counted(items[lo:hi], held, n_passages), weighty, idf_all[used][:, None] * v, latent, length, owner - lo))
    return reduce(DataFrame.unionByName, out) if out else none


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    found = saved(find(docs, benchmark, id_col, text_col), "leaks")
    hit = found.select(F.col(id_col).alias(f"{id_col}_hit")).distinct()
    return docs.join(hit, docs[id_col] == hit[f"{id_col}_hit"], "left_anti")
