"""Language identification of code-switched text by a linear-chain CRF over words.

A word is a maximal run of letters and marks that holds a letter (a run beyond
PIECE characters counts as several). Its emission score for each language is the sum
of learned weights of its features: lower-cased prefixes and suffixes of one to
three characters, all inner n-grams of one to three characters (hashed to
2**BITS buckets), and membership in the lexicon of words that one language uses almost alone. Learned
transition weights tie neighbouring words. Forward-backward gives each word's
marginal probabilities; a text's language is the one with the largest marginal
sum over its words, weighted by their lengths, and the score is its share.

Forward-backward runs over the words of many texts at once: the stream is cut into
blocks, each block's transfer matrix is computed for all blocks side by side,
boundary vectors are carried from block to block, then all blocks are filled in.
A text starts afresh from the start weights, wherever a block begins. Words are
kept as numbers into a table of distinct emissions, so memory grows with 4 bytes
a word beyond the text itself.

Fit: ``SAMPLE`` documents of each language (smallest hash of the id; the bound of the
labelled sample), of each at most PIECES stretches of PIECE_WORDS words, spread
evenly over the whole text. Labels are of documents; to learn transitions,
stretches of all languages are spliced at random into code-switched sequences.
Weights maximise the penalised log-likelihood (Adam). Prediction reads every whole text.

Defined results: null text, or text without a letter, is ``und`` with score 0; so is
every text if no labelled document with letters exists; ties go to the language
that sorts first; documents with null id or null language aren't learned from; of rows
that repeat an id and language one is; repeated rows give repeated results; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import mix64, only, row_slices

SAMPLE, PIECES, PIECE_WORDS = 256, 4, 32
SPLICED = 6             # stretches in a training sequence
BITS, GRAMS = 17, 3
LEXICON_DOCS, LEXICON_SHARE = 3, 0.8
STEPS, RATE, SHRINK = 40, 0.2, 1e-4
PIECE = 1 << 20         # characters cut into words at once
LEAST_BLOCK, MOST_BLOCK = 16, 256
HELD = 1 << 21          # numbers of a block group
UNKNOWN = "und"

_START, _PAD = 1, 2
_rng = np.random.default_rng(13)
_MIX = _rng.integers(1, 1 << 62, size=(3, GRAMS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = _rng.integers(1, 1 << 62, size=(3, GRAMS), dtype=np.uint64)   # inner, prefix, suffix
_PLACE = _rng.integers(1, 1 << 62, size=512, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@cache
def characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every code point: is a letter, is a letter or mark, lower case (one to one)."""
    kinds = np.array([unicodedata.category(chr(c))[0] for c in range(0x110000)])
    low = np.arange(0x110000, dtype=np.uint32)
    for c in np.flatnonzero(kinds == "L"):
        small = chr(c).lower()
        if len(small) == 1:
            low[c] = ord(small)
    return kinds == "L", (kinds == "L") | (kinds == "M"), low


def pieces(text: str) -> Iterator[tuple[int, str]]:
    """The text in pieces of at most PIECE characters that end outside words."""
    _, inside, _ = characters()
    lo, n = 0, len(text)
    while lo < n:
        hi = min(n, lo + PIECE)
        if hi < n and inside[ord(text[hi])]:
            cut = hi
            while cut > lo and inside[ord(text[cut - 1])]:
                cut -= 1
            hi = cut if cut > lo else hi
        yield lo, text[lo:hi]
        lo = hi


def find_words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased code points of a piece, and start and end of each word."""
    letter, inside, low = characters()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside[codes].view(np.int8), [0]))))
    start, end = edge[::2], edge[1::2]
    if len(start):
        real = np.add.reduceat(letter[codes], start, dtype=np.int64) > 0
        start, end = start[real], end[real]
    return low[codes], start, end


def flat(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all characters of the words, first place of each word among them, and place within the word."""
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    within = np.arange(size.sum()) - np.repeat(first, size)
    return np.repeat(start, size) + within, first, within


def word_keys(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words."""
    if not len(start):
        return np.zeros(0, np.uint64)
    at, first, within = flat(start, end - start)
    return mix64(np.add.reduceat(_PLACE[within % 512] * (codes[at].astype(np.uint64) + np.uint64(1)), first) + (end - start).astype(np.uint64))


def features(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the n-grams at every character (characters x GRAMS), first character of
    each word among them, and buckets of affixes (words x 2 GRAMS). What would reach
    beyond its word has the bucket 2**BITS."""
    size = end - start
    at, first, within = flat(start, size)
    c = np.concatenate((codes[at].astype(np.uint64), np.zeros(GRAMS, np.uint64)))
    left = np.repeat(size, size) - within
    n = len(at)
    inner, affix = np.full((n, GRAMS), 1 << BITS, np.int32), np.full((len(start), 2 * GRAMS), 1 << BITS, np.int32)
    shift = np.uint64(64 - BITS)
    gram = np.zeros(n, np.uint64)
    for g in range(GRAMS):
        gram = gram + c[g:g + n] * _MIX[0, g] + _SALT[0, g]
        ok = left > g
        inner[ok, g] = (mix64(gram[ok]) >> shift).astype(np.int32)
        long = size > g
        affix[long, g] = (mix64(gram[first[long]] ^ _SALT[1, g]) >> shift).astype(np.int32)
        affix[long, GRAMS + g] = (mix64(gram[first[long] + size[long] - 1 - g] ^ _SALT[2, g]) >> shift).astype(np.int32)
    return inner, first, affix


@dataclass
class Model:
    """Languages, bucket weights (a last row of zeros stands for no feature), lexicon
    (sorted word hashes and the language of each), its weights, transitions and start weights."""

    langs: list[str]
    weights: np.ndarray
    lexicon: np.ndarray
    spoken: np.ndarray
    lexical: np.ndarray
    moves: np.ndarray
    first: np.ndarray

    def emissions(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Scores of each language for each of the given words."""
        if not len(start):
            return np.zeros((0, len(self.langs)))
        inner, first, affix = features(codes, start, end)
        out = np.zeros((len(start), len(self.langs)))
        for g in range(GRAMS):
            out += np.add.reduceat(self.weights[inner[:, g]], first, axis=0)
        for a in range(affix.shape[1]):
            out += self.weights[affix[:, a]]
        return out + self.lexical[look_up(self.lexicon, self.spoken, keys, len(self.langs))]


def look_up(lexicon: np.ndarray, spoken: np.ndarray, keys: np.ndarray, none: int) -> np.ndarray:
    """The lexicon's language of each word hash, or ``none``."""
    if not len(lexicon):
        return np.full(len(keys), none)
    at = np.minimum(np.searchsorted(lexicon, keys), len(lexicon) - 1)
    return np.where(lexicon[at] == keys, spoken[at], none)


def chances(scores: np.ndarray) -> np.ndarray:
    """Emission factors, 1 for each word's best language, and a last row of ones."""
    return np.concatenate((np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -60)), np.ones((1, scores.shape[1]))))


def sweep(emit: np.ndarray, word: np.ndarray, start: np.ndarray, moves: np.ndarray, first: np.ndarray,
          visit: Callable[[int, int, np.ndarray], None], pairs: np.ndarray | None = None) -> float:
    """Forward-backward over a stream of words.

    ``emit`` holds the factors of distinct words (the last row: ones), ``word`` the row of
    each word in order; where ``start`` is set a text begins. ``visit(lo, hi, marginals)`` gets
    the marginals of words lo to hi. Returns the log of the normaliser; adds expected
    transition counts to ``pairs``.
    """
    n, k = len(word), emit.shape[1]
    size = min(MOST_BLOCK, max(LEAST_BLOCK, int(n ** 0.5)))
    blocks = -(-n // size)
    word = np.concatenate((word, np.full(blocks * size - n, len(emit) - 1, word.dtype))).reshape(blocks, size)
    kind = np.zeros(blocks * size, np.int8)
    kind[:n][start] = _START
    kind[n:] = _PAD
    kind = kind.reshape(blocks, size)
    a, pi = np.exp(np.clip(moves, -30, 30)), np.exp(np.clip(first, -30, 30))

    def step(x: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        y = x @ a
        odd = np.flatnonzero(kinds)
        if len(odd):
            y[odd] = np.where((kinds[odd] == _START).reshape(-1, *[1] * (x.ndim - 1)), x[odd].sum(-1, keepdims=True) * pi, x[odd])
        return y

    transfer, many = np.empty((blocks, k, k)), max(1, HELD // (k * k))
    for b in range(0, blocks, many):
        x = np.broadcast_to(np.eye(k), (min(many, blocks - b), k, k))
        for t in range(size):
            x = step(x, kind[b:b + many, t]) * emit[word[b:b + many, t]][:, None, :]
            x /= x.max(axis=(1, 2), keepdims=True)
        transfer[b:b + many] = x
    into, out = np.full((blocks, k), 1 / k), np.ones((blocks, k))
    for b in range(blocks - 1):
        v = into[b] @ transfer[b]
        into[b + 1] = v / v.sum()
    for b in range(blocks - 1, 0, -1):
        v = transfer[b] @ out[b]
        out[b - 1] = v / v.max()
    total, many = 0.0, max(1, HELD // (k * size))
    for b in range(0, blocks, many):
        w, kinds, x = word[b:b + many], kind[b:b + many], into[b:b + many]
        alpha = np.empty((size + 1, len(w), k))
        alpha[0] = x
        for t in range(size):
            x = step(x, kinds[:, t]) * emit[w[:, t]]
            s = x.sum(1)
            x = x / s[:, None]
            alpha[t + 1] = x
            total += float(np.log(s[kinds[:, t] != _PAD]).sum())
        beta = out[b:b + many]
        marginals = np.empty((len(w), size, k))
        for t in range(size - 1, -1, -1):
            both = alpha[t + 1] * beta
            marginals[:, t] = both / both.sum(1, keepdims=True)
            ahead = emit[w[:, t]] * beta
            inner = kinds[:, t] == 0
            if pairs is not None and inner.any():
                joint = alpha[t][inner][:, :, None] * a * ahead[inner][:, None, :]
                pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(0)
            back = ahead @ a.T
            odd = np.flatnonzero(kinds[:, t])
            if len(odd):
                back[odd] = np.where((kinds[odd, t] == _START)[:, None], (ahead[odd] @ pi)[:, None], beta[odd])
            beta = back / back.max(axis=1, keepdims=True)
        lo, hi = b * size, min(n, (b + len(w)) * size)
        visit(lo, hi, marginals.reshape(-1, k)[:hi - lo])
    return total


def fit_chain(words: list[str], label: np.ndarray, start: np.ndarray, docs: np.ndarray, langs: list[str]) -> Model:
    """The model from a stream of words with their languages; ``docs`` numbers each word's document."""
    k = len(langs)
    text = " ".join(words)
    codes, begin, end = find_words(text)
    keys = word_keys(codes, begin, end)
    keys, at, number = np.unique(keys, return_index=True, return_inverse=True)
    # lexicon: words of several documents that one language uses almost alone, by rates
    seen = np.unique(np.stack((number, label, docs)), axis=1)
    held = np.zeros((len(keys), k))
    np.add.at(held, (seen[0], seen[1]), 1.0)
    per = np.maximum(np.bincount(np.unique(np.stack((label, docs)), axis=1)[0], minlength=k), 1)
    rate = held / per
    share = rate.max(1) / rate.sum(1)
    chosen = np.flatnonzero((held.sum(1) >= LEXICON_DOCS) & (share >= LEXICON_SHARE))
    lexicon, spoken = keys[chosen], rate[chosen].argmax(1)
    inner, first, affix = features(codes, begin[at], end[at])
    owner = np.repeat(np.arange(len(keys)), np.diff(np.append(first, len(inner))))
    bucket, row = np.concatenate((inner.ravel(), affix.ravel())), np.concatenate((np.repeat(owner, GRAMS), np.repeat(np.arange(len(keys)), affix.shape[1])))
    real = bucket < 1 << BITS
    bucket, row = bucket[real], row[real]
    used, bucket = np.unique(bucket, return_inverse=True)
    member = look_up(lexicon, spoken, keys, k)
    w, lex, moves, pi = np.zeros((len(used), k)), np.zeros((k + 1, k)), np.zeros((k, k)), np.zeros(k)
    n = len(label)
    told = np.zeros((len(keys), k))
    np.add.at(told, (number, label), 1.0)
    follows = np.flatnonzero(~start)
    told_moves = np.zeros((k, k))
    np.add.at(told_moves, (label[follows - 1], label[follows]), 1.0)
    told_first = np.bincount(label[start], minlength=k).astype(float)
    state = [(x, np.zeros_like(x), np.zeros_like(x)) for x in (w, lex, moves, pi)]
    for turn in range(1, STEPS + 1):
        score = lex[member]
        for j in range(k):
            score[:, j] += np.bincount(row, weights=w[bucket, j], minlength=len(keys))
        expected, pairs, opened = np.zeros((len(keys), k)), np.zeros((k, k)), np.zeros(k)

        def visit(lo: int, hi: int, marginals: np.ndarray) -> None:
            for j in range(k):
                expected[:, j] += np.bincount(number[lo:hi], weights=marginals[:, j], minlength=len(keys))
            opened[:] += marginals[start[lo:hi]].sum(0)

        sweep(chances(score), number, start, moves, pi, visit, pairs)
        gap = told - expected
        grads = (np.stack([np.bincount(bucket, weights=gap[row, j], minlength=len(used)) for j in range(k)], axis=1),
                 np.stack([np.bincount(member, weights=gap[:, j], minlength=k + 1) for j in range(k)], axis=1), told_moves - pairs, told_first - opened)
        for (x, m, v), g in zip(state, grads):
            g = g / n - SHRINK * x / max(1, len(used)) * 10
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += RATE * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.99 ** turn)) + 1e-8)
        lex[k] = 0   # not in the lexicon: no feature
    weights = np.zeros(((1 << BITS) + 1, k), np.float32)
    weights[used] = w
    return Model(langs, weights, lexicon, spoken, lex, moves, pi)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """The model, from documents and their languages; None if there is nothing to learn from."""
    src = only(docs, id=id_col, text=text_col, lang=lang_col).withColumn("lang", F.col("lang").cast("string"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = (src.filter("id is not null and lang is not null and text is not null").select("id", "lang").distinct()
              .withColumn("k", F.row_number().over(order)).filter(F.col("k") <= SAMPLE).select("id", "lang"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, langs, parts = [], [], []
            for i, text, lang in zip(batch.column("id"), batch.column("text").to_pylist(), batch.column("lang")):
                found = [text[lo + a:lo + b] for lo, part in pieces(text) for a, b in zip(*(x.tolist() for x in find_words(part)[1:]))]
                count = min(PIECES, max(1, len(found) // PIECE_WORDS))
                at = [k * max(0, len(found) - PIECE_WORDS) // max(1, count - 1) for k in range(count)]
                if found:
                    ids.append(i.as_py())
                    langs.append(lang.as_py())
                    parts.append([found[a:a + PIECE_WORDS] for a in at])
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("id").type), pa.array(langs, pa.string()), pa.array(parts, pa.list_(pa.list_(pa.string())))], names=["id", "lang", "parts"])

    # SAMPLE rows of each language: bounded
    rows = (src.join(F.broadcast(chosen), ["id", "lang"]).select("id", "text", "lang").mapInArrow(run, f"id {kind}, lang string, parts array<array<string>>")
            .groupBy("id", "lang").agg(F.min("parts").alias("parts")).orderBy("lang", F.xxhash64("id"), "id").collect())
    if not rows:
        return None
    langs = sorted({r["lang"] for r in rows})
    stretches = [(langs.index(r["lang"]), d, part) for d, r in enumerate(rows) for part in r["parts"]]
    order = np.random.default_rng(len(stretches)).permutation(len(stretches))
    words, label, start, doc = [], [], [], []
    for k, s in enumerate(order):
        lang, d, part = stretches[s]
        start += [k % SPLICED == 0] + [False] * (len(part) - 1)
        words += part
        label += [lang] * len(part)
        doc += [d] * len(part)
    return fit_chain(words, np.array(label), np.array(start), np.array(doc), langs)


def read(model: Model, texts: list[str], visit: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], None]) -> None:
    """Marginals of all words of the texts: ``visit(text number, start, end, marginals)``, in order."""
    joined = "\n".join(texts)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    tables, numbers, starts, ends, made = [], [], [], [], 0
    for lo, part in pieces(joined):
        codes, a, b = find_words(part)
        keys, at, number = np.unique(word_keys(codes, a, b), return_index=True, return_inverse=True)
        tables.append(model.emissions(codes, a[at], b[at], keys))
        numbers.append((number + made).astype(np.int32))
        starts.append((a + lo).astype(np.int32 if len(joined) < 1 << 31 else np.int64))
        ends.append((b + lo).astype(starts[-1].dtype))
        made += len(keys)
    if not made:
        return
    start, end, number = np.concatenate(starts), np.concatenate(ends), np.concatenate(numbers)
    opens = np.zeros(len(start), bool)
    there = np.searchsorted(start, begins[:-1])
    opens[there[there < len(start)]] = True

    def one(lo: int, hi: int, marginals: np.ndarray) -> None:
        row = np.searchsorted(begins, start[lo:hi], side="right") - 1
        visit(row, start[lo:hi] - begins[row], end[lo:hi] - begins[row], marginals)

    sweep(chances(np.concatenate(tables)), number, opens, model.moves, model.first, one)


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, n_words) of every row."""
    src = only(docs, id=id_col, text=text_col)
    held = docs.sparkSession.sparkContext.broadcast(model)   # 2**BITS weights of each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for part in row_slices(batch, "text", 1 << 21):
                rows = part.num_rows
                mass, count = np.zeros((rows, len(model.langs) if model else 1)), np.zeros(rows, np.int64)

                def add(row: np.ndarray, start: np.ndarray, end: np.ndarray, marginals: np.ndarray) -> None:
                    for j in range(mass.shape[1]):
                        mass[:, j] += np.bincount(row, weights=marginals[:, j] * (end - start), minlength=rows)
                    count[:] += np.bincount(row, minlength=rows)

                if model:
                    read(model, [t or "" for t in part.column("text").to_pylist()], add)
                best = mass.argmax(1)
                share = mass.max(1) / np.maximum(mass.sum(1), 1e-300)
                names = [model.langs[b] if c else UNKNOWN for b, c in zip(best, count)] if model else [UNKNOWN] * rows
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(names, pa.string()), pa.array(np.where(count > 0, np.minimum(share, 1.0), 0.0)), pa.array(count)],
                                                 names=[id_col, "lang_pred", "score", "n_words"])

    return src.mapInArrow(run, f"`{id_col}` {src.schema['id'].dataType.simpleString()}, lang_pred string, score double, n_words long")


def label_spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): stretches of words whose likeliest language is the same, by code points, end exclusive."""
    src = only(docs, id=id_col, text=text_col)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for part in row_slices(batch, "text", 1 << 21):
                spans: list[list[dict]] = [[] for _ in range(part.num_rows)]

                def add(row: np.ndarray, start: np.ndarray, end: np.ndarray, marginals: np.ndarray) -> None:
                    best = marginals.argmax(1)
                    new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (best[1:] != best[:-1]))))
                    for a, z in zip(new, np.append(new[1:], len(row)) - 1):
                        mine, lang = spans[row[a]], model.langs[best[a]]
                        if mine and mine[-1]["lang"] == lang:   # goes on from the words before
                            mine[-1]["end"] = int(end[z])
                        else:
                            mine.append({"start": int(start[a]), "end": int(end[z]), "lang": lang})

                read(model, [t or "" for t in part.column("text").to_pylist()], add)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])))], names=[id_col, "spans"])

    return src.mapInArrow(run, f"`{id_col}` {src.schema['id'].dataType.simpleString()}, spans array<struct<start: long, end: long, lang: string>>")
