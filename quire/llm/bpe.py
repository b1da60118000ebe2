"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

Each word is a row of symbols; the leaves of the tree hold the merge rank of
each adjacent pair, every inner node the smaller of its children. The root
says whether a merge is left; walking down, left child first, gives the
leftmost pair of lowest rank. A merge changes three leaves, each a logarithmic
point update, so a word of n bytes takes O(n log n) also when it is very long.
The trees of many words are worked on side by side (``merge_many``): each step
merges the root's pair of every word that still has one.

A worker remembers the ids of the words it has met, in flat buffers, in two
generations: when the young one is full it becomes the old one, and words met
again move back, so frequent words stay and memory is bounded.

Normalisation and word splitting follow the vocabulary file (NFC, white space
dropped, lower case, letter / digit / other runs, bytes as symbols, word end
mark on the last byte). Special strings of the file are cut out first.

Defined results: null or empty text gives no ids, zero tokens and an empty
decoded text; letters that only later Unicode versions assign are neither
letters nor digits; repeated rows give repeated results; other columns of the
input, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quire.llm.common import only, row_slices

#: Words, and bytes of words and ids, that a generation of remembered words holds (memory only, never results).
REMEMBERED, REMEMBERED_BYTES = 100_000, 1 << 24
#: Bytes of text whose tokens a task holds at once, and words that are looked up at once.
OUT_BYTES, WORDS_AT_ONCE = 1 << 20, 1 << 16
#: Longest word, in bytes, whose tree is worked on beside others.
MOST_SIDE_BY_SIDE = 64

NONE = 1 << 30
PAIR = 1 << 31     # a pair of symbols as one number
# fixed values: white space and word pattern as the vocabulary file states them
_SPACE = "\t-\r \x85\xa0  -     　"
_SPLIT = re.compile(f"[{_SPACE}]+")
# fixed values: letters and digits that the tables of the split pattern don't have yet
_LATER_LETTERS = ("՘֋֌࢏౜೜₏₝-₟꟎꟏꟒꟔꟝꟢꟱꭬꭭"
                  "\U000107BB-\U000107BF\U00010940-\U00010959\U00010EC5-\U00010EC7\U00010ED9-\U00010EEE\U00011B0A\U00011DB0-\U00011DDB\U00011DF1"
                  "\U00016EA0-\U00016EB8\U00016EBB-\U00016ED3\U00016FF2\U00016FF3\U000187F8-\U000187FF\U00018CD6-\U00018CDA\U00018D09-\U00018D20"
                  "\U00018D80-\U00018DF2\U00018E00-\U00019191\U000191A0-\U000191D2\U0001B123-\U0001B128\U0001B168\U0001D6A6\U0001DF1F-\U0001DF24"
                  "\U0001DF2B-\U0001DF81\U0001DF90-\U0001DF96\U0001DFCD-\U0001DFFF\U0001E6C0-\U0001E6DE\U0001E6E0-\U0001E6E2\U0001E6E4\U0001E6E5"
                  "\U0001E6E7-\U0001E6ED\U0001E6F0-\U0001E6F4\U0001E6FE\U0001E6FF\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD"
                  "\U000323B0-\U00033479\U0003D000-\U0003FC3F")
_LATER_DIGITS = "\U00011DE0-\U00011DE9\U0001246F\U00012475-\U0001247F\U00012550-\U00012686\U00016FF4-\U00016FF6"
_LETTER, _DIGIT = rf"[\p{{L}}--[{_LATER_LETTERS}]]", rf"[\p{{N}}--[{_LATER_DIGITS}]]"
_ASCII_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zA-Z]+|[0-9]|[^\t-\r a-zA-Z0-9]+")
_WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_SPACE}\p{{L}}\p{{N}}]+")
_LATER = re.compile(f"[{_LATER_LETTERS}{_LATER_DIGITS}]")
_WORDS_WITH_LATER = regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|{_LETTER}+|{_DIGIT}|[[^{_SPACE}\p{{L}}\p{{N}}]||[{_LATER_LETTERS}{_LATER_DIGITS}]]+")


_LATIN1 = {kind: re.escape("".join(chr(c) for c in range(256) if unicodedata.category(chr(c))[0] == kind)) for kind in "LN"}
_LATIN1_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN1['L']}]+|[{_LATIN1['N']}]|[^\t-\r \x85\xa0{_LATIN1['L']}{_LATIN1['N']}]+")


def split_words(text: str) -> list[str]:
    """The words of a text, as the file cuts it: at white space, and each run by its split pattern."""
    if text.isascii():
        return _ASCII_WORDS.findall(text)
    try:
        text.encode("latin-1")
        return _LATIN1_WORDS.findall(text)
    except UnicodeEncodeError:
        return (_WORDS_WITH_LATER if _LATER.search(text) else _WORDS).findall(text)


# fixed values: lower-case pairs of letters newer than Python's own tables
_NEW_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
              **{0x10D50 + k: 0x10D70 + k for k in range(22)}, **{0x16EA0 + k: 0x16EBB + k for k in range(25)}}
_NEW = re.compile("[" + "".join(map(chr, _NEW_LOWER)) + "]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = [""] * 256
    for b in plain:
        out[b] = chr(b)
    for k, b in enumerate(b for b in range(256) if not out[b]):
        out[b] = chr(256 + k)
    return out


class PairTree:
    """Segment tree over the ranks of adjacent symbol pairs."""

    def __init__(self, ranks: list[int]):
        size = 1
        while size < len(ranks):
            size *= 2
        tree = [NONE] * size + ranks + [NONE] * (size - len(ranks))
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a <= b else b
        self.size, self.tree = size, tree

    def lowest(self) -> tuple[int, int]:
        """Rank and place of the leftmost lowest pair; the rank is NONE if none is left."""
        tree, k, size = self.tree, 1, self.size
        low = tree[1]
        if low == NONE:
            return NONE, -1
        while k < size:
            k *= 2
            if tree[k] != low:
                k += 1
        return low, k - size

    def put(self, at: int, rank: int) -> None:
        tree, k = self.tree, at + self.size
        tree[k] = rank
        while k > 1:
            other = tree[k ^ 1]
            low = rank if rank <= other else other
            k >>= 1
            if tree[k] == low:
                return
            tree[k] = rank = low


class Bpe:
    """One vocabulary: encodes texts to ids and ids back to text."""

    def __init__(self, spec: str):
        d = json.loads(spec)
        model = d["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for k, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            left = a[:-len(self.end)] if self.end and a.endswith(self.end) else a
            self.rank[self.vocab[a], self.vocab[b]] = k
            self.made.append(self.vocab[left + b])
        marks = byte_symbols()
        self.inner = [self.vocab[c] for c in marks]
        self.last = [self.vocab[c + self.end] for c in marks]
        self.special = {t["content"]: t["id"] for t in d["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.token = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        order = np.argsort(keys := np.array([x * PAIR + y for x, y in self.rank], np.int64))
        self.pair_keys, self.pair_ranks = np.append(keys[order], np.iinfo(np.int64).max), np.append(np.array(list(self.rank.values()), np.int32)[order], NONE)
        self.made_ids, self.inner_ids, self.last_ids = (np.array(x, np.int32) for x in (self.made, self.inner, self.last))
        told = [self.token.get(i, "").encode("utf-8", "surrogatepass") + b" " for i in range(max(self.token) + 1)]
        self.told = np.frombuffer(b"".join(told), np.uint8)
        self.told_at = np.concatenate(([0], np.cumsum([len(t) for t in told])))
        self.young, self.old = Words(), Words()

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-split word, by repeated leftmost lowest-rank merges."""
        raw = word.encode("utf-8", "surrogatepass")
        inner = self.inner
        sym = [inner[b] for b in raw]
        sym[-1] = self.last[raw[-1]]
        n = len(sym)
        if n == 1:
            return sym
        get = self.rank.get
        tree = PairTree([get(p, NONE) for p in zip(sym, sym[1:])])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        lowest, put, made = tree.lowest, tree.put, self.made
        while True:
            r, i = lowest()
            if r == NONE:
                break
            j = after[i]
            k = after[j]
            sym[i], sym[j] = made[r], -1
            after[i] = k
            if k < n:
                before[k] = i
                put(i, get((sym[i], sym[k]), NONE))
                put(j, NONE)
            else:
                put(i, NONE)
            p = before[i]
            if p >= 0:
                put(p, get((sym[p], sym[i]), NONE))
        return [s for s in sym if s >= 0]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs of symbols; NONE where they don't merge."""
        key = a.astype(np.int64) * PAIR + b
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def merge_many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each has."""
        size = np.array([len(w) for w in words], np.int64)
        count, parts = np.zeros(len(words), np.int64), []
        edge = 1
        while edge <= MOST_SIDE_BY_SIDE:
            of = np.flatnonzero((size <= edge) & (size > edge // 2))
            if len(of):
                sym = self._merge_class([words[k] for k in of], size[of], max(1, edge))
                kept = sym >= 0
                count[of] = kept.sum(1)
                parts.append((of, sym[kept]))
            edge *= 2
        long = np.flatnonzero(size > edge // 2)
        if len(long):
            ids = [self.encode_word(words[k].decode("utf-8", "surrogatepass")) for k in long]
            count[long] = [len(i) for i in ids]
            parts.append((long, np.concatenate([np.array(i, np.int32) for i in ids])))
        out, begin = np.empty(int(count.sum()), np.uint32), np.cumsum(count) - count
        for of, ids in parts:
            out[places(begin[of], count[of])] = ids
        return out, count

    def _merge_class(self, words: list[bytes], size: np.ndarray, leaves: int) -> np.ndarray:
        """Symbols of words of at most ``leaves`` bytes after all merges (-1: merged away): trees of equal shape, side by side."""
        n = len(words)
        raw = np.frombuffer(b"".join(words), np.uint8)
        first = np.cumsum(size) - size
        sym = np.full((n, leaves + 1), -1, np.int32)
        row = np.repeat(np.arange(n), size)
        sym[row, np.arange(len(raw)) - np.repeat(first, size)] = self.inner_ids[raw]
        sym[np.arange(n), size - 1] = self.last_ids[raw[first + size - 1]]
        if leaves == 1:
            return sym
        tree = np.full((n, 2 * leaves), NONE, np.int32)
        here, place = np.nonzero(sym[:, 1:] >= 0)
        tree[here, leaves + place] = self.ranks(sym[here, place], sym[here, place + 1])
        for k in range(leaves - 1, 0, -1):
            np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1], out=tree[:, k])
        after = np.tile(np.arange(1, leaves + 2, dtype=np.int16), (n, 1))
        before = np.tile(np.arange(-1, leaves + 1, dtype=np.int16), (n, 1))

        def put(rows: np.ndarray, at: np.ndarray, rank: np.ndarray | int) -> None:
            k = at.astype(np.int64) + leaves
            tree[rows, k] = rank
            while leaves > 1 and k[0] > 1:      # all leaves are equally deep
                k >>= 1
                tree[rows, k] = np.minimum(tree[rows, 2 * k], tree[rows, 2 * k + 1])

        rows = np.arange(n)
        while True:
            low = tree[rows, 1]
            rows = rows[low < NONE]
            if not len(rows):
                return sym
            low, k = low[low < NONE], np.ones(len(rows), np.int64)
            while k[0] < leaves:
                k *= 2
                k += tree[rows, k] != low
            i = k - leaves
            j = after[rows, i]
            far = after[rows, j]
            sym[rows, i], sym[rows, j], after[rows, i] = self.made_ids[low], -1, far
            more = far < size[rows]
            rank = np.full(len(rows), NONE, np.int32)
            if more.any():
                r, f = rows[more], far[more]
                before[r, f] = i[more]
                rank[more] = self.ranks(sym[r, i[more]], sym[r, f])
                put(r, j[more], NONE)
            put(rows, i, rank)
            p = before[rows, i]
            some = p >= 0
            if some.any():
                r, p = rows[some], p[some]
                put(r, p, self.ranks(sym[r, p], sym[r, i[some]]))

    def look_up(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and how many each has. A word is a
        string, or the id of a special one."""
        young, old = self.young, self.old
        fresh = [w for w in dict.fromkeys(words) if w not in young.number]
        again = [w for w in fresh if w in old.number]
        if again:
            young.add(again, *old.get(np.array([old.number[w] for w in again])))
        new = [w for w in fresh if w not in old.number]
        if new:
            plain = [w for w in new if not isinstance(w, int)]
            young.add(plain, *self.merge_many([w.encode("utf-8", "surrogatepass") for w in plain]))
            special = [w for w in new if isinstance(w, int)]
            young.add(special, np.array(special, np.uint32), np.ones(len(special), np.int64))
        number = young.number
        out = young.get(np.array([number[w] for w in words], np.int64))
        if len(number) > REMEMBERED or young.size > REMEMBERED_BYTES:
            self.young, self.old = Words(), young
        return out

    def words_of(self, text: str) -> Iterator[list]:
        """The words of a text in order, in runs of bounded size; special strings as their ids."""
        parts = self.cut.split(text) if self.cut and "<" in text else [text]
        for k, part in enumerate(parts):
            if k % 2:
                yield [self.special[part]]
                continue
            lo = 0
            while lo < len(part):
                hi = lo + OUT_BYTES
                if hi < len(part):      # before white space, which nothing composes with
                    gap = _SPLIT.search(part, hi)
                    hi = gap.start() if gap else len(part)
                piece = part[lo:hi]
                lo = hi
                if not piece.isascii():
                    piece = unicodedata.normalize("NFC", piece)
                    if _NEW.search(piece):
                        piece = piece.translate(_NEW_LOWER)
                    piece = piece.replace("Σ", "σ")    # lower case letter by letter
                yield split_words(piece.lower())

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        words: list = []
        marks: list[tuple[int, int]] = []

        def flush() -> None:
            ids, count = self.look_up(words)
            ends, lo = np.concatenate(([0], np.cumsum(count))), 0
            for text, k in marks:
                out[text].append(ids[ends[lo]:ends[lo + k]])
                lo += k
            words.clear()
            marks.clear()

        for t, text in enumerate(texts):
            for run in self.words_of(text):
                words += run
                marks.append((t, len(run)))
                if len(words) >= WORDS_AT_ONCE:
                    flush()
        if words:
            flush()
        return [np.concatenate(x) if len(x) > 1 else x[0] if x else np.zeros(0, np.uint32) for x in out]

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids of a whole text as little-endian 32-bit integers, and the decoded text."""
        ids = self.encode_all([text])[0]
        return ids.astype("<u4").tobytes(), b"".join(self.decoded(ids)).decode("utf-8", "surrogatepass")

    def decoded(self, ids: np.ndarray) -> Iterator[bytes]:
        """Tokens joined by blanks (the file names no decoder that would glue them), in UTF-8, in pieces."""
        for lo in range(0, len(ids), WORDS_AT_ONCE):
            some = ids[lo:lo + WORDS_AT_ONCE].astype(np.int64)
            at = self.told_at[some]
            piece = self.told[places(at, self.told_at[some + 1] - at)].tobytes()
            yield piece if lo + WORDS_AT_ONCE < len(ids) else piece[:-1]


def places(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... (size of them) for each pair, one after the other."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class Words:
    """Words and their ids in flat buffers: a word's number leads to its ids."""

    def __init__(self):
        self.number: dict = {}
        self.flat, self.begin = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64)
        self.size = 0       # bytes of words and ids

    def add(self, words: list, ids: np.ndarray, count: np.ndarray) -> None:
        n, used = len(self.number), int(self.begin[len(self.number)])
        while used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while n + len(words) >= len(self.begin):
            self.begin = np.concatenate((self.begin, np.zeros_like(self.begin)))
        self.flat[used:used + len(ids)] = ids
        self.begin[n + 1:n + 1 + len(words)] = used + np.cumsum(count)
        self.number.update(zip(words, range(n, n + len(words))))
        self.size += 4 * len(ids) + sum(len(w) if isinstance(w, str) else 4 for w in words)

    def get(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.begin[numbers]
        count = self.begin[numbers + 1] - at
        return self.flat[places(at, count)], count


_LOADED: dict[str, Bpe] = {}


def loaded(spec: str) -> Bpe:
    """The vocabulary, built once in each Python worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(spec)
    return _LOADED[key]


def digest(pieces) -> str:
    out = hashlib.sha256()
    for piece in pieces:
        out.update(piece)
    return out.hexdigest()


_TYPES = {"n_tokens": "long", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


def encode(docs: DataFrame, vocabulary: str, want: tuple[str, ...] = ("n_tokens", "ids", "decoded"),
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its id and the columns asked for in ``want``.

    ``vocabulary`` is the path of the vocabulary file on the driver; its text
    (a fixed file of under 2 MB) goes to the executors as a broadcast variable.
    ``want`` may name n_tokens, ids, decoded, ids_sha256 and decoded_sha256; the
    two digests are of the ids as little-endian unsigned 32-bit integers and
    of the decoded text in UTF-8. Nothing is shuffled; the tokens of about
    OUT_BYTES of text are in memory at a time.
    """
    src = only(docs, id=id_col, text=text_col)
    with open(vocabulary, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    id_type = src.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(spec.value)
        for batch in batches:
            for part in row_slices(batch, "text", OUT_BYTES):
                done = bpe.encode_all([text or "" for text in part.column("text").to_pylist()])
                made = {
                    "n_tokens": lambda: pa.array([len(ids) for ids in done], pa.int64()),
                    "ids": lambda: pa.ListArray.from_arrays(np.cumsum([0, *map(len, done)], dtype=np.int32), pa.array(np.concatenate(done).view(np.int32))),
                    "decoded": lambda: pa.array([b"".join(bpe.decoded(ids)) for ids in done], pa.binary()).cast(pa.string()),
                    "ids_sha256": lambda: pa.array([digest([ids.astype("<u4").tobytes()]) for ids in done], pa.string()),
                    "decoded_sha256": lambda: pa.array([digest(bpe.decoded(ids)) for ids in done], pa.string()),
                }
                yield pa.RecordBatch.from_arrays([part.column("id"), *(made[c]() for c in want)], names=[id_col, *want])

    schema = f"`{id_col}` {id_type.simpleString()}, " + ", ".join(f"{c} {_TYPES[c]}" for c in want)
    return src.mapInArrow(run, schema)
