"""Personal data: a semi-Markov conditional random field over bounded spans.

Text is cut into islands: lines' runs of neighbouring words that hold a digit,
an at sign or a bracketed "at". In an island every span of at most
``MAX_TOKENS`` tokens is a candidate segment; features of the whole span
(shape, digit count, separators, check digits, what stands around it) are
scored for each kind, all other tokens are single "other" segments, and a
dynamic programme chooses boundaries and kinds together. The weights are
fitted here by maximum likelihood on islands made from templates, a bounded
training set (``TRAIN_ISLANDS``) with known spans.

Base patterns (see ``base_spans``) are found on their own in the whole text
and always stay; the model's spans are added where they overlap none of them.

Defined results: null or empty text has no spans; repeated rows give repeated
results; spans are in code points, end exclusive; very long texts are read
whole, with work linear in their length; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from quire.llm.common import only, row_slices

KINDS = ("email", "ip", "card", "phone")
ORDER = {k: i for i, k in enumerate(KINDS)}
MAX_TOKENS = 16       # longest entity, in tokens
MAX_BACK = 128        # characters that a word may reach back from its first digit or at sign
TRAIN_ISLANDS = 600   # islands made for training
EPOCHS, RATE, SHRINK, SEED = 8, 0.3, 1e-4, 7

# fixed values: the base patterns
_EMAIL_AT = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_IP_RUN = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_HINT = re.compile(r"[0-9@]|[(\[{] ?at ?[)\]}]", re.I)
_JOIN = re.compile(r"\([0-9]|[(\[{](?:at|dot)[)\]}]", re.I)
_TOKEN = re.compile(r"[A-Za-z0-9]+|[^A-Za-z0-9]", re.S)
_AT = re.compile(r"@| ?[(\[{] ?at ?[)\]}] ?", re.I)
_DOT = re.compile(r"\.| ?[(\[{] ?dot ?[)\]}] ?", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches. A search starts only where a run of
    local-part characters starts, or right behind the last match, so long
    runs without an at sign cost linear time."""
    at, n = text.find("@"), 0
    while at >= 0:
        m = _EMAIL_AT.match(text, n) if n else None
        m = m or _EMAIL.search(text, n)
        if not m:
            return
        yield m.span()
        n = m.end()
        at = text.find("@", n)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """As for e-mails: within a run of digits only the first start can match first."""
    n = 0
    while True:
        m = _IP.match(text, n) if n and n < len(text) and text[n].isdigit() and text[n].isascii() else None
        m = m or _IP_RUN.search(text, n)
        if not m:
            return
        yield m.span()
        n = m.end()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) of the base patterns, sorted by start, then kind."""
    out: list[tuple[int, int, str]] = []
    if "@" in text:
        out += [(a, b, "email") for a, b in _emails(text)]
    if "." in text:
        for a, b in _ips(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:] if len(p) > 3 else p) <= 255 for p in text[a:b].split(".")):
                out.append((a, b, "ip"))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((*m.span(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                out.append((*m.span(), "phone"))
    out.sort(key=lambda s: (s[0], ORDER[s[2]], s[1]))
    return out


def islands(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of one line in which neighbouring words hold a digit or an at sign."""
    m = _HINT.search(text)
    while m:
        lo = m.start()
        floor = max(0, lo - MAX_BACK)
        while lo > floor and not text[lo - 1].isspace():
            lo -= 1
        wordy = not (m[0].isdigit() or m[0] == "@")  # a bracketed "at" stands between two words
        if wordy and lo > floor and text[lo - 1] == " ":
            lo -= 1
            while lo > floor and not text[lo - 1].isspace():
                lo -= 1
        hi, end = m.end(), len(text)
        while True:
            while hi < end and not text[hi].isspace():
                hi += 1
            # the next word joins if it holds a hint, too
            if hi + 1 < end and text[hi] in " \t" and not text[hi + 1].isspace():
                stop = hi + 1
                while stop < end and not text[stop].isspace():
                    stop += 1
                if wordy or _HINT.search(text, hi, stop) or text[hi + 1] in "([{" and _JOIN.match(text, hi + 1):
                    wordy = text[stop - 1] in ")]}" and bool(_JOIN.match(text, hi + 1))
                    hi = stop
                    continue
            break
        yield lo, hi
        m = _HINT.search(text, hi)


def _shape(span: str) -> str:
    out = []
    for c in span:
        k = "9" if c.isdigit() else "a" if c.isalpha() else c
        if not out or out[-1] != k or k not in "9a":
            out.append(k)
    return "".join(out[:24])


def features(text: str, a: int, b: int) -> list[str]:
    """Features of the whole span text[a:b] and of its neighbours."""
    s = text[a:b]
    digits = "".join(c for c in s if c in "0123456789")
    nd = len(digits)
    before, after = text[a - 1:a], text[b:b + 1]
    lead = text[max(0, a - 12):a].lower()
    ats = len(_AT.findall(s))
    f = [f"nd{min(nd, 20)}", "at" + str(min(ats, 2))]
    f.append("left" + ("x" if before.isalnum() or before in "@+%_" and before else "-" if before in "-./=$#:" and before else "ok"))
    on = bool(after) and after in ".-_+" and text[b + 1:b + 2].isalnum()  # the word goes on behind a dot or dash
    f.append("right" + ("x" if after.isalnum() or after in "@%_" and after else "more" if on else "-" if after in "-/=$#:%" and after else "ok"))
    letters = any(c.isalpha() for c in s)
    f.append(f"letters{int(letters)}")
    if ats == 1:
        local, domain = _AT.split(s, maxsplit=1)
        parts = _DOT.split(domain)
        good = bool(re.fullmatch(r"[A-Za-z0-9._%+-]+", local)) and len(parts) > 1 and all(re.fullmatch(r"[A-Za-z0-9-]+", p) for p in parts)
        f.append(f"mail{int(good)}")
        f.append(f"top{int(good and parts[-1].isalpha() and 2 <= len(parts[-1]) <= 6)}")
    if not letters and not ats:
        f.append("shape" + _shape(s))
        f.append(f"edge{int(s[0] in '+(' or s[0].isdigit())}{int(s[-1].isdigit())}")
        groups = re.findall(r"[0-9]+", s)
        f.append("groups" + "".join(str(min(len(g), 5)) for g in groups[:8]))
        f.append(f"plus{int(s[0] == '+')}paren{int('(' in s and ')' in s)}")
        f.append("sep" + "".join(sorted({c for c in s if not c.isdigit()}))[:6])
        if len(groups) == 4 and re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", s):
            f.append(f"octets{int(all(int(g) <= 255 for g in groups))}")
        if 14 <= nd <= 19:
            f.append(f"check{int(luhn(digits))}")
    for w in ("tel", "phone", "call", "mail", "card", "ip", "host", "version", "v"):
        if w in re.findall(r"[a-z]+", lead):
            f.append("lead-" + w)
    return f


class SemiMarkov:
    """Weights of features by kind; scores and decodes islands."""

    def __init__(self, weights: dict[str, list[float]] | None = None):
        self.w = weights or {}

    def lattice(self, text: str, lo: int, hi: int) -> tuple[list[int], list[list[tuple[int, list[str]]]]]:
        """Token borders, and for each token end the candidate (first token, features) spans."""
        borders = [m.start() + lo for m in _TOKEN.finditer(text[lo:hi])] + [hi]
        digit_sum = [0]
        hint = [0]
        for a, b in zip(borders, borders[1:]):
            s = text[a:b]
            digit_sum.append(digit_sum[-1] + sum(c in "0123456789" for c in s))
            hint.append(hint[-1] + (s == "@" or s.lower() == "at"))
        cands: list[list[tuple[int, list[str]]]] = [[]]
        for j in range(1, len(borders)):
            here: list[tuple[int, list[str]]] = []
            last = text[borders[j] - 1]
            if last.isascii() and last.isalnum():
                for i in range(max(0, j - MAX_TOKENS), j):
                    c = text[borders[i]]
                    if not (c.isascii() and c.isalnum() or c in "+(") or digit_sum[j] - digit_sum[i] < 4 and hint[j] == hint[i]:
                        continue
                    # a span without an at sign has no letters
                    if hint[j] == hint[i] and any(x.isalpha() for x in text[borders[i]:borders[j]]):
                        continue
                    here.append((i, features(text, borders[i], borders[j])))
            cands.append(here)
        return borders, cands

    def scores(self, feats: list[str]) -> list[float]:
        out = [0.0] * len(KINDS)
        for f in feats:
            if w := self.w.get(f):
                for k, x in enumerate(w):
                    out[k] += x
        return out

    def decode(self, text: str, lo: int, hi: int) -> list[tuple[int, int, str]]:
        """The best segmentation; "other" tokens score 0, so a span needs a positive score."""
        borders, cands = self.lattice(text, lo, hi)
        best: list[float] = [0.0]
        back: list[tuple[int, int]] = [(0, -1)]
        for j in range(1, len(borders)):
            top, how = best[j - 1], (j - 1, -1)
            for i, feats in cands[j]:
                for k, s in enumerate(self.scores(feats)):
                    if best[i] + s > top + 1e-12:
                        top, how = best[i] + s, (i, k)
            best.append(top)
            back.append(how)
        out, j = [], len(borders) - 1
        while j:
            i, k = back[j]
            if k >= 0:
                out.append((borders[i], borders[j], KINDS[k]))
            j = i
        return out[::-1]

    def fit(self, examples: list[tuple[str, list[tuple[int, int, str]]]], seed: int = SEED) -> SemiMarkov:
        """Stochastic gradient of the log-likelihood, by forward and backward sums over segmentations."""
        rng = random.Random(seed)
        data = []
        for text, spans in examples:
            for lo, hi in islands(text):
                borders, cands = self.lattice(text, lo, hi)
                at = {b: k for k, b in enumerate(borders)}
                gold = {(at[a], at[b], ORDER[k]) for a, b, k in spans if a in at and b in at and lo <= a and b <= hi}
                data.append((cands, gold))
        for epoch in range(EPOCHS):
            rng.shuffle(data)
            rate = RATE / (1 + epoch)
            for cands, gold in data:
                m = len(cands)
                scored = [[(i, feats, self.scores(feats)) for i, feats in c] for c in cands]
                fwd = [0.0] * m
                for j in range(1, m):
                    fwd[j] = _logsum([fwd[j - 1], *(fwd[i] + s for i, _, ss in scored[j] for s in ss)])
                bwd: list[list[float]] = [[] for _ in range(m)]
                b = [0.0] * m
                for j in range(m - 1, 0, -1):
                    b[j] = _logsum(bwd[j]) if j < m - 1 else 0.0
                    bwd[j - 1].append(b[j])
                    for i, _, ss in scored[j]:
                        bwd[i] += [b[j] + s for s in ss]
                z = fwd[m - 1]
                for j in range(1, m):
                    for i, feats, ss in scored[j]:
                        for k, s in enumerate(ss):
                            step = ((i, j, k) in gold) - math.exp(min(0.0, fwd[i] + s + b[j] - z))
                            if abs(step) < 1e-4:
                                continue
                            for f in feats:
                                w = self.w.setdefault(f, [0.0] * len(KINDS))
                                w[k] += rate * (step - SHRINK * w[k])
        return self


def _logsum(xs: list[float]) -> float:
    top = max(xs)
    return top + math.log(sum(math.exp(x - top) for x in xs))


def examples(n: int, seed: int) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Lines made from templates, with the spans they hold."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda: "".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randint(2, 8)))

    def email() -> str:
        local = word() + rng.choice(["", ".", "_", "-", "+"]) * 1
        local = (local + word() if not local[-1].isalnum() else local) + rng.choice(["", "", digits(2), "." + digits(2)])
        at = rng.choice(["@"] * 5 + ["(at)", " (at) ", "[at]", " [at] "])
        dot = "." if "@" in at or rng.random() < 0.5 else rng.choice(["(dot)", " (dot) ", "[dot]"])
        return local + at + dot.join([word() + rng.choice(["", digits(1)]), *([word()] if rng.random() < 0.5 else []), rng.choice(["com", "org", "net", "de", "fr", "io"])])

    def ip() -> str:
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))

    def card() -> str:
        body = rng.choice("3456") + digits(rng.choice([13, 14, 14, 14, 15]))
        num = next(body + str(c) for c in range(10) if luhn(body + str(c)))
        sep = rng.choice(["", "", " ", "-"])
        return sep.join(num[k:k + 4] for k in range(0, len(num), 4))

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return rng.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{digits(2)} {a} {b} {c}", f"+{digits(2)} {digits(2)} {digits(4)} {digits(4)}", f"+1{a}{b}{c}", f"+1-{a}-{b}-{c}"])

    def other() -> str:
        y, hexed = rng.randint(1900, 2030), "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([18, 32, 40])))
        bad = digits(16)
        while luhn(bad):
            bad = digits(16)
        return rng.choice([
            f"version {rng.randint(0, 9)}.{rng.randint(0, 20)}", f"{y}-{digits(2)}-{digits(2)}", f"{digits(2)}/{digits(2)}/{y}", f"{digits(2)}:{digits(2)}:{digits(2)}",
            f"${digits(3)}.{digits(2)}", str(y), digits(rng.randint(1, 8)), f"{digits(1)},{digits(3)},{digits(3)}", f"password={hexed}", f'token = "{hexed}"',
            f"AKIA{''.join(rng.choice('ABCDEFGHJKLMNPQRSTUVWXYZ0123456789') for _ in range(16))}", f"{digits(3)}.{digits(3)}.{digits(2)}", f"#{digits(9)}", f"pp. {digits(3)}-{digits(3)}",
            f"{digits(3)} {digits(4)}", bad, f"ISBN {digits(3)}-{digits(1)}-{digits(4)}-{digits(4)}-{digits(1)}", f"{digits(2)} {digits(3)} {digits(2)} {digits(3)}", f"{y} {y + 1} {y + 2}", f"@{word()}{digits(2)}", f"id {digits(12)}", f"{rng.randint(256, 999)}.{digits(3)}.{digits(3)}.{digits(3)}",
        ])

    out = []
    makers = {"email": email, "ip": ip, "card": card, "phone": phone}
    for _ in range(n):
        text, spans = "", []
        for _ in range(rng.choice([1, 1, 1, 2])):
            text += " ".join(word() for _ in range(rng.randint(0, 3)))
            text += " " if text and text[-1] != " " else ""
            if rng.random() < 0.55:
                kind = rng.choice(KINDS)
                lead = rng.choice(["", "", "", {"email": "mail: ", "ip": "host ", "card": "card ", "phone": "tel: "}[kind]])
                s = makers[kind]()
                text += lead
                spans.append((len(text), len(text) + len(s), kind))
                text += s + rng.choice(["", "", ".", ","]) + " "
            else:
                text += other() + rng.choice(["", "", ".", ","]) + " "
        out.append((text + " ".join(word() for _ in range(rng.randint(0, 2))), spans))
    return out


def train(n: int = TRAIN_ISLANDS, seed: int = SEED) -> SemiMarkov:
    return SemiMarkov().fit(examples(n, seed), seed)


@lru_cache(maxsize=1)
def trained() -> SemiMarkov:
    return train()


def all_spans(model: SemiMarkov, text: str, seen: dict | None = None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and all spans: base ones and the model's that overlap none of them."""
    if not _HINT.search(text):
        return [], []
    base = base_spans(text)
    added = []
    taken, k = sorted((a, b) for a, b, _ in base), 0
    for lo, hi in islands(text):
        # short islands without much in them (years, versions) need no lattice
        piece = text[lo:hi]
        if sum(c in "0123456789" for c in piece) < 4 and "@" not in piece and not _AT.search(piece):
            continue
        for a, b, kind in model.decode(text, lo, hi):
            while k < len(taken) and taken[k][1] <= a:
                k += 1
            if not any(x < b and a < y for x, y in taken[max(0, k - 4):k + 4]):
                added.append((a, b, kind))
    spans = sorted(base + added, key=lambda s: (s[0], ORDER[s[2]], s[1]))
    return base, spans


def told(spans: list[tuple[int, int, str]]) -> str:
    return ",".join([f"{k}:{a}:{b}" for a, b, k in spans])


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each stretch of overlapping spans replaced by its first kind in capitals."""
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, base spans and all spans as arrays of
    (start, end, kind). Nothing is shuffled; the model is fitted on the driver
    and its few weights go along with the function."""
    src = only(docs, id=id_col, text=text_col)
    weights = trained().w
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = SemiMarkov(weights)
        names = ("start", "end", "kind")
        for batch in batches:
            base, spans = [], []
            for t in batch.column("text"):
                b, s = all_spans(model, t.as_py() or "")
                base.append([dict(zip(names, x)) for x in b])
                spans.append([dict(zip(names, x)) for x in s])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(base, span), pa.array(spans, span)], names=[id_col, "base", "spans"])

    kind = "array<struct<start:bigint,end:bigint,kind:string>>"
    return src.mapInArrow(run, f"`{id_col}` {src.schema['id'].dataType.simpleString()}, base {kind}, spans {kind}")


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The input with every span in ``text_col`` replaced; all other columns as they were."""
    weights = trained().w
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = SemiMarkov(weights)
        for batch in batches:
            named = pa.RecordBatch.from_arrays(batch.columns, names=[str(k) for k in range(batch.num_columns)])
            for part in row_slices(named, str(place)):
                out = []
                for t in part.column(place):
                    t = t.as_py()
                    out.append(t and redact(t, all_spans(model, t)[1]))
                cols = list(part.columns)
                cols[place] = pa.array(out, type=batch.schema.field(place).type)
                yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
