"""License scan: ordered signature rules, all in DataFrame functions.

A text becomes a string of its words (A-Z in lower case, each word with a blank
on either side). A rule is looked for only where its keyword phrase stands.
Of the detections, intervals of that string, one that lies within another is
suppressed; of equal ones that of the first rule stays. Base phrases always
count, whatever covers them.

Defined results: null or empty text has no words and no labels, null places and
score 0; repeated rows give repeated results; whole texts are read, also very
long ones; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import only
from quire.llm.license_rules import BASE, phrase, rules

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))  # all of ASCII but digits and letters


def word_string(text: Column) -> Column:
    """`` w1  w2  w3 ``, or an empty string without words."""
    spaced = F.translate(F.coalesce(text, F.lit("")), _BETWEEN + _UPPER, " " * len(_BETWEEN) + _LOWER)
    # runs of blanks become two: < and > are free by now
    for old, new in ((" ", "<>"), ("><", ""), ("<>", "  ")):
        spaced = F.replace(spaced, F.lit(old), F.lit(new))
    spaced = F.trim(spaced)
    return F.when(spaced == "", "").otherwise(F.concat(F.lit(" "), spaced, F.lit(" ")))


def word_count(words: Column) -> Column:
    """Words of a word string: half its blanks."""
    return ((F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit("")))) / 2).cast("long")


def places(words: Column, said: str) -> tuple[Column, Column, Column]:
    """How often a phrase stands there, and the words where it does first and last."""
    p = phrase(said)
    there = words.contains(p)
    first = F.when(there, word_count(F.concat(words.substr(F.lit(1), F.locate(p, words) - 1))))
    # read from the end: the last place comes first
    back = F.locate(p[::-1], F.reverse(words))
    before = words.substr(F.lit(1), F.length(words) - back - len(p) + 1)
    last = F.when(there, word_count(before))
    n = F.when(there, ((F.length(words) - F.length(F.replace(words, F.lit(p), F.lit("")))) / len(p)).cast("long")).otherwise(F.lit(0).cast("long"))
    return n, first, last


def rule_array() -> Column:
    return F.array(*[F.struct(F.lit(k).alias("priority"), F.lit(label).alias("label"), F.lit(keyword).alias("keyword"), F.lit(weight).alias("weight"), F.lit(pattern).alias("pattern"))
                     for k, label, keyword, weight, pattern in rules()])


def keyword_array() -> Column:
    """The rules' keyword phrases."""
    return F.array(*[F.lit(k) for k in dict.fromkeys(r[2] for r in rules())])


def gate() -> str:
    """A pattern for the longest word of any keyword phrase, branched by first letters:
    a text without any needs no closer look."""
    branches: dict[str, list[str]] = {}
    for w in sorted({max(r[2].split(), key=len) for r in rules()}):
        branches.setdefault(w[0], []).append(w[1:])
    return " (?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in branches.items()) + ") "


def gated(words: Column) -> Column:
    """The keyword phrases that stand in a text."""
    return F.when(words.rlike(gate()), F.filter(keyword_array(), lambda k: words.contains(k))).otherwise(F.array().cast("array<string>"))


_SPAN = "struct<start:int,back:int,priority:int,label:string,weight:double>"


def detections(words: Column, keywords: Column) -> Column:
    """All matches of the rules whose keyword is there: start, minus end (so that
    longer ones sort first), priority, label, weight."""
    def of_rule(r: Column) -> Column:
        gaps, found = F.split(words, r["pattern"], -1), F.regexp_extract_all(words, r["pattern"], F.lit(0))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))

        def step(acc: Column, k: Column) -> Column:
            begin = acc["at"] + F.length(F.element_at(gaps, k))
            end = begin + F.length(F.element_at(found, k))
            span = F.struct(begin.alias("start"), (-end).alias("back"), r["priority"].alias("priority"), r["label"].alias("label"), r["weight"].alias("weight"))
            return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

        return F.when(F.size(found) > 0, F.aggregate(F.sequence(F.lit(1), F.size(found)), start, step, lambda acc: acc["spans"])).otherwise(F.array().cast(f"array<{_SPAN}>"))

    return F.flatten(F.transform(F.filter(rule_array(), lambda r: F.array_contains(keywords, r["keyword"])), of_rule))


def standing(spans: Column) -> Column:
    """The detections that lie within no other, in order."""
    start = F.struct(F.lit(0).alias("back"), F.array().cast(f"array<{_SPAN}>").alias("kept"))

    def step(acc: Column, s: Column) -> Column:
        inside = s["back"] >= acc["back"]
        return F.struct(F.least(acc["back"], s["back"]).alias("back"), F.when(inside, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(s))).alias("kept"))

    return F.aggregate(F.array_sort(spans), start, step, lambda acc: acc["kept"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word, base_labels (array),
    detections (array of start, end, label, weight in the word string), labels
    (array, sorted) and score, the largest weight that stands (base phrases: 0.5 at least)."""
    src = only(docs, id=id_col, text=text_col).select("id", word_string(F.col("text")).alias("words"))
    words = F.col("words")
    marks = [places(words, said) for said, _ in BASE]
    n_base = sum((n for n, _, _ in marks[1:]), marks[0][0])
    base = F.array_sort(F.array_compact(F.array(*[F.when(n > 0, F.lit(label)) for (n, _, _), (_, label) in zip(marks, BASE)])))
    found = src.select("id", "words", gated(words).alias("keywords"), word_count(words).alias("n_words"), n_base.alias("n_base"),
                       F.least(*[f for _, f, _ in marks]).alias("first_word"), F.greatest(*[x for _, _, x in marks]).alias("last_word"), base.alias("base_labels"))
    none = F.array().cast(f"array<{_SPAN}>")
    kept = found.withColumn("kept", F.when(F.size("keywords") > 0, standing(detections(words, F.col("keywords")))).otherwise(none)).drop("words", "keywords")
    spans = F.transform("kept", lambda s: F.struct(s["start"].alias("start"), (-s["back"]).alias("end"), s["label"].alias("label"), s["weight"].alias("weight")))
    weight = F.coalesce(F.array_max(F.transform("kept", lambda s: s["weight"])), F.lit(0.0))
    return kept.select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", spans.alias("detections"),
                       F.array_sort(F.array_union("base_labels", F.transform("kept", lambda s: s["label"]))).alias("labels"),
                       F.greatest(weight, F.when(F.col("n_base") > 0, 0.5).otherwise(0.0)).alias("score"))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def digest_sql() -> str:
    """The same digest in DuckDB's SQL, with windows over one row per detection."""
    values = ",\n".join(f"({k}, {_quoted(label)}, {_quoted(keyword)}, {weight}, {_quoted(pattern)})" for k, label, keyword, weight, pattern in rules())
    base = ", ".join(f"({_quoted(phrase(said))}, {_quoted(label)})" for said, label in BASE)
    return rf"""
    WITH rules(priority, label, keyword, weight, pattern) AS (VALUES {values}),
    base(said, label) AS (VALUES {base}),
    spaced AS (SELECT doc_id, trim(regexp_replace(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', '  ', 'g'), ' ') AS s FROM documents),
    docs AS (SELECT doc_id, CASE WHEN s = '' THEN '' ELSE ' ' || s || ' ' END AS words FROM spaced),
    hits AS (SELECT doc_id, b.label, string_split(words, b.said) AS gaps, length(b.said) AS len FROM docs, base b WHERE contains(words, b.said)),
    based AS (SELECT doc_id, sum(len(gaps) - 1) AS n_base,
                     min((length(gaps[1]) - length(replace(gaps[1], ' ', ''))) // 2) AS first_word,
                     max(((length(array_to_string(gaps[:-2], '')) - length(replace(array_to_string(gaps[:-2], ''), ' ', ''))) // 2)
                         + (len(gaps) - 2) * ((length(b2.said) - length(replace(b2.said, ' ', ''))) // 2)) AS last_word,
                     list_sort(list(DISTINCT hits.label)) AS base_labels
              FROM hits JOIN base b2 ON b2.label = hits.label GROUP BY doc_id),
    matched AS (SELECT doc_id, priority, label, weight, string_split_regex(words, pattern) AS gaps, regexp_extract_all(words, pattern) AS found
                FROM docs, rules WHERE contains(words, keyword) AND regexp_matches(words, pattern)),
    parts AS (SELECT doc_id, priority, label, weight, unnest(range(1, len(found) + 1)) AS k, gaps, found FROM matched),
    spans AS (SELECT doc_id, priority, label, weight, length(array_to_string(gaps[:k], '')) + length(array_to_string(found[:k - 1], '')) AS a,
                     length(array_to_string(gaps[:k], '')) + length(array_to_string(found[:k], '')) AS b FROM parts),
    swept AS (SELECT *, max(b) OVER (PARTITION BY doc_id ORDER BY a, b DESC, priority ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans),
    kept AS (SELECT doc_id, list(DISTINCT label) AS labels, max(weight) AS weight FROM swept WHERE reach IS NULL OR b > reach GROUP BY doc_id)
    SELECT d.doc_id, CAST((length(d.words) - length(replace(d.words, ' ', ''))) // 2 AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
           CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, array_to_string(coalesce(base_labels, []), ',') AS base_labels,
           array_to_string(list_sort(list_distinct(list_concat(coalesce(base_labels, []), coalesce(labels, [])))), ',') AS labels,
           CAST(greatest(coalesce(weight, 0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0 END) AS DOUBLE) AS score
    FROM docs d LEFT JOIN based USING (doc_id) LEFT JOIN kept USING (doc_id)
    """
