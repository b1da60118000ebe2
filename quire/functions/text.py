"""Column functions over text.

Everything here is a Catalyst expression except Unicode normalisation,
which Spark lacks; that one goes through an Arrow-batched pandas UDF and
only non-ASCII rows carry data into it.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# ---- fixed values (must equal the studied pipeline's for equal results) ----
# Corpus prefix written in front of every cleaned post.
PREFIX = "Ispovest:\n"
# Invisible characters deleted by the cleaner: U+200B..U+200F and U+202A..U+202E.
ZERO_WIDTH_CLASS = "[\\x{200B}-\\x{200F}\\x{202A}-\\x{202E}]"
# Python's str.isspace() set (what `\s`, `split()` and `strip()` use on str),
# written as one class valid in both Java regex and RE2.
PY_SPACE_CLASS = ("[\\t\\n\\x{0B}\\f\\r\\x{1C}-\\x{1F} \\x{85}\\x{A0}\\x{1680}"
                  "\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]")
PY_SPACES = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
ASCII_ONLY = "^[\\x{00}-\\x{7F}]*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace (a trim looks at the ends alone,
    a pattern tries every run of whitespace in the text)."""
    return F.btrim(_col(c), F.lit(PY_SPACES))


def py_collapse(c) -> Column:
    """Python ``re.sub(r"\\s+", " ", s)``."""
    return F.regexp_replace(_col(c), f"{PY_SPACE_CLASS}+", " ")


def py_split_join(c) -> Column:
    """Python ``" ".join(s.split())``: strip then collapse whitespace runs."""
    return py_collapse(py_strip(c))


def _normalizer(form: str):
    @F.pandas_udf(StringType())
    def _norm(s: pd.Series) -> pd.Series:
        return s.map(lambda x: unicodedata.normalize(form, x) if isinstance(x, str) else None)

    _norm.__name__ = f"unicode_{form.lower()}"
    # The function is pure; declaring it non-deterministic keeps Catalyst from
    # inlining it into pushed-down filters (which would evaluate the UDF and
    # everything around it twice, the first time below any repartition).
    return _norm.asNondeterministic()


_NFKC = _normalizer("NFKC")
_NFC = _normalizer("NFC")


def unicode_normalize(c, form: str = "NFC") -> Column:
    """NFC/NFKC normalisation; ASCII rows (already normal) bypass Python.

    The UDF receives NULL for ASCII rows, so only non-ASCII texts cross
    the JVM/Python boundary; the result falls back to the input.
    """
    c = _col(c)
    fn = {"NFKC": _NFKC, "NFC": _NFC}[form.upper()]
    non_ascii = F.when(~c.rlike(ASCII_ONLY), c)
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(F.coalesce(fn(non_ascii), c))


def clean_text(c) -> Column:
    """null/empty → ''; NFKC; NBSP → space; drop zero-width; collapse; strip."""
    c = F.coalesce(_col(c), F.lit(""))
    t = unicode_normalize(c, "NFKC")
    t = F.replace(t, F.lit("\u00a0"), F.lit(" "))
    t = F.regexp_replace(t, ZERO_WIDTH_CLASS, "")
    return py_strip(py_collapse(t))


def strip_prefix_everywhere(c) -> Column:
    """Delete every occurrence of the corpus prefix (not only a leading one)."""
    return F.replace(_col(c), F.lit(PREFIX), F.lit(""))


def normalize_light(c) -> Column:
    """delete prefix everywhere, strip, lower."""
    return F.lower(py_strip(strip_prefix_everywhere(c)))


def normalize_key(c, form: str = "NFC") -> Column:
    """delete prefix, lower, strip, collapse whitespace, Unicode form last."""
    t = F.lower(strip_prefix_everywhere(F.coalesce(_col(c), F.lit(""))))
    return unicode_normalize(py_collapse(py_strip(t)), form)


def content_hash(c) -> Column:
    """SHA-256 hex of lower-cased text with whitespace runs collapsed."""
    return F.sha2(py_split_join(F.lower(_col(c))), 256)


def add_prefix(c) -> Column:
    """prefix a cleaned text."""
    return F.concat(F.lit(PREFIX), _col(c))


def topic_norm(c) -> Column:
    """strip + lower."""
    return F.lower(py_strip(c))


# ---- numbered topic lines (F7, F8) ----
TOPIC_LINE = f"^([0-9]+){PY_SPACE_CLASS}+(.*)$"


def topic_line_id(c) -> Column:
    return F.regexp_extract(_col(c), TOPIC_LINE, 1).try_cast("bigint")


def topic_line_name(c) -> Column:
    """Text after the number, cut at the first ``\\s*(`` and stripped."""
    rest = py_strip(F.regexp_extract(_col(c), TOPIC_LINE, 2))
    return py_strip(F.regexp_replace(rest, f"(?s){PY_SPACE_CLASS}*\\(.*$", ""))


def strip_third_tag(c) -> Column:
    """if a text holds more than two ``[...]`` groups, delete every
    occurrence of the third group's text, strip, and squeeze runs of two or
    more whitespace characters to one space."""
    c = _col(c)
    groups = F.regexp_extract_all(c, F.lit("(?d)(\\[.*?\\])"), 1)
    third = F.element_at(groups, 3)
    removed = py_strip(F.replace(c, third, F.lit("")))
    squeezed = F.regexp_replace(removed, f"{PY_SPACE_CLASS}{{2,}}", " ")
    return F.when(F.size(groups) > 2, squeezed).otherwise(c)
