"""Numeric column functions: vote parsing and the engagement score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An integer literal as Python's int() accepts it (ASCII digits, single
# underscores between them, optional sign, surrounding whitespace). Anything else parses to the default.
INT_LITERAL = "^\\s*[+-]?[0-9]+(_[0-9]+)*\\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_int(c, default: int = 0) -> Column:
    """integer value of a string/number column, ``default`` when it is not one.
    Numbers with a fraction are cut towards zero; a string with one is no integer."""
    c = _col(c)
    s = F.trim(c.cast("string"), F.lit(" \t\n\r\f\u000b"))
    v = F.when(F.typeof(c).rlike("^(double|float|decimal)"), c.try_cast("bigint")).when(
        s.rlike(INT_LITERAL), F.replace(s, F.lit("_"), F.lit("")).try_cast("bigint"))
    return F.coalesce(v, F.lit(default).cast("bigint"))


def engagement_score(approve, disapprove, digits: int | None = 4) -> Column:
    """(a - d) / (a + d + 1), rounded half-even to ``digits`` places.

    ``bround`` (banker's rounding) matches Python's ``round``; Spark's
    ``round`` would round 0.03125 up to 0.0313.
    """
    a = parse_int(approve).cast("double")
    d = parse_int(disapprove).cast("double")
    raw = (a - d) / (a + d + F.lit(1.0))
    return F.bround(raw, digits) if digits is not None else raw
