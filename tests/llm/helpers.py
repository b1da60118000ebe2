"""Small tables with the awkward cases every operator has to take."""

import re

LONG = "lorem ipsum dolor sit amet consectetur " * 8000
CLASHING = "id string, words string, row int, toxic string, n string, value string, pivot string, key string, cell string"


def documents(spark, rows):
    """doc_id, text and columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, *["x"] * 2, 1, *["y"] * 6) for i, t in rows], "doc_id long, text string, " + CLASHING)


def words(text):
    return re.findall("[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def rows_by_id(df, key="doc_id"):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], []).append(r)
    return out
