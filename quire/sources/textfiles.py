"""Line, block and pipe-record text sources.

Each works on a DataFrame holding file contents in a string column (one row
per file, or per record of a larger file), so the same operator serves
``spark.read.text(path, wholetext=True)`` and text columns of tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T

# Python text-mode reading turns \r\n and \r into \n before splitting lines.
LINE_BREAK = "\r\n|\r|\n"


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content): one row per file."""
    return (spark.read.option("wholetext", True).text(path)
            .select(F.input_file_name().alias("path"), F.col("value").alias("content")))


def lines(df: DataFrame, col: str = "content", keys: tuple[str, ...] = ()) -> DataFrame:
    """Stripped non-blank lines with their 1-based line number in the file."""
    x = df.select(*keys, F.posexplode(F.split(F.col(col), LINE_BREAK)).alias("_pos", "_line"))
    return (x.select(*keys, (F.col("_pos") + 1).cast("bigint").alias("line_no"),
                     T.py_strip(F.col("_line")).alias("line"))
            .filter(F.col("line") != ""))


def blocks(df: DataFrame, col: str = "content", keys: tuple[str, ...] = ()) -> DataFrame:
    """Blank-line ("\\n\\n") separated blocks, stripped, empties dropped,
    numbered 1.. among the kept blocks."""
    parts = F.transform(F.split(F.col(col), "\n\n"), lambda b: T.py_strip(b))
    kept = F.filter(parts, lambda b: b != "")
    x = df.select(*keys, F.posexplode(kept).alias("_pos", "block"))
    return x.select(*keys, (F.col("_pos") + 1).cast("bigint").alias("block_no"), "block")


def pipe_prompt(line_col: str = "line", tag: str = "engagement"):
    """S8 + F16: ``score|topic[|topic...]`` → ``[tag:score] [t1] [t2]\\nIspovest:``."""
    parts = F.transform(F.split(F.col(line_col), "\\|"), lambda p: T.py_strip(p))
    score = F.element_at(parts, 1)
    topics = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    tokens = F.array_join(F.transform(topics, lambda t: F.concat(F.lit("["), t, F.lit("]"))), " ")
    prompt = F.concat(F.lit(f"[{tag}:"), score, F.lit("] "), tokens, F.lit("\n" + T.PREFIX.rstrip("\n")))
    return score, topics, prompt


def continuation(generated, prompt):
    """generated text after the prompt prefix, stripped."""
    g = F.col(generated) if isinstance(generated, str) else generated
    p = F.col(prompt) if isinstance(prompt, str) else prompt
    return T.py_strip(F.substring(g, F.length(p) + 1, 1 << 30))
