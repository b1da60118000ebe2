"""JSON-lines and JSON-document sources and sinks.

Parsing runs in the JVM (Jackson via ``from_json``); Python's stricter
``json.loads`` rules are restored with explicit options and guards:
single quotes are rejected, and text trailing the closing brace marks the
line bad.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from quire.functions import text as T

BAD = "_bad"
PARSE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD, "allowSingleQuotes": "false"}


def _with_corrupt(schema: StructType) -> StructType:
    if BAD in schema.fieldNames():
        return schema
    return StructType(list(schema.fields) + [StructField(BAD, StringType(), True)])


def _typed(value: Column, kind: DataType) -> Column:
    """A field's JSON text as its type, null where it doesn't fit."""
    if isinstance(kind, (StructType, ArrayType, MapType)):
        return F.from_json(value, kind, {"mode": "PERMISSIVE"})
    return value if isinstance(kind, StringType) else value.try_cast(kind)


def parse_json_lines(df: DataFrame, schema: StructType, line_col: str = "line",
                     required: Sequence[str] = (), keys: Sequence[str] = ()) -> DataFrame:
    """S1 over a column of lines: strip, skip blanks, classify each line.

    Adds ``status`` ∈ {ok, bad_json, missing_key} and the schema fields.
    A key counts as missing when absent from the object (a present null is
    kept, as a dict lookup would). Whether a line is valid doesn't depend on
    the field types: each value is read as its JSON text and cast on its own,
    and is null where it doesn't fit.
    """
    line = T.py_strip(F.col(line_col))
    x = df.select(*keys, line.alias("_line")).filter(F.col("_line") != "")
    texts = StructType([StructField(f.name, StringType(), True) for f in schema.fields if f.name != BAD])
    parsed = F.from_json(F.col("_line"), _with_corrupt(texts), PARSE_OPTIONS)
    x = x.withColumn("_p", parsed)
    bad = (F.col("_p").isNull() | F.col(f"_p.{BAD}").isNotNull()
           | ~F.col("_line").rlike("^\\{[\\s\\S]*\\}$"))
    obj_keys = F.json_object_keys(F.col("_line"))
    missing = F.lit(False)
    for k in required:
        missing = missing | ~F.coalesce(F.array_contains(obj_keys, F.lit(k)), F.lit(False))
    status = F.when(bad, F.lit("bad_json")).when(missing, F.lit("missing_key")).otherwise(F.lit("ok"))
    fields = [F.when(status == "ok", _typed(F.col(f"_p.{f.name}"), f.dataType)).alias(f.name) for f in schema.fields if f.name != BAD]
    return x.select(*keys, status.alias("status"), *fields)


def read_jsonl(spark: SparkSession, path: str, schema: StructType, required: Sequence[str] = ()) -> DataFrame:
    """Tolerant JSONL scan of files; returns all lines with ``status``."""
    raw = spark.read.text(path).select(F.col("value").alias("line"))
    return parse_json_lines(raw, schema, "line", required)


def read_jsonl_strict(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Any malformed line aborts the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("allowSingleQuotes", "false").json(path)


def parse_json_lines_strict(df: DataFrame, schema: StructType, line_col: str = "line",
                            keys: Sequence[str] = ()) -> DataFrame:
    """S2 over a column: FAILFAST parse of every non-blank line."""
    line = T.py_strip(F.col(line_col))
    x = df.select(*keys, line.alias("_line")).filter(F.col("_line") != "")
    p = F.from_json(F.col("_line"), schema, {"mode": "FAILFAST", "allowSingleQuotes": "false"})
    return x.select(*keys, p.alias("_p")).select(*keys, "_p.*")


def read_json_array(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A file holding one JSON array (or object) document."""
    r = spark.read.option("multiLine", True).option("allowSingleQuotes", "false")
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """UTF-8 JSON lines, non-ASCII unescaped, nulls kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


MANIFEST = "_manifest.json"


def write_json_document(df: DataFrame, path: str, key_col: str | None = None, order: Sequence[str] = ()) -> None:
    """One pretty JSON document (array, or object keyed by ``key_col``), written in parallel.

    Every part is a document of its own, ``[`` or ``{``, its rows, ``]`` or ``}``, so a
    multi-line reader takes the folder as it is; the parts' names in the manifest are in the
    order of the rows, and :func:`document_lines` strings them together to
    one document. With ``order`` the rows are range-partitioned and sorted, else
    they keep the order they have. A task streams its rows; nothing is gathered.
    """
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rest = [c for c in df.columns if c != key_col]
    body = F.to_json(F.struct(*rest), {"pretty": "true"})
    key = None if key_col is None else F.to_json(F.array(F.col(key_col).cast("string")))
    # the key's JSON text is that of a one-element array without its brackets
    entry = body if key is None else F.concat(key.substr(F.lit(2), F.length(key) - 2), F.lit(" : "), body)
    keyed = key_col is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = lambda rows: pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], names=["value"])
        yield lines(["{" if keyed else "["])
        first = True
        for batch in batches:
            rows = batch.column(0).to_pylist()
            if rows:
                yield lines([r if first and k == 0 else "," + r for k, r in enumerate(rows)])
                first = False
        yield lines(["}" if keyed else "]"])

    df.select(entry.alias("value")).mapInArrow(run, "value string").write.mode("overwrite").text(path)
    fs, folder = _folder(df.sparkSession, path)
    names = sorted(f.getPath().getName() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
    out = fs.create(df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, MANIFEST), True)
    try:
        out.write(bytearray(json.dumps({"keyed": keyed, "parts": names}).encode()))
    finally:
        out.close()


def _folder(spark: SparkSession, path: str):
    """The Hadoop file system and path of a folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def document_lines(spark: SparkSession, path: str) -> Iterator[str]:
    """The lines of the one document that the parts of a folder make, part after part."""
    fs, folder = _folder(spark, path)
    jvm = spark.sparkContext._jvm
    source = fs.open(jvm.org.apache.hadoop.fs.Path(folder, MANIFEST))
    try:
        manifest = json.loads(jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
    finally:
        source.close()
    yield "{" if manifest["keyed"] else "["
    first = True
    for name in manifest["parts"]:
        # one part at a time, without its brackets
        part = spark.read.text(f"{path.rstrip('/')}/{name}", wholetext=True).first()   # none: a task without rows
        lines = part["value"].rstrip("\n").split("\n")[1:-1] if part else []
        for k, line in enumerate(lines):
            yield line if first or k else "," + line
        first = first and not lines
    yield "}" if manifest["keyed"] else "]"


def set_json_field(line: str | Column, key: str, value_json: Column) -> Column:
    """Add (or overwrite) one top-level field of a JSON-object line while
    every other key passes through verbatim — the text is edited, not re-typed.
    An existing key is shadowed by the appended one (last key wins on parse)."""
    line = F.col(line) if isinstance(line, str) else line
    pair = F.concat(F.lit('"' + key.replace('"', '\\"') + '": '), value_json)
    empty = line.rlike("^\\s*\\{\\s*\\}\\s*$")
    return F.when(empty, F.concat(F.lit("{"), pair, F.lit("}"))).otherwise(
        F.concat(F.regexp_replace(line, "\\}\\s*$", ""), F.lit(", "), pair, F.lit("}")))
