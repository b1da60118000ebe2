"""HTML record extraction.

Spark has no HTML parser, so this is one of the few places where Python
runs per row: ``mapInPandas`` over the pages table, Arrow batches in and
out, one small streaming parser per page (stdlib ``html.parser``; no tree
is built). Semantics follow the usual soup-style ``get_text(strip=True)``:
every text node of a field element is stripped and the pieces are
concatenated with no separator; ``script``/``style`` content is ignored;
an unclosed ``<p>`` is closed by the next ``<p>`` or by the end of the
record; character references are decoded.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

_RAW_TEXT = {"script", "style"}
_AUTO_CLOSE = {"p"}


@dataclass
class FieldSpec:
    """Select elements by tag, optional class, optional id prefix."""

    tag: str
    cls: str | None = None
    id_prefix: str | None = None

    def matches(self, tag: str, attrs: dict) -> bool:
        if tag != self.tag:
            return False
        if self.cls is not None and self.cls not in (attrs.get("class") or "").split():
            return False
        if self.id_prefix is not None and not (attrs.get("id") or "").startswith(self.id_prefix):
            return False
        return True


_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


@dataclass
class _Open:
    name: str
    record: int
    level: int
    parts: list = field(default_factory=list)


class _RecordParser(HTMLParser):
    """Keeps a stack of the open elements from the outermost open record down, and which of
    them are records: a record inside a record is one of its own, and what
    stands in it belongs to both. An end tag closes everything above its
    matching start tag (implicit closes); one without a start tag is passed over."""

    def __init__(self, record: FieldSpec, fields: dict[str, FieldSpec]):
        super().__init__(convert_charrefs=True)
        self.record, self.fields = record, fields
        self.stack: list[str] = []                # open tags; empty outside records
        self.inside: list[tuple[int, int]] = []   # (number, level) of the open records
        self.raw = 0
        self.open: list[_Open] = []
        self.records: list[dict[str, list[str]]] = []

    def _pop_to(self, level: int):
        """Close every element at stack index >= level."""
        keep = []
        for o in self.open:
            if o.level >= level:
                self.records[o.record][o.name].append("".join(o.parts))
            else:
                keep.append(o)
        self.open = keep
        self.inside = [(n, at) for n, at in self.inside if at < level]
        del self.stack[level:]

    def handle_starttag(self, tag, attrs):
        if tag in _RAW_TEXT:
            self.raw += 1
            return
        a = dict(attrs)
        starts = self.record.matches(tag, a)
        if not self.inside and not starts or tag in _VOID:
            return
        if tag in _AUTO_CLOSE and self.inside:
            # within the innermost record only
            floor = self.inside[-1][1] + 1
            mine = self.stack[floor:]
            if tag in mine:
                self._pop_to(floor + len(mine) - 1 - mine[::-1].index(tag))
        self.stack.append(tag)
        for name, spec in self.fields.items():
            if self.inside and spec.matches(tag, a):
                self.open += [_Open(name, n, len(self.stack) - 1) for n, _ in self.inside]
        if starts:
            self.inside.append((len(self.records), len(self.stack) - 1))
            self.records.append({n: [] for n in self.fields})

    def handle_startendtag(self, tag, attrs):
        pass  # void elements (<br/>, <img/>) carry no text

    def handle_endtag(self, tag):
        if tag in _RAW_TEXT:
            self.raw = max(self.raw - 1, 0)
        elif tag in self.stack:
            self._pop_to(len(self.stack) - 1 - self.stack[::-1].index(tag))

    def handle_data(self, data):
        if self.raw or not self.open:
            return
        s = data.strip()
        if s:
            for o in self.open:
                o.parts.append(s)

    def close(self):
        super().close()
        self._pop_to(0)


def parse_records(html: str, record: FieldSpec, fields: dict[str, FieldSpec]) -> list[dict[str, list[str]]]:
    p = _RecordParser(record, fields)
    p.feed(html or "")
    p.close()
    return p.records


def extract(pages: DataFrame, record: FieldSpec, fields: dict[str, FieldSpec], id_col: str = "page_id",
            html_col: str = "html") -> DataFrame:
    """M1: one row per record element: (id, record_no, <field>: first text,
    <field>_all: every match's text, ...). A record without a match of a
    field gets NULL for it (the caller decides: drop or default)."""
    names = list(fields)
    id_type = pages.schema[id_col].dataType.simpleString()
    cols = ", ".join(f"{n} string, {n}_all array<string>" for n in names)
    schema = f"{id_col} {id_type}, record_no int, {cols}"

    def run(batches):
        for pdf in batches:
            out = []
            for pid, html in zip(pdf[id_col].tolist(), pdf[html_col].tolist()):
                for i, rec in enumerate(parse_records(html, record, fields), start=1):
                    row = {id_col: pid, "record_no": i}
                    for n in names:
                        row[n] = rec[n][0] if rec[n] else None
                        row[f"{n}_all"] = rec[n]
                    out.append(row)
            yield pd.DataFrame(out, columns=[id_col, "record_no"] + [c for n in names for c in (n, f"{n}_all")])

    return pages.select(id_col, html_col).mapInPandas(run, schema)
