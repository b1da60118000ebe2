"""Chat formatting by event-sourced reconstruction.

A log holds events (conversation, sequence number, message number, kind, role,
text) in any order:

* ``start``: the message begins, with its role; what it held is gone;
* ``delta``: streamed text, appended to the message;
* ``regenerate``: the answer is thrown away and streamed anew;
* ``edit``: the text is replaced by that of the event.

``messages`` deals the log out by conversation, sorts it by message and sequence
and folds it in one streaming pass: one message is in memory at a time, not a
conversation. ``render`` writes each message as a turn of the template and tells
which part of it is under the loss mask; ``parse`` reads turns back.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles each ``<``
that starts a control string gets one more ``!`` between ``<`` and ``|``; in roles
backslashes and line ends are escaped, too. Both are undone by ``parse``.

Defined results: null texts and roles are empty; null sequence numbers come
first, null message numbers and conversations are a message and a conversation
of their own; events of equal sequence are folded in the order of kind, role
and text; repeated events count as often as they stand there; an empty log
gives nothing; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import only

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
OUT_ROWS = 1024

_CONTROL = re.compile(r"<(!*)\|")
_ESCAPED = re.compile(r"<!(!*)\|")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<!\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(role: str, text: str) -> tuple[str, int, int]:
    """One turn, and the stretch of it under the loss mask (empty but for the assistant's text)."""
    head, body = f"{START}{escape_role(role)}\n", escape(text)
    end = len(head) + (len(body) if role == ASSISTANT else 0)
    return f"{head}{body}{END}\n", len(head), end


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    at = 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("not a formatted conversation")
        at = m.end()
        yield unescape_role(m[1]), unescape(m[2])
    if at != len(formatted):
        raise ValueError("not a formatted conversation")


def folded(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conversation, message, role, text) from sorted (conversation, message, kind, role, text) events."""
    key, role, parts, seen = None, "", [], False
    for conv, message, kind, who, text in rows:
        if not seen or key != (conv, message):
            if seen:
                yield *key, role, "".join(parts)
            key, role, parts, seen = (conv, message), "", [], True
        if kind == "start":
            role, parts = who or "", []
        elif kind == "delta":
            parts.append(text or "")
        elif kind == "regenerate":
            parts = []
        elif kind == "edit":
            parts = [text or ""]
    if seen:
        yield *key, role, "".join(parts)


def sorted_events(events: DataFrame, **columns: str) -> DataFrame:
    names = {c: columns.get(c, c) for c in ("conv", "message", "seq", "kind", "role", "text")}
    src = only(events, **names)
    return src.repartition("conv").sortWithinPartitions("conv", "message", "seq", "kind", "role", "text").select("conv", "message", "kind", "role", "text")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def messages(events: DataFrame, **columns: str) -> DataFrame:
    """One row per final message: conv, message, role, text, its turn in the
    template (``formatted``) and the loss mask's stretch of that (start, end)."""
    src = sorted_events(events, **columns)
    kinds = [src.schema[c].dataType.simpleString() for c in ("conv", "message")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        out: list[tuple] = []

        def batch_of(types) -> pa.RecordBatch:
            cols = list(zip(*out))
            kinds = [*types, pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["conv", "message", "role", "text", "formatted", "loss_start", "loss_end"])

        def noted() -> Iterator[pa.RecordBatch]:
            nonlocal schema
            for b in batches:
                schema = [b.schema.field(0).type, b.schema.field(1).type]
                yield b

        for conv, message, role, text in folded(_rows(noted())):
            out.append((conv, message, role, text, *render(role, text)))
            if len(out) >= OUT_ROWS:
                yield batch_of(schema)
                out.clear()
        if out:
            yield batch_of(schema)

    return src.mapInArrow(run, f"conv {kinds[0]}, message {kinds[1]}, role string, text string, formatted string, loss_start long, loss_end long")


def digests(events: DataFrame, **columns: str) -> DataFrame:
    """One row per conversation: what is read back from its formatted text, turn
    by turn, with running digests (no conversation is in memory as a whole)."""
    src = sorted_events(events, **columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        out: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        def noted() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for b in batches:
                kind = b.schema.field(0).type
                yield b

        conv, state = None, None
        for c, _, role, text in folded(_rows(noted())):
            if state is None or c != conv:
                if state:
                    out.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
                    if len(out) >= OUT_ROWS:
                        yield batch_of()
                        out.clear()
                conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            formatted, a, b = render(role, text)
            for who, said in parse(formatted):
                state[0] += 1
                state[1].update(f"{who}\n{said}\n".encode("utf-8", "surrogatepass"))
            lost = unescape(formatted[a:b])
            state[2] += len(lost)
            state[3].update(lost.encode("utf-8", "surrogatepass"))
            state[4] += len(formatted)
        if state:
            out.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
        if out:
            yield batch_of()

    kind = src.schema["conv"].dataType.simpleString()
    return src.mapInArrow(run, f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def events_of(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", piece: int = 200) -> DataFrame:
    """A log whose fold gives back a table of finished turns: each turn starts, its
    text is streamed in pieces, an assistant's after a draft that is regenerated,
    a user's with a draft that is edited away before.

    Rows of equal conversation and turn stay messages of their own: by role, then
    as they are read.
    """
    src = only(turns, conv=conv_col, turn=turn_col, role=role_col, text=text_col)
    text = F.coalesce("text", F.lit(""))

    def one(seq: int, kind: str, said):
        return F.struct(F.lit(seq).cast("long").alias("seq"), F.lit(kind).alias("kind"), said.alias("text"))

    nothing = F.lit(None).cast("string")
    pieces = F.transform(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{piece}}}"), F.lit(0)),
                         lambda said, k: F.struct((k + 4).cast("long").alias("seq"), F.lit("delta").alias("kind"), said.alias("text")))
    drafts = F.when(F.col("role") == ASSISTANT, F.array(one(1, "start", nothing), one(2, "delta", text.substr(1, 20)), one(3, "regenerate", nothing))).otherwise(
        F.array(one(1, "start", nothing), one(2, "delta", F.lit("draft")), one(3, "edit", F.lit(""))))
    message = F.struct("turn", "role", F.monotonically_increasing_id().alias("again"))
    return (src.select("conv", "role", message.alias("message"), F.concat(drafts, pieces).alias("log")).withColumn("e", F.explode("log"))
            .select("conv", "message", F.col("e.seq").alias("seq"), F.col("e.kind").alias("kind"), "role", F.col("e.text").alias("text")))
