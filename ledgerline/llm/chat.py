"""Chat formatting (operator 11): conversations rendered by a compiled template, and read back.

The template (:mod:`.template`) marks every turn and escapes the control strings
inside roles and texts, so that the formatted text can be read back exactly
whatever the turns say.  ``{% generation %}`` marks what a model is trained on.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import words as W
from ledgerline.llm.template import Template, shown

#: What marks turns; a backslash before one of these, or before a backslash, makes it plain text.
OPEN, CLOSE, ROLE_END = "### ", "</turn>", "</role>"
TEMPLATE = """
{%- for turn in turns -%}
  {{ "### " }}
  {%- if turn.role == "user" -%} User
  {%- elif turn.role == "assistant" -%} Assistant
  {%- elif turn.role == "system" -%} System
  {%- else -%} Role <{{ turn.role | escape }}</role>
  {%- endif -%}
  {{ ": " }}
  {%- if turn.role == "assistant" -%}
    {% generation %}{{ turn.text | escape }}{% endgeneration %}
  {%- else -%}
    {{ turn.text | escape }}
  {%- endif -%}
  {{ "</turn>\\n" }}
{%- endfor -%}
"""
LABELS = {"User": "user", "Assistant": "assistant", "System": "system"}
OTHER = "Role <"

#: A formatted conversation longer than this comes as several rows, cut between pieces.
PART_CHARS = 1 << 20
LOSS = "array<struct<start:bigint,end:bigint>>"

_CONTROL = re.compile(r"\\|(?=###|</turn>|</role>)")
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(value: object) -> str:
    """Text with a backslash before every backslash and before every place where a control string begins."""
    return _CONTROL.sub(lambda m: "\\" + m[0], shown(value))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def template(source: str = TEMPLATE) -> Template:
    return Template(source, ["turns"], {"escape": escape})


def formatted(conversations: DataFrame, source: str = TEMPLATE, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id, part, text, loss): every conversation formatted by the template, its turns in order.

    loss: the spans (code points of the row's text, end exclusive) to be
    trained on.  A conversation over PART_CHARS characters comes in parts, to
    be joined in order; a span is never cut.  The rows of a conversation stand
    together, in order, in one partition.

    Null text or role: empty.  Null id: one conversation like any other.  Null
    turns come first; turns of equal number are ordered by role, then text;
    repeated rows are turns each.  An empty table gives no rows.  Only the four
    named columns are read, so extra columns cannot clash.  One shuffle, sorted
    by turn and spilled by Spark; a task holds two turns and a part, however long
    the conversation.  Its text is one sequence, so one task writes it.
    """
    W.small_batches(conversations.sparkSession)
    c = conversations
    d = c.select(c[id_col].alias("key"), c[turn_col].alias("turn"), F.coalesce(c[role_col].cast("string"), F.lit("")).alias("role"),
                 F.coalesce(c[text_col].cast("string"), F.lit("")).alias("text"))
    ordered = d.repartition("key").sortWithinPartitions("key", "turn", "role", "text").select("key", "role", "text")
    kind = d.schema["key"].dataType.simpleString()

    def run(batches):
        render, types = template(source).pieces, []
        turns = ((key, {"role": role, "text": text}) for key, role, text in _rows(batches, types))
        yield from _batches(((key, *part) for key, said in groupby(turns, itemgetter(0)) for part in _parts(render(turns=(t for _, t in said)))), types)

    return ordered.mapInArrow(run, f"key {kind}, part int, text string, loss {LOSS}").withColumnRenamed("key", id_col)


def _parts(pieces: Iterable[tuple[str, bool]]) -> Iterator[tuple[int, str, list[tuple[int, int]]]]:
    """(part, text, loss) of one conversation."""
    number, out, spans, at = 0, [], [], 0
    for text, trained in pieces:
        if at >= PART_CHARS and not (trained and spans and spans[-1][1] == at):
            yield number, "".join(out), spans
            number, out, spans, at = number + 1, [], [], 0
        if trained and spans and spans[-1][1] == at:
            spans[-1] = spans[-1][0], at + len(text)
        elif trained:
            spans.append((at, at + len(text)))
        out.append(text)
        at += len(text)
    yield number, "".join(out), spans


def _rows(batches: Iterable[pa.RecordBatch], types: list[pa.DataType]) -> Iterator[tuple]:
    """The batches' rows one by one; types becomes their columns' types."""
    for b in batches:
        types[:] = b.schema.types
        yield from zip(*(column.to_pylist() for column in b.columns))


def _batches(rows: Iterable[tuple], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """(key, part, text, loss) rows as Arrow batches of some PART_CHARS characters; the key's type is the first of types."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def batch() -> pa.RecordBatch:
        keys, parts, texts, loss = zip(*held)
        spans = [[{"start": a, "end": b} for a, b in s] for s in loss]
        return pa.RecordBatch.from_arrays([pa.array(keys, types[0]), pa.array(parts, pa.int32()), pa.array(texts, pa.string()), pa.array(spans, pa.list_(span))],
                                          ["key", "part", "text", "loss"])

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2]) + 64
        if size >= PART_CHARS:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


class Reader:
    """Reads formatted text back, part by part: feed it parts, take turns."""

    def __init__(self):
        self.rest = ""

    def _find(self, mark: str, at: int) -> int:
        """Where the next mark stands that no backslash makes plain; -1 if none."""
        while (found := self.rest.find(mark, at)) >= 0:
            before = found
            while before > at and self.rest[before - 1] == "\\":
                before -= 1
            if (found - before) % 2 == 0:
                return found
            at = found + 1
        return -1

    def feed(self, text: str) -> Iterator[tuple[str, str]]:
        """(role, text) of every turn that is complete."""
        self.rest += text
        at = 0
        while (stop := self._find(CLOSE + "\n", at)) >= 0:
            if not self.rest.startswith(OPEN, at):
                raise ValueError("a turn does not begin with its mark")
            head = at + len(OPEN)
            if self.rest.startswith(OTHER, head):
                end = self._find(ROLE_END, head)
                role, body = unescape(self.rest[head + len(OTHER):end]), end + len(ROLE_END)
            else:
                body = self.rest.index(":", head)
                role = LABELS[self.rest[head:body]]
            yield role, unescape(self.rest[body + 2:stop])
            at = stop + len(CLOSE) + 1
        self.rest = self.rest[at:]


def read_back(rows: DataFrame, id_col: str = "conv_id", together: bool = False) -> DataFrame:
    """(id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of the rows of :func:`formatted`.

    Turns and trained text are taken from the formatted text alone.
    turns_sha256 is over role, line feed, text, line feed a turn; loss_chars and
    loss_sha256 over all trained text, unescaped.  ``together``: the rows come
    straight from ``formatted``, so those of a conversation stand together in
    order; otherwise they are dealt out and sorted first.  No rows give none.
    """
    d = rows.select(F.col(id_col).alias("key"), "part", "text", "loss")
    if not together:
        d = d.repartition("key").sortWithinPartitions("key", "part")
    kind = d.schema["key"].dataType.simpleString()
    names = ["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def table(held: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
        types = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

    def run(batches):
        held, types = [], []
        for key, parts in groupby(_rows(batches, types), itemgetter(0)):
            reader, turns, loss, n, lost, size = Reader(), hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for _, _, text, spans in parts:
                size += len(text)
                for role, said in reader.feed(text):
                    n += 1
                    turns.update(f"{role}\n{said}\n".encode())
                for span in spans:
                    trained = unescape(text[span["start"]:span["end"]])
                    lost += len(trained)
                    loss.update(trained.encode())
            if reader.rest:
                raise ValueError("a formatted conversation ends within a turn")
            held.append((key, n, turns.hexdigest(), lost, loss.hexdigest(), size))
            if len(held) == 4096:
                yield table(held, types[0])
                held = []
        if held:
            yield table(held, types[0])

    return d.mapInArrow(run, f"key {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").withColumnRenamed("key", id_col)


#: The same digests from the table itself: the contract's texts, and the length the template and its escapes give.
ORACLE = r"""
    WITH given AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    marked AS (
        SELECT *, concat_ws(chr(10), role, text, '') AS said,
               CASE WHEN role IN ('user', 'assistant', 'system') THEN length(role) ELSE 13 + length(role) + escapes(role) END
                 + 14 + length(text) + escapes(text) AS chars
        FROM given)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(said, '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(chars) AS BIGINT) AS formatted_chars
    FROM marked GROUP BY conv_id
"""
_ESCAPES = """(length({x}) - length(replace({x}, chr(92), ''))
                 + (length({x}) - length(replace({x}, '</turn>', ''))) // 7 + (length({x}) - length(replace({x}, '</role>', ''))) // 7
                 + CASE WHEN contains({x}, '###') THEN len([i FOR i IN range(1, length({x})) IF substr({x}, i, 3) = '###']) ELSE 0 END)"""
for _column in ("role", "text"):
    ORACLE = ORACLE.replace(f"escapes({_column})", _ESCAPES.format(x=_column))
