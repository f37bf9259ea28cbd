"""Conversations formatted by a compiled template, with the spans to learn from."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaria.llm.session import let_workers_import
from vitaria.llm.templates import compile_template

#: Strings that steer a model. None is left as it is inside a role or a text.
CONTROLS = ("<|turn|>", "<|text|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]")
TEMPLATE = """\
{%- for m in messages -%}
<|turn|>{{ m.role | escape }}<|text|>
{%- if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif -%}
<|end|>{{ '\\n' }}
{%- endfor -%}"""

_PLAIN = re.compile("|".join(rf"({re.escape(c[0])})(\\*)({re.escape(c[1:])})" for c in CONTROLS))
_TURN = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>\n", re.S)


def escape(text: str | None) -> str:
    """A backslash more after the first character of every control string, whether it has some there or none."""
    return _PLAIN.sub(lambda m: "\\".join((m[m.lastindex - 2] + m[m.lastindex - 1], m[m.lastindex])), text or "")


def unescape(text: str) -> str:
    """One backslash fewer in every control string that has any."""
    return _PLAIN.sub(lambda m: m[m.lastindex - 2] + m[m.lastindex - 1][1:] + m[m.lastindex], text)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        if not (found := _TURN.match(formatted, at)):
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


_OUT = pa.schema(
    [("conv_id", pa.int64()), ("formatted", pa.string()),
     ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
)
_OUT_DDL = "conv_id long, formatted string, loss_spans array<struct<start: long, end: long>>"


def _render(template: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, {"escape": escape})

        def turns() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, len(batch), 1024):
                    some = batch.slice(at, 1024)
                    yield from zip(*(some.column(n).to_pylist() for n in ("conv_id", "role", "text")), strict=True)

        ids, texts, spans, held = [], [], [], 0
        for conv_id, rows in groupby(turns(), key=itemgetter(0)):
            out = render({"messages": [{"role": role, "text": text} for _, role, text in rows]})
            ids.append(conv_id)
            texts.append("".join(out.parts))
            spans.append([{"start": a, "end": b} for a, b in out.spans])
            held += out.length
            if held > 8 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip((ids, texts, spans), _OUT, strict=True)], schema=_OUT)
                ids, texts, spans, held = [], [], [], 0
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip((ids, texts, spans), _OUT, strict=True)], schema=_OUT)

    return run


def format_chats(
    turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", template: str = TEMPLATE
) -> DataFrame:
    """``conv_id, formatted, loss_spans`` of every conversation; spans count code points of ``formatted``.

    The template sees ``messages``, each with ``role`` and ``text``, by turn. Null roles and texts
    are empty, a null turn comes first, and turns of one number go by role and text.
    Rows without a conversation id make one conversation without an id; repeated rows
    are repeated turns. An empty table gives an empty one, other columns are not read.
    Conversations are dealt by id and sorted, and one at a time is held in memory.
    """
    let_workers_import(turns.sparkSession)
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), text_of(role).alias("role"), text_of(text).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text").mapInArrow(_render(template), _OUT_DDL)
