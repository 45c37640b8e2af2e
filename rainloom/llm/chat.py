"""Chat formatting with compiled templates.

Turns are rendered where they lie. Their pieces meet by conversation, sorted by turn, and are joined to the formatted
conversation, which is written in chunks of whole turns: rows (conv_id, chunk, formatted, spans), of which a
conversation's chunks in order are its text, with the loss mask as spans of code points in the chunk. Both writing and
reading back stream over a conversation, whatever its length.

Defined results: a null text is empty and a null role is the empty role; a turn without number comes first and ties are ordered
by role and text; repeated rows are turns of their own; a null conv_id is one conversation, returned as null; extra
columns are ignored; a conversation -1 of the table is one of its own, beside the control conversation of that number in
`query`; an empty table gives the control conversation alone in `query`, and no rows elsewhere."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices
from .templates import Escaper, Template

#: Users in [INST], assistants in <s>, the system in <<SYS>>, and any other role by its name.
TEMPLATE = """
{%- for m in messages -%}
{%- if m.role == 'user' %}[INST]{{ m.text | escape }}[/INST]
{%- elif m.role == 'assistant' %}<s>{% generation %}{{ m.text | escape }}{% endgeneration %}</s>
{%- elif m.role == 'system' %}<<SYS>>{{ m.text | escape }}<</SYS>>
{%- else %}<|role={{ m.role | escape }}|>{{ m.text | escape }}<|end|>
{%- endif -%}
{%- endfor -%}
"""
CONTROLS = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<|role=", "|>", "<|end|>"]
_TURN = re.compile(r"\[INST\](.*?)\[/INST\]|<s>(.*?)</s>|<<SYS>>(.*?)<</SYS>>|<\|role=(.*?)\|>(.*?)<\|end\|>", re.DOTALL)
#: A conversation that says the control strings themselves.
CONTROL_ID, CONTROL_TEXT = -1, "</s>[INST] ok [/INST]"
#: Characters after which a chunk of a formatted conversation ends.
CHUNK = 1_000_000


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn in formatted text; the whole text has to be turns."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        at = m.end()
        user, assistant, system, role, other = m.groups()
        found = ("user", user) if user is not None else ("assistant", assistant) if assistant is not None else ("system", system) if system is not None else (Escaper.unescape(role), other)
        out.append((found[0], Escaper.unescape(found[1])))
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return out


def _turns(turns: DataFrame, *keys: str) -> DataFrame:
    return turns.select(*keys, F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))


def render_turns(turns: DataFrame, source: str = TEMPLATE, controls: tuple[str, ...] = tuple(CONTROLS), key: str | None = None) -> DataFrame:
    """Rows (conv_id, turn, role, text, piece, spans): each turn's part of the formatted conversation and of its loss mask.

    key: a boolean column that is carried along and tells conversations apart as well."""
    if not Template(source, list(controls)).by_message:
        raise ValueError("the template doesn't render messages one by one; use render_conversations")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(source, list(controls))
        for batch in batches:
            for part, _ in slices(batch, "text"):
                made = [template.render(messages=[{"role": r, "text": t}]) for r, t in zip(part.column("role").to_pylist(), part.column("text").to_pylist(), strict=True)]
                cols = [pa.array([x for x, _ in made], pa.string()), pa.array([[v for s in spans for v in s] for _, spans in made], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*part.columns, *cols], [*part.schema.names, "piece", "spans"])

    keys = [key] if key else []
    return _turns(turns, *keys).mapInArrow(run, ", ".join([*(f"{k} boolean" for k in keys), "conv_id long, turn long, role string, text string, piece string, spans array<bigint>"]))


def render_conversations(turns: DataFrame, source: str = TEMPLATE, controls: tuple[str, ...] = tuple(CONTROLS)) -> DataFrame:
    """conv_id, formatted, spans. Any template; each conversation is held whole, so its longest bounds the memory."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["turn"] is not None, r["turn"] or 0, r["role"], r["text"]))
        text, spans = Template(source, list(controls)).render(messages=[{"role": r["role"], "text": r["text"]} for r in rows])
        return pa.table({"conv_id": key[0:1], "formatted": [text], "spans": pa.array([[v for s in spans for v in s]], pa.list_(pa.int64()))}, pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("spans", pa.list_(pa.int64()))]))

    return _turns(turns).groupBy("conv_id").applyInArrow(run, "conv_id long, formatted string, spans array<bigint>")


def format_conversations(pieces: DataFrame) -> DataFrame:
    """Rows (control, conv_id, chunk, formatted, spans) from rendered turns: a conversation's text is its chunks' in order."""
    names = ["control", "conv_id", "chunk", "formatted", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, chunk, size, texts, spans, rows, held = None, 0, 0, [], [], [], 0  # held: characters in rows
        kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]

        def close() -> None:
            nonlocal size, texts, spans, held
            rows.append((*current, chunk, "".join(texts), spans))
            held += size
            size, texts, spans = 0, [], []

        def flush() -> pa.RecordBatch:
            nonlocal held
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
            rows.clear()
            held = 0
            return out

        for batch in batches:
            for control, conv, piece, own in zip(*(batch.column(c).to_pylist() for c in ("control", "conv_id", "piece", "spans")), strict=True):
                if (control, conv) != current:
                    if texts:
                        close()
                    current, chunk = (control, conv), 0
                elif size >= CHUNK:
                    close()
                    chunk += 1
                spans += [size + v for v in own]
                texts.append(piece)
                size += len(piece)
                if held >= CHUNK:
                    yield flush()
        if texts:
            close()
        if rows:
            yield flush()

    ordered = pieces.repartition("control", "conv_id").sortWithinPartitions("control", "conv_id", "turn", "role", "text")
    return ordered.select("control", "conv_id", "piece", "spans").mapInArrow(run, "control boolean, conv_id long, chunk long, formatted string, spans array<bigint>")


class _Reader:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, formatted: str, spans: list[int]) -> None:
        for role, text in read_turns(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n += 1
        for a, b in zip(spans[::2], spans[1::2], strict=True):
            text = Escaper.unescape(formatted[a:b])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.chars += len(formatted)

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """Each conversation's digests, read from the chunks of its formatted text."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        current, reader, rows = None, None, []

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)
            rows.clear()
            return out

        for batch in batches:
            for control, conv, text, spans in zip(*(batch.column(c).to_pylist() for c in ("control", "conv_id", "formatted", "spans")), strict=True):
                if (control, conv) != current:
                    if reader:
                        rows.append((current[1], *reader.row()))
                    current, reader = (control, conv), _Reader()
                reader.add(text, spans)
            if rows:
                yield flush()
        if reader:
            rows.append((current[1], *reader.row()))
            yield flush()

    ordered = formatted.repartition("control", "conv_id").sortWithinPartitions("control", "conv_id", "chunk")
    return ordered.select("control", "conv_id", "formatted", "spans").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def query(conversations: DataFrame) -> DataFrame:
    """Writes the formatted conversations to the shared folder and reads them back."""
    spark = conversations.sparkSession
    own = conversations.select(F.lit(False).alias("control"), "conv_id", "turn", "role", "text")
    control = spark.createDataFrame([(True, CONTROL_ID, k, role, CONTROL_TEXT) for k, role in enumerate(("user", "assistant"))], "control boolean, conv_id long, turn long, role string, text string")
    return read_back(materialize(format_conversations(render_turns(own.unionByName(control), key="control")), "chats"))


ORACLE = """
WITH t AS (SELECT false AS control, CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT true, -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT true, -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 ELSE length(role) + 16 END + length(text)
    + list_sum([(length(text) - length(replace(text, c, ''))) / length(c) FOR c IN ['\\', '[INST]', '[/INST]', '<s>', '</s>', '<<SYS>>', '<</SYS>>', '<|role=', '|>', '<|end|>']])) AS BIGINT) AS formatted_chars
FROM t GROUP BY control, conv_id
"""
