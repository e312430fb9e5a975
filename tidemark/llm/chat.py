"""Chat formatting: conversations rendered by a compiled template, with the loss mask, and read back from what was rendered.

Control strings within texts and roles are broken by a backslash after their first
character, and backslashes are doubled, so a mark in the output is always the template's own and
texts come back as they were.

Rows go to their conversation's task once, and stream through it in order: the template
hands on pieces, and pieces leave as parts of PART_CHARS characters or one turn.  A task holds
one part at a time, whatever a conversation's length; its order makes it one stream.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh
from .template import END, Piece, compiled

# The marks of the default template, and the control strings that texts may not hold as such.
MARKS = {"bos": "<s>", "eos": "</s>", "inst": "[INST]", "end_inst": "[/INST]", "sys": "<<SYS>>", "end_sys": "<</SYS>>", "as": "[ROLE]", "says": "[TEXT]", "end_as": "[/ROLE]"}
OTHERS = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<pad>", "<unk>")
CONTROLS = (*MARKS.values(), *OTHERS)

TEMPLATE = """
{#- Every turn ends with a mark of its own, so that turns of any roles in any order can be told apart. -#}
{{ bos }}
{%- for m in messages -%}
  {%- if m.role == 'user' -%} {{ inst ~ ' ' }}{{ m.text | escape }}{{ ' ' ~ end_inst }}
  {%- elif m.role == 'assistant' -%} {{ ' ' }}{% generation %}{{ m.text | escape }}{% endgeneration %}{{ eos }}
  {%- elif m.role == 'system' -%} {{ sys ~ '\n' }}{{ m.text | escape }}{{ '\n' ~ end_sys }}
  {%- else -%} {{ as }}{{ m.role | escape }}{{ says }}{{ m.text | escape }}{{ end_as }}
  {%- endif -%}
{%- endfor -%}
"""
#: Characters after which a part ends, at the end of a turn.
PART_CHARS = 1 << 20


class Escape:
    """Breaks the given control strings, none of which holds a backslash, and takes texts back."""

    def __init__(self, controls: Iterable[str] = CONTROLS) -> None:
        controls = sorted(set(controls))
        if any("\\" in c or len(c) < 2 for c in controls):
            raise ValueError("a control string has two characters at least, and no backslash")
        starts = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in controls)
        self._found = re.compile(rf"\\|{starts}" if starts else r"\\")
        self._broken = re.compile(r"\\(\\?)")

    def __call__(self, text: str | None) -> str:
        return self._found.sub(lambda m: m[0] + "\\", text or "")

    def back(self, text: str) -> str:
        return self._broken.sub(r"\1", text)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for first in range(0, batch.num_rows, 1024):
            yield from batch.slice(first, 1024).to_pylist()


_PARTS = pa.schema([
    ("conv_id", pa.int64()), ("added", pa.bool_()), ("part", pa.int64()), ("text", pa.string()),
    ("loss", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
])
_PARTS_DDL = "conv_id long, added boolean, part long, text string, loss array<struct<start:long,length:long>>"


class _Parts:
    """Pieces of one conversation, gathered to parts."""

    def __init__(self, conv_id: int | None, added: bool) -> None:
        self.of, self.part = (conv_id, added), 0
        self._reset()

    def _reset(self) -> None:
        self.texts: list[str] = []
        self.loss: list[list[int]] = []
        self.chars = 0

    def add(self, text: str, masked: bool) -> None:
        if masked and text:
            if self.loss and self.loss[-1][0] + self.loss[-1][1] == self.chars:
                self.loss[-1][1] += len(text)
            else:
                self.loss.append([self.chars, len(text)])
        self.texts.append(text)
        self.chars += len(text)

    def taken(self) -> dict:
        row = {"conv_id": self.of[0], "added": self.of[1], "part": self.part, "text": "".join(self.texts), "loss": [{"start": a, "length": n} for a, n in self.loss]}
        self.part += 1
        self._reset()
        return row


def _rendered(pieces: Iterator[Piece], parts: _Parts) -> Iterator[dict]:
    for piece in pieces:
        if piece is END:
            if parts.chars >= PART_CHARS:
                yield parts.taken()
        else:
            parts.add(*piece)
    if parts.texts or not parts.part:
        yield parts.taken()


def _in_batches(rows: Iterator[dict], schema: pa.Schema, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += 64 + len(row.get("text") or "")
        if chars >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _runs(rows: Iterator[dict], key: tuple[str, ...]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Neighbouring rows of equal keys; what of a run is not taken is passed over."""
    row = next(rows, None)
    while row is not None:
        of = tuple(row[k] for k in key)

        def run() -> Iterator[dict]:
            nonlocal row
            while row is not None and tuple(row[k] for k in key) == of:  # noqa: B023
                now, row = row, next(rows, None)
                yield now

        each = run()
        yield of, each
        for _ in each:
            pass


def formatted(
    conversations: DataFrame, template: str = TEMPLATE, constants: dict[str, str] | None = None, controls: Iterable[str] = CONTROLS,
    id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text", added: str | None = None,
) -> DataFrame:
    """Parts of the rendered conversations: conv_id, added, part, text, loss (spans of text under the mask).

    The rows of a conversation are taken by turn, null turns first, those of one turn by role
    and text; repeated rows are repeated turns.  Null texts and roles are empty ones.  Rows
    without a conv_id are one conversation of a null one.  An empty table gives no rows.  The
    column that `added` names, if any, tells conversations of one conv_id apart.  A part ends
    at the end of a turn; the parts of a conversation follow each other in one partition.
    """
    columns = {"conv_id": F.col(id_column).cast("long"), "added": F.col(added) if added else F.lit(False), "turn": F.col(turn_column).cast("long")}
    columns |= {"role": F.coalesce(F.col(role_column), F.lit("")), "text": F.coalesce(F.col(text_column), F.lit(""))}
    rows = conversations.select(*[c.alias(n) for n, c in columns.items()])
    ordered = rows.repartition("conv_id", "added").sortWithinPartitions("conv_id", "added", "turn", "role", "text")
    controls, constants = tuple(controls), dict(MARKS if constants is None else constants)
    compiled(template, constants, {"escape": Escape(controls)})  # an error in the template is one here

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compiled(template, constants, {"escape": Escape(controls)})
        each = (row for of, run in _runs(_rows(batches), ("conv_id", "added")) for row in _rendered(render(run), _Parts(*of)))
        yield from _in_batches(each, _PARTS)

    return ordered.mapInArrow(rendered, _PARTS_DDL)


class Reader:
    """Reads turns back from what the default template renders."""

    def __init__(self, escape: Escape) -> None:
        m, self.back = MARKS, escape.back
        self.kinds = [(m["inst"] + " ", " " + m["end_inst"], "user"), (m["sys"] + "\n", "\n" + m["end_sys"], "system"), (m["as"], m["end_as"], None), (" ", m["eos"], "assistant")]

    def __call__(self, text: str) -> Iterator[tuple[str, str]]:
        """(role, text) of each turn of one part."""
        at = len(MARKS["bos"]) if text.startswith(MARKS["bos"]) else 0
        while at < len(text):
            for begin, end, role in self.kinds:
                if text.startswith(begin, at):
                    break
            else:
                raise ValueError(f"no turn begins at {text[at : at + 40]!r}")
            close = text.index(end, at + len(begin))
            says = text[at + len(begin) : close]
            if role is None:
                named, _, says = says.partition(MARKS["says"])
                yield self.back(named), self.back(says)
            else:
                yield role, self.back(says)
            at = close + len(end)


def turns_read_back(parts: DataFrame, controls: Iterable[str] = CONTROLS, in_order: bool = False) -> DataFrame:
    """One row per conversation that the default template rendered: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    `in_order` says that the parts of a conversation follow each other in one partition, as `formatted` leaves them.
    """
    if not in_order:
        parts = parts.repartition("conv_id", "added").sortWithinPartitions("conv_id", "added", "part")
    controls = tuple(controls)
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escape = Escape(controls)
        reader = Reader(escape)

        def digests() -> Iterator[dict]:
            for (conv_id, _), run in _runs(_rows(batches), ("conv_id", "added")):
                turns, loss, n, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                for row in run:
                    for role, says in reader(row["text"]):
                        turns.update(f"{role}\n{says}\n".encode())
                        n += 1
                    for span in row["loss"]:
                        learnt = escape.back(row["text"][span["start"] : span["start"] + span["length"]])
                        loss.update(learnt.encode())
                        loss_chars += len(learnt)
                    chars += len(row["text"])
                yield {"conv_id": conv_id, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": loss_chars, "loss_sha256": loss.hexdigest(), "formatted_chars": chars}

        yield from _in_batches(digests(), schema)

    return parts.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def chat_digests(conversations: DataFrame) -> DataFrame:
    """All conversations and the one numbered -7, formatted by the default template, and read back.

    The added conversation stays apart from one of the table that has its number.
    """
    columns = conversations.columns
    flag = fresh("_added", columns)
    says = F.lit("</s>[INST] ok [/INST]")
    turns = conversations.sparkSession.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), says.alias("text"), F.lit(True).alias(flag))
    own = conversations.select("conv_id", "turn", "role", "text", F.lit(False).alias(flag))
    return turns_read_back(formatted(own.union(turns), added=flag), in_order=True)


def chat_sql() -> str:
    """The same from the rows of `conversations` themselves: a doubled backslash and a broken control string are one character more each."""
    grown = "length({0}) - length(replace({0}, '\\', ''))"
    for c in CONTROLS:
        grown += f" + (length({{0}}) - length(replace({{0}}, '{c}', ''))) // {len(c)}"
    marks = {"user": len(MARKS["inst"]) + len(MARKS["end_inst"]) + 2, "assistant": 1 + len(MARKS["eos"]), "system": len(MARKS["sys"]) + len(MARKS["end_sys"]) + 2}
    other = sum(len(MARKS[k]) for k in ("as", "says", "end_as"))
    cases = " ".join(f"WHEN '{role}' THEN {n}" for role, n in marks.items())
    return f"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(text) + {grown.format("text")} + CASE role {cases} ELSE {other} + length(role) + {grown.format("role")} END AS chars FROM rows_
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, encode(role), encode(text))) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, encode(role), encode(text)) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST({len(MARKS["bos"])} + sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
