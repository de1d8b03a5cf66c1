"""Chat formatting by schema fingerprints (operator 9).

Records come in different layouts: one turn a row, message lists, prompt and
completion, instruction with input. A record is a VARIANT; the shape of its
nested field paths, scalar types left out, is hashed, and the hash selects a
declarative ``Layout`` that says where turns, roles and texts are. Layouts
become one expression; there is no code for single formats.

Turns are formatted as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and
texts a backslash is doubled and a backslash is put after the first character
of every control string (``CONTROL``), so no text can end or open a turn, and
dropping one backslash of every pair restores the text. Line breaks in roles
become backslash n. Every segment carries the span of its loss text (whole
assistant texts); spans count code points.

Formatting is a projection: turns of one conversation need not meet.
``read_back`` digests the segments of a conversation in order, which needs
them in one task; it streams them and keeps hash states only, so a
conversation that holds a third of all rows takes no more memory than others.

Defined cases: null roles and texts are empty; a null or malformed record and
one of unknown layout give no turns and are returned by ``unmatched``; a
record's turns follow the row's ``turn``, ties by list position, role and text;
a null conversation id is one conversation; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: fixed values: the starts of control strings of public chat templates
CONTROL = r"([<\[])(\||/?s>|</?SYS>>|/?INST\])"
LOSS_ROLE = "assistant"


@dataclass(frozen=True)
class Layout:
    """Where a shape keeps its turns. Either ``turns`` is the path of a list
    whose entries have ``role`` and ``text`` fields, or ``parts`` lists (role,
    paths): the texts at the paths, joined by a blank line, in that role.
    ``names`` renames roles."""
    shape: str
    turns: str | None = None
    role: str = "role"
    text: str = "content"
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()
    names: dict[str, str] = field(default_factory=dict)


LAYOUTS = {
    "turn_row": Layout("OBJECT<role, text>", parts=(("$.role", ("$.text",)),)),
    "messages": Layout("OBJECT<messages: ARRAY<OBJECT<content, role>>>", turns="$.messages"),
    "from_value": Layout("OBJECT<conversations: ARRAY<OBJECT<from, value>>>", turns="$.conversations", role="from",
                         text="value", names={"human": "user", "gpt": "assistant"}),
    "prompt": Layout("OBJECT<completion, prompt>", parts=(("user", ("$.prompt",)), ("assistant", ("$.completion",)))),
    "instruction": Layout("OBJECT<input, instruction, output>",
                          parts=(("user", ("$.instruction", "$.input")), ("assistant", ("$.output",)))),
}


def shape_of(record: Column) -> Column:
    """The nested field paths of a record, without scalar types."""
    typed = F.schema_of_variant(record)
    return F.regexp_replace(F.regexp_replace(typed, r": (?!OBJECT|ARRAY)[A-Z_]+(\([0-9, ]*\))?", ""),
                            r"ARRAY<(?!OBJECT|ARRAY)[^<>]*>", "ARRAY<>")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(shape_of(record))


def _at(record: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(record, path, kind)


def _turns(layout: Layout, record: Column) -> Column:
    named = lambda role: F.coalesce(*[F.when(role == a, F.lit(b)) for a, b in layout.names.items()], role, F.lit(""))
    if layout.turns:
        entries = _at(record, layout.turns, f"array<struct<`{layout.role}`: string, `{layout.text}`: string>>")
        return F.transform(entries, lambda x: F.struct(named(x[layout.role]).alias("role"),
                                                       F.coalesce(x[layout.text], F.lit("")).alias("text")))
    turn = lambda role, paths: F.struct(
        named(_at(record, role) if role.startswith("$") else F.lit(role)).alias("role"),
        F.concat_ws("\n\n", *[F.when(_at(record, p) != "", _at(record, p)) for p in paths]).alias("text"))
    return F.array(*[turn(r, p) for r, p in layout.parts])


def canonical_turns(records: DataFrame, *, conv: str = "conv_id", turn: str = "turn", record: str = "record",
                    layouts=LAYOUTS) -> DataFrame:
    """One row per turn: conversation, turn, part, role, text, layout."""
    known = records.withColumn("__fp", fingerprint(F.col(record)))
    chosen, name = F.lit(None), F.lit(None)
    for key, layout in reversed(layouts.items()):
        fits = F.col("__fp") == F.xxhash64(F.lit(layout.shape))
        chosen = F.when(fits, _turns(layout, F.col(record))).otherwise(chosen)
        name = F.when(fits, F.lit(key)).otherwise(name)
    return (known.select(conv, turn, name.alias("layout"), F.posexplode(chosen).alias("part", "__turn"))
            .select(conv, turn, "part", "__turn.role", "__turn.text", "layout"))


def unmatched(records: DataFrame, *, record: str = "record", layouts=LAYOUTS) -> DataFrame:
    """The records that no layout fits, with their ``shape``."""
    shapes = [layout.shape for layout in layouts.values()]
    return (records.withColumn("shape", shape_of(F.col(record)))
            .filter(F.col("shape").isNull() | ~F.col("shape").isin(shapes)))


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\$2")


def format_turns(turns: DataFrame) -> DataFrame:
    """``turns`` with ``segment`` (the formatted turn) and the span
    ``loss_from``, ``loss_to`` inside it (null: no loss). A conversation's text
    is its segments in order of turn, part, role and text."""
    role = F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\n"))
    body = escaped(F.col("text"))
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    counts = F.col("role") == LOSS_ROLE
    return turns.withColumns({
        "segment": F.concat(head, body, F.lit(CLOSE)),
        "loss_from": F.when(counts, F.length(head)), "loss_to": F.when(counts, F.length(head) + F.length(body))})


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


_SEGMENT = re.compile(re.escape(OPEN) + r"([^\n]*)\n(.*)" + re.escape(CLOSE), re.S)
READ = ("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _digest_stream(batches):
    """Segments sorted by conversation in; one row per conversation out."""
    held = object()
    now, state = held, None

    def row():
        n, turns, chars, loss, size = state
        return [now, n, turns.hexdigest(), chars, loss.hexdigest(), size]

    for batch in batches:
        done = []
        for conv, segment, a, b in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if now is held or conv != now:
                if now is not held:
                    done.append(row())
                now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = _SEGMENT.fullmatch(segment).groups()
            state[0] += 1
            state[1].update(f"{unescaped(role)}\n{unescaped(text)}\n".encode())
            if a is not None:
                loss = unescaped(segment[a:b])
                state[2] += len(loss)
                state[3].update(loss.encode())
            state[4] += len(segment)
        if done:
            yield _rows(done)
    if now is not held:
        yield _rows([row()])


def _rows(done):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], names)


def read_back(segments: DataFrame, *, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Per conversation, parsed from the formatted segments: turns, digests of
    turns and of the text under the loss mask, characters."""
    ordered = segments.repartition(conv).sortWithinPartitions(conv, turn, "part", "role", "text")
    return ordered.select(F.col(conv).cast("long").alias("conv_id"), "segment", "loss_from", "loss_to").mapInArrow(
        _digest_stream, f"conv_id long, {READ}")
