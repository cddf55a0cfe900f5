"""Chat formatting: fingerprint a record's nested field paths, map it to canonical turns, write them under a template.

A record is a JSON text. Its shape, the tree of field names without values and their types, is hashed; the hash selects
a declarative mapping. DataFrame functions only. One record is one row: its turns are not spread over tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Fields:
    """A turn for each (role, field); a null field is an empty text."""

    turns: tuple[tuple[str, str], ...]

    def schema(self) -> list[str]:
        return [f"`{field}` string" for _, field in self.turns]

    def canonical(self, record: Column) -> Column:
        return F.array(*[F.struct(F.lit(role).alias("role"), F.coalesce(record[field], F.lit("")).alias("text")) for role, field in self.turns])


@dataclass(frozen=True)
class Messages:
    """A turn for each element of a list, with its role and text fields, and other names of roles."""

    field: str
    role: str
    text: str
    roles: tuple[tuple[str, str], ...] = ()

    def schema(self) -> list[str]:
        return [f"`{self.field}` array<struct<`{self.role}`: string, `{self.text}`: string>>"]

    def canonical(self, record: Column) -> Column:
        def turn(m: Column) -> Column:
            role = m[self.role]
            for other, name in self.roles:
                role = F.when(m[self.role] == other, name).otherwise(role)
            return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(m[self.text], F.lit("")).alias("text"))

        return F.transform(record[self.field], turn)


_MESSAGES = Messages("messages", "role", "content")
_SHARED = Messages("conversations", "from", "value", (("human", "user"), ("gpt", "assistant")))

#: Shape to mapping; an object's fields stand in order of their names.
MAPPINGS: dict[str, Fields | Messages] = {
    "OBJECT<prompt, response>": Fields((("user", "prompt"), ("assistant", "response"))),
    "OBJECT<prompt, response, system>": Fields((("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    "OBJECT<instruction, output>": Fields((("user", "instruction"), ("assistant", "output"))),
    "OBJECT<input, instruction, output>": Fields((("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    "OBJECT<messages: ARRAY<OBJECT<content, role>>>": _MESSAGES,
    "OBJECT<messages: ARRAY<VOID>>": _MESSAGES,
    "OBJECT<conversations: ARRAY<OBJECT<from, value>>>": _SHARED,
    "OBJECT<conversations: ARRAY<VOID>>": _SHARED,
}

#: The template's control strings; fixed values.
OPEN, CLOSE, LEARNED = "<|im_start|>", "<|im_end|>\n", "assistant"
#: A parsed variant holds 16 MB; of longer records the text values are emptied before the shape is taken.
VARIANT_BYTES = 16_000_000


def shape(record: Column) -> Column:
    """The tree of field names of a JSON text; null if it is none or repeats a field."""
    emptied = F.regexp_replace(record, r':\s*"[^"\\]*+(?:\\.[^"\\]*+)*+"', ':""')
    kind = F.schema_of_variant(F.try_parse_json(F.when(F.octet_length(record) > VARIANT_BYTES, emptied).otherwise(record)))
    return F.regexp_replace(kind, r": (?!OBJECT<|ARRAY<)[A-Z]+(\([0-9, ]*\))?", "")


def escaped(text: Column) -> Column:
    """`<|` never stands in the result: between `<` and `|` goes one backslash more than was there."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def _one_line(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))


def _any_line(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def _segments(turn: Column) -> Column:
    """The turn's pieces under the template; the assistant's texts are learned from."""
    learned = turn["role"] == LEARNED
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    return F.array(
        piece(F.concat(F.lit(OPEN), escaped(_one_line(turn["role"])), F.lit("\n")), F.lit(False)),
        piece(escaped(turn["text"]), learned),
        piece(F.lit(CLOSE), F.lit(False)),
    )


def canonical_turns(records: DataFrame, record: str = "record") -> DataFrame:
    """Adds `fingerprint`, a hash of the shape, and `turns`, an array of (role, text).

    A null record, a text that is no JSON and a shape without mapping have null turns; an empty list has none. A
    null role or text is empty. Rows stay as they are, repeated ones too; other columns of these names are replaced.
    """
    raw = F.col(f"`{record}`")
    fields = list(dict.fromkeys(f for m in MAPPINGS.values() for f in m.schema()))
    parsed = F.from_json(raw, ", ".join(fields), {"maxStringLen": "2147483647"})
    rows = records.withColumn("fingerprint", F.xxhash64(shape(raw))).withColumn("parsed__", parsed)
    turns = F.lit(None).cast("array<struct<role: string, text: string>>")
    for name, mapping in MAPPINGS.items():
        turns = F.when(F.col("fingerprint") == F.xxhash64(F.lit(name)), mapping.canonical(F.col("parsed__"))).otherwise(turns)
    return rows.withColumn("turns", turns).drop("parsed__")


def format_chats(records: DataFrame, record: str = "record") -> DataFrame:
    """Adds `fingerprint`, `formatted` and `segments` to records.

    `formatted` is the conversation under the template, `segments` the same text in pieces (text, loss): the pieces
    under the loss mask are the assistant's texts. Control strings inside texts and roles are escaped and come back
    by `read_back`. Records without turns (see `canonical_turns`) have null in both; an empty list gives an empty text.
    """
    rows = canonical_turns(records, record)
    rows = rows.withColumn("segments", F.flatten(F.transform("turns", _segments))).drop("turns")
    return rows.withColumn("formatted", F.when(F.col("segments").isNotNull(), F.array_join(F.transform("segments", lambda s: s["text"]), "")))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    blocks = F.split(formatted, r"<\|im_end\|>\n")

    def turn(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        role = F.substring(head, len(OPEN) + 1, 2**31 - 1)
        text = block.substr(F.length(head) + 2, F.length(block))
        return F.struct(_any_line(unescaped(role)).alias("role"), unescaped(text).alias("text"))

    return F.transform(F.slice(blocks, 1, F.size(blocks) - 1), turn)


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
