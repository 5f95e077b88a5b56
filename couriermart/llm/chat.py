"""Chat formatting: fingerprints of nested field paths select a declarative layout.

A record is a struct that may follow any of several layouts: prompt and response fields,
instruction, input and output, a list of messages under various names. The paths of its
filled fields, hashed, are its fingerprint; a layout lists the fingerprints it reads, and a
record becomes canonical turns by the layout that owns its fingerprint. No data is looked
at to guess a layout, and adding one adds a line to ``LAYOUTS``.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Said:
    """One turn of a fixed role; several fields are joined by a blank line."""

    role: str
    paths: tuple[str, ...]


@dataclass(frozen=True)
class Listed:
    """A turn for each struct of an array; ``roles`` translates role names."""

    path: str
    role: str
    text: str
    roles: dict[str, str] = field(default_factory=dict, hash=False)


@dataclass(frozen=True)
class Layout:
    name: str
    parts: tuple[Said | Listed, ...]
    optional: tuple[str, ...] = ()

    def paths(self) -> set[str]:
        found: set[str] = set()
        for part in self.parts:
            if isinstance(part, Said):
                found.update(part.paths)
            else:
                found.update((f"{part.path}[].{part.role}", f"{part.path}[].{part.text}"))
        return found

    def fingerprints(self) -> list[str]:
        """One for each choice of the optional fields."""
        required = self.paths() - set(self.optional)
        choices = chain.from_iterable(combinations(self.optional, n) for n in range(len(self.optional) + 1))
        return [fingerprint_of(required | set(chosen)) for chosen in choices]


LAYOUTS = (
    Layout("messages", (Listed("messages", "role", "content"),)),
    Layout("system_messages", (Said("system", ("system",)), Listed("messages", "role", "content"))),
    Layout(
        "conversations",
        (Said("system", ("system",)), Listed("conversations", "from", "value", {"human": "user", "gpt": "assistant"})),
        optional=("system",),
    ),
    Layout(
        "prompt_response",
        (Said("system", ("system",)), Said("user", ("prompt",)), Said("assistant", ("response",))),
        optional=("system",),
    ),
    Layout("prompt_completion", (Said("user", ("prompt",)), Said("assistant", ("completion",)))),
    Layout(
        "instruction",
        (Said("system", ("system",)), Said("user", ("instruction", "input")), Said("assistant", ("output",))),
        optional=("system", "input"),
    ),
    Layout("question_answer", (Said("user", ("data.question",)), Said("assistant", ("data.answer",)))),
)


@dataclass(frozen=True)
class Template:
    """Markers of a turn, the strings that no text may hold as they are, and the roles that are learned.

    No control string may begin with the end of another one.
    """

    start: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    reserved: tuple[str, ...] = ("<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    learned: tuple[str, ...] = ("assistant",)

    def controls(self) -> tuple[str, ...]:
        return (self.start, self.middle, self.end, *self.reserved)


def fingerprint_of(paths: set[str]) -> str:
    """SHA-256 of the sorted paths."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def leaf_paths(schema: T.StructType, value: Column) -> dict[str, Column]:
    """Each leaf path of a struct with the test that it is filled. A list fills its leaves by being there."""
    found: dict[str, Column] = {}
    for item in schema.fields:
        inner = value.getField(item.name)
        if isinstance(item.dataType, T.StructType):
            found |= {f"{item.name}.{path}": test for path, test in leaf_paths(item.dataType, inner).items()}
        elif isinstance(item.dataType, T.ArrayType) and isinstance(item.dataType.elementType, T.StructType):
            found |= {f"{item.name}[].{leaf}": inner.isNotNull() for leaf in item.dataType.elementType.names}
        else:
            found[item.name] = inner.isNotNull()
    return found


def fingerprint(schema: T.StructType, record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """The fingerprint of each record. Paths that no layout names do not count."""
    known = set().union(*[layout.paths() for layout in layouts])
    tests = leaf_paths(schema, record)
    filled = [F.when(tests[path], F.lit(path)) for path in sorted(set(tests) & known)]
    return F.sha2(F.concat_ws("\n", *filled) if filled else F.lit(""), 256)


def _get(record: Column, path: str) -> Column:
    return reduce(lambda value, name: value.getField(name), path.split("."), record)


def _turn(role: Column, text: Column) -> Column:
    return F.struct(
        F.coalesce(role.cast("string"), F.lit("")).alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text")
    )


def _part_turns(part: Said | Listed, record: Column, there: set[str]) -> Column:
    if isinstance(part, Said):
        texts = [_get(record, path) for path in part.paths if path in there]
        if not texts:
            return F.array().cast(TURNS)
        filled = reduce(lambda a, b: a | b, [text.isNotNull() for text in texts])
        return F.when(filled, F.array(_turn(F.lit(part.role), F.concat_ws("\n\n", *texts)))).otherwise(
            F.array().cast(TURNS)
        )

    def turn(item: Column) -> Column:
        role = item.getField(part.role).cast("string")
        names = [F.when(role == old, F.lit(new)) for old, new in part.roles.items()]
        return _turn(F.coalesce(*names, role) if names else role, item.getField(part.text))

    return F.coalesce(F.transform(_get(record, part.path), turn), F.array().cast(TURNS))


def canonical_turns(
    schema: T.StructType, record: Column, mark: Column, layouts: tuple[Layout, ...] = LAYOUTS
) -> tuple[Column, Column]:
    """The layout's name and the turns, for records and their fingerprints; NULL and no turns for unknown ones."""
    there = set(leaf_paths(schema, record))
    name, turns = F.lit(None).cast("string"), F.array().cast(TURNS)
    for layout in reversed(layouts):
        if not layout.paths() - set(layout.optional) <= there:
            continue
        mine = mark.isin(layout.fingerprints())
        name = F.when(mine, F.lit(layout.name)).otherwise(name)
        turns = F.when(mine, F.concat(*[_part_turns(part, record, there) for part in layout.parts])).otherwise(turns)
    return name, turns


def escape(text: Column, template: Template = Template()) -> Column:
    """``text`` without control strings. Backslashes are doubled and a single one is put
    behind the first character of each control string, so that ``unescape`` is exact."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in template.controls():
        text = F.replace(text, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return text


def unescape(text: Column, template: Template = Template()) -> Column:
    for control in reversed(template.controls()):
        text = F.replace(text, F.lit(control[0] + "\\" + control[1:]), F.lit(control))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def gather_turns(rows: DataFrame, key: str, order: str, role: str, text: str) -> DataFrame:
    """``key, record`` with a list of messages, for rows of one turn each.

    Turns of the same number go by role and text; NULL keys make one conversation. A
    conversation is one row of training data, so it is also one row here.
    """
    turn = F.struct(F.col(order).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content"))
    return rows.groupBy(F.col(key).alias("key")).agg(F.sort_array(F.collect_list(turn)).alias("turns")).select(
        F.col("key").alias(key),
        F.struct(
            F.transform(
                "turns", lambda x: F.struct(x.getField("role").alias("role"), x.getField("content").alias("content"))
            ).alias("messages")
        ).alias("record"),
    )


def format_chats(
    records: DataFrame,
    key: str,
    record: str = "record",
    template: Template = Template(),
    layouts: tuple[Layout, ...] = LAYOUTS,
) -> DataFrame:
    """``key, fingerprint, layout, turns, segments, formatted`` for a struct column of any layouts.

    ``segments`` is the formatted text in pieces, each with ``loss``, true for what a model
    learns: the texts of the learned roles, without markers.

    NULL roles and texts are empty. A record of no known layout, NULL included, keeps its
    row: layout NULL, no turns, formatted text empty. Other columns are ignored, repeated
    rows stay, an empty table gives an empty result.
    """
    schema = records.schema[record].dataType
    marked = records.select(F.col(key), F.col(record), fingerprint(schema, F.col(record), layouts).alias("fingerprint"))
    name, turns = canonical_turns(schema, F.col(record), F.col("fingerprint"), layouts)

    def pieces(turn: Column) -> Column:
        def piece(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))

        learned = turn.getField("role").isin(*template.learned)
        opening = F.concat(F.lit(template.start), escape(turn.getField("role"), template), F.lit(template.middle))
        return F.array(
            piece(opening, F.lit(False)),
            piece(escape(turn.getField("text"), template), learned),
            piece(F.lit(template.end), F.lit(False)),
        )

    return (
        marked.select(key, "fingerprint", name.alias("layout"), turns.alias("turns"))
        .withColumn("segments", F.flatten(F.transform("turns", pieces)))
        .withColumn("formatted", F.array_join(F.col("segments.text"), ""))
    )


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns that a formatted text holds."""
    marker = "".join("\\" + c if not c.isalnum() and c != "_" else c for c in template.start)

    def turn(piece: Column) -> Column:
        body = F.substring_index(F.substring_index(piece, template.middle, -1), template.end, 1)
        return F.struct(
            unescape(F.substring_index(piece, template.middle, 1), template).alias("role"),
            unescape(body, template).alias("text"),
        )

    pieces = F.split(formatted, marker)
    return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def read_loss(segments: Column, template: Template = Template()) -> Column:
    """All text under the loss mask, in order, as it was before escaping."""
    learned = F.filter(segments, lambda x: x.getField("loss"))
    return F.array_join(F.transform(learned, lambda x: unescape(x.getField("text"), template)), "")
