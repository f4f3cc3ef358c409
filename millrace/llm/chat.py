"""Chat formatting: heterogeneous records to canonical turns, then to one text.

Every record's layout is told by a fingerprint: the hash of those of its nested
field paths that a layout knows. A fingerprint selects a declarative mapping,
which says where roles and texts are. Other fields are ignored, and of several
layouts that a record holds, the one with the most paths is taken. Records may be typed columns (one layout per table) or JSON text
(any mixture of layouts). Conversations given by turn become JSON records first.

A formatted conversation is a row of turns: ``<|turn|>``, the role,
``<|text|>``, the text, ``<|end|>``. Inside roles and texts, every control
string gets a backslash behind its first character, so that no text can make a
turn and formatting can be undone. The loss mask is a list of spans, in code
points, of the assistants' texts in escaped form.

Defined results: a null text is empty, a null role is empty; turns are ordered
by number, nulls first, ties by role and text; repeated turns are kept; a null
conversation id is one conversation of its own; a record with an unknown
layout, or one that is not JSON, gets null turns; an empty table gives no rows.
Other columns of the input are ignored. Only built-in functions are used.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
OPEN = "<|"
#: Strings of common templates; none of them may stand unescaped in a text either.
FOREIGN = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
TURNS = "array<struct<role:string,text:string>>"
#: Texts of any length; the parser's own limit would lose the whole record.
JSON = {"maxStringLen": "2147483647"}


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record are.

    ``turns`` names a list with ``role`` and ``text`` fields; otherwise
    ``parts`` lists (field, role) in order, where fields of one role that
    follow each other are one turn, joined by an empty line.
    """

    paths: tuple[str, ...]
    turns: str | None = None
    role: str | None = None
    text: str | None = None
    parts: tuple[tuple[str, str], ...] = ()


LAYOUTS: tuple[Layout, ...] = (
    Layout(("messages[].content", "messages[].role"), "messages", "role", "content"),
    Layout(("conversations[].from", "conversations[].value"), "conversations", "from", "value"),
    Layout(("turns[].role", "turns[].text"), "turns", "role", "text"),
    Layout(("prompt", "response"), parts=(("prompt", "user"), ("response", "assistant"))),
    Layout(("completion", "prompt"), parts=(("prompt", "user"), ("completion", "assistant"))),
    Layout(("answer", "question"), parts=(("question", "user"), ("answer", "assistant"))),
    Layout(("instruction", "output"), parts=(("instruction", "user"), ("output", "assistant"))),
    Layout(
        ("input", "instruction", "output"),
        parts=(("instruction", "user"), ("input", "user"), ("output", "assistant")),
    ),
    Layout(
        ("prompt", "response", "system"),
        parts=(("system", "system"), ("prompt", "user"), ("response", "assistant")),
    ),
)


def paths_of(kind: T.DataType, at: str = "") -> list[str]:
    """The nested field paths of a type, leaves only."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in paths_of(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return paths_of(kind.elementType, f"{at}[]")
    return [at]


def fingerprint(paths: Column) -> Column:
    """The hash of a set of field paths."""
    return F.xxhash64(F.array_join(F.sort_array(F.array_distinct(paths)), "\n"))


def listed(paths: Sequence[str]) -> Column:
    return F.array(*(F.lit(p) for p in sorted(paths)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def selected(
    have: Column, layouts: Sequence[Layout], turns: Callable[[Layout], Column]
) -> Column:
    """The turns by the layout whose fingerprint the paths have; null without one.

    Paths of more than one layout match none as a whole. Then their part in
    each layout is fingerprinted, layouts with more paths first.
    """
    order = sorted(layouts, key=lambda layout: -len(layout.paths))
    marks = [fingerprint(listed(layout.paths)) for layout in order]

    def number(have: Column) -> Column:
        chosen = F.lit(None).cast("int")
        for n, layout in reversed([*enumerate(order)]):
            part = fingerprint(F.array_intersect(have, listed(layout.paths)))
            chosen = F.when(part == marks[n], F.lit(n)).otherwise(chosen)

        def whole(mark: Column) -> Column:
            found = chosen
            for n in reversed(range(len(order))):
                found = F.when(mark == marks[n], F.lit(n)).otherwise(found)
            return found

        return let(fingerprint(have), whole)

    def choose(number: Column) -> Column:
        found = F.lit(None).cast(TURNS)
        for n, layout in reversed([*enumerate(order)]):
            found = F.when(number == n, turns(layout)).otherwise(found)
        return found

    return let(let(have, number), choose)


def json_paths(record: Column, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """Those leaf paths of a JSON object that a layout knows, lists of objects one level down included.

    A field counts if it is null, too. An empty list says nothing of a layout.
    """
    known = {path for layout in layouts for path in layout.paths}
    lists = sorted({layout.turns for layout in layouts if layout.turns})

    def nested(name: str, value: Column) -> Column:
        items = F.from_json(value, "array<map<string,string>>", JSON)
        fields = F.flatten(F.transform(F.filter(items, lambda i: i.isNotNull()), F.map_keys))
        paths = F.transform(fields, lambda field: F.concat(F.lit(f"{name}[]."), field))
        return F.coalesce(paths, F.array().cast("array<string>"))

    def paths(top: Column) -> Column:
        # a text that looks like a list is one of its field all the same
        return F.array_intersect(
            F.concat(F.map_keys(top), *(nested(name, top[name]) for name in lists)), listed(known)
        )

    return let(F.from_json(record, "map<string,string>", JSON), paths)


def part_turns(layout: Layout, field) -> Column:
    """The turns of a record whose fields each are a text."""
    turns: list[tuple[str, list[Column]]] = []
    for name, role in layout.parts:
        if turns and turns[-1][0] == role:
            turns[-1][1].append(field(name))
        else:
            turns.append((role, [field(name)]))
    full = [
        F.struct(
            F.lit(role).alias("role"),
            F.concat_ws("\n\n", *(F.when(t != "", t) for t in texts)).alias("text"),
        )
        for role, texts in turns
    ]
    return F.filter(
        F.array(*full), lambda t: (t["role"] != "system") | (t["text"] != "")
    ).cast(TURNS)


def list_turns(layout: Layout, items: Column, roles: Callable[[Column], Column]) -> Column:
    return F.transform(
        items, lambda i: F.struct(roles(i[layout.role]).alias("role"), i[layout.text].alias("text"))
    ).cast(TURNS)


def canonical(role: Column) -> Column:
    """Other names of the three roles; unknown ones stay as they are."""
    names = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    return F.coalesce(names[F.lower(role)], role)


def as_given(role: Column) -> Column:
    return role


def turns_of_json(
    record: Column,
    layouts: Sequence[Layout] = LAYOUTS,
    roles: Callable[[Column], Column] = canonical,
) -> Column:
    """Canonical turns of records of any mixture of layouts, as JSON text."""

    def turns(layout: Layout) -> Column:
        if layout.turns:
            schema = f"{layout.turns} array<struct<`{layout.role}`:string,`{layout.text}`:string>>"
            return list_turns(layout, F.from_json(record, schema, JSON)[layout.turns], roles)
        schema = ", ".join(f"`{name}` string" for name, _ in layout.parts)
        return let(F.from_json(record, schema, JSON), lambda parsed: part_turns(layout, lambda name: parsed[name]))

    return selected(json_paths(record, layouts), layouts, turns)


def turns_of_columns(
    records: DataFrame,
    layouts: Sequence[Layout] = LAYOUTS,
    roles: Callable[[Column], Column] = canonical,
) -> Column:
    """Canonical turns of typed records, by the fingerprint of the columns that a layout knows."""
    have = set(paths_of(records.schema))
    fitting = [layout for layout in layouts if set(layout.paths) <= have]
    known = have & {path for layout in fitting for path in layout.paths}

    def turns(layout: Layout) -> Column:
        if layout.turns:
            return list_turns(layout, F.col(layout.turns), roles)
        return part_turns(layout, F.col)

    return selected(listed(known).cast("array<string>"), fitting, turns)


def turns_of_rows(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation, ``conv_id`` and ``turns``, from one row per turn."""
    one = F.struct(
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    grouped = rows.groupBy(F.col(conv_id).alias("conv_id")).agg(
        F.array_sort(F.collect_list(one)).alias("all")
    )
    # in sorted structs null numbers come first
    return grouped.select(
        "conv_id",
        F.transform(
            "all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
        ).alias("turns"),
    )


def special(behind: str) -> str:
    """A regex for first characters of control strings, with ``behind`` after them."""
    strings = (OPEN, *FOREIGN)
    return "|".join(f"{re.escape(s[0])}(?={behind}{re.escape(s[1:])})" for s in strings)


def escaped(text: Column) -> Column:
    """``text`` with one more backslash behind the first character of each control string.

    Backslashes that stand there already count as part of it, so that taking
    one away undoes this for every text.
    """
    return F.regexp_replace(text, F.lit("(" + special(r"\\*") + ")"), F.lit(r"$1\\"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit("(" + special(r"\\+") + r")\\"), F.lit("$1"))


def formatted(turns: Column, trained: str = "assistant") -> Column:
    """A struct of ``text`` and ``loss_spans`` (start and end, in code points) from turns."""
    pieces = F.transform(
        turns,
        lambda t: F.struct(
            F.concat(F.lit(TURN), escaped(F.coalesce(t["role"], F.lit(""))), F.lit(TEXT)).alias("head"),
            escaped(F.coalesce(t["text"], F.lit(""))).alias("body"),
            F.coalesce(t["role"] == trained, F.lit(False)).alias("trained"),
        ),
    )
    text = F.array_join(
        F.transform(pieces, lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""
    )
    spans = F.aggregate(
        pieces,
        F.struct(
            F.lit(0).cast("long").alias("at"),
            F.array().cast("array<struct<start:long,end:long>>").alias("spans"),
        ),
        lambda state, p: F.struct(
            (state["at"] + F.length(p["head"]) + F.length(p["body"]) + len(END)).cast("long").alias("at"),
            F.when(
                p["trained"],
                F.array_append(
                    state["spans"],
                    F.struct(
                        (state["at"] + F.length(p["head"])).cast("long").alias("start"),
                        (state["at"] + F.length(p["head"]) + F.length(p["body"])).cast("long").alias("end"),
                    ),
                ),
            ).otherwise(state["spans"]).alias("spans"),
        ),
        lambda state: state["spans"],
    )
    return F.struct(text.alias("text"), spans.alias("loss_spans"))


def parsed(text: Column) -> Column:
    """The turns of a formatted text."""
    marks = F.filter(F.split(text, re.escape(END)), lambda p: p != "")
    return F.transform(
        marks,
        lambda p: F.struct(
            unescaped(
                F.substring_index(p, TEXT, 1).substr(F.lit(len(TURN) + 1), F.length(p))
            ).alias("role"),
            unescaped(p.substr(F.instr(p, TEXT) + len(TEXT), F.length(p))).alias("text"),
        ),
    )


def records_of_rows(rows: DataFrame, **names: str) -> DataFrame:
    """One row per conversation, ``conv_id`` and a JSON ``record`` of it, from one row per turn."""
    return turns_of_rows(rows, **names).select("conv_id", F.to_json(F.struct("turns")).alias("record"))


def format_conversations(rows: DataFrame, **names: str) -> DataFrame:
    """conv_id, formatted text and loss spans of conversations given by turn; roles stay as they are."""
    records = records_of_rows(rows, **names)
    turns = records.select("conv_id", turns_of_json(F.col("record"), roles=as_given).alias("turns"))
    return turns.select("conv_id", formatted(F.col("turns")).alias("chat")).select(
        "conv_id", F.col("chat.text").alias("text"), F.col("chat.loss_spans").alias("loss_spans")
    )
