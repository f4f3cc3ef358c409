"""Secret scans by a trigram index.

From each rule's regex a Boolean query of trigrams is derived: what any match
must contain. The index holds, for each document, which of the rules' trigrams
occur in it: the inverted index, kept by document, so that intersecting
postings needs no shuffle. Only documents whose postings satisfy a rule's query
are searched with its regex; a rule without mandatory trigrams searches all.

Spans count code points, ends are exclusive. Matches of one rule do not
overlap, leftmost first; those of different rules may.

Defined results: a null or empty text has no spans; very long texts are searched
whole; ties in start go by the order of the rules; repeated rows are scanned
once each; an empty table gives no rows. Columns are added under the names
given, other columns stay. Only built-in functions are used.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sets of possible strings are multiplied out up to this many.
MOST_STRINGS = 64
SPANS = "array<struct<start:long,rank:int,end:long>>"


@dataclass(frozen=True)
class Rule:
    """A regex; of its matches, those stay whose ``group`` has ``least`` characters or more.

    ``hint`` is a regex that must match somewhere in a text for any match to
    stay, where the whole regex says little.
    """

    kind: str
    regex: str
    least: int = 1
    group: int = 0
    hint: str = ""


# The first three rules are the base.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6,
        group=2,
    ),
    Rule("access", "AKIA[A-Z0-9]+", least=20),
    Rule("hex", "[0-9a-f]+", least=24, hint="[0-9a-f]{24}"),
)
MORE = (
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
)
RULES = BASE + MORE

# A query is True (anything), a trigram, or ("and" | "or", parts).


def both(*parts):
    own = [p for p in parts if p is not True]
    return True if not own else own[0] if len(own) == 1 else ("and", tuple(dict.fromkeys(own)))


def either(*parts):
    if not parts or any(p is True for p in parts):
        return True
    own = tuple(dict.fromkeys(parts))
    return own[0] if len(own) == 1 else ("or", own)


def holds(strings: set[str]):
    """The query that one of these strings occurs, in lower case."""
    needs = {frozenset(s[n : n + 3] for n in range(len(s) - 2)) for s in map(str.lower, strings)}
    least = [need for need in needs if not any(other < need for other in needs)]
    return either(*(both(*need) for need in sorted(map(sorted, least))))


def alternatives(item) -> set[str] | None:
    """All strings an item can match, if they are few."""
    kind, value = item
    if kind is op.LITERAL:
        return {chr(value)}
    if kind is op.IN:
        found: set[str] = set()
        for one, what in value:
            if one is op.LITERAL:
                found.add(chr(what))
            elif one is op.RANGE and what[1] - what[0] < MOST_STRINGS:
                found |= {chr(c) for c in range(what[0], what[1] + 1)}
            else:
                return None
        return found if len(found) <= 8 else None
    if kind is op.SUBPATTERN:
        return sequence_alternatives(value[3])
    if kind is op.BRANCH:
        parts = [sequence_alternatives(branch) for branch in value[1]]
        return None if None in parts else set().union(*parts)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[1] == 1:
        inner = sequence_alternatives(value[2])
        return inner if inner is None or value[0] else inner | {""}
    return {""} if kind is op.AT else None


def sequence_alternatives(items) -> set[str] | None:
    found = {""}
    for item in items:
        own = alternatives(item)
        if own is None or len(found) * len(own) > MOST_STRINGS:
            return None
        found = {a + b for a in found for b in own}
    return found


def query_of(items) -> object:
    """What a match of a sequence of items must contain."""
    needed, run = [], {""}
    for item in items:
        own = alternatives(item)
        if own is not None and len(run) * len(own) <= MOST_STRINGS:
            run = {a + b for a in run for b in own}
            continue
        needed.append(holds(run))
        run = {""} if own is None else own
        kind, value = item
        if kind is op.SUBPATTERN:
            needed.append(query_of(value[3]))
        elif kind is op.BRANCH:
            needed.append(either(*(query_of(branch) for branch in value[1])))
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] > 0:
            needed.append(query_of(value[2]))
    return both(*needed, holds(run))


def trigram_query(regex: str):
    return query_of(parser.parse(regex))


def trigrams(query) -> Iterator[str]:
    if isinstance(query, str):
        yield query
    elif query is not True:
        for part in query[1]:
            yield from trigrams(part)


def postings(text: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The trigrams of the rules that occur in a text, sorted."""
    wanted = sorted({t for rule in rules for t in trigrams(trigram_query(rule.regex))})
    low = F.lower(text)
    return F.array_compact(F.array(*(F.when(low.contains(t), F.lit(t)) for t in wanted)))


def satisfied(query, held: Column) -> Column:
    if query is True:
        return F.lit(True)
    if isinstance(query, str):
        return F.array_contains(held, query)
    parts = [satisfied(part, held) for part in query[1]]
    return reduce(lambda a, b: a & b if query[0] == "and" else a | b, parts)


def matches(text: Column, rule: Rule, rank: int) -> Column:
    """The spans of one rule in a text, in order.

    Each step of the search takes the gap before a match and the match, so
    that the lengths add up to positions.
    """
    step = F.lit(rf"\G((?s:.*?))({rule.regex})")
    gaps, whole = F.regexp_extract_all(text, step, 1), F.regexp_extract_all(text, step, 2)
    measured = whole if not rule.group else F.regexp_extract_all(text, step, rule.group + 2)
    items = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), measured.alias("measured"))
    start = lambda state, item: (state["at"] + F.length(item["gap"])).cast("long")
    end = lambda state, item: (start(state, item) + F.length(item["whole"])).cast("long")
    return F.aggregate(
        items,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("spans")),
        lambda state, item: F.struct(
            end(state, item).alias("at"),
            F.when(
                F.length(item["measured"]) >= rule.least,
                F.array_append(
                    state["spans"],
                    F.struct(
                        start(state, item).alias("start"),
                        F.lit(rank).alias("rank"),
                        end(state, item).alias("end"),
                    ),
                ),
            ).otherwise(state["spans"]).alias("spans"),
        ),
        lambda state: state["spans"],
    )


def scan(
    docs: DataFrame, text: str = "text", spans: str = "spans", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """``docs`` with the column ``spans``: start, rank of the rule, end; in order of these."""
    held = f"_{spans}_postings"
    content = F.coalesce(F.col(text), F.lit(""))
    found = []
    for rank, rule in enumerate(rules):
        may = satisfied(trigram_query(rule.regex), F.col(held))
        if rule.hint:
            may = may & F.regexp_like(content, F.lit(rule.hint))
        found.append(
            F.when(may, matches(content, rule, rank)).otherwise(F.array().cast(SPANS))
        )
    indexed = docs.withColumn(held, postings(content, rules))
    return indexed.withColumn(spans, F.array_sort(F.concat(*found))).drop(held)


def listed(spans: Column, rules: Sequence[Rule] = RULES) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    kinds = F.array(*(F.lit(rule.kind) for rule in rules))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])
        ),
        ",",
    )


def redacted(text: Column, spans: Column, put: str = "[SECRET]") -> Column:
    """``text`` with every span, or run of overlapping spans, replaced."""
    cut = lambda start, end: text.substr((start + 1).cast("int"), (end - start).cast("int"))
    return F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("done")),
        lambda state, s: F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(
                s["start"] >= state["at"],
                F.concat(state["done"], cut(state["at"], s["start"]), F.lit(put)),
            ).otherwise(state["done"]).alias("done"),
        ),
        lambda state: F.concat(
            state["done"], text.substr((state["at"] + 1).cast("int"), F.length(text))
        ),
    )


def redact(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with secrets replaced in ``text``; texts without secrets stay as they are."""
    found = scan(docs, text, "_secrets", rules)
    clean = F.when(F.size("_secrets") > 0, redacted(F.col(text), F.col("_secrets"))).otherwise(
        F.col(text)
    )
    return found.withColumn(text, clean).drop("_secrets")
