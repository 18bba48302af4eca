"""Secret scans with trigram indexes over batches of documents."""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from re import _constants as kinds  # type: ignore[attr-defined]
from re import _parser as regex_parser  # type: ignore[attr-defined]

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textguard.llm.bytehash import LOWER, pieces, text_buffers

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_STRINGS = 16
Batches = Iterator[pa.RecordBatch]
# A query is True (any text), a trigram, or ("and" | "or", queries).
Query = object


@dataclass(frozen=True)
class SecretRule:
    """A kind of secret: what it looks like, and how long a group of it must be."""

    name: str
    pattern: str
    group: int = 0
    least: int = 0


# The first three are fixed values; the others are kinds that this operator adds.
BASE_RULES = (
    SecretRule(
        "assign",
        r"""(?a)(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    SecretRule("access", r"AKIA[A-Z0-9]+", least=20),
    SecretRule("hex", r"[0-9a-f]+", least=24),
)
MORE_RULES = (
    SecretRule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    SecretRule("url_password", r"[a-z][a-z0-9+]{1,9}://[^\s/:@]*:[^\s/@]{3,}@"),
)


def _all_of(queries: Sequence[Query]) -> Query:
    parts = [q for q in dict.fromkeys(queries) if q is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any_of(queries: Sequence[Query]) -> Query:
    parts = list(dict.fromkeys(queries))
    return True if True in parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _of_string(text: str) -> Query:
    data = text.lower().encode()
    return _all_of([data[i : i + 3] for i in range(len(data) - 2)])


def trigram_query(pattern: str) -> Query:
    """What trigrams, of the text with A-Z in lower case, a match of the regex must hold.

    The parsed regex is read from left to right with the set of strings that the part so
    far may end a run of literals with. While that set is small it grows by
    concatenation; where the regex opens up (a class, a repeat, an option) the strings'
    trigrams become part of the query and a new run begins. True means that the regex
    asks for no trigram.
    """

    def closed(strings: frozenset[str]) -> Query:
        return _any_of([_of_string(s) for s in sorted(strings)])

    def walk(items) -> tuple[Query, frozenset[str] | None]:
        """The query, and all strings that the items match if these are few."""
        query: Query = True
        run, whole = frozenset([""]), True
        for kind, value in items:
            options, needs = step(kind, value)
            if options is not None and len(options) * len(run) <= MAX_STRINGS:
                run = frozenset(a + b for a in run for b in options)
            else:
                query = _all_of([query, closed(run), needs])
                run, whole = frozenset([""]), False
        return (query, run) if whole else (_all_of([query, closed(run)]), None)

    def step(kind, value) -> tuple[frozenset[str] | None, Query]:
        if kind is kinds.LITERAL:
            return frozenset([chr(value)]), True
        if kind is kinds.IN and all(k is kinds.LITERAL for k, _ in value):
            return frozenset(chr(v) for _, v in value), True
        if kind is kinds.SUBPATTERN:
            query, strings = walk(value[3])
            return strings, query
        if kind is kinds.BRANCH:
            parts = [walk(branch) for branch in value[1]]
            if all(strings is not None for _, strings in parts):
                return frozenset().union(*[strings for _, strings in parts]), _any_of(
                    [closed(strings) for _, strings in parts]
                )
            return None, _any_of(
                [q if s is None else closed(s) for q, s in parts]
            )
        if kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT):
            least, most, inner = value
            query, strings = walk(inner)
            needs = query if strings is None else closed(strings)
            if least == 0 and most == 1 and strings is not None:
                return strings | {""}, True
            if least == most == 1:
                return strings, needs
            return None, needs if least else True
        if kind is kinds.AT:
            return frozenset([""]), True
        return None, True

    query, strings = walk(regex_parser.parse(pattern))
    return query if strings is None else closed(strings)


def _trigrams(query: Query) -> list[bytes]:
    if query is True:
        return []
    if isinstance(query, bytes):
        return [query]
    return [gram for part in query[1] for gram in _trigrams(part)]


class TrigramIndex:
    """An inverted index of a batch of texts: for each wanted trigram its documents."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, wanted: Sequence[bytes]):
        self.rows = len(offsets) - 1
        codes = {int.from_bytes(gram, "big") for gram in wanted}
        known = np.zeros(1 << 24, bool)
        known[sorted(codes)] = True
        found: dict[int, list[np.ndarray]] = {code: [] for code in codes}
        for low, high, first, last in pieces(offsets, 2):
            part = LOWER[data[first:last]].astype(np.uint32)
            grams = (part[:-2] << 16) | (part[1:-1] << 8) | part[2:]
            places = np.flatnonzero(known[grams])
            row = np.searchsorted(offsets[: high + 1], places + first, "right") - 1
            inside = places + first + 3 <= offsets[row + 1]
            hits, row = grams[places[inside]], row[inside]
            for code in np.unique(hits):
                found[int(code)].append(np.unique(row[hits == code]))
        self.postings = {
            code: np.unique(np.concatenate(lists)) if lists else np.zeros(0, np.int64)
            for code, lists in found.items()
        }

    def candidates(self, query: Query) -> np.ndarray:
        """Documents that satisfy the query, by intersecting and uniting postings."""
        if query is True:
            return np.arange(self.rows)
        if isinstance(query, bytes):
            return self.postings[int.from_bytes(query, "big")]
        kind, parts = query
        lists = sorted((self.candidates(part) for part in parts), key=len)
        out = lists[0]
        for other in lists[1:]:
            out = np.intersect1d(out, other) if kind == "and" else np.union1d(out, other)
        return out


def _finder(rules: Sequence[SecretRule], passed: Sequence[str]) -> Callable[[Batches], Batches]:
    queries = [trigram_query(rule.pattern) for rule in rules]
    # A run that must be long needs no shorter match first, so a whole-run class says so itself.
    shown = [
        re.compile(rule.pattern[:-1] + f"{{{rule.least},}}")
        if re.fullmatch(r"\[[^\]\\]+\]\+", rule.pattern) and rule.group == 0
        else re.compile(rule.pattern)
        for rule in rules
    ]
    wanted = sorted({gram for query in queries for gram in _trigrams(query)})
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            data, offsets = text_buffers(batch.column("__text"))
            index = TrigramIndex(data, offsets, wanted)
            found: list[list[tuple[int, int, int]]] = [[] for _ in range(index.rows)]
            texts: dict[int, str] = {}
            for number, (rule, query, regex) in enumerate(zip(rules, queries, shown, strict=True)):
                for row in index.candidates(query).tolist():
                    text = texts.get(row)
                    if text is None:
                        body = data[offsets[row] : offsets[row + 1]].tobytes()
                        text = texts[row] = body.decode("utf-8", "replace")
                    for match in regex.finditer(text):
                        if len(match[rule.group]) >= rule.least:
                            found[row].append((match.start(), number, match.end()))
            spans = [
                [{"start": s, "kind": k, "end": e} for s, k, e in sorted(row)] for row in found
            ]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in passed], pa.array(spans, pa.list_(span))],
                [*passed, "found"],
            )

    return run


def find_secrets(
    docs: DataFrame,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    rules: Sequence[SecretRule] = BASE_RULES + MORE_RULES,
) -> DataFrame:
    """The carried columns and ``secrets``: (start, end, kind) per match, by start and rule.

    A regex is first turned into a Boolean query over trigrams that its matches must
    hold. Each batch of documents gets an inverted index of the trigrams that some rule
    asks for; per rule its postings are intersected and united, and only candidates
    are searched with the regex itself. Rules without mandatory trigrams search every text.
    Indexes live as long as their batch, so nothing is shuffled, and a lost
    executor costs its batches.

    Offsets count code points, ends exclusive. Matches are leftmost and do not overlap
    within a rule; those whose group is shorter than the rule's least length are dropped.

    Defined cases: NULL and empty texts have no secrets; texts are searched whole at any
    length; repeated rows are searched alike; extra columns come back only if carried; an
    empty table gives an empty table.
    """
    names = F.array(*[F.lit(rule.name) for rule in rules])
    renamed = [F.col(name).alias(f"__c{i}") for i, name in enumerate(carry)]
    rows = docs.select(*renamed, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    passed = rows.columns[:-1]
    kinds_of = dict(rows.dtypes)
    schema = ", ".join(f"`{name}` {kinds_of[name]}" for name in passed)
    schema += (", " if passed else "") + "found array<struct<start:int,kind:int,end:int>>"
    found = rows.mapInArrow(_finder(rules, passed), schema)

    def named(hit: Column) -> Column:
        return F.struct(
            hit["start"].alias("start"),
            hit["end"].alias("end"),
            F.get(names, hit["kind"]).alias("kind"),
        )

    return found.select(
        *[F.col(new).alias(old) for new, old in zip(passed, carry, strict=True)],
        F.transform("found", named).alias("secrets"),
    )


def spans_text(secrets: Column) -> Column:
    """``kind:start:end`` of each match, joined by commas."""
    return F.array_join(
        F.transform(
            secrets, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def mask(text: Column, secrets: Column, by: str = "*") -> Column:
    """The text with each secret replaced; overlapping ones as one."""
    pieces_kept = F.aggregate(
        secrets,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda seen, s: F.struct(
            F.when(
                s["end"] > seen["at"],
                F.concat(
                    seen["out"],
                    F.substring(text, seen["at"] + 1, F.greatest(s["start"] - seen["at"], F.lit(0))),
                    F.when(s["start"] >= seen["at"], F.lit(by)).otherwise(F.lit("")),
                ),
            )
            .otherwise(seen["out"])
            .alias("out"),
            F.greatest(seen["at"], s["end"]).alias("at"),
        ),
    )
    return F.concat(
        pieces_kept["out"], F.substring(text, pieces_kept["at"] + 1, F.length(text))
    )
