"""Repairing conversation structure: faults by row, cheapest edits by shared matrices."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from textguard.llm.common import shuffles_dropped
from textguard.llm.turns import (
    ANSWER,
    DELETE,
    INSERT,
    KEEP,
    LETTERS,
    START,
    SYSTEM,
    USER,
    Grammar,
    illegal_pairs,
    letter,
    pack,
    unpack,
)
from textguard.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACES = " \t\n\x0b\x0c\r"
PART_LETTERS = 4096
RULES = 64
ROUNDS = 8
MEMO = 50_000
OUT_ROWS = 10_000
Batches = Iterator[pa.RecordBatch]
CELLS = "array<struct<cost:long,audit:string>>"
DIGEST = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damage(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Faults planted by the CRC-32 of id and turn: ``role`` and ``text`` after damage, and
    ``copies``, how often the row stands there: 0 for dropped rows, 2 for repeated ones.

    NULL counts as one space, in the key as in role and text.
    """
    spaced = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in (conv_id, turn, role, text)]
    code = F.crc32(F.concat(spaced[0], F.lit(":"), spaced[1])) % 20
    return rows.select(
        conv_id,
        turn,
        F.when(code == 4, "user").otherwise(spaced[2]).alias(role),
        F.when(code == 1, "")
        .when(code == 2, F.regexp_replace(spaced[3], "[.!?]", ""))
        .otherwise(spaced[3])
        .alias(text),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"),
    )


def _order(turn: str = "turn") -> list[Column]:
    return [F.col("conv"), F.col(turn), F.col("role"), F.col("digest")]


def _with_letters(rows: DataFrame) -> DataFrame:
    """One row per distinct turn, role and text of a conversation: the letter of its first
    copy, that of further copies, and how many there are.

    Equal rows are counted before they meet, and the first turn of each text comes from an
    aggregate and a join, which adaptive execution splits, so that a text that fills a
    conversation is not one task.
    """
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    last = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1)
    slim = rows.select(
        "conv",
        "turn",
        "role",
        "digest",
        "copies",
        blank.alias("blank"),
        (~last.isin(".", "!", "?")).alias("cut"),
    )
    counted = slim.groupBy("conv", "turn", "role", "digest").agg(
        F.sum("copies").alias("n"), F.max("blank").alias("blank"), F.max("cut").alias("cut")
    )
    counted = stage(counted, "repair-rows")
    place = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"))
    firsts = (
        counted.filter("n > 0")
        .groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"))
        .agg(F.min(place).alias("first"))
    )
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
    joined = counted.join(firsts, same & (F.col("digest") == F.col("d")), "left")
    initial = F.substring("role", 1, 1)
    group = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    by_group = {
        fault: F.element_at(F.array(*[F.lit(letter(role, fault)) for role in "suao"]), group + 1)
        for fault in ("none", "blank", "duplicate", "truncated")
    }
    earlier = ~place.eqNullSafe(F.col("first"))
    head = (
        F.when(F.col("blank"), by_group["blank"])
        .when(earlier, by_group["duplicate"])
        .when(F.col("cut"), by_group["truncated"])
        .otherwise(by_group["none"])
    )
    more = F.when(F.col("blank"), by_group["blank"]).otherwise(by_group["duplicate"])
    return joined.select("conv", "turn", "role", "digest", "n", head.alias("head"), more.alias("more"))


def _cutter(conv: pa.DataType) -> Callable[[Batches], Batches]:
    """Strings of letters per conversation, in parts, from rows in order."""

    def run(batches: Batches) -> Batches:
        number = TaskContext.get().partitionId() << 32
        out: list[tuple] = []
        now, letters, size, seen = None, [], 0, False

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (conv, pa.int64(), pa.string()))]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["conv", "part", "letters"])

        for batch in batches:
            names = ("conv", "n", "head", "more")
            for of, n, head, more in zip(*[batch.column(name).to_pylist() for name in names]):
                if seen and of != now:
                    out.append((now, number, "".join(letters)))
                    number, letters, size = number + 1, [], 0
                now, seen = of, True
                left, first = n, head
                while left > 0:
                    take = min(left, PART_LETTERS - size)
                    letters.append(first + more * (take - 1))
                    left, size, first = left - take, size + take, more
                    if size == PART_LETTERS:
                        out.append((now, number, "".join(letters)))
                        number, letters, size = number + 1, [], 0
                if len(out) >= OUT_ROWS:
                    yield flush()
        if seen:
            out.append((now, number, "".join(letters)))
            yield flush()

    return run


def learn_grammar(parts: DataFrame, rules: int = RULES, rounds: int = ROUNDS) -> Grammar:
    """Re-Pair over all strings: the most frequent neighbours become a symbol, again and again.

    Equal strings are counted once with their number. A round takes the most frequent
    pairs that share no symbol, so that their counts hold side by side. There are at
    most (16 + rules) squared pairs, which is what the driver gets.
    """
    strings = stage(parts.groupBy("letters").agg(F.count(F.lit(1)).alias("n")), "repair-strings")
    grammar = Grammar()
    for _ in range(rounds):
        packed = F.col("letters")
        for symbol, pair in grammar.rules:
            packed = F.replace(packed, F.lit(pair), F.lit(symbol))
        split = strings.select("n", F.split(packed, "").alias("chars")).filter(F.size("chars") > 1)
        pairs = split.select(
            "n",
            F.explode(
                F.transform(
                    F.sequence(F.lit(1), F.size("chars") - 1),
                    lambda i: F.concat(F.get("chars", i - 1), F.get("chars", i)),
                )
            ).alias("pair"),
        )
        counts = pairs.groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 1").collect()
        taken: set[str] = set()
        for row in sorted(counts, key=lambda row: (-row.n, row.pair)):
            if len(grammar.rules) < rules and len(row.pair) == 2 and not taken & set(row.pair):
                taken |= set(row.pair)
                grammar.add(row.pair)
        if not taken or len(grammar.rules) >= rules:
            break
    return grammar


def _evaluator(grammar: Grammar, conv: pa.DataType) -> Callable[[Batches], Batches]:
    """The matrix of each part; strings that come again in the task are looked up."""

    def run(batches: Batches) -> Batches:
        memo: dict[str, tuple] = {}
        cell = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))
        kinds = [conv, *[pa.int64()] * 5, pa.string(), cell]
        names = ["conv", "part", "blank", "duplicate", "truncated", "illegal", "ends", "cells"]
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("conv", "part", "letters")]
            for low in range(0, len(batch), 1000):
                rows = []
                for of, part, letters in zip(*[column[low : low + 1000] for column in columns]):
                    known = memo.get(letters)
                    if known is None:
                        faults = [sum(letters.count(LETTERS[4 * r + f]) for r in range(4)) for f in (1, 2, 3)]
                        known = (
                            *faults,
                            illegal_pairs(letters),
                            letters[:1] + letters[-1:],
                            pack(grammar.matrix(letters)),
                        )
                        if len(memo) < MEMO:
                            memo[letters] = known
                    rows.append((of, part, *known))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names
                )

    return run


def _folder(grammar: Grammar, conv: pa.DataType) -> Callable[[Batches], Batches]:
    """Cost and audit per conversation, from its parts in order."""

    def run(batches: Batches) -> Batches:
        kinds = [conv, *[pa.int64()] * 5, pa.string()]
        names = ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        for batch in batches:
            rows = []
            for of, parts in zip(batch.column("conv").to_pylist(), batch.column("parts").to_pylist()):
                cost, audit = grammar.cheapest([unpack(part["cells"]) for part in parts])
                sums = [sum(part[name] for part in parts) for name in names[1:5]]
                ends = [part["ends"] for part in parts if part["ends"]]
                sums[3] += sum(illegal_pairs(a[-1] + b[0]) for a, b in zip(ends, ends[1:]))
                rows.append((of, *sums, cost, audit))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names
                )

    return run


class Repaired:
    """The SHA-256 of a repaired conversation, fed row by row in constant memory."""

    ROLE = {"s": SYSTEM, "u": USER, "a": ANSWER}

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.empty = audit, 0, START, True
        self.hash = hashlib.sha256()

    def write(self, role: str, text: str) -> None:
        self.hash.update((("" if self.empty else "\n") + role + ":").encode())
        self.hash.update(text.encode())
        self.empty = False
        self.state = self.ROLE[role[:1]]

    def needed(self) -> str:
        return "assistant" if self.state == USER else "user"

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == INSERT:
            self.write(self.needed(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != DELETE:
            self.write(role if edit == KEEP else self.needed(), text)

    def end(self) -> str:
        self.inserts()
        return self.hash.hexdigest()


def _hasher(conv: pa.DataType) -> Callable[[Batches], Batches]:
    """Reads, per conversation, its result and then its rows in order; adds the digest."""
    names = ["conv", *DIGEST, "audit", "repaired_sha256"]
    kinds = [conv, *[pa.int64()] * len(DIGEST), pa.string(), pa.string()]

    def run(batches: Batches) -> Batches:
        out: list[tuple] = []
        now, result = None, None

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("conv", "copies", "role", "text", "result")]
            for of, copies, role, text, found in zip(*columns):
                if found is not None:
                    if result is not None:
                        out.append((*result, now.end()))
                    now = Repaired(found["audit"])
                    result = (of, *[found[name] for name in DIGEST], found["audit"])
                else:
                    for _ in range(copies):
                        now.row(role, text)
                if len(out) >= OUT_ROWS:
                    yield flush()
        if result is not None:
            out.append((*result, now.end()))
        if out:
            yield flush()

    return run


def repair(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    copies: str | None = None,
) -> DataFrame:
    """Per conversation its faults (``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``), the ``cost``
    and ``audit`` of the cheapest repair, and ``repaired_sha256`` of what it gives.

    Rows become letters for role and first fault, and each conversation a string of
    letters, cut in parts of bounded length. Re-Pair finds the strings that
    conversations share; each rule has one transfer matrix, made from those of its pair, and a
    part is the product over its compressed string. Parts of one long conversation are
    evaluated in different tasks and joined at the end. Texts are shuffled once, to
    feed each conversation's digest in order; all else handles rows without texts.

    Defined cases: rows go by turn, NULL first, then role, then the MD5 of the text; NULL
    roles and texts count as one space; rows with ``copies`` 0 only say that the
    conversation exists, and one without further rows has zeros, an empty audit and the digest
    of nothing. NULL ids form one conversation. Roles of any other initial are like any that
    stands out of order. Repeated rows are duplicates. Texts of any length are hashed
    piece by piece; the audit of one conversation is one string, a letter per row. Turns
    so far apart that ``gaps`` leaves 64 bits give NULL. Other columns play no part; an
    empty table gives an empty table.
    """
    spark = conversations.sparkSession
    kind = conversations.schema[conv_id].dataType.simpleString()
    filled = F.coalesce(F.col(text), F.lit(" "))
    rows = conversations.select(
        F.col(conv_id).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        filled.alias("text"),
        F.unhex(F.md5(filled)).alias("digest"),
        (F.lit(1) if copies is None else F.col(copies)).cast("long").alias("copies"),
    )
    arrow = to_arrow_type(conversations.schema[conv_id].dataType)
    with shuffles_dropped(spark):
        lettered = stage(_with_letters(rows), "repair-letters")
        ordered = lettered.repartitionByRange(*_order()).sortWithinPartitions(*_order())
        parts = stage(
            ordered.select("conv", "n", "head", "more").mapInArrow(
                _cutter(arrow), f"conv {kind}, part long, letters string"
            ),
            "repair-parts",
        )
        grammar = learn_grammar(parts)
        counts = "blank long, duplicate long, truncated long, illegal long"
        evaluated = parts.mapInArrow(
            _evaluator(grammar, arrow), f"conv {kind}, part long, {counts}, ends string, cells {CELLS}"
        )
        part = F.struct("part", "blank", "duplicate", "truncated", "illegal", "ends", "cells")
        grouped = evaluated.groupBy("conv").agg(F.array_sort(F.collect_list(part)).alias("parts"))
        folded = grouped.mapInArrow(
            _folder(grammar, arrow), f"conv {kind}, {counts}, cost long, audit string"
        )
        standing = F.when(F.col("n") > 0, F.col("turn"))
        span = lettered.groupBy("conv", standing.alias("turn")).agg(F.lit(1).alias("one"))
        wide = "decimal(38,0)"
        gaps = F.max("turn").cast(wide) - F.min("turn").cast(wide) + 1 - F.count("turn")
        gaps = F.coalesce(gaps, F.lit(0)).cast(wide).try_cast("long")
        gapped = span.groupBy(F.col("conv").alias("c")).agg(gaps.alias("gaps"), F.lit(True).alias("known"))
        results = folded.join(gapped, F.col("conv").eqNullSafe(F.col("c")))
        results = stage(results.select("conv", F.struct(*DIGEST, "audit").alias("result")), "repair-results")
        none = F.lit(None).cast(results.schema["result"].dataType)
        texts = rows.filter("copies > 0").withColumn("result", none)
        heads = results.select(
            "conv",
            F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
            F.lit(None).cast("string").alias("role"),
            F.lit(None).cast("string").alias("text"),
            F.lit(None).cast("binary").alias("digest"),
            F.lit(0).cast("long").alias("copies"),
            "result",
        )
        together = heads.unionByName(texts).repartition("conv")
        fed = together.sortWithinPartitions("conv", F.col("result").isNull(), *_order()[1:])
        columns = ", ".join(f"{name} long" for name in DIGEST)
        hashed = fed.select("conv", "copies", "role", "text", "result").mapInArrow(
            _hasher(arrow), f"conv {kind}, {columns}, audit string, repaired_sha256 string"
        )
        done = stage(hashed, "repair-done")
    return done.withColumnRenamed("conv", conv_id)

