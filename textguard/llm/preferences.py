"""Preference formatting: one prompt and two masked completions per pair of conversations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textguard.plans.skew import number_rows
from textguard.session import broadcast_if_small, stage

TRAINED = ("assistant",)


def pair_neighbours(conversations: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """(pair_id, chosen, rejected): conversations 2k and 2k + 1, as logs of two answers
    to one request number them; one alone has nothing to be compared with."""
    ids = conversations.select(F.col(conv_id).alias("id")).distinct()
    pair = F.floor(F.col("id") / 2).cast("long")
    first = F.pmod("id", F.lit(2)) == 0
    return (
        ids.filter(F.col("id").isNotNull())
        .groupBy(pair.alias("pair_id"))
        .agg(
            F.max(F.when(first, F.col("id"))).alias("chosen"),
            F.max(F.when(~first, F.col("id"))).alias("rejected"),
        )
        .filter(F.col("chosen").isNotNull() & F.col("rejected").isNotNull())
    )


def pair_branches(branched: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """(pair_id, chosen, rejected): the two sides of each conversation that ``branch`` made."""
    convs = branched.select(F.col(conv_id)["conv"].alias("pair_id")).distinct()
    sides = [F.struct(F.col("pair_id").alias("conv"), F.lit(side).alias("side")) for side in (0, 1)]
    return convs.select("pair_id", sides[0].alias("chosen"), sides[1].alias("rejected"))


def branch(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    answering: str = "assistant",
) -> DataFrame:
    """(conv_id, turn, role, text): each conversation c with an answer twice, under the ids
    (c, 0) and (c, 1), for ``pair_branches``. The first is c as it is; the second is c up to
    its last answer, which the last answer of the next conversation with one (the first
    follows on the last) replaces. Both share the turns before that answer.

    Answers are turns of the role ``answering``. Defined cases: all answers of one turn
    number count as that answer; rows with NULL turn or conversation are dropped;
    conversations without answers, or with the only one there is, have no pair; two answers
    alike are a pair all the same, whose completions differ by the turns that follow.
    """
    turns = conversations.select(
        F.col(conv_id).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.col(role).alias("role"),
        F.col(text).alias("text"),
    ).filter(F.col("conv").isNotNull() & F.col("turn").isNotNull())
    answer = F.col("role") == answering
    last = turns.filter(answer).groupBy("conv").agg(F.max("turn").alias("at"))
    numbered = stage(number_rows(last, "conv", "n"), "preference-answers")
    count = numbered.count()
    if count < 2:
        numbered = numbered.limit(0)
    follows = F.pmod(F.col("n") + 1, F.lit(max(count, 1)))
    givers = numbered.select(F.col("n").alias("__next"), F.col("conv").alias("giver"), F.col("at").alias("given"))
    branches = numbered.withColumn("__next", follows).join(givers, "__next").select("conv", "at", "giver", "given")
    branches = broadcast_if_small(stage(branches, "preference-branches"))
    own = turns.join(branches, "conv")
    whole, cut = (F.struct("conv", F.lit(side).alias("side")) for side in (0, 1))
    sides = F.when(F.col("turn") < F.col("at"), F.array(whole, cut)).otherwise(F.array(whole))
    kept = own.select(F.explode(sides).alias("conv_id"), "turn", "role", "text")
    other = (
        turns.filter(answer)
        .withColumnsRenamed({"conv": "giver", "turn": "given"})
        .join(branches, ["giver", "given"])
        .select(cut.alias("conv_id"), F.col("at").alias("turn"), "role", "text")
    )
    return kept.unionByName(other)


def format_preferences(
    conversations: DataFrame,
    pairs: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained: Sequence[str] = TRAINED,
) -> DataFrame:
    """Rendered turns: ``pair_id, section, turn, role, rendered, mask_start, mask_end``.

    Per pair, the turns before the first at which the two conversations differ are
    the ``prompt``, rendered once and never trained on. The turns from there on are
    the ``chosen`` and the ``rejected`` completion. Of a rendered turn the characters
    from ``mask_start`` to ``mask_end`` count in the loss: the text and the end mark
    of a trained role in a completion, else none. One row is one turn, so a
    conversation of any length is spread over tasks; ``assemble`` joins them.

    The first difference is the smallest turn with a (role, text) that the two do
    not hold equally often; rows are counted by digest, with partial counts, and no
    conversation is gathered anywhere.

    Defined cases: NULL texts render as empty and equal only NULL texts; NULL roles
    render as "none"; rows with NULL turn or conversation are dropped, having no place;
    repeated turns are all rendered and a different number of repeats is a difference;
    conversations in no pair are left out, one in several pairs is in all of them;
    extra columns are ignored; empty tables give no rows.
    """
    turns = conversations.select(
        F.col(conv_id).alias("__conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("none")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.sha2(
            F.concat(
                F.coalesce(F.col(role), F.lit("none")),
                F.lit("\n"),
                F.coalesce(F.concat(F.lit("="), F.col(text)), F.lit("null")),
            ),
            256,
        ).alias("__digest"),
    ).filter(F.col("__conv").isNotNull() & F.col("turn").isNotNull())
    sides = pairs.select(
        "pair_id",
        F.explode(
            F.array(
                F.struct(F.lit("chosen").alias("side"), F.col("chosen").alias("__conv")),
                F.struct(F.lit("rejected").alias("side"), F.col("rejected").alias("__conv")),
            )
        ).alias("s"),
    ).select("pair_id", "s.side", "s.__conv")
    sides = broadcast_if_small(stage(sides, "preference-sides"))
    placed = turns.join(sides, "__conv")
    balance = F.sum(F.when(F.col("side") == "chosen", 1).otherwise(-1))
    parted = (
        placed.groupBy("pair_id", "turn", "__digest")
        .agg(balance.alias("balance"))
        .filter("balance != 0")
        .groupBy("pair_id")
        .agg(F.min("turn").alias("__first"))
    )
    parted = broadcast_if_small(stage(parted, "preference-first"))
    head = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"))
    counted = (F.col("section") != "prompt") & F.col("role").isin(list(trained))
    rendered = F.concat(head, F.col("text"), F.lit("<|end|>\n"))
    shared = F.col("__first").isNull() | (F.col("turn") < F.col("__first"))
    return (
        placed.join(parted, "pair_id", "left")
        .withColumn("section", F.when(shared, F.lit("prompt")).otherwise(F.col("side")))
        .filter((F.col("section") != "prompt") | (F.col("side") == "chosen"))
        .select(
            "pair_id",
            "section",
            "turn",
            "role",
            rendered.alias("rendered"),
            F.when(counted, F.length(head)).otherwise(0).cast("int").alias("mask_start"),
            F.when(counted, F.length(rendered) - 1).otherwise(0).cast("int").alias("mask_end"),
        )
    )


def assemble(formatted: DataFrame) -> DataFrame:
    """One row per pair: ``prompt``, ``chosen``, ``rejected`` and the masks as arrays of
    (start, end) in each completion. A pair is one training example and becomes one
    row here; use the turns themselves where a conversation may not fit in memory."""
    spans = formatted.groupBy("pair_id", "section").agg(
        F.array_sort(
            F.collect_list(F.struct("turn", "role", "rendered", "mask_start", "mask_end"))
        ).alias("parts")
    )
    offsets = F.aggregate(
        "parts",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("masks")),
        lambda seen, p: F.struct(
            (seen["at"] + F.length(p["rendered"])).alias("at"),
            F.when(
                p["mask_end"] > p["mask_start"],
                F.concat(
                    seen["masks"],
                    F.array(
                        F.struct(
                            (seen["at"] + p["mask_start"]).alias("start"),
                            (seen["at"] + p["mask_end"]).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(seen["masks"])
            .alias("masks"),
        ),
    )
    whole = spans.select(
        "pair_id", "section", F.array_join("parts.rendered", "").alias("body"), offsets["masks"].alias("masks")
    )

    def of(section: str, column: str):
        return F.max(F.when(F.col("section") == section, F.col(column)))

    nothing = F.array().cast("array<struct<start:int,end:int>>")
    return whole.groupBy("pair_id").agg(
        F.coalesce(of("prompt", "body"), F.lit("")).alias("prompt"),
        F.coalesce(of("chosen", "body"), F.lit("")).alias("chosen"),
        F.coalesce(of("rejected", "body"), F.lit("")).alias("rejected"),
        F.coalesce(of("chosen", "masks"), nothing).alias("chosen_masks"),
        F.coalesce(of("rejected", "masks"), nothing).alias("rejected_masks"),
    )
