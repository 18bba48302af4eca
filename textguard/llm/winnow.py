"""Benchmark decontamination by winnowed fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textguard.functions.text import bind
from textguard.llm.common import (
    ROW_ID,
    ROW_TEXT,
    ascii_lower,
    count_words,
    grams,
    indexes,
    same_row,
    with_row_key,
    words,
)
from textguard.session import broadcast_if_small, scratch, stage

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 5
PER_WINDOW = WINDOW - GRAM + 1


def _word_hashes(text: Column) -> Column:
    tokens = words(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN)
    return F.transform(tokens, lambda word: F.xxhash64(word))


def _runs(hashes: Column) -> Column:
    """Winnowing: (fingerprint, start, windows) for each run of windows that share
    their smallest gram hash.

    A window of WINDOW words keeps the smallest hash among its PER_WINDOW grams, so
    texts that share a window share its fingerprint. Neighbouring windows mostly keep
    the same gram and are one run; ``windows`` are the hashes of the run's whole
    windows, from which hits are extended.
    """

    def cut(g: Column, smallest: Column) -> Column:
        def entries(starts: Column) -> Column:
            return F.transform(
                starts,
                lambda s, k: F.struct(
                    F.get(smallest, s).alias("fp"),
                    s.alias("start"),
                    F.transform(
                        F.sequence(
                            s, F.coalesce(F.get(starts, k + 1), F.size(smallest)) - F.lit(1)
                        ),
                        lambda j: F.xxhash64(F.get(g, j), F.get(g, j + (WINDOW - GRAM))),
                    ).alias("windows"),
                ),
            )

        starts = F.filter(
            indexes(0, F.size(smallest) - 1),
            lambda i: (i == 0) | (F.get(smallest, i) != F.get(smallest, i - 1)),
        )
        return bind(starts, entries)

    def minima(g: Column) -> Column:
        return F.transform(
            indexes(0, F.size(g) - PER_WINDOW),
            lambda i: F.least(*[F.get(g, i + step) for step in range(PER_WINDOW)]),
        )

    return bind(grams(hashes, GRAM), lambda g: bind(minima(g), lambda m: cut(g, m)))


def _spans_of(hashes: Column, length: int) -> Column:
    """(length, start, window) for every run of so many words."""
    return F.transform(
        grams(hashes, length),
        lambda h, i: F.struct(
            F.lit(length).alias("length"), i.alias("start"), h.alias("window")
        ),
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Per document the words inside passages shared with benchmark items.

    Returns ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``,
    ``contaminated`` and the row key. Documents and items meet at fingerprints only, each hit
    is then extended to the whole windows around it, and a window counts if the
    item has it too. Every shared run of WINDOW words is found, since both sides
    keep the same fingerprint for it. Items shorter than that are one window,
    looked up directly.

    Texts are read once and never shuffled: what leaves a row are fingerprints, and
    after the join only those that hit. The item tables are broadcast if counted
    and found short, else joined by a shuffle.

    Defined cases: NULL and empty texts have no words, match nothing and are
    returned with zeros; items without words match nothing; NULL item ids count as no
    item but their windows hit; rows with one id and text get one result each, the
    same; an empty table on either side gives no hits.
    """
    lists = stage(
        items.select(
            F.col(item_id).cast("string").alias("item"), _word_hashes(F.col(item_text)).alias("h")
        ).filter(F.size("h") > 0),
        "benchmark-words",
    )
    sizes = lists.select(F.least(F.size("h"), F.lit(WINDOW)).alias("n")).distinct().collect()
    short = sorted(row["n"] for row in sizes if row["n"] < WINDOW)
    runs = lists.filter(F.size("h") >= WINDOW).select("item", F.explode(_runs(F.col("h"))).alias("run"))
    windows = runs.select(
        "item", F.lit(WINDOW).alias("length"), F.explode("run.windows").alias("window")
    )
    for length in short:
        spans = F.explode(_spans_of(F.col("h"), length)).alias("span")
        exact = lists.filter(F.size("h") == length).select("item", spans)
        windows = windows.union(exact.select("item", "span.length", "span.window"))
    windows = stage(windows.distinct(), "benchmark-windows")
    prints = stage(runs.select(F.col("run.fp").alias("fp")).distinct(), "benchmark-prints")

    keyed = with_row_key(docs.select(F.col(doc_id), F.col(text)), doc_id, text)
    hashes = _word_hashes(F.col(text))
    met = (
        keyed.select(ROW_ID, ROW_TEXT, F.explode(bind(hashes, _runs)).alias("run"))
        .select(ROW_ID, ROW_TEXT, "run.fp", "run.start", "run.windows")
        .join(broadcast_if_small(prints), "fp", "left_semi")
    )
    spans = met.select(
        ROW_ID,
        ROW_TEXT,
        "start",
        F.posexplode("windows").alias("step", "window"),
    ).select(
        ROW_ID, ROW_TEXT, F.lit(WINDOW).alias("length"), (F.col("start") + F.col("step")).alias("start"), "window"
    )
    if short:

        def all_short(h: Column) -> Column:
            return F.flatten(F.array(*[_spans_of(h, length) for length in short]))

        spans = spans.union(
            keyed.select(ROW_ID, ROW_TEXT, F.explode(bind(hashes, all_short)).alias("span")).select(
                ROW_ID, ROW_TEXT, "span.length", "span.start", "span.window"
            )
        )
    known = broadcast_if_small(windows.select("length", "window").distinct())
    hits = stage(spans.join(known, ["length", "window"], "left_semi"), "benchmark-hits")
    places = F.explode(F.sequence("start", F.col("start") + F.col("length") - 1))
    hit_words = (
        hits.select(ROW_ID, ROW_TEXT, places.alias("place"))
        .distinct()
        .groupBy(ROW_ID, ROW_TEXT)
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    found = (
        hits.select(ROW_ID, ROW_TEXT, "length", "window")
        .distinct()
        .join(broadcast_if_small(windows), ["length", "window"])
        .filter(F.col("item").isNotNull())
        .groupBy(ROW_ID, ROW_TEXT)
        .agg(F.collect_set("item").alias("items"))
    )
    both = hit_words.join(found, same_row(hit_words, found), "left").select(
        hit_words[ROW_ID], hit_words[ROW_TEXT], "n_hit", "items"
    )
    counted = keyed.select(
        doc_id, ROW_ID, ROW_TEXT, count_words(F.col(text), BETWEEN_ANY_CASE).alias("n_words")
    )
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    return counted.join(both, same_row(counted, both), "left").select(
        counted[doc_id],
        counted[ROW_ID],
        counted[ROW_TEXT],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_found).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items_found), ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that share no window with an item, with all their columns.

    Documents drop out by their row key, against the contaminated keys alone; rows
    with NULL ids or texts are treated as in ``decontaminate``.
    """
    with scratch(docs.sparkSession):
        verdicts = decontaminate(docs, items, doc_id, text)
        bad = verdicts.filter("contaminated").select(ROW_ID, ROW_TEXT).distinct()
        bad = stage(bad, "contaminated", keep=True)
    keyed = with_row_key(docs, doc_id, text)
    bad = broadcast_if_small(bad)
    return keyed.join(bad, same_row(keyed, bad), "left_anti").drop(ROW_ID, ROW_TEXT)
