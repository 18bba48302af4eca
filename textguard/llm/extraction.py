"""Main text of web pages by two passes of rules over their blocks."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from textguard.functions.text import bind
from textguard.llm.blocks import page_blocks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The most frequent function words of four languages.
STOP_WORDS = {
    "en": "the of and a to in is that it was for on are as with be at by this from or have an they which not",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er wie",
    "fr": "de la le et les des en un une du que est pour qui dans par plus pas au sur ne se ce il sont avec",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero",
}
SHORT, LONG = 70, 200
FEW_STOPS, MANY_STOPS = 0.15, 0.2
MOST_LINKED = 0.5
BATCH_PAGES = 200
Batches = Iterator[pa.RecordBatch]
BLOCK = (
    "struct<text:string,inside:boolean,heading:boolean,linked:int,words:int,stops:int>"
)
GOOD, BAD, OPEN, TIE = "G", "B", "A", "T"


def _reader(stop_words: frozenset[str], carried: list[pa.Field]) -> Callable[[Batches], Batches]:
    block = pa.struct(
        [
            ("text", pa.string()),
            ("inside", pa.bool_()),
            ("heading", pa.bool_()),
            *[(name, pa.int32()) for name in ("linked", "words", "stops")],
        ]
    )

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for low in range(0, len(batch), BATCH_PAGES):
                part = batch.slice(low, BATCH_PAGES)
                found = [page_blocks(page.as_py(), stop_words) for page in part.column("__page")]
                columns = [part.column(field.name) for field in carried]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(found, pa.list_(block))],
                    [*[field.name for field in carried], "__blocks"],
                )

    return run


def first_label(block: Column) -> Column:
    """Pass one: good, bad or open, by link density, length and stop-word density.

    Blocks with much linked text are bad. Short ones are open; longer ones are good with many stop
    words and bad with few. Within an article few stop words, as in a table or a list of
    names, leave a block open, and so does a link that is a heading.
    """
    size = F.greatest(F.length(block["text"]), F.lit(1))
    stops = block["stops"] / F.greatest(block["words"], F.lit(1))
    return (
        F.when(
            block["linked"] > size * MOST_LINKED,
            F.when(block["inside"] & block["heading"], OPEN).otherwise(BAD),
        )
        .when(block["heading"] | (size < SHORT), OPEN)
        .when((stops >= MANY_STOPS) | ((size > LONG) & (stops >= FEW_STOPS)), GOOD)
        .when((stops >= FEW_STOPS) | block["inside"], OPEN)
        .otherwise(BAD)
    )


def spread_labels(labels: Column) -> Column:
    """Pass two: each run of open blocks takes the labels of its decided neighbours.

    A run between equal labels takes that label; between different ones each half takes the
    nearer, and the block halfway is a tie. A run at an edge takes the only neighbour it has;
    with none at all it is good. Runs are cut and put together as strings, so the time is
    linear in the number of blocks.
    """

    def fill(runs: Column) -> Column:
        def one(run: Column, at: Column) -> Column:
            before = F.substring(F.get(runs, at - 1), -1, 1)
            after = F.substring(F.get(runs, at + 1), 1, 1)
            left = F.coalesce(before, after, F.lit(GOOD))
            right = F.coalesce(after, before, F.lit(GOOD))
            half = F.floor(F.length(run) / 2).cast("int")
            halves = F.concat(
                F.repeat(left, half),
                F.repeat(F.when(left == right, left).otherwise(TIE), F.length(run) % 2),
                F.repeat(right, half),
            )
            return F.when(run.startswith(OPEN), halves).otherwise(run)

        return F.array_join(F.transform(runs, one), "")

    return bind(F.split(labels, "(?<=A)(?=[BG])|(?<=[BG])(?=A)"), fill)


def main_text(blocks: Column) -> Column:
    """The text of the blocks that two passes take for good, joined by two line feeds.

    A page with an article is read within it alone, and the article's edges count as good
    neighbours. Ties are good for headings and within an article.
    """

    def whole(seen: Column) -> Column:
        article = F.exists(seen, lambda block: block["inside"])
        return bind(article, lambda some: chosen(F.filter(seen, lambda block: ~some | block["inside"]), some))

    def chosen(kept: Column, some: Column) -> Column:
        edge = F.when(some, GOOD).otherwise("")
        first = F.array_join(F.transform(kept, first_label), "")
        final = F.split(spread_labels(F.concat(edge, first, edge)), "")
        skip = F.length(edge)

        def good(block: Column, label: Column) -> Column:
            return (label == GOOD) | ((label == TIE) & (block["heading"] | block["inside"]))

        return bind(
            F.struct(kept.alias("kept"), final.alias("final"), skip.alias("skip")),
            lambda v: F.array_join(
                F.transform(
                    F.filter(v["kept"], lambda b, i: good(b, F.get(v["final"], i + v["skip"]))),
                    lambda block: block["text"],
                ),
                "\n\n",
            ),
        )

    return bind(blocks, whole)


def extract(
    pages: DataFrame,
    page: str = "html",
    carry: Sequence[str] = ("page_id", "url"),
    stop_words: Iterable[str] | None = None,
) -> DataFrame:
    """Per page its main ``text`` and ``n_chars``, beside the carried columns.

    A helper cuts each page into blocks, reading it once from front to back; what
    stands in menus, headers, footers, sidebars, adverts, forms, scripts and readers'
    comments, by element, role, class or id, is left out there. The two passes over the blocks
    are column expressions. Nothing is shuffled, and a page is never held beside more than
    its batch.

    Defined cases: NULL and empty pages have an empty text; pages of any length are read
    whole; text outside any element is a block; an element that is never closed reaches to
    the end of its parent; repeated rows give equal rows; languages without stop words in
    the list keep their articles, and elsewhere only short blocks beside good ones. Columns not
    named in ``carry`` play no part; an empty table gives an empty table.
    """
    words = frozenset(" ".join(STOP_WORDS.values()).split() if stop_words is None else stop_words)
    rows = pages.select(*carry, F.coalesce(F.col(page), F.lit("")).alias("__page"))
    carried = [pa.field(name, to_arrow_type(rows.schema[name].dataType)) for name in carry]
    kinds = [f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in carry]
    schema = ", ".join([*kinds, f"__blocks array<{BLOCK}>"])
    read = rows.mapInArrow(_reader(words, carried), schema)
    texts = read.select(*carry, main_text(F.col("__blocks")).alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
