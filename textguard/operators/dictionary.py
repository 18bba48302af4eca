"""Terms of a dictionary table in texts: a trie for small tables, a join for large ones.

Texts and terms are cut into the same tokens, words and single signs, so a term is found
whatever white space stands between its tokens, and never within a word. Where several
terms begin at one place the longest holds, and terms do not overlap: the first from
the left holds.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textguard.functions import batches
from textguard.functions import text as tx
from textguard.functions import trie
from textguard.operators.rule import Rule, flag, scan
from textguard.plans.skew import spread_join
from textguard.session import is_small, scratch, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"
PIECE = rf"\s*(?:{TOKEN})"
TRIE_TERMS = 200_000
TRIE_CHARS = 8_000_000
HASHED_TERMS = 10_000_000
FOUND = "struct<codes:array<int>,terms:array<string>,labels:array<string>>"
RUN = "struct<place:int,n:int,h:bigint,g:bigint>"
# Odd factors of the two hashes of a run of tokens.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def tokens(text: Column, case_sensitive: bool = False) -> Column:
    return tx.extract(text if case_sensitive else F.lower(text), TOKEN)


def prepared(
    terms: DataFrame, term: str = "term", label: str = "label", case_sensitive: bool = False
) -> DataFrame:
    """The dictionary by token sequence: ``tokens``, ``term``, ``label``. Terms that are the same
    tokens are one, under the smallest label and then the smallest term."""
    split = terms.select(
        tokens(F.col(term), case_sensitive).alias("tokens"),
        F.struct(F.col(label).alias("label"), F.col(term).alias("term")).alias("entry"),
    ).filter(F.size("tokens") > 0)
    return split.groupBy("tokens").agg(F.min("entry").alias("entry")).select("tokens", "entry.*")


def fits_a_trie(dictionary: DataFrame) -> bool:
    """Whether a prepared dictionary is small enough, by terms and characters, to be sent to every task."""
    measured = dictionary.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.length(F.array_join("tokens", " "))), F.lit(0))
    ).first()
    return measured[0] <= TRIE_TERMS and measured[1] <= TRIE_CHARS


def matcher(dictionary: DataFrame):
    """A column function from tokens to FOUND: per token a code, 1 at the head of a term, -1 within
    one, else 0; and the terms and labels in order. For dictionaries that fit a trie."""
    rows = sorted(dictionary.select("tokens", "term", "label").collect())
    vocabulary, arrays = trie.build(row.tokens for row in rows)
    names = [(row.term, row.label) for row in rows]
    held = dictionary.sparkSession.sparkContext.broadcast((vocabulary, arrays, names))

    def match(column: pa.Array) -> pa.Array:
        vocabulary, arrays, names = held.value
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        texts = column.to_pylist()
        out = []
        for text in texts:
            if text is None:
                out.append(None)
                continue
            numbers = np.array([vocabulary.get(token, trie.NONE) for token in text], np.int64)
            hits = trie.longest_matches(numbers, arrays)
            codes = [0] * len(text)
            for place, size, _ in hits:
                codes[place : place + size] = [1] + [-1] * (size - 1)
            found = [names[number] for _, _, number in hits]
            out.append(
                {"codes": codes, "terms": [t for t, _ in found], "labels": [n for _, n in found]}
            )
        strings = pa.list_(pa.string())
        kind = pa.struct([("codes", pa.list_(pa.int32())), ("terms", strings), ("labels", strings)])
        return pa.array(out, kind)

    return F.arrow_udf(match, FOUND)


def masked(text: Column, found: Column, mark: str = "<{label}>") -> Column:
    """The text with each term replaced, what stands around it unchanged."""
    before, after = mark.split("{label}") if "{label}" in mark else (mark, "")
    labels = found["labels"] if "{label}" in mark else F.transform(found["labels"], lambda _: F.lit(""))
    cut = tx.extract(text, PIECE)

    def joined(state: Column) -> Column:
        # Heads of terms become a sign that no piece holds; then labels go where the signs are.
        kept = F.array_join(
            F.zip_with(
                state["pieces"],
                state["codes"],
                lambda piece, code: F.when(code == 0, F.translate(piece, HEAD, ""))
                .when(code == 1, F.concat(F.regexp_extract(piece, r"\A\s*", 0), F.lit(HEAD)))
                .otherwise(""),
            ),
            "",
        )
        parts = F.split(kept, HEAD, -1)
        put = F.transform(state["labels"], lambda label: F.concat(F.lit(before), label, F.lit(after)))
        return F.array_join(F.zip_with(parts, put, lambda part, mark: F.concat(part, F.coalesce(mark, F.lit("")))), "")

    whole = tx.bind(
        F.struct(cut.alias("pieces"), found["codes"].alias("codes"), labels.alias("labels")), joined
    )
    tail = F.regexp_extract(text, r"\s*\z", 0)
    return F.when(F.size(found["labels"]) > 0, F.concat(whole, tail)).otherwise(text)


HEAD = "\U000fffff"


def dictionary_rule(
    name: str,
    terms: DataFrame,
    term: str = "term",
    label: str = "label",
    case_sensitive: bool = False,
    mark: str = "<{label}>",
) -> Rule:
    """Texts that hold a term of a table are invalid; the repair puts a mark in its place, and
    the verdict lists the ``terms`` found. One pass over the texts, whatever the number of terms.

    For tables that fit a trie; longer ones are for ``find_terms``.
    """
    dictionary = stage(prepared(terms, term, label, case_sensitive), "dictionary")
    if not fits_a_trie(dictionary):
        raise ValueError(f"over {TRIE_TERMS} terms or {TRIE_CHARS} characters: use redact_terms or find_terms")
    return _trie_rule(name, dictionary, case_sensitive, mark)


def _rule(name: str, measure, mark: str) -> Rule:
    return Rule(
        name,
        lambda found: flag(F.size(found["terms"]) > 0),
        measure=measure,
        details={"terms": lambda found: found["terms"]},
        repair=lambda text, found: masked(text, found, mark),
    )


def _trie_rule(name: str, dictionary: DataFrame, case_sensitive: bool, mark: str) -> Rule:
    match = matcher(dictionary)
    return _rule(name, lambda text: match(tokens(text, case_sensitive)), mark)


def _hits_by_trie(df: DataFrame, key: str, text: str, dictionary: DataFrame, case: bool) -> DataFrame:
    match = matcher(dictionary)
    found = df.select(key, match(tokens(F.col(text), case)).alias("found"))
    pairs = F.arrays_zip("found.terms", "found.labels")
    starts = F.filter(
        F.transform("found.codes", lambda code, at: F.when(code == 1, at)), lambda at: at.isNotNull()
    )
    rows = found.select(key, F.posexplode(pairs).alias("nth", "pair"), starts.alias("starts"))
    return rows.select(
        key, F.get("starts", F.col("nth")).alias("place"), "pair.terms", "pair.labels"
    ).toDF(key, "place", "term", "label")


def _chooser(column: pa.Array) -> pa.Array:
    """Of the longest terms at each place, those that stay when read from the left."""
    out = []
    for hits in column.to_pylist():
        free, kept = 0, []
        for hit in sorted(hits, key=lambda hit: hit["place"]):
            if hit["place"] >= free:
                kept.append(hit)
                free = hit["place"] + hit["size"]
        out.append(kept)
    return pa.array(out, column.type)


def _run_hashes(flat: np.ndarray, size: int) -> list[np.ndarray]:
    """Two hashes of the run of so many tokens from each place on, of 64 bits each."""
    out = []
    for factor in FACTORS:
        run = np.zeros(max(len(flat) - size + 1, 0), np.uint64)
        for step in range(size):
            token = flat[step : step + len(run)]
            run = run * np.uint64(factor) + (token ^ (token >> np.uint64(factor & 31)))
        out.append((run ^ (run >> np.uint64(29))) * np.uint64(factor))
    return out


def _token_hashes(words: Column) -> Column:
    return F.transform(words, lambda token: F.xxhash64(token))


def _hashed(dictionary: DataFrame) -> DataFrame:
    """(run, term, label) of a prepared dictionary."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            lists = batch.column(0)
            flat, count = lists.flatten().to_numpy().view(np.uint64), batches.sizes(lists)
            start = np.cumsum(count) - count
            hashes = np.zeros((2, len(count)), np.uint64)
            for size in np.unique(count).tolist():
                rows = np.flatnonzero(count == size)
                for at, each in enumerate(_run_hashes(flat, size)):
                    hashes[at, rows] = each[start[rows]]
            runs = [pa.array(np.zeros(len(count), np.int32)), pa.array(count.astype(np.int32))]
            runs += [pa.array(each.view(np.int64)) for each in hashes]
            runs = pa.StructArray.from_arrays(runs, ["place", "n", "h", "g"])
            yield pa.RecordBatch.from_arrays([runs, batch.column(1), batch.column(2)], ["run", "term", "label"])

    listed = dictionary.select(_token_hashes(F.col("tokens")), "term", "label")
    types = ",".join(f"{name} {dictionary.schema[name].dataType.simpleString()}" for name in ("term", "label"))
    return listed.mapInArrow(run, f"run {RUN},{types}").selectExpr(
        "run.n AS n", "run.h AS h", "run.g AS g", "term", "label"
    )


def _kept(longest: np.ndarray) -> np.ndarray:
    """Places of the terms that stay when read from the left."""
    out, free = [], 0
    for place in np.flatnonzero(longest).tolist():
        if place >= free:
            out.append(place)
            free = place + int(longest[place])
    return np.array(out, np.int64)


def _run_finder(lookup: DataFrame):
    """A column function from tokens to the runs that are terms, the longest at each place and without
    overlap. The tasks get two hashes per term, sorted by the first; texts stay in their rows."""
    found = lookup.select("n", "h", "g").toArrow()
    columns = [found[name].combine_chunks().to_numpy() for name in ("n", "h", "g")]
    sizes = np.unique(columns[0]).tolist()
    h, g = columns[1].view(np.uint64), columns[2].view(np.uint64)
    order = np.lexsort((g, h))
    held = lookup.sparkSession.sparkContext.broadcast((sizes, h[order], g[order]))

    def find(column: pa.Array) -> pa.Array:
        sizes, first, second = held.value
        # A table by leading bits tells most runs that are no terms.
        bits = max(10, int(8 * len(first)).bit_length())
        shift = np.uint64(64 - bits)
        seen = np.zeros(1 << bits, bool)
        seen[first >> shift] = True
        out = []
        for lists in batches.slices(column):
            flat, count = lists.flatten().to_numpy().view(np.uint64), batches.sizes(lists)
            left = np.repeat(np.cumsum(count), count) - np.arange(len(flat))
            longest = np.zeros(len(flat), np.int32)
            hashes = np.zeros((2, len(flat)), np.uint64)
            for size in sizes:
                h, g = _run_hashes(flat, size)
                some = np.flatnonzero(seen[h >> shift] & (left[: len(h)] >= size))
                h, g = h[some], g[some]
                at = np.searchsorted(first, h)
                hit = np.zeros(len(some), bool)
                open_ = np.flatnonzero(at < len(first))
                while len(open_):
                    # Terms that agree in the first hash stand side by side.
                    open_ = open_[first[at[open_]] == h[open_]]
                    hit[open_] |= second[at[open_]] == g[open_]
                    at[open_] += 1
                    open_ = open_[~hit[open_] & (at[open_] < len(first))]
                places = some[hit]
                longest[places] = size
                hashes[0, places], hashes[1, places] = h[hit], g[hit]
            places = _kept(longest)
            ends = np.cumsum(count)
            row = np.searchsorted(ends, places, "right")
            place = (places - (ends - count)[row]).astype(np.int32)
            runs = [place, longest[places], *(each[places].view(np.int64) for each in hashes)]
            runs = pa.StructArray.from_arrays([pa.array(each) for each in runs], ["place", "n", "h", "g"])
            known = lists.is_valid().to_numpy(zero_copy_only=False)
            out.append(batches.listed(runs, np.bincount(row, minlength=len(count)), known))
        kind = pa.struct([("place", pa.int32()), ("n", pa.int32()), ("h", pa.int64()), ("g", pa.int64())])
        return pa.concat_arrays([pa.array([], pa.list_(kind)), *out])

    finder = F.arrow_udf(find, f"array<{RUN}>")
    return lambda words: finder(_token_hashes(words))


def _named(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """Rows with ``run``, staged, joined with the terms of their runs."""
    rows = stage(rows.select("*", F.struct("run.n", "run.h", "run.g").alias("__term")), "dictionary-found")
    lookup = lookup.select(F.struct("n", "h", "g").alias("__term"), "term", "label")

    def counts() -> tuple[DataFrame, str]:
        return rows.groupBy("__term").agg(F.count(F.lit(1)).alias("n")), "n"

    keys = [name for name in rows.columns if name not in ("run", "__term")]
    return spread_join(rows, lookup, "__term", counts, [*keys, "run.place"]).drop("__term")


def _hits_by_hash(df: DataFrame, key: str, text: str, dictionary: DataFrame, case: bool) -> DataFrame:
    lookup = stage(_hashed(dictionary), "dictionary-hashes")
    runs = _run_finder(lookup)(tokens(F.col(text), case))
    return _named(df.select(key, F.explode(runs).alias("run")), lookup).select(key, "run.place", "term", "label")


def _hits_by_join(df: DataFrame, key: str, text: str, dictionary: DataFrame, case: bool) -> DataFrame:
    """Runs of tokens meet the dictionary by two hashes; texts are not shuffled."""

    def hashes(run: Column) -> Column:
        joined = F.array_join(run, "\x00")
        return F.struct(F.size(run).alias("n"), F.xxhash64(joined).alias("h"), F.hash(joined).alias("g"))

    lookup = dictionary.select(hashes(F.col("tokens")).alias("run"), "term", "label")
    lookup = stage(lookup, "dictionary-runs")
    sizes = sorted(row.n for row in lookup.select("run.n").distinct().collect())

    def runs(words: Column) -> Column:
        def of_size(size: int) -> Column:
            places = F.when(
                F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)
            ).otherwise(F.array().cast("array<int>"))
            return F.transform(
                places,
                lambda at: F.struct(at.alias("place"), hashes(F.slice(words, at + 1, size)).alias("run")),
            )

        return F.flatten(F.array(*[of_size(size) for size in sizes]))

    spread = df.select(key, F.explode(tx.bind(tokens(F.col(text), case), runs)).alias("at"))
    spread = spread.select(key, "at.place", "at.run")

    def counts() -> tuple[DataFrame, str]:
        return spread.groupBy("run").agg(F.count(F.lit(1)).alias("n")), "n"

    hits = spread_join(spread, lookup, "run", counts, [key, "place"])
    longest = hits.groupBy(key, "place").agg(
        F.max_by(F.struct("run.n", "term", "label"), F.col("run.n")).alias("best")
    )
    listed = longest.groupBy(key).agg(
        F.collect_list(F.struct("place", F.col("best.n").alias("size"), "best.term", "best.label")).alias("hits")
    )
    listed = listed.withColumn("hits", F.array_sort("hits"))
    kind = listed.schema["hits"].dataType.simpleString()
    chosen = listed.select(key, F.explode(F.arrow_udf(_chooser, kind)("hits")).alias("hit"))
    return chosen.select(key, "hit.place", "hit.term", "hit.label")


def find_terms(
    df: DataFrame,
    key: str,
    text: str,
    terms: DataFrame,
    term: str = "term",
    label: str = "label",
    case_sensitive: bool = False,
) -> DataFrame:
    """(key, place, term, label): every term in every text, by the number of its first token.

    The key identifies rows. A dictionary that fits is sent to the tasks as a trie and the
    texts are read once, without a shuffle. Of a longer one the tasks get two hashes per term,
    and what is shuffled are hits, to meet their terms. One of over HASHED_TERMS terms is joined
    with the hashed runs of tokens of each length that it has; what is shuffled are runs and hits.
    NULL and empty texts hold no terms; NULL and empty terms are none.
    """
    with scratch(df.sparkSession):
        dictionary = stage(prepared(terms, term, label, case_sensitive), "dictionary")
        short = fits_a_trie(dictionary)
        find = _hits_by_trie if short else _hits_by_hash if is_small(dictionary, HASHED_TERMS) else _hits_by_join
        return stage(find(df, key, text, dictionary, case_sensitive), "dictionary-hits", keep=True)


def _token_codes(places: pa.Array, sizes: pa.Array, count: pa.Array) -> pa.Array:
    """Per token 1 at the head of a term, -1 within one, else 0."""
    out = []
    for heads, spans, n in zip(places.to_pylist(), sizes.to_pylist(), count.to_pylist()):
        codes = [0] * n if n is not None and n >= 0 else None
        for head, span in zip(heads, spans):
            codes[head : head + span] = [1] + [-1] * (span - 1)
        out.append(codes)
    return pa.array(out, pa.list_(pa.int32()))


def redact_terms(
    df: DataFrame,
    text: str,
    terms: DataFrame,
    name: str = "known",
    term: str = "term",
    label: str = "label",
    case_sensitive: bool = False,
    mark: str = "<{label}>",
) -> DataFrame:
    """Add the verdict of ``dictionary_rule`` for dictionaries of any length.

    One that fits a trie is scanned as that rule. Of a longer one the hits of each row, which gets
    a number for it, are named by a join and come back to the row.
    """
    dictionary = stage(prepared(terms, term, label, case_sensitive), "dictionary")
    if fits_a_trie(dictionary):
        return scan(df, text, _trie_rule(name, dictionary, case_sensitive, mark))
    rows = stage(df.withColumn("__row", F.monotonically_increasing_id()), "dictionary-rows")
    if is_small(dictionary, HASHED_TERMS):
        lookup = stage(_hashed(dictionary), "dictionary-hashes")
        runs = _run_finder(lookup)(tokens(F.col(text), case_sensitive))
        hits = _named(rows.select("__row", F.explode(runs).alias("run")), lookup)
        hits = hits.select("__row", "run.place", "run.n", "term", "label")
    else:
        size = F.size(tokens(F.col("term"), case_sensitive)).alias("n")
        hits = _hits_by_join(rows, "__row", text, dictionary, case_sensitive)
        hits = hits.select("__row", "place", size, "term", "label")
    listed = hits.groupBy("__row").agg(
        F.array_sort(F.collect_list(F.struct("place", "n", "term", "label"))).alias("hits")
    )
    nothing = F.array().cast(listed.schema["hits"].dataType)
    joined = rows.join(listed, "__row", "left").withColumn("__hits", F.coalesce("hits", nothing))
    codes = F.arrow_udf(_token_codes, "array<int>")
    count = F.size(tokens(F.col(text), case_sensitive))
    found = F.struct(
        codes(F.col("__hits.place"), F.col("__hits.n"), count).alias("codes"),
        F.col("__hits.term").alias("terms"),
        F.col("__hits.label").alias("labels"),
    )
    known = F.when(F.col(text).isNotNull(), found)
    return scan(joined, text, _rule(name, lambda _: known, mark)).drop("__row", "hits", "__hits")


def term_counts(hits: DataFrame, by: Sequence[str] = ("label", "term")) -> DataFrame:
    """Texts and places per term."""
    key = [name for name in hits.columns if name not in ("place", "term", "label")][0]
    per_text = hits.groupBy(*by, key).agg(F.count(F.lit(1)).alias("n"))
    return per_text.groupBy(*by).agg(F.count(F.lit(1)).alias("n_texts"), F.sum("n").alias("n_hits"))
