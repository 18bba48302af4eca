"""Near-duplicate groups by min-max hashing."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textguard.llm.bytehash import BASE, chunks, mix, numbers, shingle_sets, text_buffers
from textguard.llm.common import ROW_ID, ROW_TEXT, same_row, shuffles_dropped, with_row_key
from textguard.plans.components import connected_components
from textguard.session import broadcast_if_small, scratch, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BANDS = 40
PER_BAND = 5
Batches = Iterator[pa.RecordBatch]


def signatures(sets: list[np.ndarray], bands: int, per_band: int) -> np.ndarray:
    """Per set one key for each band.

    Every permutation (multiply and add modulo 2 ** 64) gives two values, its minimum and
    its maximum over the set, so half as many hashes are evaluated as values are kept; both
    agree between two sets with a chance that equals their similarity. A band's key
    joins ``per_band`` values and the number of the band. All sets must have a member.
    """
    n_hashes = (bands * per_band + 1) // 2
    factors = numbers(101, n_hashes) | np.uint64(1)
    shifts = numbers(202, n_hashes)
    members = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    values = np.empty((2 * n_hashes, len(sets)), np.uint64)
    for k in range(n_hashes):
        hashed = members * factors[k] + shifts[k]
        values[2 * k] = np.minimum.reduceat(hashed, starts)
        values[2 * k + 1] = np.maximum.reduceat(hashed, starts)
    keys = np.empty((bands, len(sets)), np.uint64)
    for band in range(bands):
        key = np.full(len(sets), band + 1, np.uint64)
        for row in values[band * per_band : (band + 1) * per_band]:
            key = mix(key) * BASE + row
        keys[band] = mix(key)
    return keys.T


def _each_chunk(
    batch: pa.RecordBatch, text: str, shingle: int
) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    data, offsets = text_buffers(batch.column(text))
    for low, high in chunks(offsets):
        first, last = offsets[low], offsets[high]
        yield low, high, shingle_sets(data[first:last], offsets[low : high + 1] - first, shingle)


def _signer(text: str, shingle: int, bands: int, per_band: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            keys = batch.drop_columns([text])
            for low, high, sets in _each_chunk(batch, text, shingle):
                full = [s for s in sets if len(s)]
                signed = iter(signatures(full, bands, per_band) if full else ())
                per_row = [next(signed).view(np.int64) if len(s) else None for s in sets]
                digests = [
                    hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                    for s in sets
                ]
                out = keys.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [
                        *out.columns,
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.array(per_row, pa.list_(pa.int64())),
                    ],
                    [*out.schema.names, "n_shingles", "digest", "bands"],
                )

    return run


def _set_writer(text: str, shingle: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for low, high, sets in _each_chunk(batch, text, shingle):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("rep").slice(low, high - low),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["rep", "members"],
                )

    return run


def _measurer() -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            shared, total = [], []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                a = np.frombuffer(left.as_buffer(), np.uint64)
                b = np.frombuffer(right.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([a, b]))
                shared.append(int(np.count_nonzero(both[1:] == both[:-1])))
                total.append(len(both) - shared[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(shared), pa.array(total)],
                ["a", "b", "shared", "total"],
            )

    return run


def _measure(pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """How much the full sets of the pairs (a, b) share, and the size of their union. A hub's
    set goes to the many pairs that hold it by a join that splits such keys."""
    lefts = sets.select(F.col("rep").alias("a"), F.col("members").alias("left"))
    rights = sets.select(F.col("rep").alias("b"), F.col("members").alias("right"))
    full = pairs.select("a", "b").join(lefts, "a").join(rights, "b")
    return stage(full.mapInArrow(_measurer(), "a long, b long, shared long, total long"), name)


def _comparer() -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            tokens = [
                np.setxor1d(
                    np.frombuffer(left.as_buffer(), np.int64),
                    np.frombuffer(right.as_buffer(), np.int64),
                    assume_unique=True,
                )
                for left, right in zip(batch.column("left"), batch.column("right"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("pivot"), batch.column("rep"), pa.array(tokens, pa.list_(pa.int64()))],
                ["pivot", "rep", "tokens"],
            )

    return run


def _differences(wide: DataFrame, sets: DataFrame) -> DataFrame:
    """Per (pivot, rep) the shingles that only one of the two has, the rarest in the
    pivot's group first, as ``tokens`` (an array of structs of ``df`` and ``token``)."""
    lefts = sets.select(F.col("rep").alias("pivot"), F.col("members").alias("left"))
    rights = sets.select("rep", F.col("members").alias("right"))
    full = wide.select("pivot", "rep").join(lefts, "pivot").join(rights, "rep")
    differ = stage(
        full.mapInArrow(_comparer(), "pivot long, rep long, tokens array<long>"), "minhash-differ"
    )
    each = differ.select("pivot", "rep", F.explode("tokens").alias("token"))
    often = each.groupBy("pivot", "token").agg(F.count(F.lit(1)).alias("df"))
    ordered = each.join(often, ["pivot", "token"]).groupBy("pivot", "rep").agg(
        F.sort_array(F.collect_set(F.struct("df", "token"))).alias("tokens")
    )
    return stage(ordered, "minhash-ordered")


def _apart(wide: DataFrame, differences: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one pivot's group and different labels that may be similar.

    With d(X) the shingles in which X differs from the pivot, two sets differ in
    |d(A)| + |d(B)| - 2 |d(A) & d(B)| shingles. So a similar pair must share a least number
    of differences, which follows from four sizes; it is over 0, because two sets
    that are similar without sharing any are both linked to the pivot and have one label.
    With all differences in one order, the first that such a pair shares stands early enough in
    both to leave room for the others. Those early ones are joined, and no similar pair is lost.

    Of a pair with two labels one at least is not linked to the pivot. What its partner
    joins ends at (|d| + c (n - pivot_n)) / 2, with c = (1 - s) / (1 + s) for a similarity s, since
    the other's differences exceed c times its size and the pivot's. Differences that most of the
    group share, which come last, are thus joined by few.
    """
    apart = F.lit(100 - percent) / F.lit(100 + percent)
    size = F.size("tokens")
    # |d| = n + pivot_n - 2 shared, so this is: shared / union < percent / 100.
    outside = size * (100 + percent) > (F.col("n") + F.col("pivot_n")) * (100 - percent)
    limit = F.floor((size + apart * (F.col("n") - F.col("pivot_n"))) / 2 + 1e-6)
    longest = F.floor(F.col("n") * (100 - percent) / F.lit(percent) + 1e-6)
    rows = wide.join(differences, ["pivot", "rep"]).select(
        "pivot",
        "rep",
        "n",
        "label",
        size.alias("size"),
        outside.alias("outside"),
        F.least(limit, longest).alias("limit"),
        F.posexplode(F.slice("tokens", 1, F.least(size, longest + 1).cast("int"))).alias("at", "entry"),
    )
    rows = rows.filter("entry.df > 1 AND (outside OR at <= limit)")
    rows = stage(rows.withColumn("token", F.col("entry.token")).drop("entry"), "minhash-prefixes")

    def side(mark: str, own: DataFrame) -> DataFrame:
        names = ("rep", "n", "label", "size", "outside", "limit", "at")
        return own.select("pivot", "token", *[F.col(c).alias(f"{mark}_{c}") for c in names])

    both = F.col("l_n") + F.col("r_n")
    least_shared = F.ceil(both * percent / F.lit(100 + percent) - 1e-6)
    needed = (F.col("l_size") + F.col("r_size") - both) / 2 + least_shared
    possible = (
        (F.col("l_label") != F.col("r_label"))
        & (~F.col("r_outside") | ((F.col("l_rep") < F.col("r_rep")) & (F.col("l_at") <= F.col("l_limit"))))
        & (F.least("l_n", "r_n") * 100 >= F.greatest("l_n", "r_n") * percent)
        & (F.col("l_at") <= F.col("l_size") - needed)
        & (F.col("r_at") <= F.col("r_size") - needed)
    )
    pairs = side("l", rows.filter("outside")).join(
        side("r", rows.filter("at <= limit")), ["pivot", "token"]
    )
    return pairs.filter(possible).select(
        F.least("l_rep", "r_rep").alias("a"), F.greatest("l_rep", "r_rep").alias("b")
    ).distinct()


def _links(measured: DataFrame, percent: int) -> DataFrame:
    return measured.filter(F.col("shared") * 100 >= F.col("total") * percent).select("a", "b")


def _open_rows(members: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """The members of buckets that hold several components, with their ``label``."""
    labels = stage(connected_components(links), f"{name}-labels")
    labelled = members.join(labels, members["rep"] == labels["node"], "left").select(
        "bucket", "rep", "n", F.coalesce("label", "rep").alias("label")
    )
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    mixed = stage(mixed.filter("lo < hi").select("bucket"), f"{name}-mixed")
    return stage(labelled.join(broadcast_if_small(mixed), "bucket"), name)


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    per_band: int = PER_BAND,
) -> DataFrame:
    """Per document: ``n_shingles``, ``component_id``, ``kept`` and the row key.

    Texts whose shingle sets have a Jaccard similarity of ``percent`` or more are linked,
    and a component is what links reach; its id is the smallest document id in it.

    1. One pass over the texts leaves the set size, a digest of the set and the band keys.
       Equal sets become one class, under its smallest id, before anything is compared.
    2. Classes that share a band key are candidates. Each class is first compared with one
       other only: the smallest id of a bucket, of all its buckets the one it meets most
       often. So a group of thousands costs one comparison a member, not one a pair.
    3. In buckets that still hold several components, each class is compared with the bucket's
       pivot, a class of the component with most members there: one comparison a member.
    4. In buckets that hold several components even then, pairs of classes from different
       components are compared if they share one of the rare shingles in which both differ
       from the pivot; ``_apart`` says why no similar pair lacks one. A pair within one
       component could not change the result.

    With 40 bands of 5 values a link at the limit of 0.8 is missed by all bands with a
    chance of 1.3e-7. Links are confirmed on the full sets of 64-bit shingle hashes.

    Defined cases: NULL, empty and blank texts have an empty set, link with nothing and are
    their own component; rows with one id are one document for the components (their texts'
    links join) and keep or lose all its rows; rows with a NULL id link with nothing, have a NULL
    component and are kept; other columns play no part; an empty table gives an empty table.
    """
    with shuffles_dropped(docs.sparkSession), scratch(docs.sparkSession):
        verdicts = _groups(docs, id_column, text, shingle, percent, bands, per_band)
        return stage(verdicts, "minhash-verdicts", keep=True)


def _groups(
    docs: DataFrame, id_column: str, text: str, shingle: int, percent: int, bands: int, per_band: int
) -> DataFrame:
    columns = docs.select(F.col(id_column).cast("long").alias(id_column), F.col(text))
    keyed = with_row_key(columns, id_column, text)
    slim = keyed.select(ROW_ID, ROW_TEXT, text)
    schema = f"{ROW_ID} long, {ROW_TEXT} long, n_shingles long, digest binary, bands array<long>"
    signed = stage(
        slim.mapInArrow(_signer(text, shingle, bands, per_band), schema), "minhash-signatures"
    )
    usable = signed.filter(F.col(ROW_ID).isNotNull() & (F.col("n_shingles") > 0))
    classes = stage(
        usable.groupBy("digest").agg(
            F.min(ROW_ID).alias("rep"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
            F.min(F.struct(ROW_ID, ROW_TEXT))[ROW_TEXT].alias("of_text"),
        ),
        "minhash-classes",
    )
    entries = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    hubs = entries.groupBy("bucket").agg(F.min("rep").alias("hub"), F.max("rep").alias("last"))
    shared = stage(hubs.filter(F.col("hub") < F.col("last")).select("bucket", "hub"), "minhash-buckets")
    members = stage(
        entries.join(broadcast_if_small(shared), "bucket").select("bucket", "hub", "rep", "n"),
        "minhash-members",
    )

    met = members.filter(F.col("rep") != F.col("hub")).groupBy("rep", "hub").agg(
        F.count(F.lit(1)).alias("times")
    )
    best = met.groupBy("rep").agg(F.max(F.struct("times", -F.col("hub"))).alias("best"))
    first = stage(
        best.select((-F.col("best.col2")).alias("a"), F.col("rep").alias("b")), "minhash-first"
    )
    wanted = broadcast_if_small(
        stage(
            members.select("rep")
            .distinct()
            .join(classes.select("rep", "of_text"), "rep")
            .select("rep", F.col("rep").alias("__rep"), "of_text"),
            "minhash-wanted",
        )
    )
    found = slim.join(
        wanted, (slim[ROW_ID] == wanted["__rep"]) & slim[ROW_TEXT].eqNullSafe(wanted["of_text"])
    )
    sets = stage(
        found.select("rep", text).mapInArrow(_set_writer(text, shingle), "rep long, members binary"),
        "minhash-sets",
    )
    measured = _measure(first, sets, "minhash-measured")
    links = _links(measured, percent)
    rows = _open_rows(members, links, "minhash-open")
    pivots = (
        rows.groupBy("bucket", "label")
        .agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("least"))
        .groupBy("bucket")
        .agg(F.max(F.struct("size", -F.col("least")))["col2"].alias("minus"))
        .select("bucket", (-F.col("minus")).alias("pivot"))
    )
    pivots = stage(pivots, "minhash-pivots")
    to_pivots = rows.join(broadcast_if_small(pivots), "bucket").filter("rep != pivot")
    to_pivots = to_pivots.select(
        F.least("pivot", "rep").alias("a"), F.greatest("pivot", "rep").alias("b")
    ).distinct()
    again = stage(to_pivots.join(measured, ["a", "b"], "left_anti"), "minhash-hubs")
    known = measured.union(_measure(again, sets, "minhash-measured-hubs"))
    links = _links(known, percent)
    rows = _open_rows(members, links, "minhash-left")

    wide = rows.join(broadcast_if_small(pivots), "bucket").filter("rep != pivot")
    wide = wide.select("pivot", "rep", "n", "label").distinct()
    # One bucket's pivot may be another's member: its own size comes from the classes.
    sizes = classes.select(F.col("rep").alias("pivot"), F.col("n").alias("pivot_n"))
    wide = stage(wide.join(sizes, "pivot"), "minhash-wide")
    across = _apart(wide, _differences(wide, sets), percent)
    rest = stage(across.join(known, ["a", "b"], "left_anti"), "minhash-rest")
    more = _links(_measure(rest, sets, "minhash-measured-rest"), percent)
    # Rows that share an id are one document, whatever their texts.
    several = usable.groupBy(ROW_ID).agg(
        F.min("digest").alias("lo"), F.max("digest").alias("hi")
    ).filter("lo < hi")
    by_digest = classes.select("digest", "rep")
    same_id = (
        usable.join(broadcast_if_small(several.select(ROW_ID)), ROW_ID)
        .join(by_digest, "digest")
        .select(F.col(ROW_ID).alias("a"), F.col("rep").alias("b"))
        .filter("a != b")
    )
    final = connected_components(stage(links.union(more).union(same_id), "minhash-all-links"))

    placed = usable.select(ROW_ID, ROW_TEXT, "digest").join(by_digest, "digest")
    result = placed.join(final, placed["rep"] == final["node"], "left").select(
        F.col(ROW_ID).alias("__i"),
        F.col(ROW_TEXT).alias("__t"),
        F.coalesce("label", "rep").alias("label"),
    )
    result = stage(
        result.groupBy("__i", "__t").agg(F.min("label").alias("label")), "minhash-result"
    )
    joined = signed.join(
        result,
        signed[ROW_ID].eqNullSafe(result["__i"]) & signed[ROW_TEXT].eqNullSafe(result["__t"]),
        "left",
    )
    component = F.coalesce("label", ROW_ID)
    return joined.select(
        F.col(ROW_ID).alias(id_column),
        ROW_ID,
        ROW_TEXT,
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col(ROW_ID) == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """One document of each group, with all its columns: that of the smallest id.

    The keys to drop are joined back, never the texts of a group gathered. Rows that repeat
    an id are cut to one: that of the smallest text hash, and of equal texts any. Only the keys
    to drop stay in the shared folder.
    """
    spark = docs.sparkSession
    keyed = with_row_key(docs, id_column, text)
    with scratch(spark):
        verdicts = near_duplicates(docs, id_column, text, shingle, percent)
        known = verdicts.filter(F.col(ROW_ID).isNotNull()).groupBy(ROW_ID).agg(
            F.min_by(ROW_TEXT, F.struct(F.col(ROW_TEXT).isNull(), F.col(ROW_TEXT))).alias("first"),
            F.count(F.lit(1)).alias("n"),
        )
        repeats = stage(known.filter("n > 1"), "minhash-repeats")
        gone = verdicts.filter(~F.col("kept")).select(ROW_ID, ROW_TEXT)
        if not repeats.isEmpty():
            several = broadcast_if_small(repeats.select(F.col(ROW_ID).alias("__i"), "first"))
            others = verdicts.join(several, verdicts[ROW_ID] == several["__i"])
            others = others.filter(~F.col(ROW_TEXT).eqNullSafe(F.col("first")))
            gone = gone.union(others.select(ROW_ID, ROW_TEXT))
        gone = stage(gone.distinct(), "minhash-gone", keep=True)
        twice = repeats.select(ROW_ID, F.col("first").alias(ROW_TEXT))
        twice = stage(twice.join(gone, [ROW_ID, ROW_TEXT], "left_anti"), "minhash-twice", keep=True)
    gone = broadcast_if_small(gone)
    kept = keyed.join(gone, same_row(keyed, gone), "left_anti")
    if twice.isEmpty():
        return kept.drop(ROW_ID, ROW_TEXT)
    twice = broadcast_if_small(twice)
    single = kept.join(twice, ROW_ID, "left_anti")
    one_each = kept.join(twice, ROW_ID, "left_semi").dropDuplicates([ROW_ID])
    return single.unionByName(one_each).drop(ROW_ID, ROW_TEXT)
