"""Toxic spans by a linear-chain conditional random field."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textguard.llm.bytehash import chunks, mix, text_buffers, token_features
from textguard.session import broadcast_if_small, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A feature is a candidate if so many toxic texts hold it, at any size of the corpus.
LEAST = 4
# Bits of the sieve that spares the clean texts' other features the shuffle.
SIEVE = 1 << 23
# A feature in fewer toxic texts of the sample than this is also weighed by its counts over all texts.
FEW = 8
# Added to twice the logarithm of the number of candidates, the least gain of a feature.
CHANCE = 6.0
# Tokens with a feature of such odds ratio (as a logarithm) are the labelled toxic tokens.
TOXIC_ODDS = 3.0
# Texts of either label that the field is fitted on, and tokens in a training segment.
SAMPLE, SEGMENT = 1000, 32
ROUNDS, STEP, DECAY = 60, 0.3, 1e-3
Batches = Iterator[pa.RecordBatch]


@dataclass
class Field:
    """The fitted model: sorted feature hashes, their weights for the state "toxic",
    the least that a token with such a feature weighs, transitions between
    (other, toxic), the score of a token without features, and the document score's
    intercept, slope for the largest and for the summed marginal."""

    features: np.ndarray
    weights: np.ndarray
    floors: np.ndarray
    moves: np.ndarray
    plain: float
    scale: tuple[float, float, float]


class Lookup:
    """Finds the number of each feature hash, behind a table of its low bits."""

    def __init__(self, features: np.ndarray):
        self.features = features
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(features & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, numbers) of the hashes that are known features."""
        places = np.flatnonzero(self.seen[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if len(self.features) == 0 or len(places) == 0:
            return places[:0], places[:0]
        numbers = np.searchsorted(self.features, hashes[places])
        numbers[numbers == len(self.features)] = 0
        exact = self.features[numbers] == hashes[places]
        return places[exact], numbers[exact]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def _counter(sieve: np.ndarray | None) -> Callable[[Batches], Batches]:
    """Per batch and feature the number of texts that hold it; a ``sieve`` drops features
    that are no candidates, and lets a few of them pass."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            seen: list[np.ndarray] = []
            for low, high in chunks(offsets):
                first, last = offsets[low], offsets[high]
                columns, bounds, _, _ = token_features(
                    data[first:last], offsets[low : high + 1] - first
                )
                owner = np.repeat(np.arange(low, high, dtype=np.uint64), np.diff(bounds))
                for hashes in columns:
                    full = hashes != 0
                    if sieve is not None:
                        bits = hashes & np.uint64(SIEVE - 1)
                        words = sieve[(bits >> np.uint64(6)).astype(np.int64)]
                        full &= (words >> (bits & np.uint64(63))) & np.uint64(1) == 1
                    picked, rows = hashes[full], owner[full]
                    _, once = np.unique(mix(picked + mix(rows + np.uint64(1))), return_index=True)
                    seen.append(picked[once])
            features, counts = np.unique(
                np.concatenate(seen or [np.zeros(0, np.uint64)]), return_counts=True
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(features.view(np.int64)), pa.array(counts.astype(np.int64))],
                ["feature", "n"],
            )

    return run


def _count_features(texts: DataFrame, sieve: np.ndarray | None = None) -> DataFrame:
    counted = texts.select("text").mapInArrow(_counter(sieve), "feature long, n long")
    return counted.groupBy("feature").agg(F.sum("n").alias("n"))


def _sieve(candidates: DataFrame) -> np.ndarray:
    """A bitmap of fixed size of the candidates' low bits, made in Spark, as 64-bit words."""
    bit = F.col("feature").bitwiseAND(SIEVE - 1)
    one = F.expr(f"shiftleft(1L, cast((feature & {SIEVE - 1}) & 63 as int))")
    words = candidates.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(one).alias("bits"))
    found = words.toArrow()
    out = np.zeros(SIEVE // 64, np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint64)


def _telling(toxic: DataFrame, clean: DataFrame, n_toxic: int, n_clean: int) -> tuple[np.ndarray, np.ndarray]:
    """(features, log odds) of all features that LEAST toxic texts hold, that have log odds of
    1 or more, and whose frequency ratio is no accident among so many candidates. Counts are
    joined and tested in Spark; only those that pass come to the driver."""
    candidates = _count_features(toxic).filter(F.col("n") >= LEAST)
    candidates = stage(candidates.withColumnRenamed("n", "a"), "toxicity-candidates")
    number = candidates.count()
    if number == 0:
        return np.zeros(0, np.uint64), np.zeros(0)
    others = _count_features(clean, _sieve(candidates)).withColumnRenamed("n", "b")
    a, b = F.col("a").cast("double"), F.coalesce(F.col("b"), F.lit(0)).cast("double")
    odds = F.log((a + 0.5) / (n_toxic - a + 0.5)) - F.log((b + 0.5) / (n_clean - b + 0.5))
    seen, share = a + b, n_toxic / max(1, n_toxic + n_clean)

    def part(count: Column, expected: Column) -> Column:
        return count * F.log(F.greatest(count, F.lit(1e-9)) / F.greatest(expected, F.lit(1e-9)))

    gain = 2 * (part(a, seen * share) + part(b, seen * (1 - share)))
    passed = (
        candidates.join(others, "feature", "left")
        .select("feature", odds.alias("odds"), gain.alias("gain"))
        .filter((F.col("odds") >= 1.0) & (F.col("gain") >= 2 * float(np.log(number)) + CHANCE))
        .select("feature", "odds")
        .toArrow()
    )
    features = passed["feature"].to_numpy().view(np.uint64)
    order = np.argsort(features)
    return features[order], passed["odds"].to_numpy()[order]


def _supports(rows: list[tuple[str, int]], lookup: Lookup) -> np.ndarray:
    """In how many of the sampled toxic texts each feature is."""
    out = np.zeros(len(lookup.features), np.int64)
    for text, toxic in rows:
        if toxic:
            body = np.frombuffer(text.encode(), np.uint8)
            columns, _, _, _ = token_features(body, np.array([0, len(body)]))
            out[np.unique(np.concatenate([lookup.find(hashes)[1] for hashes in columns]))] += 1
    return out


def _segments(
    rows: list[tuple[str, int]], lookup: Lookup, marks: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token of each feature, feature, tags, weights): sampled texts as segments of
    SEGMENT tokens. A token is tagged toxic if the text is and a marked feature is on it."""
    at, numbers, tags, lengths, total = [], [], [], [], 0
    for text, toxic in rows:
        body = np.frombuffer(text.encode(), np.uint8)
        columns, _, _, _ = token_features(body, np.array([0, len(body)]))
        count = len(columns[0])
        if count == 0:
            continue
        tag = np.zeros(count, np.int64)
        for hashes in columns:
            places, found = lookup.find(hashes)
            at.append(places + total)
            numbers.append(found)
            if toxic:
                tag[places[marks[found]]] = 1
        tags.append(tag)
        total += -(-count // SEGMENT) * SEGMENT
        tags.append(np.full(-count % SEGMENT, -1))
        lengths += [SEGMENT] * (count // SEGMENT) + ([count % SEGMENT] if count % SEGMENT else [])
    none = np.zeros(0, np.int64)
    return _collapse(
        np.concatenate(at or [none]),
        np.concatenate(numbers or [none]),
        np.concatenate(tags or [none]),
        np.array(lengths, np.int64),
    )


def _collapse(
    at: np.ndarray, numbers: np.ndarray, tags: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments without any feature are alike if of one length: one stands for all of them,
    with their number as its weight."""
    telling = np.zeros(len(lengths), bool)
    telling[at // SEGMENT] = True
    kept = np.flatnonzero(telling)
    sizes, first, counts = np.unique(
        lengths[~telling], return_index=True, return_counts=True
    )
    alike = np.flatnonzero(~telling)[first]
    new = np.zeros(len(lengths), np.int64)
    new[kept] = np.arange(len(kept))
    picked = np.concatenate([kept, alike])
    weights = np.concatenate([np.ones(len(kept)), counts.astype(float)])
    moved = new[at // SEGMENT] * SEGMENT + at % SEGMENT
    return moved, numbers, tags.reshape(-1, SEGMENT)[picked].ravel(), weights


def _fit(
    at: np.ndarray, numbers: np.ndarray, tags: np.ndarray, counts: np.ndarray, n_features: int
) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights, transitions and plain score by gradient ascent on the likelihood of the tags.

    All segments are stepped through side by side: forward, backward, then the tags'
    counts less the expected ones. The transition into other tokens from others is fixed at 0.
    """
    weights = np.zeros(n_features)
    moves = np.array([[0.0, -2.0], [0.0, 0.0]])
    plain = -2.0
    if len(counts) == 0:
        return weights, moves, plain
    shape = (len(counts), SEGMENT)
    tag = tags.reshape(shape)
    inside = tag >= 0
    rates = [np.zeros(n_features), np.zeros((2, 2)), 0.0]
    for _ in range(ROUNDS):
        score = plain + np.bincount(at, weights[numbers], len(tags)).reshape(shape)
        emit = np.stack([np.zeros(shape), score], axis=2)
        emit[~inside] = 0.0
        forward = np.zeros((*shape, 2))
        backward = np.zeros((*shape, 2))
        forward[:, 0] = emit[:, 0]
        for t in range(1, SEGMENT):
            step = forward[:, t - 1, :, None] + moves
            forward[:, t] = np.logaddexp(step[:, 0], step[:, 1]) + emit[:, t]
        for t in range(SEGMENT - 2, -1, -1):
            step = moves + (emit[:, t + 1] + backward[:, t + 1])[:, None, :]
            back = np.logaddexp(step[:, :, 0], step[:, :, 1])
            backward[:, t] = np.where(inside[:, t + 1, None], back, 0.0)
        both = forward + backward
        chance = 1 / (1 + np.exp(np.clip(both[..., 0] - both[..., 1], -500, 500)))
        slack = np.where(inside, (tag == 1) - chance, 0.0) * counts[:, None]
        of_feature = np.bincount(numbers, slack.ravel()[at], n_features)
        whole = np.logaddexp(both[:, 0, 0], both[:, 0, 1])[:, None]
        of_moves = np.zeros((2, 2))
        pair = inside[:, 1:]
        for a in (0, 1):
            for b in (0, 1):
                path = forward[:, :-1, a] + moves[a, b] + emit[:, 1:, b] + backward[:, 1:, b] - whole
                seen = (tag[:, :-1] == a) & (tag[:, 1:] == b)
                of_moves[a, b] = np.sum(((seen - np.exp(np.minimum(path, 0.0))) * counts[:, None])[pair])
        of_moves[0, 0] = of_moves[1, 0] = 0.0
        scale = 1.0 / counts.sum()
        slopes = [
            of_feature * scale - DECAY * scale * weights,
            of_moves * scale - DECAY * scale * moves,
            float(slack.sum()) * scale - DECAY * scale * plain,
        ]
        rates = [r + s * s for r, s in zip(rates, slopes, strict=True)]
        steps = [STEP * s / (np.sqrt(r) + 1e-12) for s, r in zip(slopes, rates, strict=True)]
        weights, moves, plain = weights + steps[0], moves + steps[1], plain + float(steps[2])
    return weights, moves, plain


def chain_marginals(
    scores: np.ndarray, places: np.ndarray, bounds: np.ndarray, ends: np.ndarray, model: Field
) -> np.ndarray:
    """The chance of "toxic" for each token that has a feature, by forward-backward.

    Tokens without features all score alike, so a gap of g of them is the g-th power of
    one 2 x 2 matrix, from its eigenvalues; the chain runs over the tokens with features
    only and is exact. ``bounds`` are the texts' ranges of these tokens, ``places`` their
    token numbers, ``ends`` the texts' numbers of tokens. Texts advance side by side.
    """
    one = np.exp(model.moves) * np.array([1.0, np.exp(model.plain)])
    middle, spread = (one[0, 0] + one[1, 1]) / 2, (one[0, 0] - one[1, 1]) / 2
    root = np.sqrt(spread**2 + one[0, 1] * one[1, 0])
    large, small = middle + root, middle - root
    first = (one - small * np.eye(2)) / (large - small)
    second = np.eye(2) - first

    def gap(sizes: np.ndarray) -> np.ndarray:
        ratio = (small / large) ** sizes.astype(float)
        return first + ratio[:, None, None] * second

    counts = np.diff(bounds)
    order = np.argsort(-counts, kind="stable")
    starts, counts, ends = bounds[:-1][order], counts[order], ends[order]
    longest = int(counts[0]) if len(counts) else 0
    capped = np.exp(np.clip(scores, -50, 50))
    step = np.exp(model.moves)
    before = np.zeros((len(scores), 2))
    after = np.ones((len(scores), 2))
    state = np.zeros((len(counts), 2))
    state[:, 0] = 1.0
    for t in range(longest):
        live = int(np.searchsorted(-counts, -t, "left"))
        index = starts[:live] + t
        if t == 0:
            # The first token of a text has no transition into it: the state before is a
            # vector of ones over "starts here", written as the emission of that token.
            lead = places[index]
            begin = np.tile([1.0, np.exp(model.plain)], (live, 1))
            reached = np.einsum("ni,nij->nj", begin, gap(np.maximum(lead - 1, 0)))
            reached = np.where((lead > 0)[:, None], reached @ step, 1.0)
        else:
            reached = np.einsum("ni,nij->nj", state[:live], gap(places[index] - places[index - 1] - 1))
            reached = reached @ step
        reached[:, 1] *= capped[index]
        reached /= reached.sum(axis=1, keepdims=True)
        before[index] = reached
        state[:live] = reached
    for t in range(longest - 1, -1, -1):
        live = int(np.searchsorted(-counts, -t, "left"))
        index = starts[:live] + t
        last = counts[:live] - 1 == t
        tail = np.where(last, ends[:live] - 1 - places[index], 0)
        closing = gap(tail).sum(axis=2)
        following = np.where(last, index, np.minimum(index + 1, len(scores) - 1))
        coming = after[following] * np.stack([np.ones(live), capped[following]], axis=1)
        between = np.where(last, 0, places[following] - places[index] - 1)
        inner = np.einsum("nij,nj->ni", gap(between), coming @ step.T)
        here = np.where(last[:, None], closing, inner)
        after[index] = here / here.sum(axis=1, keepdims=True)
    both = before * after
    return both[:, 1] / np.maximum(both.sum(axis=1), 1e-300)


def _measures(
    data: np.ndarray, offsets: np.ndarray, model: Field, lookup: Lookup
) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
    """Per text the largest and the summed marginal; and (row, start, end, chance) of tokens."""
    columns, bounds, starts, stops = token_features(data, offsets)
    weights, floors = np.zeros(len(starts)), np.full(len(starts), -np.inf)
    informed = np.zeros(len(starts), bool)
    for hashes in columns:
        places, numbers = lookup.find(hashes)
        weights[places] += model.weights[numbers]
        floors[places] = np.maximum(floors[places], model.floors[numbers])
        informed[places] = True
    scores = model.plain + np.maximum(weights, floors)
    tokens = np.flatnonzero(informed)
    ranges = np.searchsorted(tokens, bounds)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(ranges))
    chances = chain_marginals(
        scores[tokens], tokens - bounds[owner], ranges, np.diff(bounds), model
    )
    most = np.zeros(len(offsets) - 1)
    np.maximum.at(most, owner, chances)
    total = np.bincount(owner, chances, len(offsets) - 1)
    return most, total, owner, (starts[tokens] - offsets[owner], stops[tokens] - offsets[owner], chances)


def _inputs(most: np.ndarray, total: np.ndarray) -> np.ndarray:
    odds = np.log((most + 1e-4) / (1 - most + 1e-4))
    return np.stack([np.ones(len(most)), odds, np.log1p(total)], axis=1)


def _calibrate(inputs: np.ndarray, labels: np.ndarray, base: float) -> tuple[float, float, float]:
    """Logistic regression of the labels on the document measures, by Newton steps; each class
    weighs as its share of all labelled texts (``base``), whatever the sample took."""
    if len(labels) == 0 or labels.min() == labels.max():
        low = np.log((base + 1e-3) / (1 - base + 1e-3))
        return float(low), 0.0, 0.0
    share = labels.mean()
    weight = np.where(labels == 1, base / share, (1 - base) / (1 - share))
    beta = np.zeros(3)
    ridge = np.diag([1e-3, 1e-2, 1e-2]) * len(labels) * 0.01
    for _ in range(30):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ beta, -30, 30)))
        slope = inputs.T @ (weight * (labels - chance)) - ridge @ beta
        curve = (inputs * (weight * chance * (1 - chance))[:, None]).T @ inputs + ridge
        beta = beta + np.linalg.solve(curve + 1e-6 * np.eye(3), slope)
    return tuple(float(b) for b in beta)  # type: ignore[return-value]


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> Field:
    """Fit the field on labelled texts, leaving the held-out fifth alone.

    1. Over all labelled texts, counts of the texts of either label that hold a feature (a
       token, or its first 3 to 6 bytes), joined in Spark. Features in LEAST toxic texts
       take part, however many texts there are, if they tell toxic from clean texts.
    2. Tokens of toxic texts with a feature of log odds of TOXIC_ODDS or more are
       the labelled toxic tokens. The field is fitted on SAMPLE texts of each label, by hash
       of the id, and so is the scale of document scores.
    3. The sample holds rarer features seldom or never. A feature of TOXIC_ODDS or more that
       fewer than FEW of its toxic texts hold makes a token weigh at least so much that, alone
       among other tokens, its log odds are those counted over all texts.
    """
    known = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("__y"))
    known = known.filter(F.col("__id").isNotNull() & F.col("__y").isNotNull() & ~held_out(F.col("__id")))
    known = stage(known.groupBy("__id").agg(F.max("__y").alias("__y")), "toxicity-labels")
    rows = docs.select(F.col(doc_id).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.join(broadcast_if_small(known), "__id")
    toxic, clean = rows.filter("__y = 1"), rows.filter("__y = 0")
    n_docs = {row["__y"]: row["n"] for row in rows.groupBy("__y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = n_docs.get(1, 0), n_docs.get(0, 0)
    features, odds = _telling(toxic, clean, n_toxic, n_clean)
    lookup = Lookup(features)

    def sample(part: DataFrame) -> list[tuple[str, int]]:
        picked = part.select("__id").orderBy(F.xxhash64(F.lit("sample"), "__id"), "__id").limit(SAMPLE)
        found = part.join(F.broadcast(picked), "__id", "left_semi").select("text", "__y")
        return sorted((row["text"], row["__y"]) for row in found.collect())

    rows_sampled = sample(toxic) + sample(clean)
    weights, moves, plain = _fit(
        *_segments(rows_sampled, lookup, odds >= TOXIC_ODDS), len(features)
    )
    rare = (odds >= TOXIC_ODDS) & (_supports(rows_sampled, lookup) < FEW)
    floors = np.where(rare, odds - plain - moves[0, 1], -np.inf)
    model = Field(features, weights, floors, moves, plain, (0.0, 0.0, 0.0))
    bodies = [text.encode() for text, _ in rows_sampled]
    joined = np.frombuffer(b"".join(bodies), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(body) for body in bodies])]).astype(np.int64)
    most, total, _, _ = _measures(joined, offsets, model, lookup)
    model.scale = _calibrate(
        _inputs(most, total),
        np.array([toxic for _, toxic in rows_sampled]),
        n_toxic / max(1, n_toxic + n_clean),
    )
    return model


def _scorer(model: Field) -> Callable[[Batches], Batches]:
    lookup = Lookup(model.features)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("chance", pa.float64())])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for low, high in chunks(offsets):
                first, last = offsets[low], offsets[high]
                part, places = data[first:last], offsets[low : high + 1] - first
                most, total, owner, (starts, stops, chances) = _measures(part, places, model, lookup)
                scores = 1 / (1 + np.exp(-np.clip(_inputs(most, total) @ np.array(model.scale), -500, 500)))
                spans: list[list[dict]] = [[] for _ in range(high - low)]
                # Offsets count code points: bytes that do not continue a character.
                heads = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
                for hit in np.flatnonzero(chances >= 0.5).tolist():
                    row, base = int(owner[hit]), int(places[owner[hit]])
                    begin = int(heads[base + starts[hit]] - heads[base])
                    end = int(heads[base + stops[hit]] - heads[base])
                    spans[row].append({"start": begin, "end": end, "chance": float(chances[hit])})
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(low, high - low),
                        pa.array(scores),
                        pa.array(spans, pa.list_(span)),
                    ],
                    ["id", "score", "spans"],
                )

    return run


def score(docs: DataFrame, model: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``held_out``, ``score``, ``predicted`` and the offending ``spans``.

    The model is a few hundred kB and travels with the tasks; texts are read once and
    nothing is shuffled. Spans are tokens whose marginal is 0.5 or more, by code point.

    Defined cases: NULL and empty texts have no tokens and get the score of a text without
    any evidence; a NULL id counts as held out; repeated rows score alike; without labels of both
    kinds every score is the share of toxic labels; other columns play no part; an empty
    table gives an empty table.
    """
    kind = dict(docs.dtypes)[doc_id]
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = f"id {kind}, score double, spans array<struct<start:int,end:int,chance:double>>"
    scored = rows.mapInArrow(_scorer(model), schema)
    return scored.select(
        F.col("id").alias(doc_id),
        held_out(F.col("id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"),
        "spans",
    )
