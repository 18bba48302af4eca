"""Field names of JSON documents: golden case, brute force, and edge cases."""

import json
import math
import random
from collections import Counter

import pytest
import samples as s
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textguard.functions.wordlists import KEY_STOP_WORDS
from textguard.plans import components, key_clusters, key_names, key_paths, key_vectors, skew
from textguard.plans import standardize as job
from textguard.sources.json_folder import load_json_folder, parse_documents


@pytest.fixture
def folder(tmp_path):
    for name, text in s.JSON_FILES.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "x.json").write_text('{"unseen":1}')
    (tmp_path / "other.txt").write_text('{"unseen":1}')
    return str(tmp_path)


def test_golden_case(spark, folder, tmp_path):
    result = job.standardize_folder(spark, folder)
    assert result.status == job.OK
    assert tuple(result.report.first())[:4] == (4, 20, 6, 7)
    assert [row.file_path.rsplit("/", 1)[1] for row in result.bad_files.collect()] == ["broken.json"]
    rows = result.mapping.orderBy("key").collect()
    clusters = [keys for keys in s.JSON_CLUSTERS.values()]
    expected = {key: (i, name) for i, (name, keys) in enumerate(s.JSON_CLUSTERS.items()) for key in keys}
    expected |= {key: (-1, name) for key, name in s.JSON_NOISE.items()}
    assert {row.key: (row.cluster_id, row.standard_key) for row in rows} == expected
    assert len(rows) == 20 and len(clusters) == 6
    run = job.save_results(result, str(tmp_path / "out"))
    assert spark.read.json(f"{run}/mapping").count() == 20
    grouped = {row.standard_key: row["keys"] for row in spark.read.json(f"{run}/grouped").collect()}
    assert grouped["items_unit_price"] == ["items.unitPrice", "unit_price"]
    preview = job.preview(result.mapping).collect()
    assert [row.key for row in preview] == sorted(expected)[:10]


def test_load_folder(spark, folder):
    good, bad = load_json_folder(spark, folder)
    assert good.count() == 4 and bad.count() == 1


def test_no_documents_and_no_keys(spark, tmp_path):
    empty = job.standardize_folder(spark, str(tmp_path))
    assert empty.status == job.NO_FILES
    assert tuple(empty.report.first()) == (0, 0, 0, 0, job.NO_FILES)
    (tmp_path / "list.json").write_text("[1, 2]")
    no_keys = job.standardize_folder(spark, str(tmp_path))
    assert no_keys.status == job.NO_KEYS
    assert job.save_results(no_keys, str(tmp_path / "out")) == ""


def clusters_of(spark, keys, **options):
    df = spark.createDataFrame([(key,) for key in keys], "key string")
    return {row.key: row.cluster_id for row in key_clusters.cluster_keys(df, **options).collect()}


def test_degenerate_clusters(spark):
    assert clusters_of(spark, []) == {}
    assert clusters_of(spark, ["one"]) == {"one": 0}
    assert clusters_of(spark, ["user_name", "userName"]) == {"userName": 0, "user_name": 1}
    assert clusters_of(spark, ["a", "b", "c"]) == {"a": 0, "b": 1, "c": 2}


def test_overrides(spark):
    df = spark.createDataFrame([("user_name", 0), ("userName", 0), ("zip", -1)], "key string, cluster_id long")
    given_names = spark.createDataFrame([("cluster_0", "login")], "name_key string, standard_key string")
    names = key_names.cluster_names(df, given_names)
    rows = {row.key: row.standard_key for row in key_names.standard_map(df, names).collect()}
    assert rows == {"user_name": "login", "userName": "login", "zip": "zip"}


def test_several_overrides_for_one_name(spark):
    df = spark.createDataFrame([("user_name", 0), ("userName", 0), ("zip", -1)], "key string, cluster_id long")
    given_names = spark.createDataFrame(
        [("cluster_0", "user"), ("cluster_0", "login"), ("cluster_0", None), ("zip", None)],
        "name_key string, standard_key string",
    )
    names = key_names.cluster_names(df, given_names)
    rows = sorted((row.key, row.standard_key) for row in key_names.standard_map(df, names).collect())
    assert rows == [("userName", "login"), ("user_name", "login"), ("zip", "zip")]


def test_long_groups_come_in_parts(spark):
    df = spark.createDataFrame([(f"k{i}", "name") for i in range(50)], "key string, standard_key string")
    parts = key_names.grouped_map(df, size=10).collect()
    assert len(parts) > 1
    assert sorted(key for row in parts for key in row["keys"]) == sorted(f"k{i}" for i in range(50))


# --- paths ----------------------------------------------------------------------


def paths_of(value, prefix=""):
    found = set()
    if isinstance(value, dict):
        for key, inner in value.items():
            path = f"{prefix}.{key}" if prefix else key
            found.add(path)
            for item in inner if isinstance(inner, list) else [inner]:
                found |= paths_of(item, path)
    return found


def listed_of(value):
    entries = value.get("key_values") if isinstance(value, dict) else None
    if not isinstance(entries, list):
        return set()
    return {e["key"] for e in entries if isinstance(e, dict) and isinstance(e.get("key"), str)}


NAMES = st.sampled_from(["a", "b", "key", "key_values", "x.y", 'q"u', "back\\slash", ":,", "VARIANT", "é", " "])
SCALARS = st.one_of(st.none(), st.booleans(), st.integers(-9, 9), st.sampled_from(["", "v", '"', "1", "a:b"]))
VALUES = st.recursive(
    SCALARS, lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(NAMES, inner, max_size=3)), max_leaves=12
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(VALUES, min_size=20, max_size=60))
def test_paths_match_recursion(spark, values):
    rows = spark.createDataFrame([(json.dumps(value),) for value in values], "j string")
    samples = key_paths.document_samples(parse_documents(rows, F.lit("x"), F.col("j")))
    expected = set().union(*[paths_of(v) if isinstance(v, dict) else set() for v in values])
    expected |= set().union(*[listed_of(v) for v in values])
    found = [row.key for row in key_paths.distinct_keys(samples).collect()]
    assert sorted(found) == sorted(expected)


def test_duplicate_names_last_counts(spark):
    rows = spark.createDataFrame([('{"a":{"x":1},"a":{"y":1}}',)], "j string")
    samples = key_paths.document_samples(parse_documents(rows, F.lit("x"), F.col("j")))
    assert sorted(row.key for row in key_paths.distinct_keys(samples).collect()) == ["a", "a.y"]


# --- vectors and clusters ----------------------------------------------------------


def vectors_of(cleans):
    docs = []
    for clean in cleans:
        words = [w for w in clean.split() if len(w) > 1 and w not in KEY_STOP_WORDS]
        docs.append(Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])]))
    df = Counter(term for doc in docs for term in doc)
    n = len(docs)
    vectors = []
    for doc in docs:
        raw = {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in doc.items() if df[t] <= 0.8 * n}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        vectors.append({t: v / norm for t, v in raw.items()})
    return vectors


def cosine(a, b):
    return round(sum(v * b.get(t, 0) for t, v in a.items()), 9)


def dbscan(vectors, min_samples):
    """Label per vector: the cluster's smallest member, or None for noise."""
    n = len(vectors)
    near = [[j for j in range(n) if vectors[i] and (i == j or cosine(vectors[i], vectors[j]) >= 0.7)] for i in range(n)]
    core = [len(near[i]) >= min_samples for i in range(n)]
    label = [None] * n
    for i in range(n):
        if core[i] and label[i] is None:
            todo = [i]
            while todo:
                j = todo.pop()
                if label[j] is None:
                    label[j] = i
                    todo += [k for k in near[j] if core[k]]
    for i in range(n):
        if not core[i]:
            label[i] = min((label[j] for j in near[i] if core[j]), default=None)
    return label


WORDS = "order orders customer address zip code name total amount unit price date line item id the of".split()


def random_keys(seed, size):
    pick = random.Random(seed)
    keys = set()
    while len(keys) < size:
        words = pick.choices(WORDS, k=pick.randint(1, 4))
        camel = words[0] + "".join(w.title() for w in words[1:])
        keys.add(pick.choice(["_".join(words), camel, ".".join(words), " ".join(words) + str(pick.randint(0, 3))]))
    return sorted(keys)


@pytest.mark.parametrize("min_samples", [2, 3, 4])
def test_clusters_match_brute_force(spark, min_samples):
    keys = random_keys(min_samples, 150)
    df = spark.createDataFrame([(key,) for key in keys], "key string")
    cleans = [row[0] for row in df.select(key_vectors.clean_key(F.col("key"))).collect()]
    label = dbscan(vectors_of(cleans), min_samples)
    found = clusters_of(spark, keys, min_samples=min_samples)
    if min_samples == 2:
        ids = {first: i for i, first in enumerate(sorted({x for x in label if x is not None}))}
        assert found == {key: ids.get(label[i], -1) for i, key in enumerate(keys)}
    else:
        # A border key may go to either neighbouring cluster, so compare the rest.
        assert {k for k, c in found.items() if c == -1} == {k for k, x in zip(keys, label) if x is None}
        assert len(set(found.values()) - {-1}) == len({x for x in label if x is not None})


def test_terms_are_counted_within_the_row_of_a_name(spark):
    """No task holds the terms of its names: nothing is grouped, sorted or shuffled."""
    names = ["", None, "id", "unit price", "unit price unit price", "price price price", "x tax x tax tax", "tax"]
    names += [" ".join(random.Random(i).choices(WORDS[:6], k=i % 9 + 1)) for i in range(60)]
    df = spark.createDataFrame([(name, i + 1) for i, name in enumerate(dict.fromkeys(names))], "clean string, n_keys long")
    counts = key_vectors.term_counts(df)
    text = counts._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in text and "Exchange" not in text and "Sort " not in text
    expected = []
    for i, name in enumerate(dict.fromkeys(names)):
        words = [w for w in (name or "").split(" ") if len(w) >= 2 and w not in KEY_STOP_WORDS]
        terms = Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
        expected += [(name, i + 1, term, tf) for term, tf in terms.items()]
    assert sorted(map(tuple, counts.collect())) == sorted(expected)
    assert counts.dtypes == [("clean", "string"), ("n_keys", "bigint"), ("term", "string"), ("tf", "bigint")]
    assert ("price price price", 6, "price price", 2) in expected


def test_similar_names_match_brute_force(spark):
    keys = random_keys(9, 200)
    df = spark.createDataFrame([(key,) for key in keys], "key string")
    names = key_vectors.clean_names(df)
    counts = key_vectors.term_counts(names)
    weights = key_vectors.tfidf(counts, key_vectors.vocabulary(names, counts))
    found = {(r.a, r.b): r.cosine for r in key_vectors.similar_names(weights).collect()}
    cleans = [row[0] for row in df.select(key_vectors.clean_key(F.col("key"))).collect()]
    vectors = dict(zip(cleans, vectors_of(cleans)))
    expected = {
        (a, b): cosine(vectors[a], vectors[b])
        for a in vectors for b in vectors if a < b and cosine(vectors[a], vectors[b]) >= 0.7
    }
    assert found == pytest.approx(expected, abs=2e-9) and len(found) > 20


def test_clusters_do_not_depend_on_order_or_partitions(spark):
    keys = random_keys(5, 120)
    first = clusters_of(spark, keys)
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(key,) for key in keys], "key string").repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    again = {row.key: row.cluster_id for row in key_clusters.cluster_keys(df).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert again == first


@pytest.mark.parametrize("small", [True, False])
def test_connected_components(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(skew, "is_small", lambda df, rows=0: False)
    pick = random.Random(3)
    edges = [(pick.randint(0, 400), pick.randint(0, 400)) for _ in range(220)]
    edges += [(i, i + 1) for i in range(500, 560)] + [(600, 600 + i) for i in range(1, 200)]
    edges = [(a, b) for a, b in edges if a != b]
    parent = {x: x for edge in edges for x in edge}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    df = spark.createDataFrame(edges, "a long, b long")
    found = {row.node: row.label for row in components.connected_components(df).collect()}
    assert found == {x: root(x) for x in parent}


def test_standard_names(texts):
    cases = {
        "Invoice Number": "invoice_number",
        "the-ID of it": "the_id_of",
        "a1b2": "a_b",
        "customer.billingAddress.zipCode2.extra": "customer_billing_address_zip",
        "é": "",
        "": "",
    }
    rows = texts(*cases).orderBy("id").select(key_names.standard_name(F.col("text"))).collect()
    assert [row[0] for row in rows] == list(cases.values())


def test_skeleton_keeps_names_and_drops_scalars(spark):
    texts = {
        '{"a 1":-1.5e+3,"b":[true,null,"x,y:{}[]",{"d":"q"}],"e":{"f":{}}}': '{"a 1":,"b":[,,,{"d":}],"e":{"f":{}}}',
        r'{"a:":"b\\","c\"d":[[],["\"}"]],"":""}': '{"a:":,"c\x01d":[[],[]],"":}',
        '[1,"2",[{}]]': "[,,[{}]]",
        '"1"': "",
        "null": "",
    }
    df = spark.createDataFrame([(text,) for text in texts], "j string")
    assert {row.j: row.s for row in df.select("j", key_paths._skeleton(F.col("j")).alias("s")).collect()} == texts
