"""Search, manifest and vectors against plain Python, and on odd tables."""

import math
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.llm import corpus_queries, manifest, search, vectors

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


# --- search


def brute_search(docs, items, k=10):
    words = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "") if w]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    bags = [(i, words((t or "").translate(lower))) for i, t in docs]
    bags = [(i, len(w), Counter(w)) for i, w in bags if w]
    n, length = len(bags), sum(c for _, c, _ in bags)
    df = Counter(w for _, _, bag in bags for w in bag)
    found = []
    for item, text in items:
        scores = []
        for doc_id, count, bag in bags:
            m = 100 - 75 + (75 * count * n) // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * bag[w] // (1000 * bag[w] + 8 * m))
                for w in words((text or "").translate(lower))
                if w in bag
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        found += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1)]
    return Counter(found)


DOCS = [
    (1, "Red fox, red FOX"), (2, "red fox red fox"), (2, "red fox red fox"), (None, "red fox red fox"), (7, None), (8, ""),
    (9, "... !!"), (3, "blue Ärger fox"), (4, "blue ärger fox"), (5, "dog"), (6, "fox " * 40_000), (10, "x1 x1 _x1_"),
] + [(100 + k, "many copies of one text") for k in range(60)]
ITEMS = [(1, "fox fox red"), (2, "Ärger"), (2, "x1 dog"), (None, "copies text"), (3, None), (4, ""), (5, "absent words")]


def frame(spark, rows, ids):
    return spark.createDataFrame(rows, f"{ids} long, text string")


@pytest.mark.parametrize("vocabulary", [200_000, 3])
def test_search_equals_brute_force(spark, vocabulary):
    docs = frame(spark, DOCS, "doc_id").repartition(5).withColumn("item_id", F.lit(0)).withColumn("bag", F.lit("b"))
    items = frame(spark, ITEMS, "item_id").withColumn("score", F.lit("s"))
    rows = search.search(docs, items, k=10, vocabulary=vocabulary).collect()
    assert Counter(tuple(r) for r in rows) == brute_search(DOCS, ITEMS)
    assert [r.doc_id for r in sorted(rows, key=lambda r: r["rank"]) if r.item_id is None] == list(range(100, 110))


def test_search_of_corpus_equals_brute_force(spark, documents, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    wanted = brute_search(docs, [tuple(r) for r in items.select("item_id", "text").collect()])
    assert Counter(tuple(r) for r in search.search(documents, items).collect()) == wanted


def test_search_without_rows(spark):
    docs, items = frame(spark, DOCS, "doc_id"), frame(spark, ITEMS, "item_id")
    for found in (search.search(docs.limit(0), items), search.search(docs, items.limit(0))):
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.collect() == []


# --- manifest


def climb(digests):
    """All levels of a tree, by joining whole levels."""
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha256("".join(last[i : i + 16]).encode()).hexdigest() for i in range(0, len(last), 16)])
    return levels


def path(levels, pos):
    steps = []
    for level in levels[:-1]:
        run = level[pos // 16 * 16 : pos // 16 * 16 + 16]
        steps.append((pos % 16, [d for i, d in enumerate(run) if i != pos % 16]))
        pos //= 16
    return steps


def brute_manifest(rows):
    frame_ = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    by = {}
    for doc_id, source, text in rows:
        digest = sha256("".join(map(frame_, (doc_id, source, text))).encode()).hexdigest()
        by.setdefault(source, []).append((doc_id is not None, doc_id or 0, digest, doc_id))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([d for _, _, d, _ in sorted(by[s])]) for s in sources}
    top = climb([trees[s][-1][0] for s in sources])
    found = []
    for at, s in enumerate(sources):
        for pos, (_, _, digest, doc_id) in enumerate(sorted(by[s])):
            steps = path(trees[s], pos) + path(top, at)
            found.append((doc_id, s, digest, trees[s][-1][0], top[-1][0], repr(steps)))
    return Counter(found)


def listed(rows):
    return Counter(
        (r.doc_id, r.source, r.leaf, r.subroot, r.root, repr([(w["at"], list(w["siblings"])) for w in r.witness]))
        for r in rows
    )


ROWS = (
    [(k, "hot", f"text {k}") for k in range(4200)]
    + [(7, "copies", "same")] * 40
    + [(k, "é", None) for k in range(17)]
    + [(5, "z", "a"), (5, "z", "b"), (None, "z", ""), (None, None, None), (1, "", "empty name"), (2, "one", "Ünï\n")]
    + [(k, f"source {k}", "x") for k in range(30)]
)


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], ROWS[:16], ROWS[:17], ROWS[:4097], [(1, None, None), (2, "b", "c")]])
def test_manifest_equals_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(6)
    docs = docs.select("*", *[F.lit(c).alias(c) for c in ("grp", "pos", "digest", "leaf", "root", "block", "row", "c0")])
    found = manifest.manifest(docs, ["doc_id", "source", "text"], group="source", order="doc_id")
    folded = found.withColumn("folded", manifest.folded(F.col("leaf"), F.col("witness")))
    got = folded.collect()
    assert listed(got) == brute_manifest(rows)
    assert all(r.folded == r.root for r in got)


def test_manifest_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert manifest.manifest(docs, ["doc_id", "text"], group="source", order="doc_id").collect() == []


def test_changed_rows_do_not_verify(spark, sf_dir, documents):
    rows = corpus_queries.QUERIES["op12_merkle_manifest"](spark, sf_dir).join(
        documents.select("doc_id", F.col("text").rlike("[A-Z]").alias("changes")), "doc_id"
    )
    touched = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    wrong = rows.where(F.col("verified") == (touched & F.coalesce("changes", F.lit(False))))
    assert wrong.count() == 0 and 0 < rows.where("NOT verified").count() < rows.count()


# --- vectors


def brute_vectors(rows, cosine=0.95):
    ok = [
        v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)
        for _, v in rows
    ]
    n = len(rows)
    links = [set() for _ in range(n)]
    for length in {len(v) for (_, v), fine in zip(rows, ok) if fine}:
        at = [i for i in range(n) if ok[i] and len(rows[i][1]) == length]
        unit = np.array([rows[i][1] for i in at], dtype=np.float32).astype(float)
        unit /= np.linalg.norm(unit, axis=1)[:, None]
        for i, j in zip(*np.nonzero(unit @ unit.T >= cosine)):
            if i != j:
                links[at[i]].add(at[j])
    label = list(range(n))
    for start in range(n):
        if label[start] != start:
            continue
        todo = [start]
        while todo:
            for other in links[todo.pop()]:
                if label[other] != start:
                    label[other] = start
                    todo.append(other)
    least = {}
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            least[label[i]] = min(vec_id, least.get(label[i], vec_id))
    found = []
    for i, (vec_id, _) in enumerate(rows):
        component = least.get(label[i])
        found.append((vec_id, len(links[i]), component, component is None or component == vec_id))
    return Counter(found)


def planted(n, size, groups, seed):
    random = np.random.default_rng(seed)
    rows = random.normal(size=(n, size))
    at = n // 2
    for k in range(groups):  # groups of near copies around the threshold
        for _ in range(random.integers(2, 30)):
            rows[at] = rows[k] + random.normal(size=size) * 0.33
            at += 1
    return [(int(i), [float(x) for x in v]) for i, v in zip(random.permutation(n), rows.astype(np.float32))]


ODD = [
    (1, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0]), (3, [2.0, 0.0, 0.1]),
    (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 0.0]), (8, [float("nan"), 1.0, 0.0]),
    (9, [float("inf"), 1.0, 0.0]), (10, [1.0, 0.0]), (11, [2.0, 0.0]), (12, [5.0]), (13, [1.0]), (14, [-1.0]),
    (None, None), (None, [0.0, 1.0, 0.0]), (None, [0.0, 1.0, 0.001]), (15, [1e38, 1e38, 0.0]), (16, [1e-38, 1e-38, 0.0]),
] + [(100 + k, [0.0, 0.0, 1.0]) for k in range(50)]


@pytest.mark.parametrize("rows", [ODD, ODD[9:11], ODD[:1], planted(3000, 16, 60, 1), planted(1500, 64, 40, 2)])
def test_vectors_equal_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(vectors, "CELL_VECTORS", 8)
    docs = spark.createDataFrame(rows, VECTORS).repartition(4)
    docs = docs.select("*", *[F.lit(c).alias(c) for c in ("vec_key", "unit", "held", "cell", "walk", "label")])
    found = vectors.near_vectors(docs)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert Counter(tuple(r) for r in found.collect()) == brute_vectors(rows)


def test_dense_cell_is_dealt_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "MEMBER_BLOCK", 40)
    monkeypatch.setattr(vectors, "VISITOR_BLOCK", 70)
    random = np.random.default_rng(3)
    near = (np.ones(12) + random.normal(size=(400, 12)) * 0.12).astype(np.float32)
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(near)] + planted(600, 12, 5, 4)
    docs = spark.createDataFrame(rows, VECTORS).repartition(4)
    assert Counter(tuple(r) for r in vectors.near_vectors(docs).collect()) == brute_vectors(rows)


def test_walk_is_in_order_and_complete():
    random = np.random.default_rng(5)
    rows = random.normal(size=(20, 8))
    grid = vectors.Grid((random.normal(size=(7, 4)), random.normal(size=(7, 4))), 8, reach=4.0)
    first, second = grid.excess(rows)
    for i, walk in enumerate(grid.visited(rows)):
        far = first[i][:, None] + second[i][None]
        assert set(walk.tolist()) == set(np.flatnonzero(far.ravel() <= 4.0).tolist())
        assert (np.diff(far.ravel()[walk]) >= 0).all()


@pytest.mark.parametrize("kind", ["double", "decimal(9,6)", "int"])
def test_vectors_of_other_types(spark, kind):
    rows = [(1, [100.0, 20.0]), (2, [101.0, 20.0]), (3, [-7.0, 1.0]), (4, [200.0, 40.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    docs = docs.withColumn("embedding", F.col("embedding").cast(f"array<{kind}>"))
    assert Counter(tuple(r) for r in vectors.near_vectors(docs).collect()) == brute_vectors(rows)


def test_no_vectors(spark):
    assert vectors.near_vectors(spark.createDataFrame([], VECTORS)).collect() == []
