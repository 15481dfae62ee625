import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import healthmart.llm.queries as Q
from healthmart.llm import hard_negatives, hash_forest, lexical, vectors

from .conftest import DOCS, TEST_DIR, plain

VECS = "vec_id bigint, embedding array<double>, label int"
ITEMS = "item_id bigint, text string"


def embeddings(spark):
    return [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{TEST_DIR}/embeddings.parquet").collect()]


# -- hard negatives ----------------------------------------------------------------------------------

def brute_negatives(rows, every=100, k=5, n=5, percent=80, scale=256, relabel=lambda i, label: label):
    whole = {}
    for i, v, label in rows:
        if None not in (i, v, label) and None not in v and np.isfinite(v).all():
            whole[i] = relabel(i, label), [math.floor(scale * x) for x in v]
    out = []
    for a, (label, q) in whole.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, other) for i, (other, v) in whole.items() if i != a)
        for p, pid, _ in [s for s in scored if s[2] == label][:k]:
            inside = [(s, i) for s, i, other in scored if other != label and percent * -p <= 100 * -s <= 100 * -p][:n]
            out += [(a, pid, r, i, -p, -s) for r, (s, i) in enumerate(inside, 1)]
    return sorted(out)


def mined(df):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect())


@pytest.mark.parametrize("block, step, round_bytes", [(8192, 8, 64 << 20), (13, 1, 3000)])
def test_all_anchors_against_brute_force(spark, monkeypatch, block, step, round_bytes):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "STEP", step)
    monkeypatch.setattr(vectors, "ROUND_BYTES", round_bytes)
    want = brute_negatives(embeddings(spark), relabel=lambda i, label: (label + 1) % 10 if i % 7 == 0 else label)
    assert want and mined(Q.QUERIES["op11_hard_negatives"](spark, TEST_DIR)) == want


def odd_vectors(n=90):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, size=rng.integers(1, 6))], int(i % 3)) for i in range(n)]
    rows += [(i, [1.0, -2.0, 3.0], i % 2) for i in range(n, n + 40)]     # ties
    rows += [(200, None, 1), (201, [None, 1.0], 1), (202, [float("nan")], 1), (203, [float("inf")], 1), (None, [1.0], 1), (205, [1.0], None),
             (210, [0.0, 0.0], 1), (220, [], 1), (230, [-1.0, -2.0, -3.0], 7)]
    return rows


def test_hard_negative_edges(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 7)
    monkeypatch.setattr(hard_negatives, "STEP", 1)
    rows = odd_vectors()
    df = spark.createDataFrame(rows, VECS).withColumn("anchor_id", F.lit("clash")).withColumn("vec", F.lit(1)).withColumn("id", F.lit(2))
    want = brute_negatives(rows, every=10)
    assert want and mined(hard_negatives.mine(df, 10)) == want
    assert mined(hard_negatives.mine(df.unionByName(df.where("vec_id < 50")), 10)) == want
    assert mined(hard_negatives.mine(df.limit(0), 10)) == [] and mined(hard_negatives.mine(df.where("vec_id = 10"), 10)) == []
    # Integers too long for 64-bit scores count as no vector; long ones that fit are exact.
    long = [(i, [v * 1e6 for v in e], g) for i, e, g in rows[:90]]
    big = long + [(300, [1e300, 1.0], 1), (310, [1e18], 1)]
    assert mined(hard_negatives.mine(spark.createDataFrame(big, VECS), 10)) == brute_negatives(long, every=10)
    # One id with two vectors: the smallest (label, vector) counts.
    twice = spark.createDataFrame([(0, [1.0], 0), (0, [1.0], 1), (1, [1.0], 0), (2, [1.0], 5), (2, [9.0], 6)], VECS)
    assert mined(hard_negatives.mine(twice, 10)) == [(0, 1, 1, 2, 65536, 65536)]


# -- hash forest -------------------------------------------------------------------------------------

def cosines(rows, every):
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v and len(v) and np.isfinite(v).all() and np.any(v):
            whole[i] = np.asarray(v, np.float64)
    dims = max((len(v) for v in whole.values()), default=0)
    whole = {i: np.pad(v / np.abs(v).max(), (0, dims - len(v))) for i, v in whole.items()}
    return {q: {c: float(x @ y / math.sqrt((x @ x) * (y @ y))) for c, y in whole.items() if c != q} for q, x in whole.items() if q % every == 0}


def neighbours(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def recall(got, want, k):
    hits = total = 0
    for q, scores in want.items():
        best = sorted((-s, i) for i, s in scores.items())[:k]
        rows = got.get(q, [])
        assert [r for r, _, _ in rows] == list(range(1, len(best) + 1))
        assert all(abs(scores[i] - s) < 1e-12 for _, i, s in rows)
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1]))
        worst = -best[-1][0] - 1e-12 if best else 0
        hits += sum(s >= worst for _, _, s in rows)
        total += len(best)
    return hits / max(total, 1)


def test_recall_of_the_forest(spark):
    for d in (TEST_DIR, "/root/testdata/sf0.1"):
        rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
        assert recall(neighbours(Q.QUERIES["op13_hash_forest"](spark, d)), cosines(rows, 50), 5) >= 0.9


def test_forest_edges(spark, monkeypatch):
    monkeypatch.setattr(hash_forest, "BLOCK", 7)
    monkeypatch.setattr(vectors, "ROUND_BYTES", 1000)
    rows = [(i, v) for i, v, _ in odd_vectors()] + [(240, [1e300, 2e300]), (250, [1e-300, 3e-300]), (260, [0.5, -1.0, 1.5])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("cls", F.lit("clash")).withColumn("vec", F.lit(1))
    want = cosines(rows, 10)
    # With every class in the budget the search is exact, ties included.
    got = neighbours(hash_forest.nearest(df, 5, 10, share=24.0))
    assert recall(got, want, 5) == 1.0 and set(got) == set(want)
    copies = sorted(i for i, v in rows if v == [1.0, -2.0, 3.0] or v == [0.5, -1.0, 1.5])
    assert [i for _, i, _ in got[100]] == [i for i in copies if i != 100][:5]
    assert neighbours(hash_forest.nearest(df.unionByName(df.where("vec_id < 50")), 5, 10, share=24.0)) == got
    few = df.where("vec_id in (0, 10, 11)")
    assert {q: len(r) for q, r in neighbours(hash_forest.nearest(few, 5, 10)).items()} == {0: 2, 10: 2}
    assert neighbours(hash_forest.nearest(df.limit(0))) == {} and neighbours(hash_forest.nearest(df.where("vec_id = 0"))) == {}


def test_hot_vector(spark):
    """A third of all rows are one vector: scored once, members by ascending id."""
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else [float(x) for x in rng.normal(size=4)]) for i in range(3000)]
    got = neighbours(hash_forest.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), 5, 50))
    assert [i for _, i, _ in got[0]] == [3, 6, 9, 12, 15] and [i for _, i, _ in got[300]] == [0, 3, 6, 9, 12]
    assert recall(got, cosines(rows, 50), 5) >= 0.9


# -- ranked lexical search ---------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_search(docs, items, k=10):
    bags = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in sorted(set(items), key=str):
        if item is None or text is None:
            continue
        terms = TERM.findall(text.translate(LOWER))
        scored = []
        for i, b in bags:
            m = 25 + 75 * sum(b.values()) * n_docs // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * b[t] // (1000 * b[t] + 8 * m)) for t in terms if t in b)
            if score > 0 and i is not None:
                scored.append((-score, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def ranked(df):
    return sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


def test_all_items_against_brute_force(spark, monkeypatch):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{TEST_DIR}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{TEST_DIR}/benchmark.parquet").collect()]
    want = brute_search(docs, items)
    assert want and ranked(Q.QUERIES["op12_lexical"](spark, TEST_DIR)) == want
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 400)
    monkeypatch.setattr(lexical, "PIECE", 5)
    monkeypatch.setattr(lexical, "SCORES", 100)
    assert ranked(Q.QUERIES["op12_lexical"](spark, TEST_DIR)) == want


def test_lexical_edges(spark):
    texts = ["a b c", "A b, c!", "b", None, "", "  ", "ÉÀ é a1 1a", "x" * 5000 + " a", "a " * 300_000, "Ä ä 日本 𐍈", "c b a"] + ["hot copy a"] * 40
    docs = list(enumerate(texts)) + [(None, "a b"), (5, "a b c"), (5, "a b c")]
    items = [(1, "A b"), (1, "A b"), (1, "日本 ä"), (2, None), (3, ""), (4, "a a a hot"), (None, "a"), (5, "unknown"), (6, "É 1A " + "x" * 5000)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS).withColumn("bag", F.lit("clash")).withColumn("m", F.lit(1))
    asked = spark.createDataFrame(items, ITEMS).withColumn("item", F.lit("clash"))
    assert ranked(lexical.search(df, asked)) == brute_search(docs, items)
    assert ranked(lexical.search(df, asked, 3)) == brute_search(docs, items, 3)
    assert ranked(lexical.search(df.limit(0), asked)) == [] and ranked(lexical.search(df, asked.limit(0))) == []
    assert ranked(lexical.search(df.where("text IS NULL"), asked)) == []
    assert len(plain(lexical.search(df, asked))) == len(brute_search(docs, items))
