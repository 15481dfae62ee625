import math
import re
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

import healthmart.llm.queries as Q
from healthmart.llm import quality

from .conftest import TEST_DIR, docs, plain

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    n = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return dict(n_words=len(words), word_chars=sum(map(len, words)), n_symbols=len(re.findall(r"[#*$%&|<>]", text or "")),
                n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(inside), base_failed=failed)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def grams(text, bits):
    hs = [signed(xxhash.xxh64_intdigest(w.encode(), seed=42)) for w in WORD.findall(text or "")]
    pair = []
    for a, b in zip(hs, [*hs[1:], None]):
        h = xxhash.xxh64_intdigest(struct.pack("<q", a), seed=42)
        pair.append(signed(h if b is None else xxhash.xxh64_intdigest(struct.pack("<q", b), seed=h)))
    return [h % (1 << bits) for h in hs + pair]


def test_whole_table_against_brute_force(spark):
    table = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{TEST_DIR}/documents.parquet").collect()}
    good = {r["doc_id"] for r in spark.read.parquet(f"{TEST_DIR}/labels.parquet").collect() if r["quality"] == 1 and r["toxic"] == 0}
    raw, target, size = Counter(), Counter(), 1 << quality.BITS
    for i, t in table.items():
        g = grams(t, quality.BITS)
        raw.update(g)
        if i in good:
            target.update(g)
    scale = sum(target.values()) / sum(raw.values())
    w = {b: round(1e6 * math.log((target[b] + quality.PRIOR) / (c * scale + quality.PRIOR))) for b, c in raw.items()}
    rows = plain(Q.QUERIES["op4_quality"](spark, TEST_DIR))
    assert len(rows) == len(table)
    for r in rows:
        want = base(table[r["doc_id"]])
        g = grams(table[r["doc_id"]], quality.BITS)
        score = sum(w[b] for b in g) / (1e6 * len(g)) if g else 0.0
        assert r["score"] == pytest.approx(score, abs=2e-6)
        assert {k: r[k] for k in want} == want
        assert r["kept"] == (not want["base_failed"] and r["score"] >= quality.THRESHOLD)
    assert size == 1 << quality.BITS


def test_labelled_documents_are_told_apart(spark):
    labels = spark.read.parquet(f"{TEST_DIR}/labels.parquet")
    got = Q.QUERIES["op4_quality"](spark, TEST_DIR).join(labels, "doc_id").where(~F.col("base_failed"))
    seen = Counter((r["quality"], r["kept"]) for r in got.collect())
    assert seen[1, False] == 0 and seen[0, False] > seen[0, True]


def test_edges(spark):
    eight = " ".join(f"w{i}" for i in range(8))
    texts = [None, "", " \t\n", "one", f"{eight} {eight}", "a " * 40, "x\n\nx\n \ny\nx", " é| ç# \x0b& ", " ".join(f"v{i}" for i in range(30)),
             f"{eight} a b c {eight} d", "   ", "long " + "y" * 200_000]
    df = docs(spark, texts).withColumn("n_words", F.lit("clash")).withColumn("KEPT", F.lit(1)).withColumn("q_words", F.lit(1))
    df = df.unionByName(df)
    labels = spark.createDataFrame([(8, 1, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    rows = plain(quality.judge(df, labels))
    assert len(rows) == 2 * len(texts)
    for r in rows:
        want = base(texts[r["doc_id"]])
        assert {k: r[k] for k in want} == want
    kept = quality.keep(df, labels)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows if r["kept"]}
    assert quality.judge(df.limit(0), labels).count() == 0
    assert quality.judge(df, labels.limit(0)).count() == 2 * len(texts)


def test_plans_do_not_hold_the_weights(spark):
    # The driver keeps the text of every plan: neither it nor a row of the result may grow with the buckets.
    df, labels = docs(spark, ["some words of a text"] * 3), spark.createDataFrame([(0, 1, 0)], "doc_id bigint, quality int, toxic int")
    lengths = []
    for bits in (4, 12):
        judged = quality.judge(df, labels, bits=bits)
        plan = judged._jdf.queryExecution().executedPlan()
        assert "q_w" not in [a for line in plan.toString().split("\n") for a in re.findall(r" AS (\w+)#", line)]
        lengths.append(len(plan.toString()))
        assert len(plain(judged)) == 3
    assert abs(lengths[0] - lengths[1]) < 500
