import zlib
from collections import Counter, defaultdict

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

import healthmart.llm.queries as Q
from healthmart.llm import mixing, sharding

from .conftest import TEST_DIR, docs, plain


def test_mixture_matches_the_direct_formulation(spark, duck):
    df = Q.QUERIES["op9_mixing"](spark, TEST_DIR)
    cols = sorted(df.columns)
    got = Counter(tuple(r[c] for c in cols) for r in df.collect())
    cur = duck.execute(Q.ORACLE_SQL["op9_mixing"])
    names = [d[0] for d in cur.description]
    want = Counter(tuple(dict(zip(names, r))[c] for c in cols) for r in cur.fetchall())
    assert got == want and got


def path():
    return {"domain": F.lit("d"), "lang": F.col("lang"), "source": F.col("source")}


def leaves(spark, rows):
    return spark.createDataFrame(rows, "domain string, lang string, source string, tokens bigint")


def test_shortage_goes_to_siblings_before_ancestors(spark):
    rows = [("a", "en", "s1", 10), ("a", "en", "s2", 1000), ("a", "de", "s3", 1000), ("b", "en", "s4", 1000)]
    out = mixing.budgets(leaves(spark, rows), ["domain", "lang", "source"], {}, (400, 3010), 1)
    given = {r["source"]: int(r["given"]) for r in out.collect()}
    # Both domains get 200; "en" and "de" of domain a get 100 each; s1 can hold 10 of its 50, s2 takes the rest.
    assert given == {"s1": 10, "s2": 90, "s3": 100, "s4": 200}


def test_a_full_parent_passes_its_shortage_on(spark):
    rows = [("a", "en", "s1", 10), ("a", "en", "s2", 20), ("b", "en", "s3", 1000)]
    out = mixing.budgets(leaves(spark, rows), ["domain", "lang", "source"], {("a",): 9}, (500, 1030), 1)
    assert {r["source"]: int(r["given"]) for r in out.collect()} == {"s1": 10, "s2": 20, "s3": 470}


def test_mixture_edges(spark):
    df = docs(spark, ["a b c", None, "", "a b c", "x " * 50]).unionByName(docs(spark, ["a b c"]))
    df = df.withColumn("mix_epoch", F.lit(7)).withColumn("n_tokens", F.lit("clash"))
    out = mixing.remix(df, path(), {}, share=(1, 1), max_epochs=1, seed=1)
    assert out.columns == df.columns and out.count() == 6          # the whole budget is everything once
    twice = mixing.remix(df, path(), {}, share=(2, 1), max_epochs=2, seed=1)
    assert Counter(r["text"] for r in twice.collect())["a b c"] == 6
    empty = mixing.remix(df.limit(0), path(), {}, share=(1, 2), max_epochs=1, seed=1)
    assert empty.count() == 0


def water(leaves, budget, weight):
    """One level by plain water filling: leaves by rising capacity for their weight."""
    out, left, todo = {}, budget, sorted(leaves, key=lambda x: (x[1] / weight, x[0]))
    total = weight * len(todo)
    for i, (name, cap) in enumerate(todo):
        if cap * total > weight * left:
            return out | {n: weight * left // total for n, _ in todo[i:]}
        out[name], left, total = cap, left - cap, total - weight
    return out


def test_a_tree_of_many_leaves(spark):
    """200,000 sources under one language: split by range partitions, as by one pass over all of them."""
    rows = spark.range(200_000).select(F.lit("d").alias("domain"), F.lit("en").alias("lang"), F.format_string("s%06d", "id").alias("source"),
                                       (F.col("id") * 7919 % 1000 + 1).alias("tokens"))
    got = {r["source"]: int(r["given"]) for r in mixing.budgets(rows, ["domain", "lang", "source"], {}, (1, 2), 1).collect()}
    caps = [(f"s{i:06d}", i * 7919 % 1000 + 1) for i in range(200_000)]
    assert got == water(caps, sum(c for _, c in caps) // 2, 1)


def test_leaves_that_are_not_broadcast(spark, duck):
    """A third of the rows in one source, all joins by shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = Q.QUERIES["op9_mixing"](spark, TEST_DIR)
        got = Counter((r["doc_id"], r["epoch"]) for r in df.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == Counter(duck.execute(f"SELECT doc_id, epoch FROM ({Q.ORACLE_SQL['op9_mixing']}) t").fetchall())


def check_shards(rows, texts, n):
    slots, group, load = defaultdict(list), {}, Counter()
    for r in rows:
        t = texts[r["doc_id"]]
        assert r["size"] == len((t or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((t or "").encode())
        assert group.setdefault((t is None, t), r["shard"]) == r["shard"]
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
        assert 0 <= r["shard"] < n and r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return load


def test_shards_of_the_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{TEST_DIR}/documents.parquet").collect()}
    rows = plain(Q.QUERIES["op2_sharding"](spark, TEST_DIR))
    assert len(rows) == len(texts)
    load = check_shards(rows, texts, 16)
    assert sorted(load.items()) == sorted(enumerate(plain_lpt(rows, texts, 16)))
    counts = Counter((sum(r["size"] for r in g), g[0]["shard"]) for g in groups_of(rows, texts).values())
    assert counts == plain_counts(rows, texts, 16)


def test_shard_edges(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK_ROWS", 2)
    monkeypatch.setattr(sharding, "HOT", 6)
    texts = ["same"] * 9 + [None, None, "", "", "x" * 5000] + [f"t{i}" for i in range(40)]
    df = docs(spark, texts).withColumn("shard", F.lit("clash")).withColumn("bytes", F.lit(1))
    rows = plain(sharding.shard(df, 3))
    assert len(rows) == len(texts)
    load = check_shards(rows, dict(enumerate(texts)), 3)
    assert [load[s] for s in range(3)] == plain_lpt(rows, dict(enumerate(texts)), 3)
    assert sharding.shard(df.limit(0), 3).count() == 0
    again = plain(sharding.shard(df.repartition(7), 3))
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_lpt_takes_the_least_loaded_shard():
    assert list(sharding.schedule([(7, 1), (5, 1), (4, 1), (3, 1)], 2)) == [[1, 0], [0, 1], [0, 1], [1, 0]]


def plain_schedule(sizes, n_shards):
    """Every group one by one to the least-loaded shard, the first of equals."""
    loads, out = [0] * n_shards, []
    for size, n in sizes:
        out.append([0] * n_shards)
        for _ in range(n):
            s = loads.index(min(loads))
            loads[s] += size
            out[-1][s] += 1
    return loads, out


@given(st.dictionaries(st.integers(1, 300), st.integers(1, 90), max_size=12), st.integers(1, 9))
def test_levelled_sizes_equal_the_plain_schedule(histogram, n_shards):
    sizes = sorted(histogram.items(), reverse=True)
    assert list(sharding.schedule(sizes, n_shards)) == plain_schedule(sizes, n_shards)[1]


def groups_of(rows, texts):
    out = defaultdict(list)
    for r in rows:
        out[texts[r["doc_id"]]].append(r)
    return out


def histogram_of(rows, texts):
    return sorted(Counter(sum(r["size"] for r in g) for g in groups_of(rows, texts).values()).items(), reverse=True)


def plain_lpt(rows, texts, n):
    return plain_schedule(histogram_of(rows, texts), n)[0]


def plain_counts(rows, texts, n):
    sizes = histogram_of(rows, texts)
    return Counter({(size, s): c for (size, _), counts in zip(sizes, plain_schedule(sizes, n)[1]) for s, c in enumerate(counts) if c})
