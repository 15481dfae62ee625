import random
import re

import numpy as np
from pyspark.sql import functions as F

import healthmart.llm.queries as Q
from healthmart.llm import bpe, common, jaccard

from .conftest import TEST_DIR, docs, plain

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def grams(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in SPACE.split(low) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def brute(rows):
    """Components by testing all pairs; rows are (id, text)."""
    sets = [(i, grams(t)) for i, t in rows]
    up = {i: i for i, _ in sets if i is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and i is not None and j is not None and min(len(a), len(b)) * 100 >= 80 * max(len(a), len(b)):
                x = len(a & b)
                if 100 * x >= 80 * (len(a) + len(b) - x):
                    p, q = sorted((find(i), find(j)))
                    up[q] = p
    return sorted((i, len(s), None if i is None else find(i)) for i, s in sets if i is not None)


def got(rows):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None)


def test_documents_against_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{TEST_DIR}/documents.parquet").collect()]
    want = brute(rows)
    assert got(plain(Q.QUERIES["op6_jaccard"](spark, TEST_DIR))) == want
    assert any(i != c for i, _, c in want)


def planted():
    """Near copies around the threshold, chains, copies, one common passage in many texts."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(5))
    passage = " ".join(word() for _ in range(30))
    texts = [None, "", " \n", "one", "One", "two words", "a b c d", "A B C D", "a b c d e", "a b c d e f"]
    for _ in range(12):
        base = [word() for _ in range(rng.choice([6, 12, 40, 90]))]
        for _ in range(6):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                t[rng.randrange(len(t))] = word()
            base = t if rng.random() < .5 else base
            texts.append(" ".join(t) if rng.random() < .8 else "\t".join(t).upper())
    texts += [passage + " " + " ".join(word() for _ in range(rng.choice([2, 4, 8, 60]))) for _ in range(40)]
    return texts


def test_planted_links_against_all_pairs(spark, monkeypatch):
    texts = planted()
    df = docs(spark, texts).withColumn("n", F.lit("clash")).withColumn("component_id", F.lit(0)).repartition(3)
    want = brute(list(enumerate(texts)))
    assert got(plain(jaccard.classes(df))) == want
    monkeypatch.setattr(jaccard, "FREQUENT", 1)          # the order of shingles changes no result
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    assert got(plain(jaccard.classes(df))) == want


def test_repeated_rows_null_ids_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(20))
    df = docs(spark, ["x y", text, text + " z", "other words here", None, ""])
    df = df.unionByName(df)
    nulls = df.limit(1).withColumn("doc_id", F.lit(None).cast("bigint"))
    rows = plain(jaccard.classes(df.unionByName(nulls)))
    assert len(rows) == 13 and [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    assert {(r["doc_id"], r["component_id"]) for r in rows if r["doc_id"] is not None} == {(0, 0), (1, 1), (2, 1), (3, 3), (4, 4), (5, 5)}
    kept = jaccard.first_of_each(df.unionByName(nulls))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["0", "1", "3", "4", "5", "None"] and kept.columns == df.columns
    assert jaccard.classes(df.limit(0)).count() == 0


def test_bitmaps_bound_the_overlap_from_above():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        b = np.unique(np.concatenate([a[: rng.integers(0, len(a) + 1)], rng.integers(0, 1 << 60, rng.integers(1, 30)).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        s, t = jaccard.signature(a), jaccard.signature(b)
        size = min(len(s), len(t))
        if 100 * common >= 80 * (len(a) + len(b) - common):
            assert jaccard.may_link(len(a), jaccard.folded([s], size)[0], len(b), jaccard.folded([t], size)[0])


def test_a_stranger_does_not_bring_all_pairs_of_a_group(spark, monkeypatch):
    """Tile 1: a group of 400 with two strangers.  Tile 2: 60 components of one or two members in many
    sizes.  Tile 3: small.  All pairs across components meet once, and few others."""
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng = random.Random(3)
    rows = [(1, rng.randint(90, 110), i, 0) for i in range(400)] + [(1, 100, 400, 400), (1, 104, 401, 401)]
    rows += [(2, rng.randint(4, 60), 500 + i, 500 + i // 2 * 2 if i % 3 else 500 + i) for i in range(90)]
    rows += [(3, 10, 700 + i, 700 + i % 2) for i in range(10)]
    many = {h: sum(r[0] == h for r in rows) for h in (1, 2, 3)}
    df = spark.createDataFrame([(*r, many[r[0]]) for r in rows], "h bigint, n bigint, id bigint, comp bigint, members bigint")
    tasks = {}
    for r in plain(jaccard._block_pairs(df)):
        tasks.setdefault((r["h"], r["p"], r["q"]), ([], []))[r["side"]].append((r["n"], r["id"], r["comp"]))
    met, work = [], {1: 0, 2: 0, 3: 0}
    for (h, p, q), (one, two) in tasks.items():
        assert len(one) + len(two) <= 6 * 16
        work[h] += len(one) * len(one if p == q else two)
        both = [(x, y) for i, x in enumerate(one) for y in one[:i]] if p == q else [(x, y) for x in one for y in two]
        met += [(h, *sorted((x[1], y[1]))) for x, y in both if x[2] != y[2] and 100 * min(x[0], y[0]) >= 80 * max(x[0], y[0])]
    want = {(r[0], *sorted((r[2], o[2]))) for r in rows for o in rows
            if r[0] == o[0] and r[3] != o[3] and 100 * min(r[1], o[1]) >= 80 * max(r[1], o[1])}
    assert len(met) == len(set(met)) and set(met) == want
    assert work[1] <= 402 * 16            # not 402 * 402 / 2


def test_group_with_strangers_against_all_pairs(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(60)]
    texts = []
    for _ in range(80):
        t = list(base)
        t[rng.randrange(60)] = word()
        texts.append(" ".join(t))
    # Strangers share half of the group's text; the last ones also lie between group and strangers.
    texts += [" ".join(base[:k] + [word() for _ in range(60 - k)]) for k in (20, 30, 40, 45, 50, 52, 54, 56) for _ in range(3)]
    rng.shuffle(texts)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    assert got(plain(jaccard.classes(docs(spark, texts)))) == brute(list(enumerate(texts)))


def test_second_stars_are_no_more_than_rows(spark):
    """Members meet one member of their tile's largest component; tiles without a component of several are left."""
    rows = [(1, 100, i, 0 if i < 30 else i) for i in range(60)] + [(1, 10, 60, 60)]
    rows += [(2, 50, 100 + i, 100 + i) for i in range(20)] + [(3, 50, i, 0) for i in range(5)] + [(3, 50, 200, 200)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "h bigint, n bigint, id bigint, comp bigint, members bigint")
    pairs = {(r["a"], r["b"]) for r in plain(jaccard._second_stars(df))}
    comp = {r[2]: r[3] for r in rows}
    assert all(comp[a] == 0 and comp[b] == b for a, b in pairs)
    assert sorted(b for _, b in pairs) == [*range(30, 60), 200]        # 60 is too small, tile 2 has no group
    assert len({a for a, b in pairs if b < 60}) == 1


def test_a_pair_met_in_an_earlier_tile_is_skipped():
    one, two = jaccard._padded([[], [5], [5, 7], [0]]), jaccard._padded([[], [7], [9, 7], [0]])
    assert jaccard._met(one, two).tolist() == [False, False, True, False]


def test_rows_that_stay_are_not_shuffled(spark, monkeypatch):
    """Documents whose id is not marked meet only the broadcast filter; a filter too small for the ids costs time alone."""
    texts = [f"w{i} " * 3 + " ".join(f"x{i // 3}y{k}" for k in range(40)) for i in range(60)] + [None, "", "one"]
    df = docs(spark, texts)
    nulls = df.limit(2).withColumn("doc_id", F.lit(None).cast("bigint"))
    df = df.unionByName(df.where("doc_id % 6 = 0")).unionByName(nulls).withColumn("rows", F.lit("clash")).withColumn("Word", F.lit(1)).withColumn("a.b", F.lit(2))
    want = sorted(str(i) for i, _, c in brute(list(enumerate(texts))) if i == c) + ["None", "None"]
    for words in (jaccard.FILTER_WORDS, 1):
        monkeypatch.setattr(jaccard, "FILTER_WORDS", words)
        kept = jaccard.first_of_each(df)
        assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(want) and kept.columns == df.columns
        stay = kept._jdf.queryExecution().optimizedPlan().children().apply(0).toString()
        assert stay.count("Join ") == 1 and "rightHint=(strategy=broadcast)" in stay and "Repartition" not in stay


def test_a_worker_keeps_the_caches_of_one_operator():
    codec = bpe.Codec({bytes([i]): i for i in range(256)}, r"\S+|\s+")
    jaccard.shingles("some words of a text")
    assert len(jaccard._word_hash) == 5
    common.take_turn(codec)
    assert not jaccard._word_hash and not jaccard._word_hash.older
    codec.encode("some words")
    common.take_turn(codec)
    assert codec.chunks and codec.pieces
    jaccard.shingles("other words")
    assert not codec.chunks and not codec.pieces and len(jaccard._word_hash) == 2


def test_components_by_short_steps(spark, monkeypatch):
    rng = random.Random(3)
    chain = list(range(100, 140))
    rng.shuffle(chain)
    links = [*zip(chain, chain[1:]), *((500, i) for i in range(501, 560)), *((rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(150)),
             (7, 7), (9, 8), (8, 9), (-3, 8), (None, 5), (None, None)]
    up = {i: i for a, b in links for i in (a, b)}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        if None not in (a, b):
            p, q = sorted((find(a), find(b)))
            up[q] = p
    linked = {i for a, b in links for i in (a, b) if None not in (a, b) and a != b}
    plans, written = [], jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda df, tag, *done: plans.append(df._jdf.queryExecution().executedPlan().toString()) or written(df, tag, *done))
    rows = plain(jaccard.components(spark.createDataFrame(links, "a bigint, b bigint")))
    assert sorted((r["id"], r["comp"]) for r in rows) == sorted((i, find(i)) for i in linked)
    # What the driver keeps of a step grows with its plan: reads of the edges that are planned, reused ones as well.
    assert len(plans) > 2 and max(p.count("FileScan") for p in plans) <= 4


def test_words_hashed_in_groups_as_by_themselves():
    """Shingle sets do not depend on the texts hashed together, and equal those of a set of tuples in size."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abCD\xe9\u65e5\0-") for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 24, 63, 64, 65, 200])))
    texts = [None, "", " \n", "one", "a b c d", "x" * 5000, "a\0 a", "a a\0", "\x1c \x85 \xa0 \u2003"]
    texts += ["".join(word() + rng.choice([" ", "  ", "\t", "\n", "\x0b", "\x0c", "\r"]) for _ in range(rng.choice([1, 3, 4, 5, 6, 40, 400]))) for _ in range(60)]
    raw = [None if t is None else t.encode() for t in texts]
    together = list(jaccard.shingle_sets(raw))
    assert list(map(len, together)) == [len(grams(t)) for t in texts]
    for t, own in zip(raw, together, strict=True):
        words = (t or b"").lower().split()
        h = np.array([jaccard._hash(w) for w in words], np.uint64)
        alone = np.unique(jaccard._windows(h, min(jaccard.WORDS, max(1, len(words)))))
        assert own.tolist() == alone.tolist() == next(jaccard.shingle_sets([t])).tolist()
    assert len({jaccard._hash(w) for t in raw for w in (t or b"").lower().split()}) == len({w for t in raw for w in (t or b"").lower().split()})


def test_first_shingles_are_rare_ones():
    rng = np.random.default_rng(2)
    for share in (0.0, 0.3, 0.9, 1.0):
        g = np.unique(rng.integers(0, 1 << 62, 200).astype(np.uint64))
        often = np.sort(rng.choice(g, int(share * len(g)), replace=False))
        order = [x for x in g.tolist() if x not in set(often.tolist())] + often.tolist()
        assert jaccard.prefix(g, often).tolist() == order[:len(g) - (80 * len(g) + 99) // 100 + 1]
    assert not jaccard.prefix(g[:0], g).size and not jaccard.prefix(g[:0], g[:0]).size


def test_many_small_partitions_are_written_as_few_files(spark):
    """Each file costs an executor several processes; 600 partitions of a few rows are not 600 files."""
    df = spark.range(6000).repartition(600, "id")
    kept = jaccard.written(df, "edges")
    assert len(kept.inputFiles()) <= max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 16)
    assert kept.agg(F.count("id"), F.countDistinct("id"), F.sum("id")).first()[:] == (6000, 6000, 5999 * 3000)
