import hashlib
from collections import Counter

import duckdb
import public_tokenizers as P
import pyarrow as pa
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
import healthmart.llm.queries as Q
from healthmart.llm import bpe
from healthmart.llm.common import table, written

from .conftest import TEST_DIR, docs
from .test_jaccard import brute


def text_rows(df):
    return Counter((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_every_stage_on_what_the_one_before_kept(spark):
    before = table(spark, TEST_DIR, "documents")
    (_, quality), (_, copies), (_, mix), (_, encode) = corpus_pipeline.STAGES

    kept = written(quality(spark, before, TEST_DIR), "t1")
    judged = {r["doc_id"]: r["kept"] for r in Q.QUERIES["op4_quality"](spark, TEST_DIR).collect()}
    assert text_rows(kept) == Counter({k: n for k, n in text_rows(before).items() if judged[k[0]]})
    assert kept.columns == before.columns and any(not k for k in judged.values())

    single = written(copies(spark, kept, TEST_DIR), "t2")
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    first = {i for i, _, c in brute(rows) if i == c}
    assert sorted(text_rows(single)) == sorted(r for r in rows if r[0] in first)
    assert single.columns == before.columns

    mixed = written(mix(spark, single, TEST_DIR), "t3")
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist([r.asDict() for r in single.collect()]))
    want = Counter(r[0] for r in con.execute(f"SELECT doc_id FROM ({Q.ORACLE_SQL['op9_mixing']}) t").fetchall())
    assert Counter(r["doc_id"] for r in mixed.collect()) == want and mixed.columns == before.columns

    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(Q.BYTE_RANKS), special_tokens={})
    out = encode(spark, mixed, TEST_DIR).collect()
    texts = {i: t for i, t in text_rows(mixed)}
    for r in out:
        assert list(r["ids"]) == library.encode_ordinary(texts[r["doc_id"]])
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    got = E.queries()["pipeline"](spark, TEST_DIR)
    assert Counter((r["doc_id"], r["ids_sha256"]) for r in got.collect()) == Counter((r["doc_id"], r["ids_sha256"]) for r in out)


def test_stages_take_odd_tables(spark):
    # Two and a half thousand letters of distinct words make a document that passes; the rest are edges.
    good = " ".join(f"word{i} of the text number {i}." for i in range(60))
    df = docs(spark, [good, good, None, "", "x", good + " and more"]).withColumn("score", F.lit("clash")).withColumn("kept", F.lit("clash"))
    df = df.unionByName(df).unionByName(df.limit(1).withColumn("doc_id", F.lit(None).cast("bigint")))
    for frame, left in ((df, 1), (df.limit(0), 0)):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            frame = written(stage(spark, frame, TEST_DIR), f"odd-{i}")
            if i < 3:
                assert frame.columns == df.columns
            if i == 1:
                # Of the good texts one document stays, and the row without an id.
                assert sorted(str(r["doc_id"]) for r in frame.collect()) == ["0", "None"][:2 * left]
