import hashlib
import random
import tempfile
import time
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import healthmart.llm.queries as Q
from healthmart.llm import bpe, token_counts, token_shards

from .conftest import TEST_DIR, docs, plain

EDGES = [None, "", " ", "  a  b ", "\n", "a\n", " a\n b", "x" * 20_000, "ab" * 3000, "th" * 500 + "e", "<s></s><unk><0x0A><|endoftext|>", "日本語 𐍈 ﬁ é", "\x00 　x\xa0y", "▁a a▁b", "it's they'll 12 345 !?"]


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(Q.BYTE_RANKS)
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=Q.PIECE_MODEL)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_every_document_encodes_and_counts_as_the_libraries_do(spark, library, pieces):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{TEST_DIR}/documents.parquet").collect()}
    rows = plain(Q.QUERIES["op1_byte_bpe"](spark, TEST_DIR))
    counts = plain(Q.QUERIES["op5_token_counts"](spark, TEST_DIR))
    assert len(rows) == len(counts) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids)).encode()), sha(texts[r["doc_id"]].encode()))
    for r in counts:
        n = len(pieces.encode(texts[r["doc_id"]]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 4096)


def test_edges_of_encoding(spark, library, pieces):
    df = docs(spark, EDGES).withColumn("ids", F.lit("clash")).withColumn("n_tokens", F.lit("clash"))
    df = df.unionByName(df)
    out = bpe.encode(df, Q.BYTE_RANKS, P.PATTERN)
    back = {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(out, Q.BYTE_RANKS, P.PATTERN).collect()}
    for r in out.collect():
        text = EDGES[r["doc_id"]] or ""
        assert list(r["ids"]) == library.encode_ordinary(text) and back[r["doc_id"]] == text.encode()
    for r in plain(token_counts.token_counts(df, Q.PIECE_MODEL, limit=10)):
        n = len(pieces.encode(EDGES[r["doc_id"]] or ""))
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 10)
    assert out.count() == 2 * len(EDGES)
    assert bpe.encode(df.limit(0), Q.BYTE_RANKS, P.PATTERN).count() == token_counts.token_counts(df.limit(0), Q.PIECE_MODEL).count() == 0


@given(text=st.text(alphabet="abeht rion\n\t'sé漢𐍈▁<>|01 \x00　", max_size=80))
@settings(max_examples=400, deadline=None)
def test_any_text(library, pieces, text):
    assert bpe.codec(Q.BYTE_RANKS, P.PATTERN).encode(text).tolist() == library.encode_ordinary(text)
    assert token_counts.counter(Q.PIECE_MODEL).counts([text]) == [len(pieces.encode(text))]


def test_caches_stay_bounded(library):
    rng = random.Random(2)
    codec = bpe.Codec(bpe.read_ranks(Q.BYTE_RANKS), P.PATTERN)
    codec.pieces.entries = codec.chunks.entries = 50
    for _ in range(300):
        text = " ".join("".join(rng.choice("abcdefg,\n") for _ in range(6)) for _ in range(20))
        assert codec.encode(text).tolist() == library.encode_ordinary(text)
        assert len(codec.pieces) <= 50 and len(codec.chunks.older) <= 50


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 64, 1000, 4097])
def test_feistel_is_a_permutation(n):
    out = token_shards.feistel(np.arange(n), n, 99)
    assert sorted(out.tolist()) == list(range(n))
    if n > 60:
        assert out.tolist() != token_shards.feistel(np.arange(n), n, 98).tolist()


def expected_sequences(texts, library, length, end):
    """Every document's ids and end token, as a multiset of documents."""
    return sorted(tuple(library.encode_ordinary(t or "")) + (end,) for t in texts)


def test_shards_hold_every_document(spark, library):
    folder = tempfile.mkdtemp(prefix="healthmart-shards-")
    texts = [*EDGES, *["same text"] * 5, None]
    df = docs(spark, texts).withColumn("slot", F.lit("clash")).withColumn("ids", F.lit(1)).coalesce(2)
    params = dict(length=16, rows_per_shard=8)
    rows = plain(token_shards.materialise(df, Q.BYTE_RANKS, P.PATTERN, end_id=50_256, key=5, folder=folder, **params))
    assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    read = list(token_shards.resume(folder, 0, **params))
    assert len(read) == len(rows)
    for r in rows:
        assert (r["shard"], r["row"]) == divmod(r["slot"], 8)
        assert r["crc32"] == zlib.crc32(read[r["slot"]][:r["n_tokens"]].tobytes())
    # Put back in the order before the permutation, the sequences are the documents.
    order = np.argsort(token_shards.feistel(np.arange(len(rows)), len(rows), 5))
    used = {r["slot"]: r["n_tokens"] for r in rows}
    by_number = {int(order[slot]): read[slot][:used[slot]].tolist() for slot in used}
    stream, got = [], []
    for number in range(len(rows)):
        for i in by_number[number]:
            stream.append(i)
            if i == 50_256:
                got.append(tuple(stream))
                stream = []
    assert not stream and sorted(got) == expected_sequences(texts, library, 16, 50_256)
    assert {d for r in rows for d in r["doc_ids"]} == set(range(len(texts)))
    assert [x.tolist() for x in token_shards.resume(folder, 11, **params)] == [x.tolist() for x in read[11:]]
    assert [x.tolist() for x in token_shards.resume("file:" + folder.removeprefix("file://"), 11, **params)] == [x.tolist() for x in read[11:]]
    empty = token_shards.materialise(df.limit(0), Q.BYTE_RANKS, P.PATTERN, end_id=50_256, key=5, **params)
    assert empty.count() == 0


def test_shards_are_dealt_without_a_sample(spark):
    df = docs(spark, [f"text {i} " * 20 for i in range(40)]).coalesce(2)
    out = token_shards.materialise(df, Q.BYTE_RANKS, P.PATTERN, end_id=50_256, key=5, length=8, rows_per_shard=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("Exchange") == 1
    owned = {}
    for r in out.withColumn("task", F.spark_partition_id()).collect():
        owned.setdefault(r["task"], []).append(r["slot"])
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = sum(map(len, owned.values()))
    assert sorted(owned) == list(range(tasks))
    assert [s for t in range(tasks) for s in owned[t]] == list(range(n))        # whole ranges, front to back
    assert max(map(len, owned.values())) <= min(map(len, owned.values())) + 2 * 4


def test_whole_table(spark, library):
    rows = plain(Q.QUERIES["op8_token_shards"](spark, TEST_DIR))
    texts = spark.read.parquet(f"{TEST_DIR}/documents.parquet").collect()
    assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    assert sum(r["n_tokens"] for r in rows) == sum(len(library.encode_ordinary(r["text"] or "")) + 1 for r in texts)
    assert {d for r in rows for d in r["doc_ids"]} == {r["doc_id"] for r in texts}


def test_long_runs_of_spaces(spark):
    """Words that could merge only one pair a round go through the queue: as the library, and in time."""
    library = sentencepiece.SentencePieceProcessor(model_file=Q.PIECE_MODEL)
    texts = ["x" + " " * n + "y" for n in (2, 255, 256, 257, 1000, 20_001)] + ["a" * 3000, "ab" * 2000, " " * 5000, "\u2581" * 700, "-" * 4000 + " " * 300 + "=" * 999]
    assert token_counts.counter(Q.PIECE_MODEL).counts(texts) == [len(library.encode(t)) for t in texts]
    began = time.process_time()
    token_counts.counter(Q.PIECE_MODEL).counts(["x" + " " * 300_000 + "y"])
    assert time.process_time() - began < 20


def test_token_ids_without_a_search_for_special_tokens(library):
    """``encode`` and ``encode_to_numpy`` look for special tokens at every character, though there are none."""

    class Plain:
        encode_ordinary = staticmethod(library.encode_ordinary)

    for t in EDGES:
        ids = token_shards.token_ids(Plain, t or "", 50_256)
        assert ids.dtype == np.dtype("<u2") and ids.tolist() == [*library.encode(t or "", disallowed_special=()), 50_256]
