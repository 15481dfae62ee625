import hashlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import healthmart.llm.queries as Q
from healthmart.llm import chat, inner_product

from .conftest import TEST_DIR, plain

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn if turn is not None else -1, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss))
    return out


def digests(rows):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows}


def test_all_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{TEST_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", Q.FOREIGN_CONTROLS), (-7, 1, "assistant", Q.FOREIGN_CONTROLS)]
    assert digests(plain(Q.QUERIES["op3_chat"](spark, TEST_DIR))) == expected(rows)


NASTY = ["<|done|>", "<|turn|>user<|says|>", "<", "<\\|", "<\\\\|done|>", "|", " a ", "", None, "日本語𐍈 é", "\n\n", "</s>[INST]", "<|endoftext|>", "<|says", "x" * 3000]


@pytest.mark.parametrize("chars", [1, 1 << 20])
def test_nasty_turns(spark, monkeypatch, chars):
    monkeypatch.setattr(chat, "SEGMENT_CHARS", chars)
    rows = [(1, i, "assistant", t) for i, t in enumerate(NASTY)] + [(2, i, t, t) for i, t in enumerate(NASTY)]
    rows += [(3, None, "assistant", "b"), (3, 0, None, "c"), (3, 0, "assistant", "a"), (3, 0, "assistant", "a"), (None, 1, "assistant", "n")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("segment", F.lit("clash"))
    assert digests(plain(chat.read_back(chat.format_conversations(df, Q.BYTE_TOKENIZER)))) == expected(rows)
    assert chat.read_back(chat.format_conversations(df.limit(0), Q.BYTE_TOKENIZER)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|x"]), st.text(alphabet="<|\\doneturnsay>\n é", max_size=20)), max_size=6))
def test_rendering_reads_back(turns):
    text, spans = chat.render(turns)
    assert [(chat.unescape(r), chat.unescape(t)) for r, t in chat._TURNS.findall(text)] == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant" and t]


def test_masked_tokens_decode_to_the_assistant(spark):
    tok = chat.tokenizer(Q.BYTE_TOKENIZER)
    rows = [(1, 0, "user", "hello there"), (1, 1, "assistant", " I am fine, "), (1, 2, "assistant", "bye 日")]
    got = sorted(chat.format_conversations(spark.createDataFrame(rows, SCHEMA), Q.BYTE_TOKENIZER).collect(), key=lambda r: r["segment"])
    assert tok.decode([i for r in got for i, m in zip(r["ids"], r["loss"]) if m]) == " I am fine, bye 日"
    whole, _ = chat.render([r[2:] for r in rows])
    assert "".join(r["formatted"] for r in got) == whole
    assert [i for r in got for i in r["ids"]] == tok.encode(whole, add_special_tokens=False).ids


def brute_top_k(rows, k=20, every=20):
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v and np.isfinite(v).all():
            whole[i] = np.floor(64 * np.asarray(v, np.float64)).astype(np.int64)
    out = []
    for q in whole:
        if q % every == 0:
            scores = sorted((-int(whole[q] @ whole[c]), c) for c in whole if c != q)[:k]
            out += [(q, r, c, -s) for r, (s, c) in enumerate(scores, 1)]
    return sorted(out)


def found(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def test_all_queries_against_brute_force(spark, monkeypatch):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{TEST_DIR}/embeddings.parquet").collect()]
    assert found(Q.QUERIES["op10_top_k"](spark, TEST_DIR)) == brute_top_k(rows)
    monkeypatch.setattr(inner_product, "CANDIDATES", 32)
    monkeypatch.setattr(inner_product, "QUERIES", 5)
    monkeypatch.setattr(inner_product, "QUERY_STEP", 2)
    assert found(Q.QUERIES["op10_top_k"](spark, TEST_DIR)) == brute_top_k(rows)


def test_top_k_edges(spark, monkeypatch):
    monkeypatch.setattr(inner_product, "CANDIDATES", 8)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6) * rng.choice([.01, 1, 9])]) for i in range(60)]
    rows += [(i, [1.0, -2.0, 3.0, 0.0, 0.5, 0.25]) for i in range(60, 120)] + [(121, None), (122, [None, 1.0]), (140, [float("nan")] * 6), (160, [float("inf")] * 6), (None, [1.0] * 6), (180, [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("clash"))
    assert found(inner_product.top_k(df)) == brute_top_k(rows)
    assert found(inner_product.top_k(df.unionByName(df.where("vec_id < 40")))) == brute_top_k(rows)
    long = df.select("vec_id", "embedding").unionByName(spark.createDataFrame([(200, [1e300, 1.0]), (220, [1e18])], "vec_id bigint, embedding array<double>"))
    assert found(inner_product.top_k(long)) == brute_top_k(rows)
    twice = spark.createDataFrame([(0, [1.0]), (1, [1.0]), (1, [3.0]), (2, [2.0])], "vec_id bigint, embedding array<double>")
    assert found(inner_product.top_k(twice)) == [(0, 1, 2, 8192), (0, 2, 1, 4096)]
    few = df.where("vec_id in (0, 20, 61)")
    assert found(inner_product.top_k(few)) == brute_top_k([r for r in rows if r[0] in (0, 20, 61)])
    assert found(inner_product.top_k(df.where("vec_id = 0"))) == [] and found(inner_product.top_k(df.limit(0))) == []
