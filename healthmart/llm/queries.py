"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, hard_negatives, hash_forest, inner_product, jaccard, lexical, mixing, page_text, quality, sharding, token_counts, token_shards
from .common import table

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")

#: The mixture: three domains of sources, languages inside them, sources inside those.  A weight is
#: an integer share among siblings; None stands for any value of that level; 1 where none is given.
MIX_WEIGHTS = {("web",): 5, ("reference",): 3, ("community",): 2,
               (None, "en"): 4, (None, "de"): 2, (None, "fr"): 2,
               ("web", None, "src0"): 3}
#: Budget as a fraction of all tokens (as many as there are), epochs of a document at most, seed of the orders.
MIX_SHARE, MIX_EPOCHS, MIX_SEED = (1, 1), 2, 42


def mix_path() -> dict[str, Column]:
    number = F.regexp_extract("source", r"^src(\d{1,6})$", 1)
    domain = (F.when(number == "", "community").when(number.cast("int") < 10, "web")
              .when(number.cast("int") < 15, "reference").otherwise("community"))
    return {"domain": F.coalesce(domain, F.lit("community")), "lang": F.col("lang"), "source": F.col("source")}


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN, with_ids=False)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 16)


#: A conversation whose texts are full of control strings of a common template.
FOREIGN_CONTROLS = "</s>[INST] ok [/INST]"


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, i, role, FOREIGN_CONTROLS) for i, role in enumerate(("user", "assistant"))], rows.schema)
    return chat.read_back(chat.format_conversations(rows.unionByName(extra), BYTE_TOKENIZER))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inner_product.top_k(table(spark, sf_dir, "embeddings"), 20, 20)


def op7_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages"))


#: Token shards: end token, ids in a sequence, sequences in a file, key of the training order.
END_ID, SEQUENCE, SHARD_ROWS, ORDER_KEY = 50_256, 2048, 4096, 20_240


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.materialise(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN,
                                    end_id=END_ID, length=SEQUENCE, rows_per_shard=SHARD_ROWS, key=ORDER_KEY)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), mix_path(), MIX_WEIGHTS, share=MIX_SHARE,
                          max_epochs=MIX_EPOCHS, seed=MIX_SEED)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Some rows are given the next label, so that labels do not follow the clusters exactly.
    label = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), 100, 5, 5, 80, 256, label=label)


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


def op13_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_forest.nearest(table(spark, sf_dir, "embeddings"), 5, 50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_sharding": op2_sharding,
    "op3_chat": op3_chat,
    "op4_quality": op4_quality,
    "op5_token_counts": op5_token_counts,
    "op6_jaccard": op6_jaccard,
    "op7_page_text": op7_page_text,
    "op8_token_shards": op8_token_shards,
    "op9_mixing": op9_mixing,
    "op10_top_k": op10_top_k,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_lexical": op12_lexical,
    "op13_hash_forest": op13_hash_forest,
}


def _mix_sql() -> str:
    """The mixture by a direct formulation: every epoch's documents are numbered in one window."""
    num, den = MIX_SHARE

    def level(name: str, cols: str, key: str, parent: str, weight: str) -> str:
        over = f"PARTITION BY {parent}" if parent else ""
        source = f"JOIN {parent and 'g_' + parent.split(',')[-1].strip()} p USING ({parent})" if parent else "CROSS JOIN root p"
        return f"""
 n_{name} AS (SELECT {cols}, SUM(tokens)::HUGEINT * {MIX_EPOCHS} AS cap, ({weight})::HUGEINT AS weight FROM leaf GROUP BY {cols}),
 o_{name} AS (SELECT n.*, p.given AS budget,
   SUM(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left,
   COALESCE(SUM(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c_before
   FROM n_{name} n {source} WINDOW w AS ({over} ORDER BY cap::DOUBLE / weight::DOUBLE, {key})),
 f_{name} AS (SELECT *, cap * w_left <= weight * (budget - c_before) AS is_full FROM o_{name}),
 g_{name} AS (SELECT {cols}, CASE WHEN is_full THEN cap ELSE (weight * (budget
   - COALESCE(SUM(cap) FILTER (WHERE is_full) OVER ({over}), 0)))
   // SUM(weight) FILTER (WHERE NOT is_full) OVER ({over}) END AS given FROM f_{name})"""

    return f"""WITH d AS (SELECT doc_id,
   CASE WHEN TRY_CAST(regexp_extract(source, '^src([0-9]{{1,6}})$', 1) AS INT) < 10 THEN 'web'
        WHEN TRY_CAST(regexp_extract(source, '^src([0-9]{{1,6}})$', 1) AS INT) < 15 THEN 'reference' ELSE 'community' END AS domain,
   COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
   COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens FROM documents),
 leaf AS (SELECT domain, lang, source, SUM(n_tokens)::HUGEINT AS tokens FROM d GROUP BY ALL),
 root AS (SELECT SUM(tokens) * {num} // {den} AS given FROM leaf),{
    level("domain", "domain", "domain", "", "CASE domain WHEN 'web' THEN 5 WHEN 'reference' THEN 3 ELSE 2 END")},{
    level("lang", "domain, lang", "lang", "domain", "CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END")},{
    level("source", "domain, lang, source", "source", "domain, lang", "CASE WHEN domain = 'web' AND source = 'src0' THEN 3 ELSE 1 END")},
 b AS (SELECT domain, lang, source, given, CASE WHEN tokens > 0 THEN given // tokens ELSE 0 END AS whole, tokens
   FROM g_source JOIN leaf USING (domain, lang, source)),
 e AS (SELECT d.*, b.given, b.whole, b.given - b.whole * b.tokens AS rest, SUM(n_tokens) OVER (PARTITION BY domain, lang, source
   ORDER BY md5('{MIX_SEED}:' || b.whole || ':' || COALESCE(doc_id::VARCHAR, '')), doc_id, n_tokens ROWS UNBOUNDED PRECEDING) AS upto
   FROM d JOIN b USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens, u.epoch::BIGINT AS epoch, given::BIGINT AS leaf_budget
FROM e, (SELECT UNNEST(range({MIX_EPOCHS} + 1)) AS epoch) u WHERE u.epoch < whole OR (u.epoch = whole AND upto <= rest)"""


#: DuckDB SQL of the queries that SQL can express; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {"op9_mixing": _mix_sql()}
