"""Quality rules and a hashed n-gram log-likelihood ratio, with DataFrame functions only.

Words are runs of characters other than ASCII white space.  The hashed n-grams (single words and
pairs of neighbours, ``2 ** bits`` buckets) of all documents give the raw-corpus multinomial, those
of trusted documents the target multinomial.  Both get the same additive prior after the raw counts
are scaled to the target's size, so a bucket that is rare in both says little, at any corpus size.
A document's score is its mean log ratio over its n-grams; it is kept when it passes the base rules
and its score is at least a fixed threshold.  Weights, scores and verdicts depend on the rows alone.

Defined results: a null text has no words; a document without words has score 0 and fails the base
rules; null or repeated ids and repeated rows are judged row by row; empty tables give empty tables;
a corpus without trusted documents has all weights at most 0 and the same rules; columns that the
operator adds to a table get names that no column of the table has.

Trusted ids are broadcast, which their number bounds: of the labelled rows at most
``trusted_rows`` are taken, those with the smallest hash of their id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, written

GAP = r"[\x20\x09-\x0D]+"
NOT_GAP = r"[^\x20\x09-\x0D]"
#: Words in the windows whose repetition counts.
WINDOW = 8

#: Production parameters: buckets, prior count of a bucket, score to reach, bound of trusted rows.
BITS, PRIOR, THRESHOLD, TRUSTED_ROWS = 18, 4.0, -0.25, 100_000


def _fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that clash with no column of ``df``, whatever its case."""
    used = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in used:
            n = "_" + n
        used.add(n.lower())
        out.append(n)
    return out


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def _hashes(df: DataFrame, text_col: str, words: str, hashes: str) -> DataFrame:
    # Two projections: the split is evaluated once for each row.
    df = df.withColumn(words, _words(F.coalesce(F.col(text_col), F.lit(""))))
    return df.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))


def _grams(hashes: str, bits: int) -> Column:
    """Buckets of the single words, then of each word with the one behind it (the last with none)."""
    size = F.lit(1 << bits).cast("bigint")
    one = F.transform(hashes, lambda h: F.pmod(h, size).cast("int"))
    two = F.transform(hashes, lambda h, i: F.pmod(F.xxhash64(h, F.get(F.col(hashes), i + 1)), size).cast("int"))
    return F.concat(one, two)


def weights(docs: DataFrame, labels: DataFrame, *, bits: int = BITS, prior: float = PRIOR,
            trusted_rows: int = TRUSTED_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row, ``w``: the log ratio of every bucket in millionths, joined by commas in bucket order."""
    trusted = (labels.where((F.col("quality") == 1) & (F.col("toxic") == 0) & F.col(id_col).isNotNull())
               .select(F.col(id_col).alias("t_id")).distinct()
               .orderBy(F.xxhash64("t_id"), "t_id").limit(trusted_rows).withColumn("t", F.lit(1)))
    rows = docs.select(F.col(id_col).alias("d_id"), F.col(text_col).alias("text"))
    rows = rows.join(F.broadcast(trusted), rows["d_id"] == trusted["t_id"], "left").select("text", "t")
    grams = _hashes(rows, "text", "words", "hashes").select("t", F.explode(_grams("hashes", bits)).alias("bucket"))
    # Written, because both the totals and the ratios read it: 2 ** bits rows at most.
    counts = written(grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("t").alias("target")), "grams")
    total = counts.agg(F.sum("raw").alias("raw_all"), F.sum("target").alias("target_all"))
    ratio = F.log((F.col("target") + prior) / (F.col("raw") * (F.col("target_all") / F.col("raw_all")) + prior))
    seen = counts.join(F.broadcast(total)).select("bucket", ratio.alias("ratio"))    # one row of totals
    size = 1 << bits
    every = docs.sparkSession.range(size).select(F.col("id").cast("int").alias("bucket"))
    # 2 ** bits values in bucket order: bounded by the parameter, not by the data.
    return (every.join(seen, "bucket", "left").select("bucket", F.coalesce("ratio", F.lit(0.0)).alias("ratio"))
            .agg(F.sort_array(F.collect_list(F.struct("bucket", "ratio"))).alias("all"))
            .select(F.array_join(F.transform("all", lambda x: F.round(x["ratio"] * 1e6).cast("int").cast("string")), ",").alias("w")))


def verdicts(docs: DataFrame, labels: DataFrame, *, bits: int = BITS, prior: float = PRIOR,
             threshold: float = THRESHOLD, trusted_rows: int = TRUSTED_ROWS, id_col: str = "doc_id",
             text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the counts, the score and the verdict, and the names these columns have."""
    known = weights(docs, labels, bits=bits, prior=prior, trusted_rows=trusted_rows, id_col=id_col, text_col=text_col)
    # One array of 2 ** bits integers, whatever the corpus, so looking a bucket up needs neither a join nor a row for
    # each n-gram.  A scalar subquery, not a literal: a plan with a literal is kept with all its values as text by
    # the driver, twice for each of its executions.
    weight = known.select(F.split("w", ",").cast("array<int>")).scalar()
    want = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept"]
    name = dict(zip(want, _fresh(docs, *want), strict=True))
    words, hashes, windows, lines, placed, at, w = _fresh(docs, "q_words", "q_hashes", "q_windows", "q_lines", "q_placed", "q_at", "q_w")
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = _hashes(docs, text_col, words, hashes)
    df = (df.withColumn(name["n_words"], F.size(words).cast("long"))
          .withColumn(name["word_chars"], F.char_length(F.array_join(words, "")).cast("long"))
          .drop(words))
    df = (df.withColumn(name["n_symbols"], F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"))
          .withColumn(lines, F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_GAP)))
          .withColumn(name["n_dup_lines"], (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))
          .drop(lines))
    h, n = F.col(hashes), F.col(name["n_words"])
    n_windows = F.greatest(n - (WINDOW - 1), F.lit(0)).cast("int")
    df = df.withColumn(windows, F.transform(F.slice(h, F.lit(1), n_windows),
                                            lambda _, i: F.xxhash64(F.slice(h, i + 1, F.lit(WINDOW)))))
    # Read at one place only, so Spark puts the subquery there instead of the array into rows.
    df = df.withColumn(w, weight)
    score = F.aggregate(_grams(hashes, bits), F.lit(0).cast("bigint"), lambda acc, b: acc + F.get(F.col(w), b))
    df = df.withColumn(name["score"], F.when(n > 0, score / (2e6 * n)).otherwise(F.lit(0.0))).drop(hashes, w)
    # Equal windows stand together when sorted; only documents that have some are sorted.
    df = df.withColumn(placed, F.when(F.size(windows) > F.size(F.array_distinct(windows)),
                                      F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))).drop(windows)
    p = F.col(placed)
    twice = F.filter(p, lambda x, i: F.coalesce((F.get(p, i - 1)["h"] == x["h"]) | (F.get(p, i + 1)["h"] == x["h"]), F.lit(False)))
    df = df.withColumn(at, F.sort_array(F.transform(twice, lambda x: x["i"]))).drop(placed)
    a = F.col(at)
    steps = F.transform(a, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(a, i + 1) - x, F.lit(WINDOW))))
    df = df.withColumn(name["n_repeat_words"], F.coalesce(F.aggregate(steps, F.lit(0), lambda s, x: s + x), F.lit(0)).cast("long")).drop(at)
    # A filter on the verdict stops here: pushed further down, it would repeat all of the above.
    df = df.withColumn(at, F.monotonically_increasing_id())
    df = df.withColumn(name["base_failed"], (n < 20) | (100 * F.col(name["n_repeat_words"]) > 30 * n) | (F.col(at) < 0)).drop(at)
    return df.withColumn(name["kept"], ~F.col(name["base_failed"]) & (F.col(name["score"]) >= threshold)), name


def judge(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """One row per document: its id, the base counts, the score and the verdict."""
    rows = docs.select(F.col(id_col).alias("row_id"), F.col(text_col).alias("row_text"))
    labelled = labels.select(F.col(id_col).alias("row_id"), "quality", "toxic")
    df, name = verdicts(rows, labelled, id_col="row_id", text_col="row_text", **params)
    return df.select(F.col("row_id").alias(id_col), *[F.col(v).alias(k) for k, v in name.items()])


def keep(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns as they were."""
    df, name = verdicts(docs, labels, **params)
    return df.where(F.col(name["kept"])).select(*[F.col(f"`{c}`") for c in docs.columns])
