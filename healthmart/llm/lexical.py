"""Ranked lexical search over deduplicated bags of terms.

Documents are restricted to the vocabulary of the items: what is left of one is a bag, its item terms with
their counts, and the length figure ``m``.  Documents with equal bags and equal ``m`` have equal scores for
every item and form a class; bags are grouped by their hash and compared in full.  Each class is scored
once against all items, through the items' posting lists, and only the classes that are among an item's
best are opened: their members are listed by ascending id.

Items are searched in blocks, dealt by a hash so that a block has about BLOCK_TERMS different terms of
items; a block's terms, counts and weights are what the tasks are sent.  Counts and statistics (documents,
terms, document frequencies) cover all documents, and whole texts, which are cut into terms piece by piece.

A term is a maximal run of ASCII letters and digits and of characters beyond ASCII; only A to Z are
lower-cased.  With N documents that hold a term, L terms in all, n terms in the document, df documents
with the term and tf occurrences in the document, a term weighs ``floor(1000 ln((2N + 2) / (2 df + 1)))``,
``m`` is ``100 - b + b n N div L`` and the score sums ``w (10^9 tf div (1000 tf + c m))`` over the item's
terms, repeats included, in whole numbers.

Defined results: a null text has no terms; every row is a document, so repeated rows are ranked one after
the other; a row without an id counts in the statistics and is never returned; an item without a term, or
without an id, has no rows; repeated item rows count once, and different texts of one item id are searched
each for itself; documents of score 0 are not returned; ties go to the smaller id; empty tables give empty
tables; only the id and text columns are read, so others cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from .common import bound_batches, written

#: Item terms (counted once an item) of a block of items, and bytes of a text that are cut at once.
BLOCK_TERMS, PIECE = 1 << 18, 1 << 20
#: Length and saturation of the score: m = 100 - B + ..., 1000 tf + C m.
LENGTH, SATURATION = 75, 8
#: Scores of classes and items that are held at once.
SCORES = 1 << 22

#: Bytes: A to Z to lower case, term bytes to themselves, all others to a space.
_TERM_BYTES = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def pieces(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded part of it at a time."""
    raw = text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + PIECE)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def bag(text: str | None) -> Counter:
    out = Counter()
    for terms in pieces(text or ""):
        out.update(terms)
    return out


class Items:
    """A block of items: its terms, and for each term the items that hold it."""

    def __init__(self, rows: list[Row]):
        self.ids = [r["item_id"] for r in rows]
        bags = [bag(r["text"]) for r in rows]
        self.terms = sorted(set().union(*bags))
        number = {t: i for i, t in enumerate(self.terms)}
        lists: list[list[tuple[int, int]]] = [[] for _ in self.terms]
        for i, b in enumerate(bags):
            for t, count in b.items():
                lists[number[t]].append((i, count))
        self.starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        self.items = np.array([i for x in lists for i, _ in x], np.int64)
        self.counts = np.array([c for x in lists for _, c in x], np.int64)
        self.longest = max((sum(b.values()) for b in bags), default=0)


def _bags(docs: DataFrame, sent) -> DataFrame:
    """``(doc_id, n, bag)``: a document's number of terms, and the numbers and counts of its item terms (null: none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(sent.value)}
        held = number.__contains__
        for batch in batches:
            sizes, bags = [], []
            for text in batch.column(1):
                n, found = 0, Counter()
                for terms in pieces(text.as_py() or ""):
                    n += len(terms)
                    found.update(filter(held, terms))
                sizes.append(n)
                pairs = np.array(sorted((number[t], c) for t, c in found.items()), np.uint32)
                bags.append(pairs.tobytes() if found else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())], ["doc_id", "n", "bag"])

    return docs.mapInArrow(run, "doc_id bigint, n bigint, bag binary")


def _frequencies(bags: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each term of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n_terms, np.int64)
        for batch in batches:
            for b in batch.column(0).to_pylist():
                held[np.frombuffer(b, np.uint32)[::2]] += 1
        term = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(held[term])], ["term", "df"])

    out = np.zeros(n_terms, np.int64)
    for r in bags.select("bag").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect():   # one row a term of the block
        out[r["term"]] = r["df"]
    return out


def _scored(classes: DataFrame, sent, k: int) -> DataFrame:
    """``(item, cls, first, score)``: each item's k best classes of a task, equal scores by the smallest member."""
    step, saturation = SCORES, SATURATION

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weights = sent.value
        n_items = len(block.ids)
        length = np.diff(block.starts)
        # Sums below 2 ** 53 are exact in doubles.
        plain = int(weights.max(initial=0)) * 10 ** 6 * block.longest < 1 << 53
        best = [(np.zeros(0, np.int64),) * 3] * n_items
        for batch in batches:
            cls, first, m = (batch.column(i).to_numpy() for i in range(3))
            raw = batch.column(3).to_pylist()
            at_once = max(1, step // n_items)
            for a in range(0, len(raw), at_once):
                parts = [np.frombuffer(b, np.uint32).astype(np.int64) for b in raw[a:a + at_once]]
                row = np.repeat(np.arange(len(parts)), [len(p) // 2 for p in parts])
                pairs = np.concatenate(parts)
                term, tf = pairs[::2], pairs[1::2]
                gain = weights[term] * ((10 ** 9 * tf) // (1000 * tf + saturation * m[a:a + at_once][row]))
                # Every (class, term) meets the postings of its term.
                many = length[term]
                nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
                posting = np.repeat(block.starts[term], many) + nth
                cell = np.repeat(row, many) * n_items + block.items[posting]
                value = np.repeat(gain, many) * block.counts[posting]
                if plain:
                    score = np.bincount(cell, value, len(parts) * n_items).astype(np.int64)
                else:
                    score = np.zeros(len(parts) * n_items, np.int64)
                    np.add.at(score, cell, value)
                score = score.reshape(len(parts), n_items)
                for i in range(n_items):
                    c, f, s = best[i]
                    new = np.flatnonzero(score[:, i] >= (s[-1] if len(s) == k else 1))
                    if new.size:
                        c, f, s = np.concatenate([c, cls[a + new]]), np.concatenate([f, first[a + new]]), np.concatenate([s, score[new, i]])
                        order = np.lexsort((f, -s))[:k]
                        best[i] = c[order], f[order], s[order]
        item = np.repeat(np.arange(n_items), [len(b[0]) for b in best])
        yield pa.RecordBatch.from_arrays([pa.array(item), *[pa.array(np.concatenate([b[j] for b in best]) if best else np.zeros(0, np.int64)) for j in range(3)]],
                                         ["item", "cls", "first", "score"])

    return classes.select("cls", "first", "m", "bag").mapInArrow(run, "item bigint, cls bigint, first bigint, score bigint")


def _best(found: DataFrame, key: str, tie: str, k: int) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.col("score").desc(), tie)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, *, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    bound_batches(spark)
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    asked = items.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # Words between spaces bound an item's terms from above well enough to size the blocks.
    blocks = max(1, math.ceil((asked.agg(F.sum(F.size(F.split("text", "[^0-9A-Za-z\\x80-\\x{10FFFF}]+")))).first()[0] or 0) / BLOCK_TERMS))
    for number in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        block = Items(sorted(rows, key=lambda r: (r["item_id"], r["text"])))
        if block.terms:
            out = out.unionByName(written(_search(texts, block, k), "ranked"))
    return out


def _search(texts: DataFrame, block: Items, k: int) -> DataFrame:
    spark = texts.sparkSession
    bags = written(_bags(texts, spark.sparkContext.broadcast(block.terms)), "bags")
    n_docs, n_terms = bags.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    n_terms = n_terms or 1
    held = bags.where(F.col("bag").isNotNull())
    df = _frequencies(held, len(block.terms))
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    wide = "decimal(38,0)"
    m = (F.lit(100 - LENGTH) + F.expr(f"(CAST({LENGTH} AS {wide}) * n * {n_docs}) DIV {n_terms}")).cast("bigint")
    member = held.where(F.col("doc_id").isNotNull()).select("doc_id", m.alias("m"), "bag", F.xxhash64(m, "bag").alias("hash"))
    # Equal hashes are verified: bags and m are grouping keys too.
    classes = member.groupBy("hash", "m", "bag").agg(F.min("doc_id").alias("first")).withColumn("cls", F.monotonically_increasing_id())
    classes = written(classes, "classes")
    found = _scored(classes, spark.sparkContext.broadcast((block, weights)), k)
    # The k best documents of an item are members of its k best classes, by score and smallest member.
    best = written(_best(found, "item", "first", k).select("item", "cls", "score"), "best-classes")
    opened = classes.join(best.select("cls").distinct(), "cls").select("cls", "hash", "m", "bag")
    members = member.join(opened, ["hash", "m", "bag"]).select("cls", "doc_id")
    nth = F.row_number().over(Window.partitionBy("cls").orderBy("doc_id"))
    members = members.withColumn("nth", nth).where(F.col("nth") <= k)
    ranked = _best(best.join(members.select("cls", "doc_id"), "cls"), "item", "doc_id", k)
    names = spark.createDataFrame(list(enumerate(block.ids)), "item bigint, item_id bigint")
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
