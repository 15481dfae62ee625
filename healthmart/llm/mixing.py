"""Mixing sources to target weights by hierarchical budgets, with DataFrame functions only.

The tree has the levels of ``path`` (domain, language, source).  A node's capacity is the tokens
below it times ``max_epochs``.  The budget is split level by level in proportion to the integer
weights of siblings; a child that cannot use its part gets its capacity and the rest goes to its
siblings, so a shortage reaches a parent's siblings only when all children of the parent are full.
A leaf repeats its documents in whole epochs and fills what is left with a prefix, by tokens, of
one more epoch in an order seeded by the epoch.

The prefix needs no sort of a whole leaf: the seeded order is cut into ``16 ** BUCKET_HEX`` buckets,
token sums of the buckets give the one bucket in which the prefix ends, and only rows of that
bucket are ordered.  A source that holds a third of all rows is spread like any other.

Defined results: a null path value is the empty string; a null text has no tokens; documents
without tokens cost nothing and are in a prefix up to where it ends; equal ids are ordered by
token count, and repeated rows are selected one by one; empty tables give empty tables.  A leaf whose budget is
smaller than its first document gets none.  Columns the operator adds to a table get free names.
The tree may be of any size: siblings are split by running sums over range partitions, one small sum for each
partition and parent.  What a leaf's documents need to know of it reaches them in two joins: leaves that hold
at least one in HOT of all rows, of which there are HOT at most, are broadcast; the others are left to
Spark's choice, and none of them is large enough to burden a task of a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written
from .quality import _fresh

BUCKET_HEX, HOT = 3, 1000
BIG = "decimal(38,0)"


def token_count(text: Column) -> Column:
    """Tokens of the budget: words between ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _weight(cols: Sequence[str], weights: Mapping[tuple, int]) -> Column:
    """The weight of a node of this level; 1 where none is given."""
    out = None
    for path, weight in weights.items():
        if len(path) == len(cols):
            hit = F.lit(True)
            for c, v in zip(cols, path, strict=True):
                hit = hit & ((F.col(c) == v) if v is not None else F.lit(True))
            out = F.when(hit, F.lit(weight)) if out is None else out.when(hit, F.lit(weight))
    return (F.lit(1) if out is None else out.otherwise(F.lit(1))).cast(BIG)


def _split(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Split each parent's ``budget`` over its children (columns ``cap``, ``weight``) into ``given``.

    Children are taken by rising capacity for their weight: as long as a child's fair part of what
    is left is more than it can hold, it is full; the others share the rest by weight.
    """
    nothing = F.lit(0).cast(BIG)
    # The children in order, by range: no task holds all children of one parent.
    order = [*parent, F.col("cap").cast("double") / F.col("weight").cast("double"), name]
    nodes = written(nodes.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "siblings")
    inside = Window.partitionBy(*parent, "part").orderBy(*order[len(parent):])
    nodes = (nodes.withColumn("w_in", F.sum("weight").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
             .withColumn("c_in", F.sum("cap").over(inside.rowsBetween(Window.unboundedPreceding, -1))))
    sums = nodes.groupBy(*parent, "part").agg(F.sum("weight").alias("w"), F.sum("cap").alias("c"))
    parts = Window.partitionBy(*parent).orderBy("part") if parent else Window.orderBy("part")       # one row a partition
    before = parts.rowsBetween(Window.unboundedPreceding, -1)
    whole = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = sums.select(*parent, "part", F.sum("w").over(whole).alias("w_all"), F.coalesce(F.sum("w").over(before), nothing).alias("w_off"),
                       F.coalesce(F.sum("c").over(before), nothing).alias("c_off"))
    nodes = nodes.join(sums, [*parent, "part"])
    nodes = (nodes.withColumn("w_left", (F.col("w_all") - F.col("w_off") - F.coalesce("w_in", nothing)).cast(BIG))
             .withColumn("c_before", (F.col("c_off") + F.coalesce("c_in", nothing)).cast(BIG)))
    nodes = nodes.withColumn("full", F.expr(f"cap * w_left <= weight * cast(budget - c_before as {BIG})"))
    rest = nodes.groupBy(*parent).agg(F.sum(F.when(F.col("full"), F.col("cap")).otherwise(nothing)).cast(BIG).alias("c_full"),
                                      F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(nothing)).cast(BIG).alias("w_rest"))
    nodes = nodes.join(rest, list(parent)) if parent else nodes.join(F.broadcast(rest))             # without a parent one row
    given = F.expr(f"case when full then cap else cast((weight * cast(budget - c_full as {BIG})) div w_rest as {BIG}) end")
    return nodes.withColumn("given", given).drop(
        "part", "w_in", "c_in", "w_all", "w_off", "c_off", "w_left", "c_before", "full", "c_full", "w_rest", "weight", "cap", "budget")


def budgets(leaves: DataFrame, path: Sequence[str], weights: Mapping[tuple, int], share: tuple[int, int],
            max_epochs: int) -> DataFrame:
    """``leaves`` (path, ``tokens``) with ``given``, the tokens each leaf is to contribute: ``share``
    (a fraction) of all tokens is the budget of the root."""
    num, den = share
    caps = leaves.withColumn("cap", (F.col("tokens") * max_epochs).cast(BIG))
    root = leaves.agg(F.expr(f"cast((cast(coalesce(sum(tokens), 0) as {BIG}) * {int(num)}) div {int(den)} as {BIG})").alias("budget"))
    above: DataFrame | None = None
    for level in range(1, len(path) + 1):
        cols = list(path[:level])
        nodes = caps.groupBy(*cols).agg(F.sum("cap").cast(BIG).alias("cap")).withColumn("weight", _weight(cols, weights))
        parent = root if above is None else above.withColumnRenamed("given", "budget")
        nodes = nodes.join(F.broadcast(parent)) if above is None else nodes.join(parent, cols[:-1])     # the root is one row
        above = _split(nodes, cols[:-1], cols[-1])
    return leaves.join(above, list(path))


def _told(rows: DataFrame, facts: DataFrame, cols: Sequence[str], n_rows: int, spread: Column, salt: str) -> DataFrame:
    """``rows`` with what ``facts`` (leaf, rows ``n`` of the leaf, more) says of their leaf; NULL where it has none."""
    told = [c for c in facts.columns if c not in (*cols, "n")]
    facts = facts.withColumn("hot", F.col("n") * HOT >= n_rows)
    hot = facts.where("hot").select(*cols, *[F.col(c).alias(f"hot_{c}") for c in told], "hot")
    cold = facts.where("NOT hot").select(*cols, *told, F.xxhash64(*cols).alias(salt))
    out = rows.join(F.broadcast(hot), cols, "left")                 # HOT rows at most
    # Rows of hot leaves match nothing here, wherever they go.
    out = out.withColumn(salt, F.when(F.col("hot"), spread).otherwise(F.xxhash64(*cols))).join(cold, [*cols, salt], "left")
    return out.withColumns({c: F.coalesce(F.col(f"hot_{c}"), F.col(c)) for c in told}).drop("hot", salt, *[f"hot_{c}" for c in told])


def mix(docs: DataFrame, path: Mapping[str, Column], weights: Mapping[tuple, int], *, share: tuple[int, int],
        max_epochs: int, seed: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """The selected rows of ``docs``, once for each epoch they are selected in, and the names of the
    columns added: the path, ``n_tokens``, ``epoch`` and ``leaf_budget``."""
    want = [*path, "n_tokens", "epoch", "leaf_budget", "order_key", "salt"]
    name = dict(zip(want, _fresh(docs, *[f"mix_{w}" for w in want]), strict=True))
    rows = docs.withColumns({name[k]: F.coalesce(c.cast("string"), F.lit("")) for k, c in path.items()}
                            | {name["n_tokens"]: token_count(F.col(text_col))})
    cols = [name[k] for k in path]
    tokens = rows.groupBy(*cols).agg(F.sum(name["n_tokens"]).cast("long").alias("tokens"), F.count(F.lit(1)).alias("n"))
    tokens = written(tokens, "leaves")
    by_name = {v: k for k, v in name.items()}
    plain = tokens.select(*[F.col(c).alias(by_name[c]) for c in cols], "tokens")
    leaf = budgets(plain, list(path), weights, share, max_epochs)
    counts = tokens.select(*[F.col(c).alias(by_name[c]) for c in cols], "n")
    leaf = leaf.join(counts, list(path))
    leaf = leaf.withColumn("whole", F.expr("case when tokens > 0 then cast(given div tokens as bigint) else 0 end"))
    leaf = leaf.withColumn("rest", F.expr("cast(given as bigint) - whole * tokens")).select(
        *[F.col(by_name[c]).alias(c) for c in cols], F.col("given").cast("long").alias(name["leaf_budget"]), "whole", "rest", "n")
    leaf = written(leaf, "budgets")

    # The order of the last, partial epoch: a seeded digest of the id.
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    n_rows = leaf.agg(F.sum("n")).first()[0] or 0
    spread = F.xxhash64(id_col, name["n_tokens"])
    keyed = _told(rows, leaf, cols, n_rows, spread, name["salt"]).withColumn(name["order_key"], key)
    bucket = F.substring(name["order_key"], 1, BUCKET_HEX)
    sums = keyed.groupBy(*cols, "rest", bucket.alias("bucket")).agg(F.sum(name["n_tokens"]).alias("t"))
    run = Window.partitionBy(*cols).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ends = (sums.withColumn("upto", F.sum("t").over(run)).where(F.col("upto") > F.col("rest"))
            .groupBy(*cols).agg(F.min(F.struct(F.col("bucket"), (F.col("upto") - F.col("t")).alias("before"))).alias("end")))
    ends = written(ends.select(*cols, F.col("end.bucket").alias("end_bucket"), F.col("end.before").alias("before")), "ends")
    placed = _told(keyed, ends.join(leaf.select(*cols, "n"), cols), cols, n_rows, spread, name["salt"])

    inside = F.col("end_bucket").isNull() | (bucket < F.col("end_bucket"))
    epochs = F.when(F.col("whole") + inside.cast("int") > 0, F.sequence(F.lit(0).cast("long"), F.col("whole") + inside.cast("int") - 1))
    out = [*[F.col(f"`{c}`") for c in docs.columns], *cols, name["n_tokens"], name["leaf_budget"]]
    most = placed.withColumn(name["epoch"], F.explode(epochs)).select(*out, F.col(name["epoch"]))
    last = Window.partitionBy(*cols).orderBy(name["order_key"], id_col, name["n_tokens"]).rowsBetween(Window.unboundedPreceding, 0)
    edge = (placed.where(bucket == F.col("end_bucket"))
            .withColumn("upto", F.col("before") + F.sum(name["n_tokens"]).over(last)).where(F.col("upto") <= F.col("rest"))
            .select(*out, F.col("whole").alias(name["epoch"])))
    return most.unionByName(edge), name


def mixture(docs: DataFrame, path: Mapping[str, Column], weights: Mapping[tuple, int], *, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """One row per document and epoch it is selected in: id, path, tokens, epoch and the leaf's budget."""
    wanted = docs.select(id_col, text_col, *[c.alias(f"p_{k}") for k, c in path.items()])
    df, name = mix(wanted, {k: F.col(f"p_{k}") for k in path}, weights, id_col=id_col, text_col=text_col, **params)
    return df.select(id_col, *[F.col(name[k]).alias(k) for k in [*path, "n_tokens", "epoch", "leaf_budget"]])


def remix(docs: DataFrame, path: Mapping[str, Column], weights: Mapping[tuple, int], **params) -> DataFrame:
    """The selected rows with the columns of ``docs``, repeated for each epoch."""
    df, _ = mix(docs, path, weights, **params)
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])
