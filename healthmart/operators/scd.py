"""D4b in one pass: a batch of dated changes applied to a slowly changing dimension (type 2).

The dimension is read once.  Its versions are put in order for each key, the batch is gathered into one
sorted list for each key, and one full outer join on the key lets every version meet its key's changes.  A
version owns the changes that start in it or between it and the next version (the first one also those that
start before it), so each change is applied by exactly one row, and that row turns into what is left of the
version plus the versions that its changes open.

A change says that from its start year on the key has these attributes:

* inside a version, it splits it: the version ends the year before, the new one takes the rest, up to the
  version's own end, or to the change's end year (NULL: open) when the version was the current one;
* a change that repeats the attributes in force at its start is no change;
* in a gap or before the first version, it opens a version up to the next one, which is not current;
* behind the last version, or for a new key, it opens a current version to the change's end year;
* at a version's own start, it replaces it: the old row stays as an empty interval (its end the year
  before its start), so that no id disappears.

Several changes of one key apply in the order of their start years; the same key and start year twice is an
error.  A NULL key is a key of its own in the batch and meets no version, as in any join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import IntegrityError, assert_unique
from .keys import freeze, with_dense_id


def _piece(type_: str, id_: Column, start: Column, end: Column, current: Column, attrs: Column, fresh: bool) -> Column:
    return F.struct(id_.alias("id"), start.alias("start"), end.alias("end"), current.alias("current"), attrs.alias("attrs"), F.lit(fresh).alias("fresh")).cast(type_)


def scd2_versions(dim: DataFrame, changes: DataFrame, key: str, attrs: Sequence[str], id_col: str, current_col: str = "is_current",
                  start_col: str = "start_year", end_col: str = "end_year") -> DataFrame:
    """The dimension's rows after the batch; new versions have a NULL id and NULL in columns that the batch does not set."""
    kind = {f.name: f.dataType.simpleString() for f in dim.schema.fields}
    record = F.struct(*[F.col(a).cast(kind[a]).alias(a) for a in attrs])
    attrs_type = f"struct<{','.join(f'`{a}`:{kind[a]}' for a in attrs)}>"
    piece = f"struct<id:{kind[id_col]},start:bigint,end:bigint,current:boolean,attrs:{attrs_type},fresh:boolean>"
    end = F.col(end_col) if end_col in changes.columns else F.lit(None)
    batch = changes.select(F.col(key).cast(kind[key]).alias("_key"), F.struct(F.col(start_col).cast("bigint").alias("start"), end.cast("bigint").alias("end"),
                                                              record.alias("attrs")).alias("_change"))
    batch = batch.groupBy("_key").agg(F.sort_array(F.collect_list("_change")).alias("_changes"))

    ordered = Window.partitionBy(key).orderBy(F.col(start_col).asc_nulls_first(), F.col(end_col).asc_nulls_last(), id_col)
    versions = dim.withColumn("_first", F.row_number().over(ordered) == 1).withColumn("_next", F.lead(F.col(start_col).cast("bigint")).over(ordered)) \
        .withColumn("_is_row", F.lit(True))
    both = versions.join(batch, versions[key] == batch["_key"], "full_outer")
    none = F.array().cast(f"array<struct<start:bigint,end:bigint,attrs:{attrs_type}>>")
    both = both.withColumn("_changes", F.coalesce("_changes", none))

    start, nxt, is_row = F.col(start_col).cast("bigint"), F.col("_next"), F.col("_is_row").isNotNull()
    null_id, no, yes = F.lit(None), F.lit(False), F.lit(True)
    before = F.filter("_changes", lambda c: is_row & F.col("_first") & (c["start"] < start))
    inside = F.filter("_changes", lambda c: ~is_row | ((c["start"] >= start) & (nxt.isNull() | (c["start"] < nxt))))
    own = _piece(piece, F.col(id_col), start, F.col(end_col), F.col(current_col), record, False)
    starting = F.when(is_row, F.array(own)).otherwise(F.array().cast(f"array<{piece}>"))

    def apply(done: Column, c: Column) -> Column:
        last = F.element_at(done, -1)
        covered = F.coalesce(last["current"], no) | last["end"].isNull() | (c["start"] <= last["end"])
        current = F.when(covered, F.coalesce(last["current"], no)).otherwise(nxt.isNull())
        rest = (F.when(nxt.isNotNull(), F.when(covered, F.coalesce(last["end"], nxt - 1)).otherwise(nxt - 1))
                .when(covered & ~F.coalesce(last["current"], no), last["end"]).otherwise(c["end"]))
        closed = F.struct(last["id"].alias("id"), last["start"].alias("start"), F.when(covered, c["start"] - 1).otherwise(last["end"]).alias("end"),
                          no.alias("current"), last["attrs"].alias("attrs"), last["fresh"].alias("fresh")).cast(piece)
        opened = _piece(piece, null_id, c["start"], rest, current, c["attrs"], True)
        kept = F.slice(done, F.lit(1), F.size(done) - 1)
        return (F.when(F.size(done) == 0, F.array(_piece(piece, null_id, c["start"], c["end"], yes, c["attrs"], True)))
                .when(covered & last["attrs"].eqNullSafe(c["attrs"]), done)
                .otherwise(F.concat(kept, F.array(closed), F.array(opened))))

    # Versions before the first one end where the next change or the first version starts.
    early = F.transform(before, lambda c, i: _piece(
        piece, null_id, c["start"], F.when(i + 1 < F.size(before), F.get(before, i + 1)["start"]).otherwise(start) - 1, no, c["attrs"], True))
    out = both.withColumn("_p", F.explode(F.concat(early, F.aggregate(inside, starting, apply))))
    cell = {id_col: F.col("_p.id"), start_col: F.col("_p.start"), end_col: F.col("_p.end"), current_col: F.col("_p.current"),
            key: F.coalesce(F.col(key), F.col("_key")), **{a: F.col("_p.attrs")[a] for a in attrs}}
    return out.select(*[(cell[c] if c in cell else F.when(~F.col("_p.fresh"), F.col(c))).cast(kind[c]).alias(c) for c in dim.columns])


def scd2_merge(dim: DataFrame, changes: DataFrame, key: str, attrs: Sequence[str], id_col: str, current_col: str = "is_current",
               start_col: str = "start_year", end_col: str = "end_year") -> DataFrame:
    """The dimension after a batch of changes ``(key, attrs..., start year[, end year])``.  New versions are numbered
    after the largest id, in the order of their columns.  The result of the one pass over the dimension is
    a written table, from which the ids are taken."""
    changes = assert_unique(changes, [key, start_col], "SCD-2 change batch")
    if changes.where(F.col(start_col).isNull()).limit(1).collect():
        raise IntegrityError("an SCD-2 change needs a start year")
    done = freeze(scd2_versions(dim, changes, key, attrs, id_col, current_col, start_col, end_col), "scd2")
    top = done.agg(F.max(id_col)).first()[0] or 0
    fresh = done.where(F.col(id_col).isNull()).drop(id_col)
    numbered = with_dense_id(fresh, fresh.columns, id_col, start=int(top) + 1)
    return done.where(F.col(id_col).isNotNull()).unionByName(numbered.withColumn(id_col, F.col(id_col).cast(dim.schema[id_col].dataType)))
