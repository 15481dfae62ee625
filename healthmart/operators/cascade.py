"""A11 over the key graph, and A9 for all foreign keys at once.

``cascade`` is ON UPDATE CASCADE as a job: keys of one table change, and every column that refers to them,
directly or through another key column, changes with them.  The declared foreign keys are the graph.  Each
table that holds an affected column is rewritten once, with one left join for each such column, and all new
versions take their names in one swap.

``orphan_report`` reads each table once, whatever number of keys it takes part in: its key columns become
rows (key space, key, which column), parents and children alike, and one grouping by key decides which keys
have a parent.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.schemas import FOREIGN_KEYS
from ..sources.tables import Catalog
from .dml import remap_key
from .joins import IntegrityError, assert_unique

ForeignKey = tuple[str, str, str, str]     # child table, column, parent table, column


def affected_columns(table: str, column: str, foreign_keys: Sequence[ForeignKey] = FOREIGN_KEYS) -> dict[str, list[str]]:
    """The columns that change with ``table.column``, by table: itself, the columns that refer to it, those that
    refer to these, and so on.  Cycles end where they close."""
    out, todo = {table: [column]}, [(table, column)]
    while todo:
        parent = todo.pop()
        for child, fk, *key in foreign_keys:
            if tuple(key) == parent and fk not in out.setdefault(child, []):
                out[child].append(fk)
                todo.append((child, fk))
    return {t: cols for t, cols in out.items() if cols}


def check_mapping(parent: DataFrame, column: str, mapping: DataFrame, old: str, new: str) -> None:
    """Refuse a key change that is not one: a NULL, an old key listed twice, two keys becoming one.  Keys may
    change places, as in one UPDATE statement."""
    if mapping.where(F.col(old).isNull() | F.col(new).isNull()).limit(1).collect():
        raise IntegrityError("a key changes from or to NULL")
    assert_unique(mapping, [old], "key remapping")
    after = remap_key(parent.select(column), column, mapping, old, new)
    moved = after.join(mapping.select(F.col(new).alias("_new")).distinct(), F.col(column) == F.col("_new"), "left_semi")
    assert_unique(moved, [column], "key after remapping")


def cascade(cat: Catalog, table: str, column: str, mapping: DataFrame, old: str = "old_key", new: str = "new_key",
            foreign_keys: Sequence[ForeignKey] = FOREIGN_KEYS) -> dict[str, list[str]]:
    """Change keys of ``table.column`` by ``mapping`` and let every stored table of the graph follow, in one swap.
    Returns the rewritten columns by table.  Old keys that do not occur are ignored; NULL keys stay NULL."""
    check_mapping(cat.scan(table), column, mapping, old, new)
    changed = {t: cols for t, cols in affected_columns(table, column, foreign_keys).items() if cat.exists(t)}
    frames = {}
    for t, cols in changed.items():
        df = cat.scan(t)
        for c in cols:
            df = remap_key(df, c, mapping, old, new, check=False)
        frames[t] = df
    cat.replace_all(frames)
    return changed


def _stream_type(types: Sequence[T.DataType]) -> str:
    return "bigint" if all(isinstance(t, T.IntegralType) for t in types) else "string"


def orphan_report(tables: Mapping[str, DataFrame], foreign_keys: Sequence[ForeignKey]) -> DataFrame:
    """A9 for all keys: one row for each foreign key with the number of child rows whose non-NULL key has no parent."""
    # A key space is one parent column; its children and itself meet there.
    spaces = {key: i for i, key in enumerate(dict.fromkeys(tuple(fk[2:]) for fk in foreign_keys))}
    kind = _stream_type([tables[t].schema[c].dataType for fk in foreign_keys for t, c in (fk[:2], fk[2:])])
    parts = []
    for name, df in tables.items():
        roles = [(spaces[key], key[1], None) for key in spaces if key[0] == name]
        roles += [(spaces[tuple(fk[2:])], fk[1], i) for i, fk in enumerate(foreign_keys) if fk[0] == name]
        if roles:
            entries = [F.struct(F.lit(space).alias("space"), F.col(c).cast(kind).alias("key"), F.lit(child).cast("int").alias("child"))
                       for space, c, child in roles]
            parts.append(df.select(F.explode(F.array(*entries)).alias("e")).select("e.*").where(F.col("key").isNotNull()))
    stream = parts[0]
    for p in parts[1:]:
        stream = stream.unionByName(p)
    # Counts combine before the shuffle, so a hot key is one row a map task.
    by_key = stream.groupBy("space", "key").agg(
        F.max(F.col("child").isNull()).alias("has_parent"),
        *[F.count_if(F.col("child") == i).alias(f"n{i}") for i in range(len(foreign_keys))])
    sums = by_key.where(~F.col("has_parent")).agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(foreign_keys))])
    rows = [F.struct(*[F.lit(v).alias(n) for v, n in zip(fk, ("child_table", "fk_column", "parent_table", "pk_column"))],
                     F.col(f"n{i}").alias("orphan_rows")) for i, fk in enumerate(foreign_keys)]
    return sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
