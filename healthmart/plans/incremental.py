"""Facts that are maintained instead of rebuilt.

* B1 and B2 from stored partials: every batch of arriving outcomes is folded into sums per (cell, indication)
  (B1) and per (person, cost) (B2) and stored as a partition of its own.  The sums of several batches add up,
  so a fact is derived from the stored partials, and a merge reads the arrivals alone.  A batch that is run
  again replaces its own partition.  ``compact`` folds the batches into one and remembers their names, so that
  a batch which comes again afterwards is still recognised.
* B3 restated by year (D5): the intensity fact is partitioned by year, and a restatement rewrites the years in
  which some row changes; the files of the others stay.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dml import restate
from ..session import small_tasks
from ..sources.tables import Catalog
from . import facts as FT

CELL_KEYS = [*FT.OUTCOME_KEYS, "indication_id"]
PERSON_KEYS = ["person_id", "cost_cents"]
#: Name of the partition that compaction writes.
FOLDED = "folded"


class Partials:
    """Stored sums per ``keys``, one partition for each batch."""

    def __init__(self, cat: Catalog, table: str, keys: Sequence[str]):
        self.cat, self.table, self.keys = cat, table, list(keys)
        self.names = f"{table}_folded_batches"

    def merge(self, batch: str, partials: DataFrame) -> bool:
        """Store the sums of one batch; False when the batch was folded before and nothing is to be done."""
        if batch == FOLDED:
            raise ValueError(f"{FOLDED!r} is the name of the compacted batches")
        if self.cat.exists(self.names) and self.cat.scan(self.names).where(F.col("batch") == batch).limit(1).collect():
            return False
        self.cat.overwrite_partitions(self.table, partials.withColumn("batch", F.lit(batch)), ["batch"])
        return True

    def sums(self) -> DataFrame:
        df = self.cat.scan(self.table)
        if self._partitions() == [FOLDED]:      # one row for each key, as ``compact`` wrote it
            return df.drop("batch")
        values = [c for c in df.columns if c not in (*self.keys, "batch")]
        return df.groupBy(*self.keys).agg(*[F.sum(c).cast(df.schema[c].dataType).alias(c) for c in values])

    def _partitions(self) -> list[str]:
        """The stored batches, as the catalog lists them: no data is read."""
        shown = self.cat.spark.sql(f"SHOW PARTITIONS {self.cat.name(self.table)}").collect()
        return sorted(unquote(r["partition"].removeprefix("batch=")) for r in shown)

    def compact(self) -> None:
        """Fold all batches into one partition, in one swap with the list of their names."""
        batches = self.cat.scan(self.table).select("batch").where(F.col("batch") != FOLDED).distinct()
        if self.cat.exists(self.names):
            batches = batches.union(self.cat.scan(self.names)).distinct()
        with small_tasks(self.cat.spark):
            self.cat.replace_all({self.table: self.sums().withColumn("batch", F.lit(FOLDED)), self.names: batches}, {self.table: ["batch"]})

    def drop(self) -> None:
        self.cat.drop(self.table)
        self.cat.drop(self.names)


class OutcomeFacts:
    """B1 and B2 over stored partials of one namespace."""

    def __init__(self, cat: Catalog):
        self.cells = Partials(cat, "outcome_cell_partials", CELL_KEYS)
        self.persons = Partials(cat, "outcome_person_partials", PERSON_KEYS)

    def merge(self, batch: str, lines: DataFrame, outcome: DataFrame, indication: DataFrame, profit: DataFrame) -> None:
        """Fold a batch of outcomes: ``lines`` carry their patient's cell (B1), ``outcome`` the person (B2)."""
        with small_tasks(lines.sparkSession):
            self.cells.merge(batch, FT.outcome_partials(lines))
            self.persons.merge(batch, FT.person_costs(outcome, indication, profit))

    def fact(self, indication: DataFrame, profit: DataFrame) -> DataFrame:
        return FT.fact_from_partials(self.cells.sums(), indication, profit)

    def fact_no_country(self, cells: DataFrame, profit: DataFrame) -> DataFrame:
        return FT.fact_from_person_costs(self.persons.sums(), cells, profit)

    def drop(self) -> None:
        self.cells.drop()
        self.persons.drop()


def store_by_year(cat: Catalog, table: str, fact: DataFrame) -> None:
    """The intensity fact, partitioned by year."""
    cat.replace_all({table: fact}, {table: ["year_id"]})


def restate_years(cat: Catalog, table: str, versions: DataFrame) -> list[int]:
    """D5 on a fact partitioned by year: rewrite the years in which a row changes its level, and no other.
    ``versions`` is ``facts.current_versions_by_year``.  Returns the rewritten years' ids (a calendar's worth)."""
    fact = cat.scan(table)
    new = restate(fact, versions, ["year_id", "disease_id"], "intensity_level_id", "intensity_level_id")
    paired = fact.select("fact_disease_intensity_id", "year_id", F.col("intensity_level_id").alias("_old")).join(
        new.select("fact_disease_intensity_id", "year_id", "intensity_level_id"), ["fact_disease_intensity_id", "year_id"])
    changed = paired.where(~F.col("_old").eqNullSafe(F.col("intensity_level_id"))).select("year_id").distinct().collect()
    years = sorted(r["year_id"] for r in changed)
    if years:
        # The filter on the partition column prunes the read to the years that are written.
        touched = restate(fact.where(F.col("year_id").isin(years)), versions, ["year_id", "disease_id"], "intensity_level_id", "intensity_level_id")
        cat.overwrite_partitions(table, touched, ["year_id"])
    return years
