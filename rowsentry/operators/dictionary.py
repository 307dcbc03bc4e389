"""Dictionaries of categories of any size: sorted, numbered tables that no task and not the driver holds whole.

Distinct categories are laid out in ranges of their order, each task numbers its range, and the sizes of the earlier ranges are
added (:func:`rowsentry.operators.ranking.bucketed_rank`). The table is written below ``spark.checkpoint.dir`` and read back, so
that using it starts there.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from rowsentry.operators.ranking import bucketed_rank
from rowsentry.operators.sizing import kept, written  # noqa: F401


def numbered(found: DataFrame, by: Sequence[str] = (), name: str = "place") -> DataFrame:
    """Distinct ``by, category`` rows with ``place`` from 0 in the order of the categories within ``by``.

    Ranges of the sorted order are tasks. The ranges come from a sample and are written down before they are counted; where no
    folder is named, the first characters of the categories stand for them.
    """
    found = found.select(*by, "category")
    ranged = written(found.repartitionByRange(*by, "category").withColumn("_part", F.spark_partition_id()))
    if ranged is None:
        ranged, part = found, F.substring("category", 1, 3)
    else:
        part = F.col("_part")
    ranked = bucketed_rank(ranged, by, part, ["category"], "_place")
    return ranked.select(*by, "category", (F.col("_place") - 1).cast("int").alias(name))


@dataclass(frozen=True)
class Dictionary:
    """``category, place`` rows (and ``fold``, if ``per_fold``) of a column with ``size`` places over all folds."""

    table: DataFrame
    size: int
    per_fold: bool

    def of_fold(self, fold) -> Dictionary:
        """What one fold has seen, at the same places, for rows of any fold."""
        if not self.per_fold:
            return self
        return Dictionary(self.table.filter(F.col("fold") == fold).select("category", "place"), self.size, False)

    def names(self) -> list[str]:
        """The categories at their places: for a dense column each, which is as many names on the driver."""
        out = [""] * self.size
        for r in self.table.select("category", "place").distinct().toLocalIterator():
            out[r["place"]] = r["category"]
        return out


def build(rows: DataFrame, size: int, per_fold: bool) -> Dictionary:
    """The dictionary of distinct ``fold, category`` rows of one column."""
    places = numbered(rows.select("category").distinct())
    table = rows.select("fold", "category").join(places, "category") if per_fold else places
    return Dictionary(kept(table), size, per_fold)
