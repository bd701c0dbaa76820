"""Joining rows with one row per group of them, where one group may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegrid.operators.storage import fits_broadcast

#: A group is split that holds more than this part of all rows, and more than FEW; fewer groups than this can be so large.
SPLIT, FEW = 1000, 512


def beside_groups(rows: DataFrame, groups: DataFrame, key: str, count: str) -> DataFrame:
    """Each of ``rows`` with the columns of its group; NULL is a key like others, rows without a group go.

    ``groups`` is a stored table with one row per ``key``; its column ``count`` tells how many of ``rows`` have it. A small
    one is broadcast; else see `SplitJoin`.
    """
    if fits_broadcast(groups):
        named = groups.withColumnRenamed(key, "_key")
        return rows.join(F.broadcast(named), F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
    split = SplitJoin(groups.select(key, F.col(count).alias("n")), key, null_safe=True)
    return split.join(split.dealt(rows), groups)


class SplitJoin:
    """`beside_groups` by a shuffle of both sides; ``counts`` (key, n) is a stored table.

    If some groups are large, they are dealt to several tasks, each with a copy of the group's row: all copies together
    number at most the groups plus SPLIT. Otherwise it is a plain join.
    """

    def __init__(self, counts: DataFrame, key: str, null_safe: bool = False):
        self.key, self.null_safe = key, null_safe
        found = counts.agg(F.sum("n").alias("total"), F.max("n").alias("most")).first()
        most = max(FEW, -(-(found["total"] or 0) // SPLIT))
        copies = F.ceil(F.col("n") / most).cast("int").alias("_copies")
        self.large = None
        if (found["most"] or 0) > most:
            self.large = F.broadcast(counts.filter(F.col("n") > most).select(F.col(key).alias("_key"), copies))  # fewer than SPLIT rows

    def _same(self) -> Column:
        return F.col(self.key).eqNullSafe(F.col("_key")) if self.null_safe else F.col(self.key) == F.col("_key")

    def dealt(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the number ``_part`` of the copy that each will meet, if there are copies."""
        if self.large is None:
            return rows
        any_of = F.pmod(F.monotonically_increasing_id(), F.coalesce("_copies", F.lit(1))).cast("int")
        return rows.join(self.large, self._same(), "left").withColumn("_part", any_of).drop("_key", "_copies")

    def join(self, dealt: DataFrame, groups: DataFrame) -> DataFrame:
        if self.large is None:
            return dealt.join(groups.withColumnRenamed(self.key, "_key"), self._same()).drop("_key")
        each = F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1))
        copied = groups.join(self.large, self._same(), "left").withColumn("_of", each).drop("_key", "_copies")
        copied = copied.withColumnRenamed(self.key, "_key")
        return dealt.join(copied, self._same() & (F.col("_part") == F.col("_of"))).drop("_key", "_part", "_of")
