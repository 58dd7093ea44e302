"""Gapless positions of rows within groups of any size, without a task that sorts a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.operators.scratch import materialize

ROW_BITS = 33  # of a partition in monotonically_increasing_id


def group_key(column: Column) -> Column:
    """A text that sorts as the column does bytewise, null first, and joins null with null."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def positions(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df``, stored, with ``pos`` (from 0 in its group, by ``order``) and ``n`` (rows of the group).

    Rows are range-partitioned by (group, order) and numbered as they are written; a group's first
    number in each range and its rows in earlier ranges turn these into positions. Only one row per
    group and range is counted. Rows alike in group and order go by their place in ``df``, which also
    lets one key spread over many ranges. ``df`` is read twice: pass a stored table.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(group, *order, "_tie").sortWithinPartitions(group, *order, "_tie").drop("_tie")
    numbered = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "numbered")

    numbered = numbered.withColumn("_part", F.shiftright("_at", ROW_BITS))
    pieces = numbered.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    pieces = pieces.select(
        group,
        "_part",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(whole).alias("n"),
    )
    placed = numbered.join(pieces, [group, "_part"])
    return placed.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")
