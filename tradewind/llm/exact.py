"""Exact duplicates by a tree merge of digest runs.

Each input partition reduces its rows to a run: one entry per digest, sorted by it. In every
round up to ``FAN_IN`` runs merge into one (entries of a digest combine, the row that stays is
retained), until a single run is left. That run is spread over the cluster by digest; no task
holds it. The outcome then walks the same tree down again, so that even a text that a third
of all rows share meets at most ``FAN_IN`` entries per key and level, and at the leaves only
the rows of one partition.

An entry is known by SHA-256, byte length and an independent 64-bit hash together: texts
whose SHA-256 alone collided would stay apart.

Defined results: a null text counts as empty; a null id loses against every other id; rows
that repeat both id and text count separately and exactly one of them stays; an empty table
gives an empty result; columns other than id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.operators.scratch import materialize

FAN_IN = 16
KEY = ["digest", "n_bytes", "second_hash"]


def _fingerprint(text: Column, normalise: Callable[[Column], Column] | None) -> list[Column]:
    text = F.coalesce(text, F.lit(""))
    data = (normalise(text) if normalise else text).cast("binary")
    return [
        F.unhex(F.sha2(data, 256)).alias("digest"),
        F.octet_length(data).cast("long").alias("n_bytes"),
        F.xxhash64(data).alias("second_hash"),
    ]


@dataclass(frozen=True)
class ExactDuplicates:
    docs: DataFrame
    id_col: str = "doc_id"
    text_col: str = "text"
    keep: str = "largest"  # or "smallest": the id that stays
    normalise: Callable[[Column], Column] | None = None
    fan_in: int = FAN_IN

    def rows(self) -> DataFrame:
        """One narrow row per input row, in sorted runs: run, place, id and the digest key."""
        rows = self.docs.select(
            F.spark_partition_id().cast("long").alias("run"),
            F.monotonically_increasing_id().alias("place"),
            F.col(self.id_col).alias("id"),
            *_fingerprint(F.col(self.text_col), self.normalise),
        )
        return materialize(rows.sortWithinPartitions(*KEY), "digest-rows")

    def _best(self, entry: Column) -> Column:
        return F.max(entry) if self.keep == "largest" else F.min(entry)

    def membership(self) -> DataFrame:
        """id, place, keep_id, group_size, kept and digest for every input row."""
        rows = self.rows()
        # A null id must lose either way round, so the entry starts with its presence.
        present = F.col("id").isNotNull() if self.keep == "largest" else F.col("id").isNull()
        entry = F.struct(present.alias("ranked"), F.col("id"), F.col("place"))
        leaf = rows.groupBy("run", *KEY).agg(self._best(entry).alias("best"), F.count("*").alias("n"))
        levels = [materialize(leaf, "digest-runs-0")]
        last_run = levels[0].agg(F.max("run")).first()[0] or 0
        while last_run > 0:
            merged = (
                levels[-1]
                .withColumn("run", F.expr(f"run div {self.fan_in}"))
                .groupBy("run", *KEY)
                .agg(self._best(F.col("best")).alias("best"), F.sum("n").alias("n"))
            )
            levels.append(materialize(merged, f"digest-runs-{len(levels)}"))
            last_run //= self.fan_in
        shared = reduce(self._descend, reversed(levels[:-1]), levels[-1].filter("n > 1"))
        shared = shared.withColumnsRenamed({"best": "group_best", "n": "group_n"})
        found = rows.join(shared, ["run", *KEY], "left")
        return found.select(
            "id",
            "place",
            F.when(F.col("group_n").isNull(), F.col("id")).otherwise(F.col("group_best.id")).alias("keep_id"),
            F.coalesce("group_n", F.lit(1)).cast("long").alias("group_size"),
            F.coalesce(F.col("group_best.place") == F.col("place"), F.lit(True)).alias("kept"),
            "digest",
        )

    def _descend(self, above: DataFrame, level: DataFrame) -> DataFrame:
        """Entries of ``level`` with the outcome of the run they merged into."""
        entries = level.select("run", *KEY).withColumn("above", F.expr(f"run div {self.fan_in}"))
        outcome = above.withColumnRenamed("run", "above")
        return entries.join(outcome, ["above", *KEY]).drop("above")

    def unique(self) -> DataFrame:
        """The rows that stay, with all their columns."""
        found = materialize(self.membership(), "digest-members")
        mark = "_tw_digest"
        keys = found.filter("kept").select(F.col("id").alias("_tw_id"), F.col("digest").alias("_tw_kept"))
        digest = _fingerprint(F.col(self.text_col), self.normalise)[0]
        docs = self.docs.withColumn(mark, digest)
        same = docs[self.id_col].eqNullSafe(keys["_tw_id"]) & (docs[mark] == keys["_tw_kept"])
        kept = docs.join(keys, same, "left_semi")
        repeated = found.filter(~F.col("kept") & F.col("id").eqNullSafe(F.col("keep_id")))
        if not repeated.isEmpty():  # rows that repeat id and text alike: one of them stays
            kept = kept.dropDuplicates([self.id_col, mark])
        return kept.drop(mark)
