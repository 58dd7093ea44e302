"""Shards by weighted rendezvous hashing of stable record keys.

Every shard draws a score from (key, shard); the record goes to the highest. A new shard can
only win records for itself, and a shard that leaves gives up only its own, so a change of
the shard count moves the fewest records possible. Nothing but the key, the shard and its
weight enters a score: copies of a text and hot sources spread like any other rows.

Defined results: a null key is replaced by the text's SHA-256, so rows without a key spread as
well; a null text has no bytes; rows that repeat a key land in the same shard in slots of
their own; an empty table gives an empty result. Columns other than key and text are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.operators.scratch import materialize

ROW_BYTES = 16  # fixed part of a record's size


def _score(key: Column, shard: Column, weight: Column | None) -> Column:
    draw = F.xxhash64(key, shard)
    if weight is None:
        return draw
    # -weight / ln(u) with u in (0, 1): the chance to be highest is in proportion to the weight.
    u = (F.shiftrightunsigned(draw, 11).cast("double") + F.lit(0.5)) / F.lit(float(2**53))
    return -weight / F.ln(u)


def rendezvous(key: Column, shards: Mapping[int, float]) -> Column:
    """The winner among ``shards`` (shard -> weight) for a key, as struct(score, shard)."""
    even = len(set(shards.values())) == 1
    options = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(float(w)).alias("w")) for s, w in shards.items()])
    scored = F.transform(
        options, lambda o: F.struct(_score(key, o["s"], None if even else o["w"]).alias("score"), o["s"].alias("shard"))
    )
    return F.array_max(scored)


def record_key(id_col: str, text_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))


def assign(
    docs: DataFrame,
    n_shards: int,
    weights: Mapping[int, float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, size, text_crc32, shard and grown_shard (the shard if there were one more of mean weight)."""
    shards = {s: 1.0 for s in range(n_shards)} | dict(weights or {})
    mean = sum(shards.values()) / len(shards)
    grown = shards | {n_shards: mean}
    even = len(set(grown.values())) == 1
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        record_key(id_col, text_col).alias("key"),
    )
    won = keyed.withColumn("won", rendezvous(F.col("key"), shards))
    newcomer = _score(F.col("key"), F.lit(n_shards), None if even else F.lit(mean))
    return won.select(
        "id",
        "size",
        "text_crc32",
        F.col("won.shard").alias("shard"),
        F.when(newcomer > F.col("won.score"), F.lit(n_shards)).otherwise(F.col("won.shard")).alias("grown_shard"),
    )


def with_slots(assigned: DataFrame) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each shard.

    Rows are numbered within (part, shard) and shifted by the rows of the shard's earlier
    parts, so no task sorts a whole shard. The parts are those of the stored table.
    """
    stored = materialize(assigned.withColumn("part", F.spark_partition_id()), "sharded")
    counts = stored.groupBy("shard", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    within = Window.partitionBy("shard", "part").orderBy("id", "text_crc32", "size")
    numbered = stored.withColumn("place", F.row_number().over(within))
    joined = numbered.join(shifts, ["shard", "part"])
    return joined.withColumn("slot", F.col("shift") + F.col("place") - 1).drop("part", "shift", "place")


def write_shards(
    docs: DataFrame, path: str, n_shards: int, files_per_shard: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Writes whole records as parquet folders ``shard=N``, each of ``files_per_shard`` files."""
    won = rendezvous(record_key(id_col, text_col), {s: 1.0 for s in range(n_shards)})
    file = F.pmod(F.xxhash64(record_key(id_col, text_col), F.lit("file")), F.lit(files_per_shard))
    placed = docs.withColumns({"shard": won["shard"], "_tw_file": file})
    spread = placed.repartition(n_shards * files_per_shard, "shard", "_tw_file").drop("_tw_file")
    spread.write.partitionBy("shard").parquet(path)
