"""Near duplicates by SimHash fingerprints and pigeonhole blocks.

A fingerprint's 64 bits fall into blocks. Two fingerprints that differ in at most ``distance``
bits agree in at least blocks - distance whole blocks, so every choice of that many blocks is
a key to meet under: 20 keys of about 32 bits with 6 blocks and 3 bits. Keys that long keep
chance meetings rare at any corpus size. Only distinct fingerprints enter, each with the
smallest id that carries it.

Within a key, members are compared by Hamming distance while they are at most ``compared``, and
only the links of a spanning forest leave the task; a member that is linked up is not compared
again, so a tight group costs little more than its size. Keys with more members are linked
exactly, without comparing pairs: two members within the distance become equal when half of
the bits (rounded up) are flipped in the one and the other half in the other; only bits outside
the key's blocks can differ. The members that flip into the same value by the smaller half lie within
the distance of all others there, so each value's first such member is linked to the rest,
and nothing is missed.

Defined results: a null text counts as empty; texts without words have fingerprint zero and link
like others; rows with a null id get a fingerprint and the component of the ids that share it (null if
none does), and link nothing; rows that repeat an id and text get the same result;
texts of any length are read whole; an empty table gives an empty result. Columns other than
id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tradewind.llm.components import connected_components
from tradewind.operators.scratch import materialize

DISTANCE, BLOCKS = 3, 6
COMPARED = 20_000
SEED = 42
SHINGLES_AT_ONCE = 200_000


def key_masks(distance: int, blocks: int) -> list[int]:
    """The bits of every choice of blocks - distance blocks; blocks are as even as 64 bits allow, low bits first."""
    sizes = [64 // blocks + (i < 64 % blocks) for i in range(blocks)]
    masks = [((1 << size) - 1) << sum(sizes[:i]) for i, size in enumerate(sizes)]
    return [sum(chosen) for chosen in combinations(masks, blocks - distance)]


def _shingle_hashes(words: list[bytes], width: int) -> Iterator[np.ndarray]:
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        if words:
            yield np.array([digest(b" ".join(words), SEED)], np.uint64)
        return
    n = len(words) - width + 1
    for begin in range(0, n, SHINGLES_AT_ONCE):
        end = min(begin + SHINGLES_AT_ONCE, n)
        columns = [words[begin + i : end + i] for i in range(width)]
        yield np.fromiter((digest(b" ".join(s), SEED) for s in zip(*columns)), np.uint64, end - begin)


def _ones(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How often each bit is set from each start up to the next, as (starts, 64)."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int32)


def fingerprints_of(texts: list[bytes], width: int = 3) -> np.ndarray:
    """64-bit SimHash of each text; A-Z in lower case, words are runs without ASCII white space."""
    result = np.zeros(len(texts), np.uint64)
    waiting: list[tuple[int, np.ndarray]] = []
    size = 0

    def majority(ones: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view("<u8").ravel()

    def settle() -> None:
        nonlocal waiting, size
        if waiting:
            n = np.array([len(h) for _, h in waiting])
            ones = _ones(np.concatenate([h for _, h in waiting]), np.cumsum(n) - n)
            result[[i for i, _ in waiting]] = majority(ones, n)
        waiting, size = [], 0

    for i, text in enumerate(texts):
        words = text.lower().split()  # of bytes: ASCII only, both
        if len(words) > SHINGLES_AT_ONCE:
            ones, n = np.zeros(64, np.int64), 0
            for hashes in _shingle_hashes(words, width):
                ones, n = ones + _ones(hashes, np.array([0]))[0], n + len(hashes)
            result[i] = majority(ones[None], np.array([n]))[0]
            continue
        for hashes in _shingle_hashes(words, width):
            waiting.append((i, hashes))
            size += len(hashes)
        if size > SHINGLES_AT_ONCE:
            settle()
    settle()
    return result


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """Stored (id, fp): fp is the fingerprint's 64 bits as a long."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    source = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = fingerprints_of(batch.column("text").to_pylist(), width).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps)], names=["id", "fp"])

    return materialize(source.mapInArrow(compute, "id long, fp long"), "fingerprints")


def _forest(fps: np.ndarray, ids: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the members within ``distance`` bits of each other."""
    left, links = np.arange(len(fps)), []
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(fps[left] ^ fps[at]) <= distance
            found, left = left[near].tolist(), left[~near]
            links += [(int(ids[at]), int(ids[x])) for x in found]
            queue += found
    return links


def _flips(free: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Flip masks of up to half the distance, rounded up, in the ``free`` bits; whether each is in the smaller half."""
    bits = [1 << b for b in range(64) if free >> b & 1]
    masks = [[sum(c) for c in combinations(bits, n)] for n in range((distance + 1) // 2 + 1)]
    few = [n <= distance // 2 for n, some in enumerate(masks) for _ in some]
    return np.array([m for some in masks for m in some], np.uint64), np.array(few)


def links(distinct: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, compared: int = COMPARED) -> DataFrame:
    """Links (u, v) between ids that connect all fingerprints within the distance. ``distinct``: (fp, id)."""
    masks = key_masks(distance, blocks)
    keys = F.array(
        *[
            F.struct(F.lit(t).cast("smallint").alias("t"), F.expr(f"fp & {np.uint64(m).view(np.int64)}L").alias("key"))
            for t, m in enumerate(masks)
        ]
    )
    keyed = distinct.select("fp", "id", F.explode(keys).alias("k")).select("k.t", "k.key", "fp", "id")
    # Only keys that several fingerprints share go on.
    shared = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    met = materialize(keyed.join(shared, ["t", "key"]), "simhash-keys")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of key; a key's members may span batches, never more than ``compared``."""
        left = None
        for batch in batches:
            now = batch.to_pandas()
            now = now if left is None else pd.concat([left, now], ignore_index=True)
            if not len(now):
                continue
            last = (now["t"] == now["t"].iloc[-1]) & (now["key"] == now["key"].iloc[-1])
            left = now[last]
            yield link_up(now[~last])
        if left is not None:
            yield link_up(left)

    def link_up(rows: pd.DataFrame) -> pa.RecordBatch:
        found: list[tuple[int, int]] = []
        t, key = rows["t"].to_numpy(), rows["key"].to_numpy()
        fps, ids = rows["fp"].to_numpy().view(np.uint64), rows["id"].to_numpy()
        starts = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (key[1:] != key[:-1])]) if len(rows) else []
        for a, b in zip(starts, [*starts[1:], len(rows)]):
            found += _forest(fps[a:b], ids[a:b], distance)
        u, v = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    def flip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            ts, ids = batch.column("t").to_numpy(), batch.column("id").to_numpy()
            fps = batch.column("fp").to_numpy().view(np.uint64)
            for t, fp, i in zip(ts.tolist(), fps, ids):
                if t not in flips:
                    flips[t] = _flips(~masks[t] & (1 << 64) - 1, distance)
                values, few = flips[t]
                columns = [
                    pa.array(np.full(len(values), t, np.int16)),
                    pa.array((values ^ fp).view(np.int64)),
                    pa.array(np.full(len(values), i)),
                    pa.array(few),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["t", "value", "id", "few"])

    ordered = met.filter(F.col("n") <= compared).repartition("t", "key").sortWithinPartitions("t", "key", "fp")
    small = ordered.select("t", "key", "fp", "id").mapInArrow(compare, "u long, v long")
    crowded = met.filter(F.col("n") > compared)
    flipped = crowded.select("t", "fp", "id").mapInArrow(flip, "t smallint, value long, id long, few boolean")
    # A value has few members: all differ from it in at most half the distance.
    centred = flipped.groupBy("t", "value").agg(
        F.min(F.when(F.col("few"), F.col("id"))).alias("u"), F.collect_set("id").alias("members")
    )
    large = centred.filter("u is not null and size(members) > 1").select("u", F.explode("members").alias("v"))
    return small.unionByName(large.filter("u <> v"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 3,
    distance: int = DISTANCE,
    blocks: int = BLOCKS,
    compared: int = COMPARED,
) -> DataFrame:
    """id, fp and component_id, the smallest id that can be reached over links, for every row."""
    found = fingerprints(docs, id_col, text_col, width)
    distinct = materialize(found.groupBy("fp").agg(F.min("id").alias("id")), "distinct-fingerprints")
    roots = connected_components(links(distinct.filter("id is not null"), distance, blocks, compared))
    named = distinct.join(roots.withColumnRenamed("node", "id"), "id", "left")
    component = F.coalesce("root", "id").alias("component_id")
    classes = named.select("fp", component)
    return found.join(classes, "fp", "left").select("id", "fp", "component_id")


def representatives(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 3,
    distance: int = DISTANCE,
    blocks: int = BLOCKS,
) -> DataFrame:
    """The rows of the smallest id of each component, and those without an id, with all their columns.

    Of rows that repeat the id with different texts, only those with the component's own fingerprint stay.
    """
    found = near_duplicates(docs, id_col, text_col, width, distance, blocks)
    gone = found.filter("id <> component_id").select(F.col("id").alias("_tw_id")).distinct()
    kept = found.filter("id = component_id").select(F.col("id").alias("_tw_id")).distinct()
    both = gone.join(kept, "_tw_id")
    same = docs[id_col].cast("long") == gone["_tw_id"]
    return docs.join(gone, same, "left_anti") if both.isEmpty() else _by_text(docs, id_col, text_col, width, found)


def _by_text(docs: DataFrame, id_col: str, text_col: str, width: int, found: DataFrame) -> DataFrame:
    """As above where an id has texts of several components: rows are told apart by their fingerprints too."""
    marked = docs.withColumn("_tw_text", F.coalesce(F.col(text_col), F.lit("")).cast("binary"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = fingerprints_of(batch.column("_tw_text").to_pylist(), width).view(np.int64)
            yield batch.drop_columns(["_tw_text"]).append_column("_tw_fp", pa.array(fps))

    schema = T.StructType([*docs.schema.fields, T.StructField("_tw_fp", T.LongType())])
    gone = found.filter("id <> component_id").select(F.col("id").alias("_tw_id"), F.col("fp").alias("_tw_other")).distinct()
    rows = marked.mapInArrow(mark, schema)
    same = (rows[id_col].cast("long") == gone["_tw_id"]) & (rows["_tw_fp"] == gone["_tw_other"])
    return rows.join(gone, same, "left_anti").select(*docs.columns)
