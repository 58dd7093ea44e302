"""Packing: concatenate the token ids of all documents and cut them into sequences.

Pass one encodes every text once, stores the ids and, with them, each document's offset in its
partition. The partitions' totals, summed up in order, turn these into offsets in the one
long stream. Pass two cuts the stream at every multiple of the sequence length: a document
that crosses a cut yields one boundary record per sequence it touches. Only the last sequence
can be short, so padding is less than one sequence in all.

Defined results: a null text counts as empty and is its end id alone; rows that repeat an id
are packed as documents of their own; null ids are kept; an empty table has no sequences; a
text of any length is encoded whole. Columns other than id and text are ignored. The order of
the documents is that of the input's partitions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tradewind.llm.storage import stored
from tradewind.llm.tokens import encoder

BATCH_BYTES = 32 << 20  # ids in one Arrow batch
BROADCAST_PARTS = 500_000  # partition offsets, 16 bytes each


def narrow_ids(data: bytes, dtype: str) -> bytes:
    return data if dtype == "<u4" else np.frombuffer(data, "<u4").astype(dtype).tobytes()


def tokenised(
    docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Stored rows (part, place, id, n_tokens, local_start, ids): ids in two bytes where the vocabulary allows."""
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = source.schema["id"].dataType
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("id", id_type),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("local_start", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, end = TaskContext.get().partitionId(), 0, end_id.to_bytes(4, "little")
        for batch in batches:
            keys, encoded = batch.column("id"), encoder(tokenizer).encode(batch.column("text").to_pylist())
            counts, data, size, begin = [], [], 0, 0
            for place, ids in enumerate(encoded):
                counts.append(len(ids) // 4 + 1)
                data.append(narrow_ids(ids + end, dtype))
                size += len(data[-1])
                if size > BATCH_BYTES or place == batch.num_rows - 1:
                    offsets = start + np.cumsum([0, *counts])
                    columns = [
                        pa.array([part] * len(data), pa.int32()),
                        keys.slice(begin, len(data)),
                        pa.array(counts, pa.int64()),
                        pa.array(offsets[:-1], pa.int64()),
                        pa.array(data, pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["part", "id", "n_tokens", "local_start", "ids"])
                    start, begin = int(offsets[-1]), place + 1
                    counts, data, size = [], [], 0

    return stored(source.mapInArrow(encode, schema), "token-ids")


def with_offsets(parts: DataFrame) -> DataFrame:
    """Adds ``start``, the ids before the document: its partition's offset and its own."""
    totals = parts.groupBy("part").agg(F.max(F.col("local_start") + F.col("n_tokens")).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    if totals.count() <= BROADCAST_PARTS:
        bases = F.broadcast(bases)
    return parts.join(bases, "part").withColumn("start", F.col("base") + F.col("local_start")).drop("base")


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    length: int = 2048,
    vocabulary: int = 1 << 16,
    with_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The boundary records: one row per document and sequence it lies in.

    id, start (in the document), length, ids_crc32, doc_tokens, sequence_id, offset (in the
    sequence) and, if wanted, ids.
    """
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    placed = with_offsets(tokenised(docs, tokenizer, end_id, vocabulary, id_col, text_col))
    placed = placed.select("id", "n_tokens", "start", "ids")
    longs = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = T.StructType([T.StructField("id", placed.schema["id"].dataType)])
    for name in longs:
        schema.add(name, T.LongType())
    if with_ids:
        schema.add("ids", T.BinaryType())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            takes, rows, pieces = [], [], []
            starts, counts, data = (batch.column(c) for c in ("start", "n_tokens", "ids"))
            for i in range(batch.num_rows):
                first, n = starts[i].as_py(), counts[i].as_py()
                ids = np.frombuffer(data[i].as_buffer(), dtype).astype("<u4").tobytes()
                at = 0
                while at < n:
                    sequence, offset = divmod(first + at, length)
                    size = min(length - offset, n - at)
                    piece = ids[4 * at : 4 * (at + size)]
                    takes.append(i)
                    rows.append((at, size, zlib.crc32(piece), n, sequence, offset))
                    if with_ids:
                        pieces.append(piece)
                    at += size
            columns = [batch.column("id").take(pa.array(takes, pa.int64()))]
            columns += [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * len(longs))]
            if with_ids:
                columns.append(pa.array(pieces, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return placed.mapInArrow(cut, schema)


def sequences(pieces: DataFrame, length: int = 2048, pad_id: int = 0) -> DataFrame:
    """One row per sequence: ids (little-endian 32-bit, padded), n_tokens and its documents in order.

    A sequence is padded to ``length`` unless its own length is a power of two. A group holds
    at most ``length`` ids.
    """
    piece = F.struct("offset", "id", "start", "length", "ids")
    grouped = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    n = F.aggregate("pieces", F.lit(0).cast("bigint"), lambda total, p: total + p["length"])
    filled = grouped.withColumn("n_tokens", n)
    is_power = F.expr("n_tokens & (n_tokens - 1)") == 0
    missing = F.when(is_power, 0).otherwise(F.greatest(F.lit(length) - F.col("n_tokens"), F.lit(0)))
    joined = F.aggregate("pieces", F.lit(b""), lambda data, p: F.concat(data, p["ids"]))
    padding = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), missing.cast("int")))
    documents = F.transform("pieces", lambda p: p.dropFields("ids"))
    return filled.select("sequence_id", "n_tokens", F.concat(joined, padding).alias("ids"), documents.alias("documents"))
