"""Token-id files: patched frame-of-reference blocks with an index of their starts.

A file holds the ids of consecutive documents, in order of document id, as blocks of
``BLOCK`` ids. From each id the block's smallest is subtracted; the differences are packed at the
width that holds ``FIT`` of them, and what is above that width goes to an exception list. After
the blocks come the documents (id, token count), the byte at which each block starts, and a
trailer, so any block can be read on its own.

    block    = minimum u32, ids u32, exceptions u32, width u8, packed bits, positions u16, high parts u32
    file     = MAGIC, blocks, document ids i64, their presence u8, token counts i64, block starts u64, trailer
    trailer  = documents u64, blocks u64, ids u64, start of the document table u64, MAGIC

Every writing task attempt uses a file of its own name; the manifest lists those of the attempts
that were committed, so a lost executor leaves at most an unlisted file.

Defined results: a null text counts as empty (its end id alone); null ids come first; rows
that repeat an id follow each other, ordered by the hash of their text; an empty table gives no
documents. Columns other than id and text are ignored; texts are encoded whole.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tradewind.llm.storage import opened, shared_folder, stored
from tradewind.llm.tokens import encoder

MAGIC = b"TWIDS01\n"
BLOCK = 8192  # ids; positions in a block take 16 bits
FIT = 0.95  # share of a block's differences that the packed width holds
HEAD, TRAILER = struct.Struct("<IIIB"), struct.Struct("<QQQQ8s")
BLOCKS_READ = 64  # at once


def pack_block(ids: np.ndarray) -> bytes:
    low = int(ids.min())
    above = (ids - low).astype("<u4")
    needed = np.frexp(above.astype(np.float64))[1]  # the bits of each difference
    fitting = np.cumsum(np.bincount(needed, minlength=33))
    width = int(np.searchsorted(fitting, FIT * len(above)))
    odd = np.flatnonzero(needed > width)
    low_bytes = above.view(np.uint8).reshape(-1, 4)[:, : -(-width // 8)]
    matrix = np.unpackbits(low_bytes, axis=1, count=width, bitorder="little")
    packed = np.packbits(matrix, bitorder="little").tobytes()
    high = (above[odd].astype(np.uint64) >> np.uint64(width)).astype("<u4")
    return HEAD.pack(low, len(ids), len(odd), width) + packed + odd.astype("<u2").tobytes() + high.tobytes()


def unpack_block(data: memoryview) -> np.ndarray:
    low, n, n_odd, width = HEAD.unpack_from(data)
    end = HEAD.size + (n * width + 7) // 8
    matrix = np.zeros((n, 32), np.uint8)
    bits = np.unpackbits(np.frombuffer(data[HEAD.size : end], np.uint8), count=n * width, bitorder="little")
    matrix[:, :width] = bits.reshape(n, width)
    ids = np.packbits(matrix, axis=1, bitorder="little").view("<u4").ravel().astype(np.uint64)
    odd = np.frombuffer(data[end : end + 2 * n_odd], "<u2")
    high = np.frombuffer(data[end + 2 * n_odd : end + 6 * n_odd], "<u4").astype(np.uint64)
    ids[odd] |= high << np.uint64(width)
    return (ids + np.uint64(low)).astype("<u4")


def _write_file(out, documents: Iterator[tuple[int | None, bytes]]) -> tuple[int, int, int]:
    """Documents, ids and bytes written."""
    keys, counts, starts, waiting, size, at = [], [], [], [], 0, len(MAGIC)
    out.write(MAGIC)

    def flush(last: bool) -> None:
        nonlocal waiting, size, at
        ids = np.frombuffer(b"".join(waiting), "<u4")
        stop = len(ids) if last else len(ids) // BLOCK * BLOCK
        for begin in range(0, stop, BLOCK):
            block = pack_block(ids[begin : begin + BLOCK])
            starts.append(at)
            out.write(block)
            at += len(block)
        waiting, size = [ids[stop:].tobytes()], 4 * (len(ids) - stop)

    for key, ids in documents:
        keys.append(key)
        counts.append(len(ids) // 4)
        waiting.append(ids)
        size += len(ids)
        if size >= 4 * BLOCK * BLOCKS_READ:
            flush(last=False)
    flush(last=True)
    table = np.array([0 if k is None else k for k in keys], "<i8").tobytes()
    table += np.array([k is not None for k in keys], np.uint8).tobytes()
    table += np.array(counts, "<i8").tobytes() + np.array(starts, "<u8").tobytes()
    total = sum(counts)
    out.write(table + TRAILER.pack(len(keys), len(starts), total, at, MAGIC))
    return len(keys), total, at + len(table) + TRAILER.size


def read_file(uri: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document id, ids) of one file, in order; a few blocks are in memory at a time."""
    system, path = opened(uri)
    with system.open_input_file(path) as file:
        size = file.size()
        n_docs, n_blocks, _, table_at, magic = TRAILER.unpack(file.read_at(TRAILER.size, size - TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token-id file")
        table = file.read_at(size - TRAILER.size - table_at, table_at)
        keys = np.frombuffer(table, "<i8", n_docs).tolist()
        present = np.frombuffer(table, np.uint8, n_docs, 8 * n_docs)
        counts = np.frombuffer(table, "<i8", n_docs, 9 * n_docs).tolist()
        starts = np.frombuffer(table, "<u8", n_blocks, 17 * n_docs).tolist() + [table_at]
        rest, at = np.empty(0, "<u4"), 0
        for key, known, n in zip(keys, present, counts):
            parts = [rest[:n]]
            got, rest = len(parts[0]), rest[n:]
            while got < n:
                stop = min(at + BLOCKS_READ, n_blocks)
                data = memoryview(file.read_at(starts[stop] - starts[at], starts[at]))
                spans = zip(starts[at:stop], starts[at + 1 : stop + 1])
                rest = np.concatenate([unpack_block(data[a - starts[at] : b - starts[at]]) for a, b in spans])
                at = stop
                parts.append(rest[: n - got])
                got, rest = got + len(parts[-1]), rest[n - got :]
            yield (key if known else None), parts[0] if len(parts) == 1 else np.concatenate(parts)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes the documents into files under ``folder``; returns the stored manifest, a row per file."""
    key = F.col(id_col).cast("long")
    source = docs.select(key.alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("id"), F.xxhash64("text")]
    ordered = source.repartitionByRange(*order).sortWithinPartitions(*order)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, end = TaskContext.get().partitionId(), end_id.to_bytes(4, "little")
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        system, root = opened(folder)
        system.create_dir(root, recursive=True)
        name = f"part-{part:06d}-{uuid.uuid4().hex}.ids"

        def documents() -> Iterator[tuple[int | None, bytes]]:
            batch = first
            while batch is not None:
                texts = batch.column("text").to_pylist()
                yield from ((k, ids + end) for k, ids in zip(batch.column("id").to_pylist(), encoder(tokenizer).encode(texts)))
                batch = next(batches, None)

        with system.open_output_stream(f"{root}/{name}") as out:
            n_docs, n_ids, n_bytes = _write_file(out, documents())
        row = {"part": [part], "file": [f"{folder}/{name}"], "n_docs": [n_docs], "n_ids": [n_ids], "n_bytes": [n_bytes]}
        yield pa.RecordBatch.from_pydict(row)

    schema = "part long, file string, n_docs long, n_ids long, n_bytes long"
    return stored(ordered.mapInArrow(encode, schema), "token-files")


def read(spark: SparkSession, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """id, start (ids before the document in all files), n_tokens, ids_crc32 and, if wanted, ids."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    based = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    files = based.repartition(max(1, manifest.count()))
    names = ["id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                rows, size = [], 0
                for key, ids in read_file(uri):
                    data = ids.tobytes()
                    rows.append((key, start, len(ids), zlib.crc32(data), data)[: len(names)])
                    start += len(ids)
                    size += 64 + len(data) * with_ids
                    if size > 16 << 20:
                        yield _batch(rows, names)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names)

    schema = "id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return files.mapInArrow(decode, schema)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files to the shared folder and reads them back."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-ids")
    return read(spark, write(docs, folder, tokenizer, end_id, id_col, text_col))
