"""Repeated byte strings across documents, by bucket refinement over anchored windows.

Every window of ``LENGTH`` bytes is assigned the smallest-hashed ``GRAM``-byte string inside it (the
leftmost of equals), its anchor. The choice depends on the window's bytes alone, so equal windows
have equal anchors and meet in the bucket of that gram; about one position in 35 is an anchor,
and only those travel. Anchors met once can't carry a repeat and are dropped.

For the rest the windows themselves meet, bucket by bucket. Their buckets start from the
gram at the window's start and are refined by sorting on the identifiers of the grams at later
offsets of the window, until they cover it whole; each refinement reuses the identifiers of
the one before, and windows left alone in a bucket drop out. Within a final bucket every
window but the first in document order is a repeat, and all its bytes are covered.

Identifiers of grams are 64-bit rolling hashes: different windows would have to agree in all
identifiers to be taken as equal.

Later copies of whole texts are told by their hash alone and bring no anchors, in groups of more than one row in
``COPIED``; the copies of smaller groups meet like other repeats. Of an anchor met more than ``CROWD`` times, rows with the
same bytes around the gram meet first, by grouping alone: all but the first of them are covered, and only the first goes on. If still
more than ``CROWD`` differ, they are refined before their windows meet: they fall into parts by how far before the gram they begin, and a part's new bucket is the gram with all bytes that the part's windows have in
common around it. Buckets that stay too large are parted again, until a part is one window and its
bucket holds equal windows only. Those, if still more than ``CROWD``, are dealt over several tasks by document;
each task leaves its first window, and these meet across tasks. A task streams over its buckets and carries of
a long bucket only rows with first windows.

Defined results: a null text counts as empty; a null id stands after all other ids; rows that
share an id are ordered by a hash of their text, with which their anchors and spans stay apart, and rows that repeat id and text are one
document in two copies with equal results; texts shorter than a window lose nothing; texts of
any length are read whole, in stretches; an empty table gives an empty result. Columns other
than id and text are passed on untouched where whole rows are returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.llm.storage import stored

LENGTH = 100
GRAM = 32
CROWD = 20_000  # rows of one bucket in a task; each takes some kilobytes while it is settled
PARTS = 4  # a refinement of a large bucket
COPIED = 100_000  # texts, of 40 bytes each, whose copies are known in every task
SPAN = LENGTH - GRAM + 1  # grams in a window
STRETCH = 1 << 18  # bytes worked on at once while anchors are sought
WINDOWS = 2_000_000  # refined at once
FACTOR = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Rolling hash of the GRAM bytes at each position, by doubling; GRAM is a power of two."""
    hashes, factor, width = data.astype(np.uint64) + np.uint64(1), np.array([FACTOR]), 1
    while width < GRAM:
        hashes = hashes[:-width] * factor + hashes[width:]
        factor, width = factor * factor, 2 * width
    hashes ^= hashes >> np.uint64(32)
    hashes *= MIX
    return hashes | np.uint64(1)


def _slide(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The best of each ``width`` neighbours, by doubling."""
    reach = 1
    while 2 * reach <= width:
        values = best(values[:-reach], values[reach:])
        reach *= 2
    return best(values[: len(values) - (width - reach)], values[width - reach :]) if reach < width else values


def anchors(data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, place, first window, last window) of each anchor; ``valid`` says which windows exist.

    Next to windows that don't exist the range may run over some of them.
    """
    hashes = gram_hashes(data)
    least = np.where(valid, _slide(hashes, SPAN, np.minimum), np.uint64(0))
    nothing = np.zeros(SPAN - 1, np.uint64)
    chosen = np.flatnonzero(hashes == _slide(np.concatenate([nothing, least, nothing]), SPAN, np.maximum))
    value = hashes[chosen]
    first, last = chosen - SPAN + 1, chosen.copy()
    # A smaller gram to the left, or an equal one, takes the windows it lies in; to the right only a smaller one.
    for back, wins in ((True, np.less_equal), (False, np.less)):
        shift, open_ = 1, np.arange(len(chosen))
        while len(open_):
            other = open_ - shift if back else open_ + shift
            inside = (other >= 0) & (other < len(chosen))
            open_, other = open_[inside], other[inside]
            near = np.abs(chosen[other] - chosen[open_]) < SPAN
            open_, other = open_[near], other[near]
            beaten = wins(value[other], value[open_])
            if back:
                first[open_[beaten]] = chosen[other[beaten]] + 1
            else:
                last[open_[beaten]] = chosen[other[beaten]] - SPAN
            open_ = open_[~beaten]
            shift += 1
    return value, chosen, first, last


def _stretches(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Texts side by side, or parts of long ones: bytes, valid windows; each part's text, place, length and begin."""
    parts, size = [], 0
    for i, text in enumerate(texts):
        for begin in range(0, len(text) - LENGTH + 1, STRETCH):
            part = text[begin : begin + STRETCH + LENGTH - 1]
            parts.append((i, begin, part))
            size += len(part)
            if size >= STRETCH:
                yield _side_by_side(parts)
                parts, size = [], 0
    if parts:
        yield _side_by_side(parts)


def _side_by_side(parts: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    lengths = np.array([len(p) for _, _, p in parts])
    places = np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
    # Windows that would run over the end of their part don't exist.
    missing = np.zeros(len(data) + 1, np.int32)
    missing[places + lengths - LENGTH + 1] += 1
    missing[places + lengths] -= 1
    valid = np.cumsum(missing)[: len(data) - LENGTH + 1] == 0
    return data, valid, np.array([i for i, _, _ in parts]), places, lengths, np.array([b for _, b, _ in parts])


def _anchor_rows(docs: DataFrame) -> DataFrame:
    """(gram, id, twin, spot): spot is the first window the anchor stands for, how far behind it the gram is, and how many follow it."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, twins = batch.column("id").to_numpy(), batch.column("twin").to_numpy()
            texts = batch.column("text").to_pylist()
            for data, valid, index, places, lengths, begins in _stretches(texts):
                gram, chosen, first, last = anchors(data, valid)
                part = np.searchsorted(places, chosen, side="right") - 1
                first = np.maximum(first, places[part])
                last = np.minimum(last, places[part] + lengths[part] - LENGTH)
                some = first <= last
                part, first, last = part[some], first[some], last[some]
                spot = ((first - places[part] + begins[part]) << 14) | ((chosen[some] - first) << 7) | (last - first)
                columns = [gram[some].view(np.int64), ids[index[part]], twins[index[part]], spot]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["gram", "id", "twin", "spot"])

    return docs.select("id", "twin", "text").mapInArrow(find, "gram long, id long, twin long, spot long")


def _contexts(docs: DataFrame, met: DataFrame) -> DataFrame:
    """The bytes of all windows of each anchor in ``met`` (gram, id, twin, spot), and where in them the gram is."""
    spots = met.groupBy("id", "twin").agg(F.collect_set(F.struct("gram", "spot")).alias("spots"))
    schema = "gram long, id long, twin long, begin long, at long, bytes binary"

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text, found = batch.column("text")[i].as_py(), batch.column("spots")[i].values
                gram, spot = (found.field(f).to_numpy() for f in ("gram", "spot"))
                begin, at = spot >> 14, spot >> 7 & 127
                stop = begin + (spot & 127) + LENGTH
                ours = np.flatnonzero(stop <= len(text))  # others are of a text with an equal hash
                id_, twin = batch.column("id")[i].as_py(), batch.column("twin")[i].as_py()
                pieces = [text[a:b] for a, b in zip(begin[ours].tolist(), stop[ours].tolist())]
                columns = [gram[ours], np.full(len(ours), id_), np.full(len(ours), twin), begin[ours], at[ours]]
                arrays = [*map(pa.array, columns), pa.array(pieces, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["gram", "id", "twin", "begin", "at", "bytes"])

    joined = docs.join(spots, ["id", "twin"]).select("id", "twin", "text", "spots")
    return joined.mapInArrow(gather, schema)


def _parted(contexts: DataFrame, width: int) -> DataFrame:
    """Contexts (with low) whose windows begin low to low + width - 1 bytes before the gram, in narrower parts with their buckets."""
    step = -(-width // PARTS)
    schema = "gram long, low long, id long, twin long, begin long, at long, bytes binary"

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("gram", "low", "id", "twin", "begin", "at", "bytes"))):
                gram, low, id_, twin, begin, at, data = row
                for least in range(low, low + width, step):
                    most = min(least + step, low + width) - 1
                    first, last = max(0, at - most), min(len(data) - LENGTH, at - least)
                    if first <= last:
                        common = data[at - least : at - most + LENGTH]
                        bucket = xxhash.xxh64_intdigest(common, (gram + least) & (1 << 64) - 1)
                        bucket -= (bucket >> 63) << 64
                        rows.append((bucket, least, id_, twin, begin + first, at - first, data[first : last + LENGTH]))
            if rows:
                types = [pa.int64()] * 6 + [pa.binary()]
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(arrays, names=["gram", "low", "id", "twin", "begin", "at", "bytes"])

    return contexts.mapInArrow(part, schema)


def _first_contexts(contexts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first of the contexts that have a gram and all bytes around it in common, and (id, twin, begin, end) of the others."""
    first = F.min(F.struct("id", "twin", "begin")).alias("first")
    firsts = stored(contexts.groupBy("gram", "at", "bytes").agg(first).select("gram", "first.*", "at", "bytes"), "first-contexts")
    key = ["gram", "id", "twin", "begin", "at"]
    end = (F.col("begin") + F.octet_length("bytes")).alias("end")
    marked = [df.select(*key, end, F.lit(is_first).alias("first")) for df, is_first in ((contexts, False), (firsts, True))]
    others = marked[0].unionByName(marked[1]).groupBy(*key, "end").agg(F.bool_or("first").alias("first")).filter(~F.col("first"))
    return firsts, others.select("id", "twin", "begin", "end")


def _uncrowded(crowded: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """Contexts in buckets of at most CROWD rows; those of equal windows that are more, with their number n."""
    columns = ["gram", "id", "twin", "begin", "at", "bytes"]
    small, width, left = [], SPAN, crowded.withColumn("low", F.lit(0).cast("long"))
    while width > 1:
        parts = stored(_parted(left, width), "crowd")
        width = -(-width // PARTS)
        sizes = parts.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1")
        sized = parts.join(stored(sizes, "crowd-sizes"), "gram")
        small.append(sized.filter(F.col("n") <= CROWD).select(*columns))
        left = sized.filter(F.col("n") > CROWD)
        if sizes.filter(F.col("n") > CROWD).isEmpty():
            return small, None
    return small, left.select(*columns, "n")


def refine(hashes: np.ndarray, windows: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of equal windows: (windows' indices, bucket by bucket; where buckets begin). Lone windows are left out.

    ``hashes`` are those of the grams at each byte, ``windows`` the bytes where windows begin. Windows of
    different shares stay apart.
    """
    live, bucket = np.arange(len(windows)), share.astype(np.uint64) * FACTOR
    starts = np.empty(0, np.int64)
    for later in (*range(0, LENGTH - GRAM, GRAM), LENGTH - GRAM):
        key = (bucket * FACTOR ^ hashes[windows[live] + later]) * MIX
        order = np.argsort(key)
        key = key[order]
        fresh = np.r_[True, key[1:] != key[:-1]][: len(key)]
        rank = np.cumsum(fresh) - 1
        kept = (np.bincount(rank)[rank] > 1) if len(rank) else np.empty(0, bool)
        live, fresh = live[order][kept], fresh[kept]
        starts = np.flatnonzero(fresh)
        # The bucket's number takes part in the next round, spread over 64 bits.
        bucket = np.cumsum(fresh).astype(np.uint64) * FACTOR
        bucket ^= bucket >> np.uint64(29)
    return live, starts


def _settle(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each window, its begin in the row, whether it repeats an earlier one); rows are in document order."""
    data = rows["bytes"].tolist()
    sizes = np.array([len(b) for b in data])
    counts = sizes - LENGTH + 1
    row = np.repeat(np.arange(len(rows)), counts)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    windows = offset + np.repeat(np.cumsum(sizes) - sizes, counts)
    hashes = gram_hashes(np.frombuffer(b"".join(data), np.uint8))
    live, starts = refine(hashes, windows, rows["share"].to_numpy()[row])
    repeats = np.zeros(len(row), bool)
    if len(live):
        first = np.repeat(np.minimum.reduceat(live, starts), np.diff(np.r_[starts, len(live)]))
        ids, twins, begins = (rows[c].to_numpy() for c in ("id", "twin", "begin"))
        a, b = row[live], row[first]
        itself = (ids[a] == ids[b]) & (twins[a] == twins[b]) & (begins[a] + offset[live] == begins[b] + offset[first])
        repeats[live] = ~itself
    return row, offset, repeats


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pd.DataFrame, bool]]:
    """Rows in order of bucket, in bounded portions; whether the last bucket goes on in the next."""
    waiting: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch.to_pandas())
        size += batch.nbytes
        if size >= 2 * WINDOWS:
            rows = pd.concat(waiting, ignore_index=True)
            last = (rows["gram"] == rows["gram"].iloc[-1]) & (rows["share"] == rows["share"].iloc[-1])
            if last.all():
                yield rows, True
                waiting, size = [], 0
            else:
                yield rows[~last].reset_index(drop=True), False
                waiting, size = [rows[last]], 0
    if waiting:
        yield pd.concat(waiting, ignore_index=True), False


def _repeats(contexts: DataFrame, survivors: bool) -> DataFrame:
    """(id, twin, begin, end) of covered bytes.

    With ``survivors`` also (gram, begin, bytes) of the rows with first windows among those that are dealt over shares.
    """
    order = ["gram", "share", "id", "twin", "begin"]
    dealt = contexts.repartition("gram", "share").sortWithinPartitions(*order)
    names = ["id", "twin", "begin", "end"] + ["gram", "bytes"] * survivors
    schema = "id long, twin long, begin long, end long" + ", gram long, bytes binary" * survivors

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: pd.DataFrame | None = None
        for rows, goes_on in _chunks(batches):
            old = 0
            if carried is not None:
                same = (carried["gram"].iloc[0] == rows["gram"].iloc[0]) and (carried["share"].iloc[0] == rows["share"].iloc[0])
                if same:
                    old = len(carried)
                    rows = pd.concat([carried, rows], ignore_index=True)
                carried = None
            row, offset, repeats = _settle(rows)
            firsts = np.zeros(len(rows), bool)
            firsts[row[~repeats]] = True
            if goes_on:
                carried = rows[firsts].reset_index(drop=True)
            ids, twins, begins = (rows[c].to_numpy() for c in ("id", "twin", "begin"))
            at = np.flatnonzero(repeats & (row >= old))
            cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(row[at]) != 0))
            run, end = at[np.r_[0, cut + 1]] if len(at) else at, at[np.r_[cut, len(at) - 1]] if len(at) else at
            of = row[run]
            columns = [ids[of], twins[of], begins[of] + offset[run], begins[of] + offset[end] + LENGTH]
            arrays = [pa.array(c, pa.int64()) for c in columns]
            if survivors:
                arrays += [pa.nulls(len(of), pa.int64()), pa.nulls(len(of), pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
            if survivors:
                left = rows[firsts & (np.arange(len(rows)) >= old) & (rows["share"].to_numpy() > 0)]
                columns = [left["id"], left["twin"], left["begin"], left["begin"], left["gram"]]
                arrays = [*(pa.array(c.to_numpy(), pa.int64()) for c in columns), pa.array(left["bytes"], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return dealt.mapInArrow(settle, schema)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, twin (tells texts of one id apart) and the text's bytes."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(*_identity(id_col, text_col), text.alias("text"))


def _once(source: DataFrame) -> DataFrame:
    """One row of those that repeat id and text."""
    repeated = stored(source.groupBy("id", "twin").agg(F.count("*").alias("c")).filter("c > 1").select("id", "twin"), "repeated-rows")
    if repeated.isEmpty():
        return source
    first = source.join(repeated, ["id", "twin"]).groupBy("id", "twin").agg(F.first("text").alias("text"))
    return stored(source.join(repeated, ["id", "twin"], "left_anti").unionByName(first), "single-rows")


def _identity(id_col: str, text_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)).alias("id"), F.xxhash64(text).alias("twin")]


def _copied(source: DataFrame) -> DataFrame:
    """Texts with very many copies, as (c_twin, c_digest, c_first), the smallest id: at most ``COPIED`` of them."""
    sized = source.filter(F.octet_length("text") >= LENGTH).select("twin", F.md5("text").alias("digest"), "id")
    groups = stored(sized.groupBy("twin", "digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1"), "copies")
    rows = groups.agg(F.sum("n")).first()[0] or 0
    # Of groups with more than rows / COPIED rows there can't be more than COPIED; others need no special care.
    some = groups.filter(F.col("n") > rows // COPIED)
    return some.select(F.col("twin").alias("c_twin"), F.col("digest").alias("c_digest"), F.col("first").alias("c_first"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, twin, spans): every covered stretch of bytes of a text, as (begin, end), unmerged."""
    every = _once(_source(docs, id_col, text_col))
    copied = F.broadcast(_copied(every))
    # A later copy of a whole text is covered from end to end, and what it covers elsewhere its first copy covers as well.
    later = (F.col("twin") == F.col("c_twin")) & (F.md5("text") == F.col("c_digest")) & (F.col("id") > F.col("c_first"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.octet_length("text").cast("long").alias("end")))
    copies = every.join(copied, later).select("id", "twin", whole.alias("spans"))
    return _partly_repeated(every.join(copied, later, "left_anti")).unionByName(copies)


def _partly_repeated(source: DataFrame) -> DataFrame:
    """The spans of texts none of which has very many copies."""
    # Counted apart and joined, so that no task has to take all rows of a gram. Anchors are sought twice rather than stored.
    grams = stored(_anchor_rows(source).groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1"), "grams")
    met = stored(_anchor_rows(source).join(grams, "gram"), "anchors")
    buckets, alike, large = [_contexts(source, met.filter(F.col("n") <= CROWD))], None, None
    if not grams.filter(F.col("n") > CROWD).isEmpty():
        firsts, alike = _first_contexts(stored(_contexts(source, met.filter(F.col("n") > CROWD)), "crowd-contexts"))
        sizes = stored(firsts.groupBy("gram").agg(F.count("*").alias("n")), "crowd-contexts-sizes")
        sized = firsts.join(sizes, "gram")
        buckets.append(sized.filter(F.col("n") <= CROWD).drop("n"))
        if not sizes.filter(F.col("n") > CROWD).isEmpty():
            small, large = _uncrowded(sized.filter(F.col("n") > CROWD).drop("n"))
            buckets += small
    columns, share = ["gram", "share", "id", "twin", "begin", "bytes"], F.lit(0).cast("long")
    spans = _repeats(reduce(DataFrame.unionByName, buckets).withColumn("share", share).select(*columns), survivors=False)
    if alike is not None:
        spans = spans.unionByName(alike)
    if large is not None:
        dealt = large.withColumn("share", 1 + F.pmod(F.xxhash64("id", "twin", "begin"), F.expr(f"n div {CROWD} + 1")))
        shares = stored(_repeats(dealt.select(*columns), survivors=True), "crowded")
        firsts = shares.filter("bytes is not null").withColumn("share", share)
        across = _repeats(firsts.select(*columns), survivors=False)
        spans = spans.unionByName(shares.filter("bytes is null").select(*across.columns)).unionByName(across)
    return spans.groupBy("id", "twin").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))


def merged(spans: pa.Scalar) -> list[tuple[int, int]]:
    """The maximal covered runs of one text, in order."""
    if not spans.is_valid:
        return []
    begin, end = (spans.values.field(f).to_numpy() for f in ("begin", "end"))
    if not len(begin):
        return []
    order = np.argsort(begin)
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    fresh = np.r_[True, begin[1:] > reach[:-1]]
    return list(zip(begin[fresh].tolist(), reach[np.r_[np.flatnonzero(fresh)[1:] - 1, len(reach) - 1]].tolist()))


def _kept(text: bytes, runs: list[tuple[int, int]]) -> Iterator[bytes]:
    at = 0
    for begin, end in runs:
        yield text[at:begin]
        at = end
    yield text[at:]


def removal_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans and kept_sha256 (of the bytes that are left) of every row."""
    spans = repeated_spans(docs, id_col, text_col)
    joined = _source(docs, id_col, text_col).join(spans, ["id", "twin"], "left").select("id", "text", "spans")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for id_, text, spans in zip(*(batch.column(c) for c in ("id", "text", "spans"))):
                text, runs, left = text.as_py(), merged(spans), hashlib.sha256()
                for part in _kept(text, runs):
                    left.update(part)
                rows.append((id_.as_py(), len(text), sum(b - a for a, b in runs), len(runs), left.hexdigest()))
            columns = [pa.array(c) for c in zip(*rows)] if rows else []
            if rows:
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = joined.mapInArrow(measure, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return found.withColumn("id", F.when(F.col("id") != 2**63 - 1, F.col("id")))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with the covered bytes cut out of their text; a character that a cut would split stays."""
    spans = repeated_spans(docs, id_col, text_col).withColumnsRenamed({"id": "_tw_id", "twin": "_tw_twin", "spans": "_tw_spans"})
    id_, twin = _identity(id_col, text_col)
    marked = docs.withColumns({"_tw_id": id_, "_tw_twin": twin}).join(spans, ["_tw_id", "_tw_twin"], "left")

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_cut(*row) for row in zip(text, spans)], dtype=object)

    shorter = F.when(F.col("_tw_spans").isNull(), F.col(text_col)).otherwise(cut(text_col, "_tw_spans"))
    return marked.withColumn(text_col, shorter).select(*docs.columns)


def _cut(text: str | None, spans: np.ndarray | None) -> str | None:
    if text is None or spans is None or not len(spans):
        return text
    data = text.encode()
    listed = pa.scalar(list(spans), pa.list_(pa.struct({"begin": pa.int64(), "end": pa.int64()})))
    inner = [(_forward(data, a), _back(data, b)) for a, b in merged(listed)]
    return b"".join(_kept(data, [(a, b) for a, b in inner if a < b])).decode()


def _forward(data: bytes, at: int) -> int:
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at += 1
    return at


def _back(data: bytes, at: int) -> int:
    while at < len(data) and at > 0 and data[at] & 0xC0 == 0x80:
        at -= 1
    return at
