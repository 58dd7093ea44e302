"""SentencePiece encoding and decoding of the documents, partition by partition.

Texts fall into units: a word with the blanks before it, a run of blanks at the end of a line, or a line
break. No piece reaches over the border of a unit. The distinct units of some megabytes of text are encoded
together: all their substrings that are pieces are the edges of their lattices, found by walking a trie of
the pieces from every character at once, and a fold over the edges gives the parts of each unit.

Which fold depends on the model. For a unigram model it is Viterbi: the best score of each end
is extended from the best scores of the begins. The ids of a BPE model are not those of the best
path; there the fold repeatedly merges the best-scored edge that spans exactly two current parts
(the leftmost of equals). Characters that are no piece become their bytes.

A unit is encoded anew in each stretch of text it occurs in. To encode it once, stretches and their units
would have to be shuffled and joined; so nothing is shuffled or stored, and the tables of the model are broadcast.

Defined results: a null or empty text has no pieces; repeated ids are encoded each; null ids are
kept; an empty table gives an empty result; texts and units of any length are encoded whole;
bytes that are no UTF-8 count as U+FFFD. Columns other than id and text are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T

BLANK = "▁"
STRETCH_BYTES = 16 << 20  # of texts whose distinct units are encoded together
LATTICE_CHARACTERS = 500_000  # of units that share a lattice
WIDTHS = (4, 8, 16, 32, 64)  # units of up to so many characters are merged side by side
CHARACTER = np.int64(1) << 21  # above every code point
NEVER = np.iinfo(np.int32).max  # rank of what is no piece


class Model(NamedTuple):
    """Pieces as a trie. Arrays by id have one more entry, which -1, the id of no piece, refers to."""

    steps: np.ndarray  # node * CHARACTER + code point, ascending; the last one is above all
    nodes: np.ndarray  # where each step leads
    node_ids: np.ndarray  # the piece that ends at a node, or -1
    longest: int
    ranks: np.ndarray  # by id: place of its score among all scores, best first
    scores: np.ndarray  # by id
    unknown: float  # score of a character that is no piece
    first_byte: int  # id of byte 0
    decoded: pa.LargeBinaryArray  # by id: the bytes it stands for


def read_model(model_file: str) -> Model:
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    special = lambda i: model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
    pieces = {i: model.id_to_piece(i) for i in range(model.get_piece_size()) if not special(i)}
    first_byte = model.piece_to_id("<0x00>")
    trie: dict[tuple[int, int], int] = {}
    ends = {}
    for i, piece in pieces.items():
        node = 0
        for character in piece:
            node = trie.setdefault((node, ord(character)), len(trie) + 1)
        ends[node] = i
    steps = [node * int(CHARACTER) + character for node, character in trie]
    steps = np.array([*steps, np.iinfo(np.int64).max], np.int64)
    order = np.argsort(steps)
    node_ids = np.full(len(trie) + 1, -1, np.int32)
    node_ids[list(ends)] = list(ends.values())
    size = max(model.get_piece_size(), first_byte + 256)
    scores = np.full(size + 1, -np.inf)
    scores[list(pieces)] = [model.get_score(i) for i in pieces]
    ranks = np.full(size + 1, NEVER, np.int32)
    ranks[list(pieces)] = np.unique(-scores[list(pieces)], return_inverse=True)[1]
    decoded = {first_byte + byte: bytes([byte]) for byte in range(256)} | {i: p.encode() for i, p in pieces.items()}
    return Model(
        steps[order],
        np.r_[1 : len(trie) + 1, 0][order],
        node_ids,
        max(map(len, pieces.values()), default=1),
        ranks,
        scores,
        min(scores[list(pieces)], default=0.0) - 10,
        first_byte,
        pa.array([decoded.get(i, b"") for i in range(size + 1)], pa.large_binary()),
    )


def lattice(characters: np.ndarray, ends: np.ndarray, model: Model) -> np.ndarray:
    """[begin, length - 1]: the id of the piece there, or -1. ``ends``: of each character's unit."""
    edges = np.full((len(characters), model.longest), -1, np.int32)
    begins, nodes = np.arange(len(characters)), np.zeros(len(characters), np.int64)
    for length in range(model.longest):
        inside = begins + length < ends[begins]
        begins, nodes = begins[inside], nodes[inside]
        wanted = nodes * CHARACTER + characters[begins + length]
        at = np.searchsorted(model.steps, wanted)
        found = model.steps[at] == wanted
        begins, nodes = begins[found], model.nodes[at[found]]
        edges[begins, length] = model.node_ids[nodes]
    return edges


def _pair_ranks(edges: np.ndarray, ranks: np.ndarray, begins: np.ndarray, middles: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The rank of the edge over each two neighbouring parts. A part past the end of its unit is empty."""
    lengths = ends - begins
    open_ = (ends > middles) & (middles > begins) & (lengths <= edges.shape[1])
    return np.where(open_, ranks[edges[np.where(open_, begins, 0), np.where(open_, lengths, 1) - 1]], NEVER)


def merge_fold(bounds: np.ndarray, edges: np.ndarray, model: Model) -> np.ndarray:
    """Whether a part begins at each character, as byte-pair merging leaves them. ``bounds`` of the units, ascending."""
    begins_part = np.ones(len(edges), bool)
    sizes = np.diff(bounds)
    for least, width in zip((1, *WIDTHS), WIDTHS):
        here = np.flatnonzero((sizes > least) & (sizes <= width))
        cuts = np.minimum(bounds[here, None] + np.arange(width + 1), bounds[here + 1, None])
        ranks = _pair_ranks(edges, model.ranks, cuts[:, :-2], cuts[:, 1:-1], cuts[:, 2:])
        column = np.arange(width + 1)
        while len(cuts):
            row, best = np.arange(len(cuts)), ranks.argmin(axis=1)
            live = ranks[row, best] < NEVER
            cuts, ranks, best = cuts[live], ranks[live], best[live]
            row = np.arange(len(cuts))
            begins_part[cuts[row, best + 1]] = False
            moved = column + (column > best[:, None])
            cuts = np.take_along_axis(cuts, np.minimum(moved, width), axis=1)
            ranks = np.take_along_axis(ranks, np.minimum(moved[:, : width - 1], width - 2), axis=1)
            ranks[:, -1] = NEVER
            for pair in (best, np.maximum(best - 1, 0)):
                pair = np.minimum(pair, width - 2)
                ranks[row, pair] = _pair_ranks(edges, model.ranks, *(cuts[row, pair + i] for i in range(3)))
    for unit in np.flatnonzero(sizes > WIDTHS[-1]).tolist():
        begin, end = bounds[unit], bounds[unit + 1]
        begins_part[begin:end] = _merge_long(model.ranks[edges[begin:end]])
    return begins_part


def _merge_long(ranks: np.ndarray) -> np.ndarray:
    """As ``merge_fold`` for one unit, from the ranks of its edges, with the open edges in a heap."""
    n, longest = ranks.shape
    after, before = list(range(1, n + 1)), list(range(-1, n))
    begins_part = np.ones(n, bool)
    heap = [(rank, b, b + 1, b + 2) for b, rank in enumerate(ranks[:-1, 1].tolist()) if rank < NEVER] if longest > 1 else []
    heapq.heapify(heap)

    def meet(b: int, mid: int, e: int) -> None:
        if e - b <= longest and ranks[b, e - b - 1] < NEVER:
            heapq.heappush(heap, (int(ranks[b, e - b - 1]), b, mid, e))

    while heap:
        _, b, mid, e = heapq.heappop(heap)
        if after[b] != mid or after[mid] != e:
            continue
        begins_part[mid] = False
        after[b], before[e], after[mid] = e, b, -1
        if b > 0:
            meet(before[b], b, e)
        if e < n:
            meet(b, e, after[e])
    return begins_part


def viterbi_fold(bounds: np.ndarray, edges: np.ndarray, model: Model) -> np.ndarray:
    """Whether a part of the best path begins at each character. A character may stand alone for ``model.unknown``."""
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    starts, falling = bounds[:-1][order], -sizes[order]
    # By unit and character; the best path to the begin of a unit is not among them.
    best, back = np.zeros(len(edges)), np.zeros(len(edges), np.int64)
    alone = np.where(edges[:, 0] < 0, model.unknown, model.scores[edges[:, 0]])
    for end in range(1, int(sizes.max(initial=0)) + 1):
        units = starts[: np.searchsorted(falling, -end, side="right")]
        score, begin = np.full(len(units), -np.inf), np.zeros(len(units), np.int64)
        for length in range(min(end, model.longest), 0, -1):
            at = units + end - length
            own = alone[at] if length == 1 else model.scores[edges[at, length - 1]]
            reached = (best[at - 1] if length < end else 0.0) + own
            better = reached >= score
            score[better], begin[better] = reached[better], at[better]
        best[units + end - 1], back[units + end - 1] = score, begin
    begins_part = np.zeros(len(edges), bool)
    at, first = bounds[1:], bounds[:-1]
    while len(at):
        at = back[at - 1]
        begins_part[at] = True
        at, first = at[at > first], first[at > first]
    return begins_part


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.LargeBinaryArray:
    """Values that begin and end at the bytes ``bounds``."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, buffers)


def _parted(values: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the values in a row, and the bounds of each."""
    bounds = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def encode_units(characters: np.ndarray, bounds: np.ndarray, kind: str, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the units, whose code points lie between ``bounds``, in a row, and the number of ids of each."""
    unit_ends = np.repeat(bounds[1:], np.diff(bounds))
    edges = lattice(characters, unit_ends, model)
    begins_part = (merge_fold if kind == "bpe" else viterbi_fold)(bounds, edges, model)
    begins = np.flatnonzero(begins_part)
    ids = edges[begins, np.diff(begins, append=len(characters)) - 1].astype(np.int64)
    n_ids = np.ones(len(ids), np.int64)
    # Parts that are no piece are single characters; their bytes follow the ids in a table.
    bare = ids < 0
    points, which = np.unique(characters[begins[bare]], return_inverse=True)
    raw = [chr(point).encode() for point in points.tolist()]
    sizes = np.array([len(r) for r in raw], np.int64)
    table = np.r_[np.arange(len(model.scores)), np.frombuffer(b"".join(raw), np.uint8) + np.int64(model.first_byte)]
    n_ids[bare] = sizes[which]
    ids[bare] = len(model.scores) + (np.cumsum(sizes) - sizes)[which]
    ends = np.cumsum(n_ids)
    spread = table[np.repeat(ids - ends + n_ids, n_ids) + np.arange(n_ids.sum())]
    parts_before = np.r_[0, np.cumsum(begins_part)][bounds]
    return spread.astype("<u4"), np.diff(np.r_[0, ends][parts_before])


def decode_units(ids: np.ndarray, n_ids: np.ndarray, model: Model) -> pa.LargeBinaryArray:
    """The bytes that the ids of each unit stand for, from the piece table."""
    data, bounds = _parted(model.decoded.take(pa.array(ids.astype(np.int64))))
    return _binary(data, bounds[np.r_[0, np.cumsum(n_ids)]])


def _units(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The bounds of the units in texts whose blanks are spaces."""
    blank, line = data == ord(" "), data == ord("\n")
    first = line.copy()
    first[1:] |= line[:-1] | (blank[1:] & ~blank[:-1])
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.r_[np.flatnonzero(first), len(data)]


def encode_texts(texts: pa.LargeBinaryArray, kind: str, model: Model) -> tuple[pa.LargeBinaryArray, pa.LargeBinaryArray]:
    """The ids of each text as little-endian 32-bit numbers, and the bytes they decode to."""
    data, bounds = _parted(texts)
    cuts = _units(data, bounds)
    coded = _binary(data, cuts).dictionary_encode()
    letters, unit_bounds = _parted(coded.dictionary)
    characters = np.frombuffer(letters.tobytes().decode().replace(" ", BLANK).encode("utf-32-le"), "<u4").astype(np.int64)
    before = np.r_[0, np.cumsum(letters & 0xC0 != 0x80)][unit_bounds]
    ids, n_ids, at = [np.empty(0, "<u4")], [np.empty(0, np.int64)], 0
    while at < len(before) - 1:
        end = max(at + 1, int(np.searchsorted(before, before[at] + LATTICE_CHARACTERS, side="right")) - 1)
        found = encode_units(characters[before[at] : before[end]], before[at : end + 1] - before[at], kind, model)
        ids.append(found[0])
        n_ids.append(found[1])
        at = end
    ids, n_ids = np.concatenate(ids), np.concatenate(n_ids)
    known = _binary(ids, 4 * np.r_[0, np.cumsum(n_ids)]), decode_units(ids, n_ids, model)
    units_before = np.searchsorted(cuts[:-1], bounds)
    whole = (_parted(values.take(coded.indices)) for values in known)
    return tuple(_binary(part, ends[units_before]) for part, ends in whole)


def _stretches(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of about STRETCH_BYTES of text, one row at least."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy().astype(np.int64))
    at = 0
    while at < len(ends):
        read = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, read + STRETCH_BYTES, side="right")))
        yield batch.slice(at, end - at)
        at = end


def encode(
    docs: DataFrame, model_file: str, kind: str = "bpe", id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """id, n_pieces, ids_crc32 (of little-endian 32-bit ids), decoded (the text from the ids) and, if wanted, ids as bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model_file))
    text = F.coalesce(F.col(text_col), F.lit(""))
    # A regular expression reads its input as characters, which replaces what is no UTF-8.
    text = F.when(F.is_valid_utf8(text), text).otherwise(F.regexp_replace(text, "^", ""))
    dressed = F.when(text == "", text).otherwise(F.concat(F.lit(" "), F.replace(text, F.lit(BLANK), F.lit(" "))))
    rows = docs.select(F.col(id_col).alias("id"), dressed.alias("text"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in _stretches(batch)):
            ids, raw = encode_texts(part.column("text").cast(pa.large_binary()), kind, shared.value)
            data, bounds = _parted(ids)
            crc = [zlib.crc32(data[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            shown = pc.replace_substring(raw.cast(pa.large_string()), BLANK, " ")
            decoded = pc.utf8_slice_codeunits(shown, 1).cast(pa.string())
            columns = [part.column("id"), pa.array(np.diff(bounds) // 4), pa.array(crc, pa.int64()), decoded, ids.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(columns[: len(schema)], names=schema.names)

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType)])
    schema = schema.add("n_pieces", "long").add("ids_crc32", "long").add("decoded", "string")
    schema = schema.add("ids", "binary") if with_ids else schema
    return rows.mapInArrow(encoded, schema)
