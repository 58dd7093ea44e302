"""Encoding without shuffled or stored units, in lattices and stretches of any size, for units of any length."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece

from texts import prose
from tradewind.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


def drawn(seed, letters, n):
    draw = random.Random(seed)
    return "".join(draw.choice(letters) for _ in range(n))


def test_units_are_neither_shuffled_nor_stored(spark, make_docs, monkeypatch):
    def refused(*_):
        raise AssertionError("stored")

    monkeypatch.setattr("tradewind.operators.scratch.scratch_path", refused)
    monkeypatch.setattr("tradewind.llm.storage.scratch_path", refused)
    docs = make_docs([(1, prose(20, 1))]).localCheckpoint()
    encoded = pieces.encode(docs, PATH)
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert encoded.count() == 1


def test_a_long_unit_without_blanks_equals_the_library(make_docs):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = [(1, drawn(1, "etaoinshrdlu", 50_000)), (2, drawn(2, "日本語東京éx", 3_000)), (3, "ab" * 20_000)]
    texts += [(n, drawn(n, "etaoinshr", n)) for n in range(59, 70)]
    found = {r["id"]: (np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) for r in pieces.encode(make_docs(texts), PATH).collect()}
    assert found == {i: (model.encode(t), t) for i, t in texts}


def test_lattices_and_stretches_end_anywhere(monkeypatch):
    model, library = pieces.read_model(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    monkeypatch.setattr(pieces, "LATTICE_CHARACTERS", 7)
    monkeypatch.setattr(pieces, "STRETCH_BYTES", 500)
    texts = [""] + [drawn(i, "abcdeéthinrs  \n.,日", 5 * i) for i in range(60)] + ["", " \n", ""]
    dressed = pa.record_batch({"text": pa.array([t and " " + t for t in texts])})
    found = []
    for part in pieces._stretches(dressed):
        assert part.num_rows == 1 or part.nbytes < 1000
        ids, raw = pieces.encode_texts(part.column("text").cast(pa.large_binary()), "bpe", model)
        found += [(np.frombuffer(i, "<u4").tolist(), r.decode().replace("▁", " ")[1:]) for i, r in zip(ids.to_pylist(), raw.to_pylist())]
    assert found == [(library.encode(t), t) for t in texts]


def test_bytes_that_are_no_text_become_replacement_characters(spark):
    docs = spark.sql("SELECT 1 AS doc_id, cast(unhex('61FF62EDA08020C3A9') AS string) AS text")
    assert pieces.encode(docs, PATH).first()["decoded"] == "a\ufffdb\ufffd é"


def merged(n, ranks):
    """One merge after another: the best edge over exactly two parts, the leftmost of equals."""
    cuts = list(range(n + 1))
    while True:
        at = [(ranks[b, e - b - 1], b, mid) for b, mid, e in zip(cuts, cuts[1:], cuts[2:]) if e - b <= ranks.shape[1]]
        rank, _, mid = min(at, default=(pieces.NEVER, 0, 0))
        if rank == pieces.NEVER:
            return cuts[:-1]
        cuts.remove(mid)


def test_merges_take_the_best_open_edge_though_its_parts_score_worse():
    draw = np.random.default_rng(5)
    model = pieces.read_model(PATH)
    ranks = np.append(draw.integers(0, 40, len(model.ranks) - 1), pieces.NEVER).astype(np.int32)
    sizes = np.array([1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33, 63, 64, 65, 66, 90] * 8)
    bounds = np.r_[0, np.cumsum(sizes)]
    edges = draw.integers(0, len(ranks) - 1, (bounds[-1], 6)).astype(np.int32)
    edges[draw.random(edges.shape) < 0.5] = -1
    # No edge reaches over the end of a unit.
    left = np.repeat(bounds[1:], sizes) - np.arange(bounds[-1])
    edges[np.arange(6) >= left[:, None]] = -1
    found = pieces.merge_fold(bounds, edges, model._replace(ranks=ranks))
    expected = [b + p for b, n in zip(bounds.tolist(), sizes.tolist()) for p in merged(n, ranks[edges[b : b + n]])]
    assert np.flatnonzero(found).tolist() == expected
