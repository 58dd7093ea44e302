import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from tradewind.llm import token_files, tokens
from tradewind.llm.packing import pack, sequences

PATH = public_tokenizers.path("word_bpe_49k.json")
ENCODER = tokens.Encoder(PATH)


def ids_of(text):
    return ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text() | st.text(alphabet="abÉé .,'\n\t1_<|>\x1ć"), max_size=4))
def test_encoding_equals_the_library(texts):
    assert [np.frombuffer(d, "<u4").tolist() for d in ENCODER.encode(texts)] == [ids_of(t) for t in texts]


def test_long_texts_and_a_full_memory(monkeypatch):
    monkeypatch.setattr(tokens, "BATCH_CHARACTERS", 40)
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    fresh = tokens.Encoder(PATH)
    texts = ["many different words that do not fit into a memory of five, and " * 3, "", "short", "a" * 200]
    assert [np.frombuffer(d, "<u4").tolist() for d in fresh.encode(texts)] == [ids_of(t) for t in texts]


def test_packing(make_docs, odd_pairs):
    docs = make_docs(odd_pairs)
    pieces = [r.asDict() for r in pack(docs, PATH, end_id=1, length=64).collect()]
    expected = collections.Counter((i, tuple(ids_of(t) + [1])) for i, t in odd_pairs)
    by_stream = sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"]))
    found, current = collections.Counter(), []
    position = 0
    for p in by_stream:
        assert p["sequence_id"] * 64 + p["offset"] == position and p["offset"] + p["length"] <= 64
        position += p["length"]
        assert p["start"] == len(current) and p["ids_crc32"] == zlib.crc32(p["ids"])
        current += np.frombuffer(p["ids"], "<u4").tolist()
        if len(current) == p["doc_tokens"]:
            found[p["id"], tuple(current)] += 1
            current = []
    assert found == expected and not current


def test_sequences_are_padded_unless_a_power_of_two(make_docs):
    texts = [(1, "river " * 70), (2, "stone")]
    rows = sequences(pack(make_docs(texts), PATH, end_id=1, length=64), 64, pad_id=9).orderBy("sequence_id").collect()
    total = sum(len(ids_of(t)) + 1 for _, t in texts)
    assert sum(r["n_tokens"] for r in rows) == total
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        n = r["n_tokens"]
        assert len(ids) == (n if n & (n - 1) == 0 else 64) and (ids[n:] == 9).all()
        assert sum(d["length"] for d in r["documents"]) == n


def test_packing_nothing(make_docs):
    assert pack(make_docs([]), PATH, end_id=1).count() == 0


@pytest.mark.parametrize("ids", [[0], [5] * 9000, list(range(8192)), [0, 2**32 - 1], [7, 7, 2**31, 7]])
def test_blocks_round_trip(ids):
    ids = np.array(ids[: token_files.BLOCK], "<u4")
    assert token_files.unpack_block(memoryview(token_files.pack_block(ids))).tolist() == ids.tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 50), min_size=1, max_size=300))
def test_any_block_round_trips(ids):
    packed = token_files.pack_block(np.array(ids, "<u4"))
    assert token_files.unpack_block(memoryview(packed)).tolist() == ids


def test_outliers_go_to_the_exception_list():
    ids = np.array([3] * 4000 + [2**30], "<u4")
    assert len(token_files.pack_block(ids)) < 40


def test_files_round_trip_in_order(make_docs, odd_pairs):
    rows = token_files.round_trip(make_docs(odd_pairs), PATH, end_id=2).orderBy("start").collect()
    ids = [r["id"] for r in rows]
    assert ids == [None, None, 1, 2, 2, 3, 4, 5, 6, 7, 8, 9]
    texts, at = {i: t for i, t in odd_pairs if i is not None}, 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
        if r["id"] is not None:
            data = np.array(ids_of(texts[r["id"]]) + [2], "<u4").tobytes()
            assert (r["n_tokens"], r["ids_crc32"]) == (len(data) // 4, zlib.crc32(data))


def test_no_documents_no_files(make_docs):
    assert token_files.round_trip(make_docs([]), PATH, end_id=2).count() == 0


def test_memory_is_bounded_and_long_chunks_are_not_kept(monkeypatch):
    draw = random.Random(4)
    encoder = tokens.Encoder(PATH)
    long = ["".join(draw.choice("abcdefXYZ+/09é日本") for _ in range(5000)) for _ in range(4)]
    texts = [f"{chunk} some words {chunk}, and\n{chunk[:90]}" for chunk in long] + ["x" * 300_000, "日本語" * 400, "aB" * 51 + "!"]
    whole = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == whole
    assert max(map(len, encoder.chunks)) <= tokens.LONGEST_REMEMBERED
    monkeypatch.setattr(tokens, "REMEMBERED", 20_000)
    sizes = []
    for k in range(60):
        text = " ".join("".join(draw.choice("abcdefgh") for _ in range(9)) + draw.choice(["", ".", "(9)"]) for _ in range(50))
        (found,) = encoder.encode([text])
        assert np.frombuffer(found, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
        sizes.append(len(encoder.chunks))
    assert max(sizes[1:]) < 200


@pytest.mark.parametrize("text", ["É à Ünï ß. ÀÉ ÿŸ", "don't I'M a'b", "ﬁ Ⅷ ½ ² é", "NUL\x00x \x85 y  z", "Ａ １ İ ı ẞ", "a.b .c d., e- - --f", "\t\r\n \x0b"])
def test_unusual_characters_give_the_librarys_ids(text):
    encoder = tokens.Encoder(PATH)
    (found,) = encoder.encode([text])
    assert np.frombuffer(found, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
