import collections
import zlib

import numpy as np
import public_tokenizers
import sentencepiece

from texts import prose
from tradewind.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    (1, "Hello  world\n\n a\tb"),
    (2, ""),
    (None, None),
    (3, "   "),
    (4, "日本語 😀 naïve\x00 ﬁ"),
    (5, prose(40, 1)),
    (5, prose(40, 1)),
    (6, "unbelievably internationalisation" + "x" * 60),
    (7, " lead and trail "),
]


def test_ids_and_decoding_equal_the_library(make_docs):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = pieces.encode(make_docs(TEXTS), PATH).collect()
    found = collections.Counter((r["id"], tuple(np.frombuffer(r["ids"], "<u4").tolist()), r["decoded"]) for r in rows)
    assert found == collections.Counter((i, tuple(model.encode(t or "")), t or "") for i, t in TEXTS)
    assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) and r["n_pieces"] == len(r["ids"]) // 4 for r in rows)


def test_encoding_nothing(make_docs):
    assert pieces.encode(make_docs([]), PATH).count() == 0


def _varint(data, at):
    value = shift = 0
    while True:
        value |= (data[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if not data[at - 1] & 128:
            return value, at


def as_unigram(data: bytes) -> bytes:
    """The model with its type, field 3 of field 2, set to unigram."""
    changed, at = bytearray(data), 0
    while at < len(data):
        tag, at = _varint(data, at)
        size, at = _varint(data, at)
        if tag == 2 << 3 | 2:
            inner, end = at, at + size
            while inner < end:
                tag, inner = _varint(data, inner)
                if tag == 3 << 3:
                    changed[inner] = 1
                    return bytes(changed)
                value, inner = _varint(data, inner)
                inner += value if tag & 7 == 2 else 0
                assert tag & 7 in (0, 2)
        at += size
    raise ValueError("no model type")


def best_score(unit, scores):
    best = [0.0] + [float("-inf")] * len(unit)
    for end in range(1, len(unit) + 1):
        for begin in range(max(0, end - 16), end):
            best[end] = max(best[end], best[begin] + scores.get(unit[begin:end], float("-inf")))
    return best[-1]


def test_viterbi_finds_the_best_scores(make_docs, tmp_path):
    path = tmp_path / "unigram.model"
    path.write_bytes(as_unigram(open(PATH, "rb").read()))
    model = sentencepiece.SentencePieceProcessor(model_file=str(path))
    scores = {model.id_to_piece(i): model.get_score(i) for i in range(259, model.get_piece_size())}
    texts = [(i, t) for i, t in enumerate(["river stones", "internationalisation", "naïve é", prose(15, 3)])]
    assert any(model.encode(t) != sentencepiece.SentencePieceProcessor(model_file=PATH).encode(t) for _, t in texts)
    alike = []
    for r in pieces.encode(make_docs(texts), str(path), kind="unigram").collect():
        ids, text = np.frombuffer(r["ids"], "<u4").tolist(), texts[r["id"]][1]
        assert r["decoded"] == text
        assert sum(map(model.get_score, ids)) == sum(best_score("▁" + w, scores) for w in text.split(" "))
        alike.append(ids == model.encode(text))
    assert any(alike)
