"""Token ids of whole texts by a public tokenizer, one encoder per Python worker.

White space never enters a token of the tokenizers this is for, so a text's ids are those of
its space-separated chunks in a row. Most chunks are a plain word and the marks after it, which the
tokenizer takes one by one and whatever the case, so both go to its model on their own; anything unusual
goes through the tokenizers library as it is. An encoder remembers words, marks and unusual chunks, up to a number of
bytes, in arrays; then it forgets those it hasn't met again. Long chunks are not remembered.
"""

from __future__ import annotations

import itertools
import operator
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

REMEMBERED = 80 << 20  # bytes of parts and ids, each with some overhead; beyond it what was not met again is forgotten
OVERHEAD = 120  # of an entry, with that of finding it
LONGEST_REMEMBERED = 100  # characters
BATCH_CHARACTERS = 4_000_000  # of texts encoded at once
# Letters of Latin-1, then ASCII marks: one word and one run of marks to the tokenizer, whatever the case.
LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha() and c not in "ªµº")
MARKS = ".,;:!?%&*#$()[]>/-"
ID = operator.attrgetter("id")


def _byte_letters() -> dict[int, int]:
    """The character a byte-level tokenizer writes for each byte: printable ones stand for themselves, others follow 255 in order."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = itertools.count(256)
    return {byte: byte if byte in own else next(others) for byte in range(256)}


BYTE_LETTERS = _byte_letters()


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.parts = pa.array([], pa.large_string())  # words, marks and unusual chunks
        self.ids, self.bounds = np.empty(0, "<u4"), np.zeros(1, np.int32)
        self.again = np.empty(0, bool)

    @property
    def chunks(self) -> list[str]:
        """All that is remembered."""
        return self.parts.to_pylist()

    def _forget(self) -> None:
        """What was met again stays, until next time."""
        met = np.flatnonzero(self.again)
        self.parts = self.parts.take(pa.array(met))
        self.ids, self.bounds = _gathered(self.ids, self.bounds, met)
        self.again = np.zeros(len(met), bool)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _plain_ids(self, word: str) -> list[int]:
        """One word or run of marks to the tokenizer goes to its model directly, as the characters its bytes stand for."""
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_LETTERS)
        return list(map(ID, self.tokenizer.model.tokenize(letters)))

    def _known(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, the bounds of stretches of them, and the number of each part's stretch. Short new parts are remembered."""
        if len(self.parts) * OVERHEAD + pc.sum(pc.binary_length(self.parts), min_count=0).as_py() + self.ids.nbytes > REMEMBERED:
            self._forget()
        found = pc.index_in(parts, value_set=self.parts)
        self.again[found.drop_null().to_numpy()] = True
        new = parts.filter(found.is_null())
        plain = pc.or_(pc.equal(pc.utf8_ltrim(new, characters=LETTERS), ""), pc.equal(pc.utf8_rtrim(new, characters=MARKS), ""))
        long = pc.greater(pc.utf8_length(new), LONGEST_REMEMBERED)
        kind = pc.if_else(long, 2, pc.if_else(plain, 0, 1)).to_numpy()
        order = np.argsort(kind, kind="stable")
        words, odd, _ = np.bincount(kind, minlength=3).tolist()
        new = new.take(pa.array(order))
        texts = new.to_pylist()
        learnt = [*map(self._plain_ids, texts[:words]), *map(self._ids, texts[words:])]
        ids = np.concatenate([self.ids, np.fromiter(itertools.chain.from_iterable(learnt), "<u4")])
        ends = np.cumsum(np.fromiter(map(len, learnt), np.int32, len(learnt)), dtype=np.int32)
        bounds = np.r_[self.bounds, self.bounds[-1] + ends]
        numbers = found.fill_null(0).to_numpy().copy()
        numbers[np.flatnonzero(found.is_null().to_numpy(zero_copy_only=False))[order]] = np.arange(len(self.parts), len(bounds) - 1)
        self.parts = pa.concat_arrays([self.parts, new.slice(0, words + odd)])
        self.bounds = bounds[: len(self.parts) + 1].copy()
        self.ids = ids[: self.bounds[-1]].copy()
        self.again = np.r_[self.again, np.zeros(words + odd, bool)]
        return ids, bounds, numbers

    def _encode(self, texts: list[str]) -> list[bytes]:
        """Chunks, then their parts, are told apart in Arrow, so that Python sees new parts only; ids are then gathered by number."""
        lists = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        chunks = coded.dictionary
        words, marks = pc.utf8_rtrim(chunks, characters=MARKS), pc.utf8_ltrim(chunks, characters=LETTERS)
        # Nothing but letters, then marks: what is left without either makes up the whole.
        plain = pc.equal(pc.add(pc.binary_length(words), pc.binary_length(marks)), pc.binary_length(chunks))
        plain = pc.and_(plain, pc.less_equal(pc.utf8_length(chunks), LONGEST_REMEMBERED))
        words, marks = pc.if_else(plain, pc.utf8_lower(words), chunks), pc.if_else(plain, marks, "")
        parts = pa.concat_arrays([words, marks]).dictionary_encode()
        # A batch has far fewer ids than 32 bits can count.
        ids, bounds, numbers = self._known(parts.dictionary)
        pairs = parts.indices.to_numpy().reshape(2, -1).T.ravel()  # each chunk's word and marks
        pool, bounds = _gathered(ids, bounds, numbers[pairs])
        ids, bounds = _gathered(pool, bounds[::2], coded.indices.to_numpy())
        ids, bounds = ids.tobytes(), bounds[lists.offsets.to_numpy() - lists.offsets[0].as_py()].astype(np.int64) * 4
        return [ids[a:b] for a, b in itertools.pairwise(bounds.tolist())]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text. Very long texts are taken in stretches that end at a space."""
        waiting: list[str] = []
        size = 0
        for text in texts:
            if size + len(text) > BATCH_CHARACTERS and waiting:
                yield from self._encode(waiting)
                waiting, size = [], 0
            if len(text) > BATCH_CHARACTERS:
                yield b"".join(self._encode([part])[0] for part in _stretches(text))
            else:
                waiting.append(text)
                size += len(text)
        yield from self._encode(waiting)


def _gathered(pool: np.ndarray, bounds: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbered stretches of ``pool`` in a row, and their bounds."""
    n = np.diff(bounds)[numbers]
    ends = np.cumsum(n, dtype=np.int32)
    places = np.repeat(bounds[1:][numbers] - ends, n)
    places += np.arange(len(places), dtype=np.int32)
    return pool[places], np.r_[np.int32(0), ends]


def _stretches(text: str) -> Iterator[str]:
    begin = 0
    while begin < len(text):
        end = text.find(" ", begin + BATCH_CHARACTERS)
        end = len(text) if end < 0 else end
        yield text[begin:end]
        begin = end


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker and tokenizer file, kept between tasks."""
    return Encoder(path)
