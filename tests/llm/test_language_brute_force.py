"""The whole path of language identification once more, in plain Python and doubles, on a small corpus."""

import collections
import math
import random
import zlib

import pytest
from texts import SCHEMA

from tradewind.llm import language

SYLLABLES = {"aa": "ka to mi ru ne so".split(), "bb": "st ein ich der und ver".split(), "cc": "çã ção os dade mente ra".split()}


def corpus():
    draw = random.Random(7)
    rows = []
    for i in range(150):
        lang = list(SYLLABLES)[i % 3]
        pool = SYLLABLES[lang] + draw.sample(sum(SYLLABLES.values(), []), 4)  # some syllables of any language
        words = ["".join(draw.choices(pool, k=draw.randint(1, 4))) for _ in range(draw.randint(5, 60))]
        rows.append((i, " ".join(words) + draw.choice(["", "!", "\n12 %"]), lang if i % 5 else None))
    return rows + [(900, None, "aa"), (901, "", "bb"), (902, "123 ...", "cc"), (903, "Ka To", None)]


def grams(text):
    blank = {ord(c): " " for c in "\t\n\x0b\x0c\r"}
    kept = [b for c in text.lower().translate(blank) for b in c.encode() if b >= 128 or chr(b).isalpha() or chr(b) == " "]
    codes = [a * 256 + b for a, b in zip(kept, kept[1:])]
    codes += [(a * 256 + b) * 256 + c + 2**24 for a, b, c in zip(kept, kept[1:], kept[2:])]
    return collections.Counter((code * 2654435761 % 2**32) >> 20 for code in codes)


def unit(vector):
    length = math.sqrt(sum(x * x for x in vector.values()))
    return {k: x / length for k, x in vector.items()} if length else vector


def dot(a, b):
    return sum(x * b.get(k, 0.0) for k, x in a.items())


def centroids_of(points):
    whole = collections.Counter()
    for p in points:
        whole.update(p)
    chosen = [max(points, key=lambda p: dot(p, whole))]
    while len(chosen) < min(language.CLUSTERS, len(points)):
        chosen.append(min(points, key=lambda p: max(dot(p, c) for c in chosen)))
    for _ in range(language.ROUNDS):
        members = [[] for _ in chosen]
        for p in points:
            members[max(range(len(chosen)), key=lambda k: dot(p, chosen[k]))].append(p)
        for k, own in enumerate(members):
            if own:
                total = collections.Counter()
                for p in own:
                    total.update(p)
                chosen[k] = unit(total)
    return chosen


def brute(rows):
    learned = [(t, lang) for i, t, lang in rows if t is not None and lang and zlib.crc32(str(i).encode()) % 3 != 1]
    filled = collections.Counter(b for t, _ in learned for b in grams(t))
    idf = {b: math.log((1 + len(learned)) / (1 + filled[b])) + 0.05 for b in range(language.BINS)}

    def vector(text):
        return unit({b: math.log1p(n) * idf[b] for b, n in grams(text).items()})

    model = {}
    for lang in sorted({lang for _, lang in learned}):
        points = [vector(t) for t, own in learned if own == lang and any(map(str.isalpha, t))]
        model[lang] = centroids_of(points)
    found = {}
    for i, text, _ in rows:
        if text is None or not any(map(str.isalpha, text)):
            found[i] = ("und", 0.0)
        else:
            point = vector(text)
            found[i] = max(((lang, max(dot(point, c) for c in some)) for lang, some in model.items()), key=lambda hit: hit[1])
    return found


def test_predictions_equal_plain_python(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, lang, "a", 1, None, "x", 7, 1) for i, t, lang in rows], SCHEMA).repartition(3)
    found = {r["id"]: r for r in language.identify(docs).collect()}
    expected = brute(rows)
    assert set(found) == set(expected)
    for i, (lang, score) in expected.items():
        assert found[i]["lang_pred"] == lang and found[i]["score"] == pytest.approx(score, abs=1e-4), i
        assert found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
    right = [found[i]["lang_pred"] == list(SYLLABLES)[i % 3] for i in range(150) if found[i]["held_out"]]
    assert sum(right) >= 0.95 * len(right)
