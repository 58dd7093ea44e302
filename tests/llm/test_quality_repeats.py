import random

from texts import SCHEMA, WORDS, prose
from tradewind.llm import quality


def in_lines(words, n=8):
    return "\n".join(" ".join(words[i : i + n]) for i in range(0, len(words), n))


def test_repeated_lines_and_words_are_rejected_by_themselves(spark):
    draw = random.Random(8)
    texts = {i: in_lines(prose(draw.randint(80, 200), i).split()) for i in range(300)}
    for i in range(0, 300, 50):  # a few lines repeated once in a clean text are no junk
        lines = texts[i].split("\n")
        texts[i] = "\n".join(lines + lines[:1])
    for i in range(300, 310):  # menus: short lines in changing order, few repeated windows of words
        texts[i] = "\n".join(draw.choice(WORDS) for _ in range(60))
    for i in range(310, 320):  # repeated words just under the base rule
        words = prose(82, i).split()
        texts[i] = in_lines(words[:70] + words[:20])
    found = quality.judged(spark.createDataFrame([(i, t, "en", "s", len(t), None, "x", 7, 1) for i, t in texts.items()], SCHEMA))
    rows = {r["id"]: r for r in found.collect()}
    junk = [rows[i] for i in range(300, 320)]
    assert not any(r["base_failed"] for r in rows.values())
    assert all(r["n_dup_lines"] > 0.5 * 60 for r in junk[:10])
    assert {i for i, r in rows.items() if not r["kept"]} == set(range(300, 320))
