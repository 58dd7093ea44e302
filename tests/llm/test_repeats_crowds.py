import random
import string

import pytest
from pyspark.sql import functions as F

import tradewind.llm.repeats as repeats
from test_near_and_repeats import brute_repeats


def noise(n, seed):
    return "".join(random.Random(seed).choices(string.ascii_letters, k=n))


@pytest.mark.parametrize("length", [40, 80, 99, 130])
def test_a_frequent_string_does_not_meet_in_one_task(make_docs, monkeypatch, length):
    monkeypatch.setattr(repeats, "CROWD", 30)
    crowds = []
    settle = repeats._repeats

    def watched(contexts, survivors):
        sizes = contexts.groupBy("gram", "share").agg(F.count("*").alias("n"))
        crowds.append(sizes.agg(F.max("n")).first()[0] or 0)
        return settle(contexts, survivors)

    monkeypatch.setattr(repeats, "_repeats", watched)
    common = noise(length, 1)
    pairs = [(i, noise(120, 100 + i) + common + noise(120, 900 + i)) for i in range(200)]
    pairs += [(300, pairs[5][1][60:400]), (301, "zz" + pairs[6][1][90:340])]
    rows = repeats.removal_report(make_docs(pairs)).collect()
    expected = brute_repeats(pairs)
    assert {r["id"]: r["n_removed"] for r in rows} == {i: sum(cover) for i, (_, cover) in expected.items()}
    assert max(crowds) <= 60  # dealt by hash, so about CROWD
