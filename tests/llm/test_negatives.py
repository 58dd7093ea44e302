import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import negatives
from tradewind.llm.negatives import SortedLists, hard_negatives, search

SCHEMA = "vec_id long, embedding array<float>, label int, row long, vector string, anchor int, score double"


def brute(rows, every, k=5, m=5, low=80, scale=256):
    used = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        used.append((i, [math.floor(scale * x) for x in v], label))
    found = collections.Counter()

    def order(hit):
        return (-hit[0], hit[1] is None, hit[1] or 0)

    for place, (i, q, label) in enumerate(used):
        if i is None or i % every:
            continue
        scored = [(sum(a * b for a, b in zip(q, v)), j, other) for at, (j, v, other) in enumerate(used) if at != place]
        for positive in sorted([s for s in scored if s[2] == label], key=order)[:k]:
            admitted = [s for s in scored if s[2] != label and low * positive[0] <= 100 * s[0] <= 100 * positive[0]]
            for rank, hit in enumerate(sorted(admitted, key=order)[:m], 1):
                found[(i, positive[1], rank, hit[1], positive[0], hit[0])] += 1
    return found


def check(spark, rows, every=10, **options):
    docs = spark.createDataFrame([(*r, 1, "x", 2, 0.5) for r in rows], SCHEMA).repartition(3)
    rounded = [tuple(r)[:3] for r in docs.collect()]
    found = hard_negatives(docs, anchor=F.col("vec_id") % every == 0, **options)
    got = collections.Counter(tuple(int(v) if k.endswith("score") else v for k, v in r.asDict().items()) for r in found.collect())
    assert got == brute(rounded, every, options.get("positives", 5), options.get("negatives", 5), options.get("low_percent", 80))
    return got


def clustered(n, width, seed, labels=3):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(8, width))
    return [(i, (centres[i % 8] + draw.normal(size=width) * 0.3).astype("float32").tolist(), int(draw.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("shard_rows,block", [(16_384, 4_096), (40, 7)])
def test_equals_brute_force_in_any_number_of_shards_and_blocks(spark, monkeypatch, shard_rows, block):
    monkeypatch.setattr(negatives, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(negatives, "BLOCK", block)
    assert check(spark, clustered(300, 12, 1))


def test_other_sizes_of_the_answer(spark):
    check(spark, clustered(150, 5, 2), positives=2, negatives=9, low_percent=30)


def test_a_third_of_the_rows_alike(spark):
    same = clustered(1, 8, 5)[0][1]
    rows = [(i, same if i % 3 == 0 else v, label) for i, v, label in clustered(240, 8, 4)]
    check(spark, rows)


def test_odd_rows(spark):
    good = clustered(60, 4, 6, labels=2)
    odd = [
        (None, good[0][1], 0),
        (None, good[0][1], 1),
        (0, good[0][1], good[0][2]),  # a repeated row
        (0, good[3][1], 1 - good[0][2]),  # a repeated id
        (100, None, 0),
        (110, good[1][1], None),
        (120, [float("nan")] * 4, 0),
        (130, [float("inf"), 0.0, 0.0, 0.0], 0),
        (140, [None, 1.0, 1.0, 1.0], 0),
        (150, [], 0),
        (160, [0.0] * 4, 1),
        (170, good[2][1][:2], 0),
        (180, [-x for x in good[2][1]], 0),
    ]
    check(spark, good + odd)


def test_no_rows_and_one_label(spark):
    assert not check(spark, [])
    assert not check(spark, [(i, [1.0, float(i)], 4) for i in range(30)])
    assert not check(spark, [(1, None, 4)])


@pytest.mark.parametrize("size", [1e3, 1e6, 1e9, 1e13])
def test_scores_beyond_doubles_and_longs_are_whole(spark, size):
    rows = [(i, [float(x) * size for x in v], label) for i, v, label in clustered(80, 3, 7)]
    assert check(spark, rows)


def test_the_search_stops_early_and_only_below_the_kth_score():
    """A few rows in the anchor's direction: sorted access ends long before the lists do, and ties are all met."""
    draw = np.random.default_rng(8)
    vectors = draw.integers(-20, 20, size=(4000, 6))
    vectors[:40] = [100, -100, 90, 0, 50, -70]
    lists, anchor = SortedLists(vectors.astype(float), 100), np.array([10.0, -9.0, 8.0, 0.0, 3.0, -5.0])
    met = np.zeros(4000, bool)
    for fresh, scores, threshold in lists.descent(anchor):
        met[fresh] = True
        assert scores.tolist() == (vectors[fresh] @ anchor).tolist()
        assert met.all() or (vectors[~met] @ anchor).max() <= threshold
    ids = np.arange(4000)[::-1].copy()
    (hits,) = search(lists, anchor, ids, np.ones(4000, bool), [(None, None)], 5)
    assert [place for place, _ in hits] == [39, 38, 37, 36, 35]


def test_a_settled_search_leaves_most_rows_unmet(monkeypatch):
    draw = np.random.default_rng(8)
    vectors = draw.integers(-20, 20, size=(4000, 6)).astype(float)
    vectors[:40] = [100, -100, 90, 0, 50, -70]
    met, descent = [], SortedLists.descent
    monkeypatch.setattr(SortedLists, "descent", lambda self, q: (met.append(len(step[0])) or step for step in descent(self, q)))
    search(SortedLists(vectors, 100), np.array([10.0, -9.0, 8.0, 0.0, 3.0, -5.0]), np.arange(4000), np.ones(4000, bool), [(None, None)], 5)
    assert sum(met) < 1000
