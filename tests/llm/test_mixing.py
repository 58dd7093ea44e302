import collections
import hashlib
import random
import re

import pytest
from texts import prose

from tradewind.llm import mixing

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return len(WORD.findall(text or ""))


def key_of(i, text):
    joined = ":".join([("" if i is None else str(i)), *([] if text is None else [text])])
    return int(hashlib.sha256(joined.encode()).hexdigest()[:15], 16)


def target_of(rows, weights, most, share=1.0):
    """Target per source by the rule's own words: cap whatever is above, share out again."""
    own = collections.Counter()
    for _, text, source in rows:
        own[source] += words(text)
    names = sorted(own, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    free, fixed = set(names), {}
    while True:
        rest = sum(own.values()) * share - sum(fixed.values())
        total = sum(weight[s] for s in free)
        parts = {s: rest * weight[s] / total for s in free}
        above = {s for s in free if parts[s] > most * own[s]}
        if not above:
            return own, parts | {s: float(v) for s, v in fixed.items()}
        fixed |= {s: most * own[s] for s in above}
        free -= above


def brute(rows, weights, most, share=1.0):
    """Counted (id, size, source_size, target, taken): documents in the order of their hash, one by one."""
    own, target = target_of(rows, weights, most, share)
    found = collections.Counter()
    for source in own:
        times = int(target[source] // own[source]) if own[source] else 0
        budget, used = target[source] - times * own[source], 0
        for i, text in sorted(((i, t) for i, t, s in rows if s == source), key=lambda r: key_of(*r)):
            size = words(text)
            extra = 2 * used + size <= 2 * budget
            used += size
            found[(i, size, own[source], target[source], size * (times + extra))] += 1
    return found


def table(spark, rows, parts=4):
    """Documents beside columns whose names the operator uses itself."""
    schema = "doc_id long, text string, source string, size long, skey string, hash int"
    return spark.createDataFrame([(i, t, s, 1, "x", 2) for i, t, s in rows], schema).repartition(parts)


def check(spark, rows, weights=(1, 2, 3), most=3, share=1.0):
    found = mixing.mixed(table(spark, rows), weights, most, share)
    assert found.columns == ["id", "size", "source_size", "target", "taken"]
    rows_found = collections.Counter(map(tuple, found.collect()))
    assert rows_found == brute(rows, weights, most, share)
    return rows_found


SIZES = {"hot": 400, "a": 30, "tiny": 2, None: 25, "é": 20, "b": 1, "": 9, "z": 60}


def sources(seed=3):
    draw = random.Random(seed)
    return [(k * 1000 + j, prose(draw.randint(1, 40), k * 1000 + j), s) for k, (s, n) in enumerate(SIZES.items()) for j in range(n)]


@pytest.mark.parametrize("weights,most", [((1, 2, 3), 3), ((1,), 1.0), ((5, 1), 2), ((1, 2, 3), 100)])
def test_mix_equals_documents_taken_one_by_one(spark, weights, most):
    check(spark, sources(), weights, int(most))


def test_sums_come_within_half_a_document_of_the_targets(spark):
    rows = sources()
    found = mixing.mixed(table(spark, rows)).collect()
    by = collections.defaultdict(lambda: [0, 0.0, 0])
    source = {i: s for i, _, s in rows}
    for r in found:
        by[source[r["id"]]][0] += r["taken"]
        by[source[r["id"]]][1] = r["target"]
        by[source[r["id"]]][2] = max(by[source[r["id"]]][2], r["size"])
        assert r["taken"] <= 3 * r["size"]
    assert all(2 * abs(taken - target) <= largest for taken, target, largest in by.values())
    assert by["tiny"][1] == 3 * sum(words(t) for _, t, s in rows if s == "tiny") == by["tiny"][0]


def test_odd_rows(spark, odd_pairs):
    known = [(i, t, s) for k, (i, t) in enumerate(odd_pairs) for s in ["a", None, "b"][k % 3 : k % 3 + 1]]
    found = mixing.mixed(table(spark, known)).collect()
    assert collections.Counter((r["id"], r["size"]) for r in found) == collections.Counter((i, words(t)) for i, t, _ in known)
    assert all(r["taken"] in {k * r["size"] for k in range(4)} for r in found)


def test_equal_rows_fill_the_budget_by_their_number(spark):
    rows = [(5, "one two three", "a")] * 200 + [(i, prose(30, i), "b") for i in range(60)] + [(None, None, "c"), (None, "", None)]
    rows += [(None, "four words in all", "a")] * 100
    first = collections.Counter(map(tuple, mixing.mixed(table(spark, rows, 2)).collect()))
    assert first == collections.Counter(map(tuple, mixing.mixed(table(spark, rows, 7)).collect()))
    own, target = target_of(rows, (1, 2, 3), 3)
    taken = sum(k[4] * n for k, n in first.items() if k[2] == own["a"])
    assert abs(taken - target["a"]) <= 2


def test_mixes_of_smaller_budgets_are_nested(spark):
    docs = table(spark, sources())
    taken = [{r["id"]: r["taken"] for r in mixing.mixed(docs, share=share).collect()} for share in (0.1, 0.4, 1.0, 2.0)]
    assert all(few[i] <= more[i] for few, more in zip(taken, taken[1:]) for i in few)
    check(spark, sources(), share=0.4)


def test_tables_without_words_or_rows(spark):
    empty = [(1, None, "a"), (2, " \n", None)]
    assert [tuple(r) for r in mixing.mixed(table(spark, empty)).orderBy("id").collect()] == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mixing.mixed(table(spark, empty).limit(0)).count() == 0


def test_a_single_long_document(spark):
    check(spark, [(1, prose(30_000, 1), "a"), (2, prose(10, 2), "b"), (3, prose(10, 3), "b")])
