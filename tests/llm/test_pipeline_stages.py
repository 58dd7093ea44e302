import random

import pytest

import corpus_pipeline
from test_near_and_repeats import brute_fingerprint, components_of
from texts import SCHEMA, prose
from tradewind.operators.scratch import materialize


def representatives_of(texts):
    """Smallest ids of the components of fingerprints at most three bits apart, by comparing all pairs."""
    fps = {i: brute_fingerprint(t or "") for i, t in texts.items()}
    return set(components_of(fps, lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3).values())


@pytest.fixture(scope="module")
def corpus():
    """Clean texts, junk, exact and near copies, shared passages, and odd rows."""
    clean = {i: prose(120, i) for i in range(60)}
    junk = {100 + i: prose(120, 100 + i).replace(" ", "%%% ") for i in range(8)}
    copies = {200: clean[0], 201: clean[0], 202: clean[1]}
    words = clean[2].split()
    near = {300: " ".join(words[:-1] + ["changed"]), 301: " ".join(words + ["and"])}
    passage = prose(60, 999)
    shared = {400 + i: f"{prose(80, 500 + i)} {passage} {prose(80, 600 + i)}" for i in range(3)}
    odd = {700: None, 701: "", 702: "too short", 703: " \n "}
    return clean, junk, copies, near, shared, passage, odd


def test_each_stage_takes_effect(spark, corpus):
    clean, junk, copies, near, shared, passage, odd = corpus
    pairs = [p for part in (clean, junk, copies, near, shared, odd) for p in part.items()]
    random.Random(1).shuffle(pairs)
    rows = [(i, t, "en", f"s{i % 2}", None if t is None else len(t), None, "x", 7, 1) for i, t in pairs]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.columns
        docs = materialize(stage(spark, docs, ""), "stage")
        if name != "packing":
            assert docs.columns == before
            left[name] = {r["doc_id"]: r for r in docs.collect()}
    assert set(left["quality rules"]) == set(clean) | set(copies) | set(near) | set(shared)
    assert set(left["exact dedup"]) == set(left["quality rules"]) - {0, 200, 1}
    assert set(left["near dedup"]) == representatives_of({i: r["text"] for i, r in left["exact dedup"].items()})
    assert 300 not in left["near dedup"]
    texts = {i: r["text"] for i, r in left["repeated passages"].items()}
    assert set(texts) == set(left["near dedup"])
    assert passage in texts[400] and passage not in texts[401] and passage not in texts[402]
    assert all(texts[i] == clean[i] for i in clean if i in texts)
    assert all(r["n_chars"] == len(r["text"]) for r in left["repeated passages"].values())
    pieces = docs.collect()
    assert {p["doc_id"] for p in pieces} == set(texts)


def test_near_dedup_equals_brute_force(spark, make_docs):
    draw, pairs = random.Random(5), []
    for k in range(40):
        words = prose(draw.randint(30, 200), 700 + k).split()
        pairs.append((len(pairs), " ".join(words)))
        for edits in (1, 1, 2, 4):
            copy = list(words)
            for at in draw.sample(range(len(copy)), edits):
                copy[at] = f"w{draw.randrange(10**6)}"
            pairs.append((len(pairs), " ".join(copy)))
            words = copy if k % 3 == 0 else words  # chains of edits
    pairs += [(1000, None), (1001, ""), (1002, pairs[0][1].upper()), (1003, "one"), (1004, "one")]
    docs = make_docs(pairs)
    expected = representatives_of(dict(pairs))
    assert len(expected) < len(pairs) - 20
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == expected


def test_near_dedup_of_odd_rows(spark, make_docs, odd_pairs):
    """Nulls, empties and copies; an id with texts of two components keeps the text of its own."""
    left = corpus_pipeline.near_dedup(spark, make_docs(odd_pairs), "").collect()
    ids = [r["doc_id"] for r in left]
    assert {1, 3, 6, 7, 8} <= set(ids) and not {2, 4, 5} & set(ids) and ids.count(None) == 2
    a, b = prose(50, 41), prose(50, 42)
    split = corpus_pipeline.near_dedup(spark, make_docs([(1, a), (2, a), (2, b), (3, b)]), "").collect()
    assert sorted((r["doc_id"], r["text"]) for r in split) == [(1, a), (2, b)]


def test_stages_take_empty_tables_and_odd_rows(spark, make_docs, odd_pairs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, make_docs([]), "").count() == 0
    for name, stage in corpus_pipeline.STAGES[2:]:
        assert stage(spark, make_docs(odd_pairs), "").count() > 0
