import hashlib
import random

import numpy as np
import pytest
import xxhash

import tradewind.llm.repeats as repeats
from texts import prose
from tradewind.llm import simhash
from tradewind.llm.components import connected_components


def components_of(nodes, near):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and near(a, b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {n: root(n) for n in nodes}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200), (None, 3), (5, 4), (4, 5)]
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == dict.fromkeys(range(41), 0) | dict.fromkeys(range(100, 130), 100)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("distance, blocks, compared", [(3, 6, 1000), (3, 6, 3), (2, 4, 2), (6, 9, 1000)])
def test_links_join_all_fingerprints_within_the_distance(spark, distance, blocks, compared):
    draw = random.Random(distance)
    fps = {draw.getrandbits(64) for _ in range(60)}
    for start in list(fps)[:12]:
        for _ in range(12):
            fp = start
            for _ in range(draw.randint(1, distance + 1)):
                fp ^= 1 << draw.randrange(64)
            fps.add(fp)
            start = draw.choice([start, fp])
    fps = sorted(fps)
    rows = [(int(np.uint64(fp).view(np.int64)), i) for i, fp in enumerate(fps)]
    links = simhash.links(spark.createDataFrame(rows, "fp long, id long"), distance, blocks, compared)
    near = lambda a, b: (fps[a] ^ fps[b]).bit_count() <= distance
    assert all(near(r["u"], r["v"]) for r in links.collect())
    found = {r["node"]: r["root"] for r in connected_components(links).collect()}
    expected = components_of(range(len(fps)), near)
    assert {n: found.get(n, n) for n in expected} == expected


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(monkeypatch):
    texts = ["", "One", "one two", "A b C d e", "É x\x1cy z w", prose(500, 1), " \t"]
    expected = [brute_fingerprint(t) for t in texts]
    assert simhash.fingerprints_of([t.encode() for t in texts]).tolist() == expected
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 7)
    assert simhash.fingerprints_of([t.encode() for t in texts]).tolist() == expected


def test_near_duplicates_of_odd_rows(make_docs, odd_pairs):
    docs = make_docs(odd_pairs)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(odd_pairs)
    texts = {i: t or "" for i, t in odd_pairs if i is not None}
    fps = {i: brute_fingerprint(t) for i, t in texts.items() if i != 6}
    by_id = {r["id"]: r for r in rows if r["id"] is not None}
    assert all(np.int64(by_id[i]["fp"]).view(np.uint64) == fp for i, fp in fps.items())
    assert {by_id[i]["component_id"] for i in (3, 4, 5)} == {3} and {by_id[i]["component_id"] for i in (1, 2)} == {1}
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns and {1, 3, 6} <= {r["doc_id"] for r in kept.collect()}
    assert simhash.near_duplicates(make_docs([])).count() == 0 and simhash.representatives(make_docs([])).count() == 0


def brute_repeats(pairs):
    """Covered bytes by (id, text), by definition."""
    seen, covered = {}, {}
    for i, t in sorted(set(pairs), key=lambda p: p[0]):
        data = (t or "").encode()
        cover = bytearray(len(data))
        for s in range(len(data) - 99):
            window = data[s : s + 100]
            if seen.setdefault(window, (i, s)) != (i, s):
                cover[s : s + 100] = b"\1" * 100
        covered[i] = (data, cover)
    return covered


@pytest.fixture
def passages():
    shared, other = prose(40, 50), prose(35, 51)
    pairs = [(i, f"{prose(30, i)} {shared} {prose(10 + i, 100 + i)}") for i in range(12)]
    pairs += [(20, other + "\n" + other), (21, "a" * 350), (22, "x" * 99), (23, "é" * 120 + other), (24, None), (25, "")]
    pairs += [(26, shared[:99]), (27, shared[3:105]), (28, prose(30, 3)), (20, other + "\n" + other)]
    return pairs


@pytest.mark.parametrize("crowd, windows, stretch", [(1_000_000, 2_000_000, 1 << 18), (3, 300, 150)])
def test_repeats_equal_the_definition(make_docs, passages, monkeypatch, crowd, windows, stretch):
    for name, value in (("CROWD", crowd), ("WINDOWS", windows), ("STRETCH", stretch)):
        monkeypatch.setattr(repeats, name, value)
    docs = make_docs(passages)
    expected = brute_repeats(passages)
    rows = repeats.removal_report(docs).collect()
    assert len(rows) == len(passages)
    for r in rows:
        data, cover = expected[r["id"]]
        left = bytes(b for b, c in zip(data, cover) if not c)
        spans = sum(c and not (k and cover[k - 1]) for k, c in enumerate(cover))
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(data), sum(cover), spans)
        assert r["kept_sha256"] == hashlib.sha256(left).hexdigest()
    cut = repeats.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(passages)
    for r in cut.collect():
        data, cover = expected[r["doc_id"]]
        left = bytes(b for b, c in zip(data, cover) if not c)
        if r["doc_id"] != 23:
            assert (r["text"] or "").encode() == left
    assert {r["doc_id"]: r["text"] for r in cut.collect()}[24] is None


def test_repeats_of_odd_rows(make_docs, odd_pairs):
    rows = repeats.removal_report(make_docs(odd_pairs)).collect()
    assert len(rows) == len(odd_pairs)
    by_id = {r["id"]: r for r in rows if r["id"] is not None}
    assert by_id[1]["n_removed"] == 0 and by_id[2]["n_removed"] == by_id[2]["n_bytes"]
    assert repeats.removal_report(make_docs([])).count() == 0 and repeats.without_repeats(make_docs([])).count() == 0
