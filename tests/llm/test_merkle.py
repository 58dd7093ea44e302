import collections
import hashlib

import pytest
from pyspark.sql import functions as F
from texts import prose

from tradewind.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    values = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[c] for c in FIELDS)]
    return digest("".join(values))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + 16])) for i in range(0, len(below), 16)])
    return levels


def path_of(levels, place):
    path = []
    for nodes in levels[:-1]:
        begin = place // 16 * 16
        run = nodes[begin : begin + 16]
        path.append(("".join(run[: place - begin]), "".join(run[place - begin + 1 :])))
        place //= 16
    return path


def brute(rows, altered):
    """Counted (id, leaf, subroot, root, proof, folded, verified) of each row."""
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r["source"]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        groups[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    trees = {s: levels_of([leaf_of(r) for r in groups[s]]) for s in names}
    top = levels_of([trees[s][-1][0] for s in names])
    root, found = top[-1][0], collections.Counter()
    for k, s in enumerate(names):
        for place, r in enumerate(groups[s]):
            path = path_of(trees[s], place) + path_of(top, k)
            node = leaf_of(altered(r))
            for left, right in path:
                node = digest(left + node + right)
            proof = digest("".join(a + b for a, b in path))
            found[(r["doc_id"], leaf_of(r), trees[s][-1][0], root, proof, node, node == root)] += 1
    return found


def check(docs):
    where = F.col("doc_id") % 3 == 0
    found = merkle.verified(docs, FIELDS, {"text": F.concat("text", F.lit("!"))}, where)
    columns = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert found.columns == columns

    def altered(r):
        touched = r["doc_id"] is not None and r["doc_id"] % 3 == 0 and r["text"] is not None
        return {**r, "text": r["text"] + "!"} if touched else r

    expected = brute([r.asDict() for r in docs.collect()], altered)
    assert collections.Counter(map(tuple, found.collect())) == expected
    return expected


def test_odd_rows_of_one_source(make_docs, odd_pairs):
    check(make_docs(odd_pairs))


def test_sources_of_all_depths(make_docs, spark):
    """1, 2, 16, 17, 256 and 257 rows and a source with most rows; more sources than one parent holds."""
    sizes = {None: 3, "": 1, "a": 1, "é": 2, "b": 16, "B": 17, "c": 256, "hot": 700, "d": 257} | {f"s{i}": 1 for i in range(12)}
    docs = make_docs([(i, f"text {i}") for i in range(sum(sizes.values()))])
    names = [s for s, n in sizes.items() for _ in range(n)]
    named = spark.createDataFrame(list(enumerate(names)), "doc_id long, name string")
    docs = docs.join(named, "doc_id").withColumn("source", F.col("name")).repartition(5)
    found = check(docs)
    assert len({row[2] for row in found}) == len(sizes) and {row[6] for row in found} == {True, False}


def test_many_equal_rows_keep_a_place_each(make_docs):
    check(make_docs([(7, "same")] * 90 + [(None, None)] * 40 + [(8, prose(50, 1))]))


def test_a_single_row_is_the_root(make_docs):
    (row,) = check(make_docs([(4, "alone")]))
    assert row[1] == row[2] == row[3] and row[4] == digest("")


def test_an_empty_table(make_docs):
    found = merkle.manifest(make_docs([]), FIELDS)
    assert found.root is None and found.rows.count() == 0 and found.subroots.count() == 0


def test_any_changed_field_is_seen(make_docs):
    docs = make_docs([(i, prose(20, i)) for i in range(20)])
    for column, value in [("lang", F.lit(None).cast("string")), ("n_chars", F.col("n_chars") + 1), ("source", F.lit("b"))]:
        rows = merkle.verified(docs, FIELDS, {column: value}, F.lit(True)).collect()
        assert not any(r["verified"] for r in rows)
    assert all(r["verified"] for r in merkle.verified(docs, FIELDS, {}, F.lit(True)).collect())


@pytest.mark.parametrize("parts", [1, 6])
def test_the_root_does_not_depend_on_partitions(make_docs, parts):
    docs = make_docs([(i % 50, prose(5, i)) for i in range(120)])
    assert merkle.manifest(docs.repartition(parts), FIELDS).root == merkle.manifest(docs, FIELDS).root
