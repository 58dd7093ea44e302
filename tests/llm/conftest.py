from __future__ import annotations

import pytest

from texts import SCHEMA, prose


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs; further columns clash with names used inside operators."""

    def build(pairs, lang="en", source="a"):
        rows = [(i, t, lang, source, None if t is None else len(t), None, "x", 7, 1) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA).repartition(3)

    return build


@pytest.fixture(scope="session")
def odd_pairs():
    """Nulls, empties, a long text, ties, copies and repeated rows."""
    long = prose(30_000, 1)
    return [
        (1, prose(80, 2)),
        (2, prose(80, 2)),
        (2, prose(80, 2)),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (None, prose(60, 3)),
        (None, None),
        (6, long),
        (7, "é" * 150 + " ß 日本語 😀\n" + prose(30, 4)),
        (8, "one"),
        (9, prose(80, 2) + " and one more"),
    ]
