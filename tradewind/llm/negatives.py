"""Hard negatives: vectors that score almost as high with an anchor as one of its positives, but are labelled otherwise.

Fagin's threshold algorithm, in shards. The candidates are dealt out by a hash of their rows; a shard holds, for
every dimension, its rows sorted by that component. For an anchor, sorted access goes down each list from the end that
the sign of the anchor's component favours. Every row met is scored at once by random access, as an integer inner
product. The components at the depth reached, multiplied with the anchor's, add up to the threshold: no row not met
yet scores higher. A search is over once the threshold is strictly below the k-th score of each of its windows, so that
rows that tie with it have been met too, or below what the windows still admit.

Two rounds. The first has one window per anchor, the rows of its own label, and gives the positives. The second
has one window per positive: other labels, between a share of its score and its score. Each shard returns its
first k of a window, and the shards' rows are ranked once more by window.

Anchors meet shards in blocks: an anchor is sent to every shard once, a shard to every block of anchors once, never
pairs of rows. A shard holds about ``SHARD_ROWS`` rows at most and a block ``BLOCK`` anchors, whatever their numbers, and
a group has one of each. Labels and common vectors play no part in how rows are dealt, so a third of all
rows alike are spread like any others; they tie, and ties end by id within each shard's own k.

Defined results: rows without a label or vector, or with a null, NaN or infinite component, take no part. Components
become ``floor(scale * x)``; rows with one beyond 2**53, where doubles are no longer whole numbers, take no part either. Vectors shorter than the longest count as if filled up with zeros. A row without an id is no anchor
and comes after all ids in ties. Rows that repeat an id are rows of their own: as anchors, each has its own
result, and as candidates, each takes a place. Without rows of another label in a window there is no row for it; an
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.operators.scratch import materialize

SHARD_ROWS = 16_384
LEAST_SHARD = 32  # rows; more shards than this allows would only be empty
BLOCK = 4_096  # anchors
FIRST_DEPTH = 8  # of sorted access; each further step goes four times as deep
EXACT_FLOAT, EXACT_DOUBLE, EXACT_LONG = 1 << 24, 1 << 53, 1 << 63
LARGEST = 1 << 53  # whole components beyond it are not told apart by doubles
NO_ID = (1 << 63) - 1


class SortedLists:
    """One shard: its rows as integers and, per dimension, their places sorted by component."""

    def __init__(self, vectors: np.ndarray, largest: int):
        order = np.argsort(vectors, axis=0, kind="stable")
        kind = _kind(vectors.shape[1], largest)
        self.vectors = _as(vectors, kind)
        self.order = np.ascontiguousarray(order.T)
        self.sorted = _as(np.ascontiguousarray(np.take_along_axis(vectors, order, axis=0).T), kind)

    def descent(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Deeper and deeper: places met for the first time, their scores, and the threshold for all others."""
        n, q = len(self.vectors), _as(anchor, self.vectors.dtype)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        met = np.zeros(n, bool)
        begin, depth = 0, FIRST_DEPTH
        while begin < n and not met.all():
            end = min(depth, n)
            reached = np.zeros(n, bool)
            reached[self.order[up, n - end : n - begin]] = True
            reached[self.order[down, begin:end]] = True
            if not len(up) and not len(down):
                reached[:] = True  # a zero vector scores 0 with every row
            fresh = np.flatnonzero(reached & ~met)
            met |= reached
            threshold = (self.sorted[up, n - end] * q[up]).sum() + (self.sorted[down, end - 1] * q[down]).sum()
            yield fresh, _whole(self.vectors[fresh] @ q), int(threshold)
            begin, depth = end, depth * 4


def _kind(width: int, largest: int) -> type:
    """The fastest type in which no inner product of such components loses a digit."""
    bound = width * largest * largest
    return np.float32 if bound < EXACT_FLOAT else np.float64 if bound < EXACT_DOUBLE else np.int64 if bound < EXACT_LONG else object


def _as(values: np.ndarray, kind: type) -> np.ndarray:
    return values.astype(np.int64).astype(object) if kind is object or kind == np.dtype(object) else values.astype(kind)


def _whole(scores: np.ndarray) -> np.ndarray:
    return scores if scores.dtype == object else scores.astype(np.int64)


def _kth(scores: np.ndarray, k: int) -> int:
    """The k-th highest of at least k scores."""
    return np.sort(scores)[len(scores) - k] if scores.dtype == object else np.partition(scores, len(scores) - k)[len(scores) - k]


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> list[int]:
    """Places of the k highest scores, ties by smaller id."""
    places = np.flatnonzero(scores >= _kth(scores, k)) if len(scores) > k else np.arange(len(scores))
    return sorted(places.tolist(), key=lambda i: (-scores[i], ids[i]))[:k] if len(places) <= 4 * k else _first_of_ties(scores, ids, places, k)


def _first_of_ties(scores: np.ndarray, ids: np.ndarray, places: np.ndarray, k: int) -> list[int]:
    """As above where very many scores tie: at most k - 1 are above the k-th, the rest is ordered by id alone."""
    least = scores[places].min()
    above = places[scores[places] > least]
    tied = places[scores[places] == least]
    tied = tied[np.argpartition(ids[tied], k - 1)[:k]]
    return sorted([*above.tolist(), *tied.tolist()], key=lambda i: (-scores[i], ids[i]))[:k]


Range = tuple[int | None, int | None]  # lowest and highest score; the first round's has no ends


def _inside(scores: np.ndarray, window: Range) -> np.ndarray:
    """Places of the scores in a window."""
    low, high = window
    return np.arange(len(scores)) if low is None else np.flatnonzero((scores >= low) & (scores <= high))


def _settled(scores: np.ndarray, threshold: int, window: Range, k: int) -> bool:
    low, high = window
    if low is not None and (high < low or threshold < low):
        return True
    inside = scores[_inside(scores, window)]
    return len(inside) >= k and threshold < _kth(inside, k)


def search(lists: SortedLists, anchor: np.ndarray, ids: np.ndarray, admitted: np.ndarray, windows: list[Range], k: int) -> list[list[tuple[int, int]]]:
    """Of each window the first k admitted rows as (place, score); stops at the threshold."""
    places, scores = [np.empty(0, np.int64)], [np.empty(0, _whole(lists.vectors[:0, :1].sum(axis=1)).dtype)]
    for fresh, found, threshold in lists.descent(anchor):
        own = admitted[fresh]
        places.append(fresh[own])
        scores.append(found[own])
        places, scores = [np.concatenate(places)], [np.concatenate(scores)]
        if all(_settled(scores[0], threshold, window, k) for window in windows):
            break
    results = []
    for window in windows:
        inside = _inside(scores[0], window)
        where, points = places[0][inside], scores[0][inside]
        results.append([(int(where[i]), int(points[i])) for i in _first(points, ids[where], k)] if len(inside) else [])
    return results


def integers(rows: DataFrame, embedding: Column, label: Column, vec_id: Column, anchor: Column, scale: int) -> DataFrame:
    """Stored (row, vec_id, label, vector, anchor) of the rows that take part; ``row`` tells repeated ids apart."""
    whole = F.transform(embedding.cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))).cast("double"))
    sound = F.forall(embedding.cast("array<double>"), lambda x: x.isNotNull() & (F.abs(x) <= LARGEST / scale))
    used = rows.filter(label.isNotNull() & embedding.isNotNull() & sound).select(
        F.monotonically_increasing_id().alias("row"),
        vec_id.cast("long").alias("vec_id"),
        label.cast("string").alias("label"),
        whole.alias("vector"),
        F.coalesce(anchor & vec_id.isNotNull(), F.lit(False)).alias("anchor"),
    )
    return materialize(used, "integer-vectors")


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for place, vector in enumerate(vectors):
        out[place, : len(vector)] = vector
    return out


class Miner:
    """The two rounds over one table of integer vectors."""

    def __init__(self, vectors: DataFrame, positives: int, negatives: int, low_percent: int):
        self.vectors, self.positives, self.negatives, self.low_percent = vectors, positives, negatives, low_percent
        size = F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", F.abs)))
        facts = vectors.agg(F.count("*").alias("n"), F.count_if("anchor").alias("anchors"), size[0].alias("width"), size[1].alias("largest")).first()
        self.width, self.largest = max(1, facts["width"] or 0), int(facts["largest"] or 0)
        parallel = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.shards = max(1, -(-facts["n"] // SHARD_ROWS), min(parallel, facts["n"] // LEAST_SHARD))
        self.blocks = max(1, -(-facts["anchors"] // BLOCK))

    def _meet(self, anchors: DataFrame, windows_of, admitted, k: int) -> DataFrame:
        """(anchor_row, window, vec_id, score): each shard's first k rows of each window of each anchor."""
        width, largest = self.width, self.largest

        def task(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
            found = []
            if len(shard) and len(block):
                lists = SortedLists(_matrix(shard["vector"], width), largest)
                ids = shard["vec_id"].fillna(NO_ID).astype("int64").to_numpy()
                known, rows, labels = shard["vec_id"].notna().to_numpy(), shard["row"].to_numpy(), shard["label"].to_numpy()
                block = block.rename(columns=lambda c: c.removeprefix("a_"))
                for anchor, vector in zip(block.to_dict("records"), _matrix(block["vector"], width)):
                    windows = windows_of(anchor)
                    each = search(lists, vector, ids, admitted(anchor, rows, labels), windows, k)
                    found += [
                        (anchor["row"], number, ids[place] if known[place] else None, str(score))
                        for number, hits in enumerate(each, 1)
                        for place, score in hits
                    ]
            return pd.DataFrame(found, columns=["anchor_row", "window", "vec_id", "score"]).astype({"vec_id": "Int64"})

        def numbers(n: int) -> Column:
            return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

        def dealt(n: int) -> Column:
            return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

        candidates = self.vectors.select("row", "vec_id", "label", "vector", dealt(self.shards).alias("shard"), numbers(self.blocks).alias("block"))
        # Both sides come from one table; new names keep its columns apart.
        sent = anchors.select(
            *[F.col(c).alias(f"a_{c}") for c in anchors.columns],
            dealt(self.blocks).alias("a_block"),
            numbers(self.shards).alias("a_shard"),
        )
        pairs = candidates.groupBy("shard", "block").cogroup(sent.groupBy("a_shard", "a_block"))
        found = pairs.applyInPandas(lambda a, b: task(a, b), "anchor_row long, window int, vec_id long, score string")
        return found.withColumn("score", F.col("score").cast("decimal(38,0)"))

    def _ranked(self, found: DataFrame, k: int) -> DataFrame:
        order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last()]
        place = F.row_number().over(Window.partitionBy("anchor_row", "window").orderBy(*order))
        return found.withColumn("rank", place).filter(F.col("rank") <= k)

    def mined(self) -> DataFrame:
        anchors = self.vectors.filter("anchor").drop("anchor")
        same = self._meet(
            anchors, lambda anchor: [(None, None)], lambda a, rows, labels: (labels == a["label"]) & (rows != a["row"]), self.positives
        )
        positives = materialize(
            self._ranked(same, self.positives).select(
                "anchor_row", F.col("rank").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
            ),
            "positives",
        )
        # The best k of an anchor: a handful of rows in order of their rank.
        by_anchor = positives.groupBy(F.col("anchor_row").alias("row")).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("window", "positive_score"))), lambda p: p["positive_score"]).alias("scores")
        )
        low = self.low_percent

        def windows_of(anchor) -> list[Range]:
            return [(-(-low * int(s) // 100), int(s)) for s in anchor["scores"]]

        others = self._meet(anchors.join(by_anchor, "row"), windows_of, lambda a, rows, labels: labels != a["label"], self.negatives)
        ids = anchors.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
        negatives = self._ranked(others, self.negatives).withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
        return negatives.join(positives, ["anchor_row", "window"]).join(ids, "anchor_row").drop("anchor_row", "window")


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    label: Column | None = None,
    id_col: str = "vec_id",
    embedding_col: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    low_percent: int = 80,
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Anchors are the rows for which ``anchor`` holds. Their positives are their first ``positives`` other rows of the same
    ``label``, and for each, the result has the first ``negatives`` rows of other labels that score at least
    ``low_percent`` percent of the positive and no more than it.
    """
    label = F.col("label") if label is None else label
    vectors = integers(rows, F.col(embedding_col), label, F.col(id_col), anchor, scale)
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Miner(vectors, positives, negatives, low_percent).mined().select(*columns)
