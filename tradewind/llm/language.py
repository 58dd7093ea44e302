"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text becomes counts of the 2- and 3-grams of its lower-case letters' UTF-8 bytes, hashed into ``BINS``; the
counts' logarithms are weighted by inverse document frequency and brought to length one. Each language
has up to ``CLUSTERS`` centroids, found by spherical k-means; a text goes to the language of the
centroid with the largest cosine. Where even that is smaller than what the language's own texts
nearly always reach (the ``REJECTED`` quantile of the sample), the prediction is marked as
rejected, and the language stays the nearest one.

Document frequencies come from every labelled text that may be learned from, as 4096 sums. Centroids
are fitted on at most ``SAMPLE`` texts of a language, those with the smallest hashes of
id and text, repeated rows once: a bounded, documented sample, gathered per language in one task. Of more than ``LABELS`` labels
the most frequent are learned. The model is languages x CLUSTERS x BINS numbers, 16 KB a centroid; it goes to the tasks with the function that predicts.

Defined results: a null text, or one without letters, is ``und`` with score 0 and not rejected; rows
with a null label or a null id are predicted but not learned from; rows that repeat are predicted
alike; without any labelled text all predictions are ``und``; an empty table gives an
empty result; texts of any length are read whole, in stretches. Columns other than id, text and
label are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


BINS = 4096
CLUSTERS = 4
SAMPLE = 800
ROUNDS = 12
LABELS = 1_000
REJECTED = 0.001
STRETCH = 1 << 20
BATCH = 256


# Of ASCII only letters and white space, as blanks, take part: marks and digits tell no language.
BLANKS = bytes.maketrans(b"\t\n\x0b\x0c\r", b" " * 5)
MARKS = bytes(b for b in range(128) if not chr(b).isalpha() and chr(b) not in " \t\n\x0b\x0c\r")


def gram_counts(text: str) -> np.ndarray:
    """Counts of hashed byte 2- and 3-grams."""
    data = np.frombuffer(text.lower().encode().translate(BLANKS, MARKS), np.uint8).astype(np.uint32)
    counts = np.zeros(BINS, np.int64)
    for begin in range(0, len(data), STRETCH):
        part = data[begin : begin + STRETCH + 2]
        two = part[:-1] * np.uint32(256) + part[1:]
        three = two[:-1] * np.uint32(256) + part[2:] + np.uint32(1 << 24)
        own = two[:STRETCH], three[:STRETCH]  # grams that begin in this stretch
        codes = np.concatenate(own) * np.uint32(2654435761) >> np.uint32(20)
        counts += np.bincount(codes, minlength=BINS)
    return counts


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    found = np.log1p(np.stack([gram_counts(t) for t in texts])).astype(np.float32) * idf.astype(np.float32)
    return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), np.float32(1e-9))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass(frozen=True)
class Model:
    """Centroids in rows; their languages, and each one's least usual cosine."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    least: np.ndarray

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        result = [("und", 0.0, False)] * len(texts)
        usable = [i for i, t in enumerate(texts) if t is not None and has_letter(t)] if self.languages else []
        for begin in range(0, len(usable), BATCH):
            some = usable[begin : begin + BATCH]
            cosine = vectors([texts[i] for i in some], self.idf) @ self.centroids.T
            best = cosine.argmax(axis=1)
            for i, b, c in zip(some, best.tolist(), cosine.max(axis=1).tolist()):
                result[i] = (self.languages[b], min(1.0, max(0.0, c)), c < self.least[b])
        return result


def _cluster(rows: np.ndarray) -> np.ndarray:
    """Spherical k-means from centroids far from each other; deterministic."""
    chosen = [int((rows @ rows.mean(axis=0)).argmax())]
    while len(chosen) < min(CLUSTERS, len(rows)):
        chosen.append(int((rows @ rows[chosen].T).max(axis=1).argmin()))
    centroids = rows[chosen]
    for _ in range(ROUNDS):
        nearest = (rows @ centroids.T).argmax(axis=1)
        sums = np.stack([rows[nearest == k].sum(axis=0) if (nearest == k).any() else centroids[k] for k in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), np.float32(1e-9))
    return centroids


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts and, for each bin, of texts that fill it. ``texts`` has a column text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled, n = np.zeros(BINS, np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                filled += gram_counts(text) > 0
                n += 1
        if n:
            yield pa.RecordBatch.from_pydict({"bin": np.r_[-1, np.arange(BINS)], "n": np.r_[n, filled]})

    sums = texts.select("text").mapInArrow(count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    found = {row["bin"]: row["n"] for row in sums}
    return found.get(-1, 0), np.array([found.get(b, 0) for b in range(BINS)], np.float64)


def fit(labelled: DataFrame) -> Model:
    """Model of (id, text, label) rows, all of which may be learned from."""
    known = labelled.filter("id is not null and text is not null and label is not null")
    n, filled = document_frequencies(known)
    idf = np.log((1 + n) / (1 + filled)) + 0.05
    # One row per language, LABELS at most: broadcast, so that no text moves before it is drawn.
    counted = known.groupBy("label").agg(F.count("*").alias("n"))
    sizes = F.broadcast(counted.orderBy(F.desc("n"), "label").limit(LABELS))
    # About SAMPLE texts of each language by the hash of id and text, repeated rows once; the task then keeps the least SAMPLE.
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30))
    drawn = known.join(sizes, "label").withColumn("draw", draw).filter(F.col("draw") * F.col("n") < F.lit(1.3 * SAMPLE * (1 << 30)))
    drawn = drawn.groupBy("label", "id", "draw").agg(F.min("text").alias("text"))

    def centroids(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows[[has_letter(t) for t in rows["text"]]].sort_values(["draw", "id", "text"]).head(SAMPLE)
        if not len(rows):
            return pd.DataFrame({"label": [], "centroid": [], "least": []})
        points = vectors(rows["text"].tolist(), idf)
        found = _cluster(points)
        least = float(np.quantile((points @ found.T).max(axis=1), REJECTED))
        return pd.DataFrame({"label": rows["label"].iloc[0], "centroid": list(found), "least": least})

    fitted = drawn.select("id", "text", "label", "draw").groupBy("label")
    rows = fitted.applyInPandas(centroids, "label string, centroid array<float>, least double").collect()
    rows = sorted(rows, key=lambda r: r["label"])
    stack = np.array([r["centroid"] for r in rows], np.float32).reshape(len(rows), BINS)
    return Model(idf, stack, [r["label"] for r in rows], np.array([r["least"] for r in rows]))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score (cosine) and rejected for every row."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.predict(batch.column("text").to_pylist())
            language, score, rejected = zip(*found) if found else ((), (), ())
            columns = [batch.column("id"), pa.array(language, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "lang_pred", "score", "rejected"])

    return source.mapInArrow(apply, "id long, lang_pred string, score double, rejected boolean")


def held_out(id_col: str = "doc_id") -> Column:
    """True for a third of the ids, which are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """Learns from the rows that aren't held out and predicts all: id, held_out, lang_pred, score, rejected."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).alias("label"))
    model = fit(rows.filter(~held_out("id")))
    return predict(rows, model, "id", "text").withColumn("held_out", held_out("id"))
