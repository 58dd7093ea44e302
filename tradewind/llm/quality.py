"""Quality rules: base rules on a text's words, then robust multivariate outliers.

Statistics of every whole text become a vector (logarithm of the mean word length; square roots of
the shares of symbols, capitals, repeated lines and repeated words). Per language and source the
minimum covariance determinant estimates say what is usual: from a start at medians and quartile
ranges, concentration steps keep the ``CORE`` share of texts that lie closest and take mean and
covariance of these alone, until junk no longer shapes the estimate. A text is rejected when its
squared Mahalanobis distance, scaled so that the core's edge is where it is for normal data, is
beyond ``CUT``.

Cells with fewer than ``LEAST`` texts use the estimates of their language, languages with fewer
those of all texts. The vectors are whole numbers (1/256 units), their sums exact, and distances are
cut into fine classes before they are ranked, so the outcome doesn't depend on how rows
are spread. Each step reads narrow rows and combines before it shuffles; a hot source
is a few hundred counted classes.

Defined results: a text without words, null or empty, fails the base rules; null languages
and sources are cells of their own; rows that repeat are judged each, alike; an empty table gives
an empty result; texts of any length are read whole. Columns other than id, text, language and
source are passed on untouched where whole rows are returned.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.operators.scratch import materialize

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "".join(chr(c) for c in [*range(65, 91), *range(0xC0, 0xD7), *range(0xD8, 0xDF)])
UNIT = 256  # vector units in 1
FEATURES = ["word_length", "symbols", "capitals", "dup_lines", "repeats"]
P = len(FEATURES)
# Least standard deviations: what hardly a text varies in, as repeats that most lack, must not reject for little, but
# each statistic's extreme must be able to reject by itself: where no other text repeats any, from about half of
# the lines or a third of the words on.
FLOORS = [f * UNIT for f in (0.07, 0.04, 0.06, 0.13, 0.10)]
CORE = 0.75
STEPS = 5
LEAST = 200
TAIL = 1e-5  # share of normal data beyond the cut
CLASSES = 256  # distance classes for each doubling
FEWEST_WORDS, MOST_REPEATED = 50, 50  # base rules: words, percent


def chi_square_quantile(share: float, freedom: int) -> float:
    """Wilson and Hilferty's approximation."""
    ninth = 2 / (9 * freedom)
    return freedom * (1 - ninth + NormalDist().inv_cdf(share) * math.sqrt(ninth)) ** 3


EDGE, CUT = chi_square_quantile(CORE, P), chi_square_quantile(1 - TAIL, P)


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def text_statistics(docs: DataFrame, text: Column) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines and n_capitals."""
    words = F.array_remove(F.split(F.col("_text"), r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split(F.col("_text"), "\n"), lambda line: _without(line, SPACE) > 0)
    step1 = docs.withColumn("_text", F.coalesce(text, F.lit(""))).withColumns({"_words": words, "_lines": lines})
    length = F.length("_text")
    last = F.size("_words") - 3
    # Hash and place of each window of three words, sorted: equal windows become neighbours.
    window = lambda i: F.struct(
        F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("i")
    )
    windows = F.array_sort(F.transform(F.sequence(F.lit(0), last), window))
    step2 = step1.select(
        *docs.columns,
        F.size("_words").cast("long").alias("n_words"),
        _without(F.col("_text"), SPACE).cast("long").alias("word_chars"),
        (length - _without(F.col("_text"), SYMBOLS)).cast("long").alias("n_symbols"),
        (length - _without(F.col("_text"), CAPITALS)).cast("long").alias("n_capitals"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(last >= 0, windows).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("_windows"),
    )
    twice = F.filter(
        "_windows",
        lambda w, k: F.coalesce(w["h"] == F.get("_windows", k - 1)["h"], F.lit(False))
        | F.coalesce(w["h"] == F.get("_windows", k + 1)["h"], F.lit(False)),
    )
    covered = F.flatten(F.transform(twice, lambda w: F.array(w["i"], w["i"] + 1, w["i"] + 2)))
    return step2.withColumn("n_repeat_words", F.size(F.array_distinct(covered)).cast("long")).drop("_windows")


def _vector() -> dict[str, Column]:
    def root(part: str, whole: str) -> Column:
        return F.sqrt(F.col(part) / F.greatest(F.col(whole), F.lit(1)))

    values = [
        F.ln(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
        root("n_symbols", "word_chars"),
        root("n_capitals", "word_chars"),
        root("n_dup_lines", "n_lines"),
        root("n_repeat_words", "n_words"),
    ]
    return {name: F.rint(v * UNIT).cast("long") for name, v in zip(FEATURES, values)}


def _members(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cells with the group whose estimates they use, vectors by each group they shape)."""
    sound = rows.filter(~F.col("base_failed"))
    cells = sound.groupBy("lang_key", "cell").agg(F.count("*").alias("n"))
    of_lang = cells.groupBy("lang_key").agg(F.sum("n").alias("lang_n"), F.min("n").alias("least_n"))
    sized = cells.join(of_lang, "lang_key")
    lang_group = F.concat(F.lit("lang:"), F.col("lang_key"))
    group = (
        F.when(F.col("n") >= LEAST, F.concat(F.lit("cell:"), F.col("cell")))
        .when(F.col("lang_n") >= LEAST, lang_group)
        .otherwise("all")
    )
    cells = materialize(sized.withColumn("group", group), "quality-cells")
    small_langs = cells.filter("group = 'all'").isEmpty()
    shapes = F.array_compact(
        F.array(
            F.when(F.col("n") >= LEAST, F.col("group")),
            F.when((F.col("least_n") < LEAST) & (F.col("lang_n") >= LEAST), lang_group),
            F.when(F.lit(not small_langs), F.lit("all")),
        )
    )
    shaping = cells.select("cell", F.explode(shapes).alias("group"))
    vectors = sound.select("cell", *FEATURES).join(shaping, "cell").select("group", *FEATURES)
    return cells.select("cell", "group"), materialize(vectors, "quality-vectors")


def _quantiles(vectors: DataFrame) -> DataFrame:
    """Start: median as mean and the quartile range as spread, exact from counted values."""
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f).alias("x")) for k, f in enumerate(FEATURES)])
    counted = vectors.select("group", F.inline(pairs)).groupBy("group", "k", "x").agg(F.count("*").alias("n"))
    along = Window.partitionBy("group", "k").orderBy("x")
    whole = Window.partitionBy("group", "k")
    ranked = counted.select("group", "k", "x", F.sum("n").over(along).alias("upto"), F.sum("n").over(whole).alias("all_n"))
    at = {q: F.min(F.when(F.col("upto") >= q * F.col("all_n"), F.col("x"))) for q in (0.25, 0.5, 0.75)}
    floor = F.get(F.array(*map(F.lit, FLOORS)), F.first("k"))
    spread = F.greatest((at[0.75] - at[0.25]) / 1.349, floor)
    found = ranked.groupBy("group", "k").agg(at[0.5].cast("double").alias("centre"), (1 / (spread * spread)).alias("weight"))
    rows = found.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("k", "centre", "weight"))).alias("s"))
    inverse = F.array(*[F.get("s", F.lit(i))["weight"] if i == j else F.lit(0.0) for i in range(P) for j in range(P)])
    return rows.select("group", F.transform("s", lambda s: s["centre"]).alias("mean"), inverse.alias("inverse"))


def _inverse(matrix: Column) -> Column:
    """Inverse of a positive definite P x P matrix as a flat array, by Gauss and Jordan's in-place steps."""

    def eliminate(m: Column, k: Column) -> Column:
        pivot = F.get(m, k * P + k)

        def entry(x: Column) -> Column:
            i, j = F.floor(x / P).cast("int"), x % P
            row, column = F.get(m, k * P + j), F.get(m, i * P + k)
            return (
                F.when((i == k) & (j == k), 1 / pivot)
                .when(i == k, row / pivot)
                .when(j == k, -column / pivot)
                .otherwise(F.get(m, x) - column * row / pivot)
            )

        return F.transform(F.sequence(F.lit(0), F.lit(P * P - 1)), entry)

    return F.aggregate(F.sequence(F.lit(0), F.lit(P - 1)), matrix, eliminate)


def _distance() -> Column:
    off = [F.col(f) - F.get("mean", F.lit(i)) for i, f in enumerate(FEATURES)]
    terms = [F.get("inverse", F.lit(i * P + j)) * off[i] * off[j] * (1 if i == j else 2) for i in range(P) for j in range(i + 1)]
    return sum(terms[1:], terms[0])


def _class(distance: Column) -> Column:
    return F.floor(F.log2(1 + F.greatest(distance, F.lit(0.0))) * CLASSES).cast("int")


def _edges(vectors: DataFrame, estimates: DataFrame) -> DataFrame:
    """Per group the class that the closest CORE share of its texts reaches."""
    classed = vectors.join(estimates, "group").select("group", _class(_distance()).alias("class"))
    counted = classed.groupBy("group", "class").agg(F.count("*").alias("n"))
    along, whole = Window.partitionBy("group").orderBy("class"), Window.partitionBy("group")
    ranked = counted.select("group", "class", F.sum("n").over(along).alias("upto"), F.sum("n").over(whole).alias("all_n"))
    return ranked.groupBy("group").agg(F.min(F.when(F.col("upto") >= CORE * F.col("all_n"), F.col("class"))).alias("edge"))


def _concentrate(vectors: DataFrame, estimates: DataFrame) -> DataFrame:
    """One step: mean and inverse covariance of the texts up to the edge."""
    placed = vectors.join(estimates.join(_edges(vectors, estimates), "group"), "group")
    core = placed.filter(_class(_distance()) <= F.col("edge"))
    sums = [F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES)]
    products = [
        F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"s{i}{j}") for i in range(P) for j in range(i + 1)
    ]
    total = core.groupBy("group").agg(F.count("*").alias("n"), *sums, *products)
    mean = [F.col(f"s{i}") / F.col("n") for i in range(P)]

    def covariance(i: int, j: int) -> Column:
        i, j = max(i, j), min(i, j)
        value = F.col(f"s{i}{j}") / F.col("n") - mean[i] * mean[j]
        return value + F.lit(FLOORS[i] ** 2) if i == j else value

    matrix = F.array(*[covariance(i, j) for i in range(P) for j in range(P)])
    return total.select("group", F.array(*mean).alias("mean"), matrix.alias("matrix")).select(
        "group", "mean", _inverse(F.col("matrix")).alias("inverse")
    )


def _cell(lang_col: str, source_col: str) -> Column:
    """Language and source as one text, nulls included."""
    return F.to_json(F.struct(F.col(lang_col).alias("l"), F.col(source_col).alias("s")))


def judged(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """id, twin (a hash of the text), cell (language and source), the statistics, base_failed, distance (NULL where
    base_failed) and kept, per row."""
    text = F.col(text_col)
    source = docs.select(
        F.col(id_col).alias("id"),
        text.alias("text"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("twin"),
        F.to_json(F.struct(F.col(lang_col).alias("l"))).alias("lang_key"),
        _cell(lang_col, source_col).alias("cell"),
    )
    measured = text_statistics(source, F.col("text")).drop("text")
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = materialize(measured.withColumn("base_failed", failed).withColumns(_vector()), "text-statistics")
    cells, vectors = _members(rows)
    estimates = materialize(_quantiles(vectors), "estimates")
    for _ in range(STEPS):
        estimates = materialize(_concentrate(vectors, estimates), "estimates")
    final = materialize(estimates.join(_edges(vectors, estimates), "group"), "estimates")
    edge = F.pow(F.lit(2.0), (F.col("edge") + 1) / CLASSES) - 1
    scale = F.lit(EDGE) / F.greatest(edge, F.lit(EDGE))  # floors can pull the edge in: never enlarged for that
    known = rows.join(cells.join(final, "group"), "cell", "left")
    distance = F.when(~F.col("base_failed"), _distance() * scale)
    return known.withColumn("distance", distance).select(
        "id",
        "twin",
        "cell",
        *["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance"],
        (~F.col("base_failed") & (F.col("distance") <= CUT)).alias("kept"),
        *FEATURES,
    )


def accepted(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """The rows that pass, with all their columns."""
    passed = judged(docs, id_col, text_col, lang_col, source_col).filter("kept")
    keys = passed.select(F.col("id").alias("_tw_id"), F.col("twin").alias("_tw_twin"), F.col("cell").alias("_tw_of")).distinct()
    hashed = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    marked = docs.withColumns({"_tw_hash": hashed, "_tw_cell": _cell(lang_col, source_col)})
    same = marked[id_col].eqNullSafe(keys["_tw_id"]) & (marked["_tw_hash"] == keys["_tw_twin"]) & (marked["_tw_cell"] == keys["_tw_of"])
    return marked.join(keys, same, "left_semi").drop("_tw_hash", "_tw_cell")
