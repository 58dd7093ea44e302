"""Mixing sources to target weights by thresholds on a hash of the records.

Every source has a target in words. Its whole multiples of the source's size are taken from all its
documents alike; the rest is a budget that documents win in the order of a hash, up to the threshold
where the budget is used up. The order is never produced: a histogram of words by source and leading hash bits
shows the one bucket in which the budget ends, and only that bucket's rows are counted again by the next
bits, until it holds a single row. What lies below goes in, what lies above stays out, in a plain filter.

A smaller budget has a lower threshold of the same hash, so mixes of different budgets are nested: a document
never gives a smaller mix more words than a larger one of the same weights.

Hot sources cost nothing extra: words are summed by bucket before they are shuffled, each histogram
has at most ``2**DIGIT`` rows a source, and the filter joins one row per source. Only sizes and hashes
are stored and counted again, 40 bytes a document; texts are read once and don't move.

Defined results: a null or wordless text has no words, so nothing is taken of it. Sources without words
have the target 0. Documents without a source are one source, last in order. The hash is of id and text; rows equal
in both are told apart by a second hash of their place in the input, and as they are alike, only their number in
the mix counts, which no order of rows changes. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.llm.places import group_key, positions
from tradewind.operators.scratch import materialize

WORD = r"[^\x20\x09-\x0D]+"
BITS = 60  # of each of the two hashes
DIGIT = 10  # bits of a histogram


def n_words(text: Column) -> Column:
    """Words as runs of anything but blanks, tabs and line breaks."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def record_hash(id_col: Column, text: Column) -> Column:
    """60 bits of the SHA-256 of id and text."""
    data = F.concat_ws(":", F.coalesce(id_col.cast("string"), F.lit("")), text)
    return F.conv(F.substring(F.sha2(data.cast("binary"), 256), 1, BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Stored (skey, id, size, hash, tie): all that the mix needs of each document."""
    text = F.col(text_col)
    rows = docs.select(
        group_key(F.col(source_col)).alias("skey"),
        F.col(id_col).alias("id"),
        n_words(text).alias("size"),
        record_hash(F.col(id_col), text).alias("hash"),
        F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - BITS).alias("tie"),
    )
    return materialize(rows, "sized")


def targets(sizes: DataFrame, weights: Sequence[int], most: int, share: float = 1.0) -> DataFrame:
    """Stored (skey, source_size, target) per source of ``sizes``.

    Sources in order of their names weigh as ``weights`` says, which repeats. They divide ``share`` of all
    words by weight, none more than ``most`` times its own; the excess is divided by weight again among the others,
    until no one is above. Each round adds up the sources that are still below; the driver gets four sums.
    """
    totals = materialize(sizes.groupBy("skey").agg(F.sum("size").alias("source_size")), "source-sizes")
    ordered = positions(totals.withColumns({"all": F.lit("all"), "last": F.col("skey") == ""}), "all", ["last", "skey"])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("pos") % len(weights) + 1).cast("int")).cast("long")
    weighed = materialize(
        ordered.select("skey", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("cap")), "weights"
    )
    everything = weighed.agg(F.sum("source_size")).first()[0] or 0
    below, capped = F.lit(True), None
    while True:
        fixed = F.sum(F.when(~below, F.col("cap"))).alias("fixed")
        row = weighed.agg(fixed, F.sum(F.when(below, F.col("weight"))).alias("weight"), F.count_if(~below).alias("n")).first()
        left = everything * share - (row["fixed"] or 0)
        portion = F.lit(float(left)) * F.col("weight") / F.lit(float(row["weight"] or 1))
        if row["n"] == capped:
            break
        capped, below = row["n"], below & (portion <= F.col("cap"))
    target = F.when(below, portion).otherwise(F.col("cap").cast("double"))
    return materialize(weighed.select("skey", "source_size", target.alias("target")), "targets")


def thresholds(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """(skey, low, high, tie_low, tie_high, whole): the range of hashes in which each source's budget ends.

    ``budgets`` has (skey, budget), less than the source's size. Hashes below ``low`` are in; those in the range
    are in where the tie hash is below ``tie_low``, or below ``tie_high`` and the last row goes in ``whole``, which is
    where it brings the sum nearer to the budget.
    """
    full = F.lit(1 << BITS)
    state = budgets.select(
        "skey", "budget", *[F.lit(0).cast("long").alias(c) for c in ("low", "tie_low", "before")],
        *[full.cast("long").alias(c) for c in ("high", "tie_high")], F.lit(False).alias("whole"),
    )
    rows = sizes.filter(F.col("size") > 0)
    for column, (low, high) in (("hash", ("low", "high")), ("tie", ("tie_low", "tie_high"))):
        for shift in range(BITS - DIGIT, -1, -DIGIT):
            state, most = _refined(rows, state, column, low, high, shift)
            if most is None or most <= 1:
                return state.select("skey", "low", "high", "tie_low", "tie_high", "whole")
    return state.select("skey", "low", "high", "tie_low", "tie_high", "whole")


def _refined(rows: DataFrame, state: DataFrame, column: str, low: str, high: str, shift: int) -> tuple[DataFrame, int | None]:
    """``state`` narrowed by the next bits of ``column``, and the largest number of rows left in a range."""
    open_rows = rows.join(state.select("skey", "low", "high", "tie_low", "tie_high"), "skey").filter(
        F.col("hash").between(F.col("low"), F.col("high") - 1) & F.col("tie").between(F.col("tie_low"), F.col("tie_high") - 1)
    )
    histogram = open_rows.groupBy("skey", F.shiftright(column, shift).alias("bucket")).agg(
        F.sum("size").alias("words"), F.count("*").alias("rows"), F.min("size").alias("least")
    )
    # The histogram is one row per source and bucket, 2**DIGIT a source at most.
    upto = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cumulated = histogram.withColumn("upto", F.sum("words").over(upto)).join(state, "skey")
    reached = F.col("before") + F.col("upto")
    hit = F.struct("bucket", "words", "rows", "upto")
    ended = cumulated.filter(reached >= F.col("budget")).groupBy("skey").agg(F.min(hit).alias("hit"))
    inside = F.col("hit").isNotNull()
    before = F.col("before") + F.col("hit.upto") - F.col("hit.words")
    begin = F.shiftleft("hit.bucket", shift)
    nearer = (F.col("hit.rows") == 1) & (2 * before + F.col("hit.words") <= 2 * F.col("budget"))
    kept = [c for c in state.columns if c not in ("skey", "before", "whole", low, high)]
    narrowed = state.join(ended, "skey", "left").select(
        "skey",
        *kept,
        F.when(inside, before).otherwise(F.col("before")).alias("before"),
        F.when(inside, begin).otherwise(F.col(low)).alias(low),
        F.when(inside, begin + F.lit(1 << shift).cast("long")).otherwise(F.col(high)).alias(high),
        F.when(inside, nearer).otherwise(F.col("whole")).alias("whole"),
        F.col("hit.rows").alias("rows"),
    )
    narrowed = materialize(narrowed, "thresholds")
    return narrowed.drop("rows"), narrowed.agg(F.max("rows")).first()[0]


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    share: float = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """id, size, source_size, target (of the source) and taken (words the mix takes, repeats counted) of every document.

    Within a source all documents are taken equally often, or once more where their hash is below the threshold. So
    the words taken of a source differ from its target by half a document's words at most.
    """
    sizes = sized(docs, id_col, text_col, source_col)
    aims = targets(sizes, weights, most, share)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    aims = aims.withColumn("times", times)
    budget = F.col("target") - F.col("times") * F.col("source_size")
    limits = thresholds(sizes, aims.select("skey", budget.alias("budget")))
    plan = materialize(aims.join(limits, "skey"), "mix")
    in_range = (F.col("hash") >= F.col("low")) & (F.col("hash") < F.col("high"))
    in_tie = (F.col("tie") < F.col("tie_low")) | (F.col("whole") & (F.col("tie") < F.col("tie_high")))
    extra = (F.col("hash") < F.col("low")) | (in_range & in_tie)
    copies = F.col("times") + F.when(extra, F.lit(1)).otherwise(F.lit(0))
    return sizes.join(plan, "skey").select("id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"))
