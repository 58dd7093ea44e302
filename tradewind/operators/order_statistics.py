"""Exact ranks without a global sort: order statistics, quantiles and NTILE.

``Window.orderBy`` without ``partitionBy`` sends every row to one task and the ``percentile``
aggregate keeps every distinct value in one task. Here a mergeable quantile sketch brackets each
wanted rank, an exact count says how many rows stand before the bracket and in it, and only the few
rows inside are fetched. Nothing is shuffled but sketches and counts, nothing is stored, and the
sketch's error can cost a further read, never the result.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from decimal import Decimal
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

GRID = 1_000  # ranks a sketch is asked for; a bracket is about two steps wide
ACCURACY = 2_000  # of a sketch: its ranks are off by about one part in this; some 50 KB a partition and sketch
FETCHED = 20_000  # rows of a bracket that may be brought to the driver
CHUNK = 6  # bytes of a text in one key
INF = math.inf


@dataclass(frozen=True)
class _Level:
    """What a bracket is cut from: a number that never falls while the column rises, over rows alike so far."""

    column: int
    number: Column
    alike: Column  # which rows
    chunk: int = 0  # of a text, the byte the number begins at


@dataclass(frozen=True)
class _Bracket:
    """Where the row at ``rank`` (from 0, among the level's rows) is: its number lies within low and high."""

    series: int
    position: int
    rank: int
    level: _Level
    low: float = -INF
    high: float = INF
    outer: tuple[float, float] = (-INF, INF)  # surely around the rank
    before: int = 0  # rows of the level below ``low``, once counted
    counted: bool = field(default=False)

    @property
    def rows(self) -> Column:
        number = self.level.number
        return self.level.alike & (number >= F.lit(self.low)) & (number <= F.lit(self.high))

    @property
    def point(self) -> bool:
        return self.low == self.high

    def narrowed(self, grid: list[float], size: int) -> _Bracket:
        """The neighbouring ranks of a sketch of ``size`` rows; if that brings nothing new, one of its values."""
        at = (self.rank - self.before) / max(1, size - 1) * (len(grid) - 1)
        low = grid[max(0, math.floor(at) - 1)] if math.floor(at) > 0 else self.low
        high = grid[min(len(grid) - 1, math.ceil(at) + 1)] if math.ceil(at) < len(grid) - 1 else self.high
        if (low, high) == (self.low, self.high):
            low = high = grid[round(at)]
        return replace(self, low=low, high=high, outer=(self.low, self.high), counted=False)


def _number(column: Column, kind: T.DataType, chunk: int) -> Column:
    """Null stands before all values; NaN shares a number with infinity and is told apart when fetched."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        data = column.cast("binary")
        digit = lambda i: F.conv(F.hex(F.substring(data, chunk + i + 1, 1)), 16, 10).cast("double") + 1
        digits = [F.when(F.octet_length(data) > chunk + i, digit(i)).otherwise(0.0) for i in range(CHUNK)]
        return F.when(data.isNull(), F.lit(-1.0)).otherwise(reduce(lambda number, d: number * 257 + d, digits))
    number = _plain(column, kind).cast("double")
    return F.when(column.isNull(), F.lit(-INF)).when(F.isnan(number), F.lit(INF)).otherwise(number)


def _plain(column: Column, kind: T.DataType) -> Column:
    return F.unix_micros(column.cast("timestamp")) if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else column


def _units(column: Column, kind: T.DataType) -> Column:
    """A whole or decimal number as its unscaled whole number."""
    if isinstance(kind, T.DecimalType) and kind.scale:
        column = F.regexp_replace(F.format_string(f"%.{kind.scale}f", column), r"\.", "")
    return _plain(column, kind).cast("decimal(38,0)")


def order_statistics(
    df: DataFrame, series: dict[str, list[Column]], positions: Callable[[int], list[int]]
) -> dict[str, tuple[int, dict[int, Row]]]:
    """What stands at given 0-based positions of several orderings of the rows of ``df``.

    Each of ``series`` orders all rows ascending by its columns, of the same types in every series; rows alike in all
    columns are interchangeable. ``positions`` maps the number of rows to the positions wanted.

    Returns series -> (number of rows, position -> values of the columns). ``df`` is read three times up to about ten
    million rows, and once more for every further factor of five hundred or where very many rows tie in a leading
    column. The driver gets a sketch per wanted rank and the rows inside the brackets, a bounded number.
    """
    columns = [[f"c{i}_{j}" for j in range(len(order))] for i, order in enumerate(series.values())]
    narrow = df.select(*[c.alias(name) for names, order in zip(columns, series.values()) for name, c in zip(names, order)])
    return _Selection(narrow, list(series), columns).at(positions)


class _Selection:
    def __init__(self, df: DataFrame, names: list[str], columns: list[list[str]]):
        self.df, self.names, self.columns = df, names, columns
        self.kinds = [df.schema[c].dataType for c in columns[0]]

    def at(self, positions: Callable[[int], list[int]]) -> dict[str, tuple[int, dict[int, Row]]]:
        levels = [self._first(i, 0, F.lit(True)) for i in range(len(self.names))]
        row = self.df.agg(F.count("*").alias("n"), *[_sketch(level.number, f"g{i}") for i, level in enumerate(levels)]).first()
        n = row["n"]
        if not n:
            return {}
        open_ = [
            _Bracket(i, position, position, level).narrowed(row[f"g{i}"], n)
            for i, level in enumerate(levels)
            for position in sorted(set(positions(n)))
        ]
        ready: list[_Bracket] = []
        while open_:
            open_ = self._counted(open_, ready)
        return self._fetched(n, ready)

    def _first(self, series: int, column: int, alike: Column, chunk: int = 0) -> _Level:
        return _Level(column, _number(F.col(self.columns[series][column]), self.kinds[column], chunk), alike, chunk)

    def _counted(self, brackets: list[_Bracket], ready: list[_Bracket]) -> list[_Bracket]:
        """One read: rows before and in every bracket, and a sketch of what is inside for those still too large."""
        found: dict[tuple, int] = {}
        distinct: list[_Bracket] = []
        for b in brackets:
            key = (b.series, id(b.level), b.low, b.high)
            if key not in found:
                found[key] = len(distinct)
                distinct.append(b)
        # Numbers and conditions are worked out once a row, however many facts rest on them.
        worked = self.df.select("*", *[e for k, b in enumerate(distinct) for e in self._worked(b, k)])
        row = worked.agg(*[e for k, b in enumerate(distinct) for e in self._facts(b, k)]).first()
        left, deeper = [], {}
        for b in brackets:
            k = found[(b.series, id(b.level), b.low, b.high)]
            before, size = row[f"before{k}"], row[f"size{k}"]
            if b.rank < before:
                left.append(replace(b, low=b.outer[0], high=math.nextafter(b.low, -INF)))
            elif b.rank >= before + size:
                left.append(replace(b, low=math.nextafter(b.high, INF), high=b.outer[1]))
            elif size <= FETCHED:
                ready.append(replace(b, before=before, counted=True))
            elif not b.point:
                left.append(replace(b, before=before).narrowed(row[f"grid{k}"], size))
            else:
                if k not in deeper:
                    deeper[k] = self._deeper(b, row, k)
                inner = deeper[k]
                if inner is None:  # alike in all columns
                    ready.append(replace(b, before=before, counted=True))
                else:
                    fresh = _Bracket(b.series, b.position, b.rank - before, inner)
                    same = row[f"grid{k}"] if inner.column == b.level.column + 1 else None
                    left.append(fresh.narrowed(same, size) if same else fresh)
        return left

    def _worked(self, b: _Bracket, k: int) -> list[Column]:
        """The level's number of its rows, else null; for a point also the number of the column that follows."""
        worked = [F.when(b.level.alike, b.level.number).alias(f"number{k}")]
        if b.point and b.level.column + 1 < len(self.kinds):
            worked.append(F.when(b.rows, self._first(b.series, b.level.column + 1, b.rows).number).alias(f"next{k}"))
        return worked

    def _facts(self, b: _Bracket, k: int) -> list[Column]:
        number = F.col(f"number{k}")
        inside = (number >= F.lit(b.low)) & (number <= F.lit(b.high))
        facts = [F.count_if(number < F.lit(b.low)).alias(f"before{k}"), F.count_if(inside).alias(f"size{k}")]
        if not b.point:
            return [*facts, _sketch(F.when(inside, number), f"grid{k}")]
        value = F.when(inside, F.col(self.columns[b.series][b.level.column]))
        facts += [F.min(value).alias(f"least{k}"), F.max(value).alias(f"most{k}"), F.count(value).alias(f"known{k}")]
        if b.level.column + 1 < len(self.kinds):
            facts.append(_sketch(F.col(f"next{k}"), f"grid{k}"))
        return facts

    def _deeper(self, b: _Bracket, row: Row, k: int) -> _Level | None:
        """The next level for rows that share a number: more of the same column, or the next one."""
        column, kind = F.col(self.columns[b.series][b.level.column]), self.kinds[b.level.column]
        least, most, known, size = (row[f"{fact}{k}"] for fact in ("least", "most", "known", "size"))
        both_nan = least != least and most != most
        if not known or known == size and (least == most or both_nan):
            if b.level.column + 1 == len(self.kinds):
                return None
            return self._first(b.series, b.level.column + 1, b.rows)
        if isinstance(kind, (T.StringType, T.BinaryType)):
            ends = [v.encode() if isinstance(v, str) else bytes(v) for v in (least, most)]
            shared = next((i for i, (x, y) in enumerate(zip(*ends)) if x != y), min(map(len, ends)))
            return self._first(b.series, b.level.column, b.rows, max(shared, b.level.chunk + 1))
        if isinstance(kind, (T.DoubleType, T.FloatType)):  # infinity before NaN, null before minus infinity
            number = F.when(column.isNull(), 0.0).when(F.isnan(column), 2.0).otherwise(1.0)
        else:
            number = (_units(column, kind) - _units(F.lit(least).cast(kind), kind)).cast("double")
            number = F.when(column.isNull(), F.lit(-INF)).otherwise(number)
        return _Level(b.level.column, number, b.rows)

    def _fetched(self, n: int, ready: list[_Bracket]) -> dict[str, tuple[int, dict[int, Row]]]:
        """One read: the distinct rows of each bracket with their number, and from them the rows at the ranks."""
        result: dict[str, tuple[int, dict[int, Row]]] = {name: (n, {}) for name in self.names}
        numbers: dict[tuple, int] = {}
        tagged = []
        for b in ready:
            key = (b.series, id(b.level), b.low, b.high)
            if key not in numbers:
                numbers[key] = len(tagged)
                values = [F.col(c).alias(f"v{j}") for j, c in enumerate(self.columns[b.series])]
                tagged.append(F.when(b.rows, F.struct(F.lit(len(tagged)).alias("b"), *values)))
        if not tagged:
            return result
        names = ["b", *[f"v{j}" for j in range(len(self.kinds))]]
        inside = reduce(lambda a, b: a | b, [t.isNotNull() for t in tagged])
        hits = self.df.filter(inside).select(F.explode(F.array_compact(F.array(*tagged))).alias("h"))
        rows: dict[int, list[tuple[Row, int]]] = {}
        for hit in hits.groupBy(*[F.col(f"h.{name}").alias(name) for name in names]).agg(F.count("*").alias("n")).collect():
            rows.setdefault(hit["b"], []).append((hit, hit["n"]))
        ends = {}
        for number, some in rows.items():
            some.sort(key=lambda hit: [_sortable(hit[0][name]) for name in names[1:]])
            total = 0
            ends[number] = [total := total + count for _, count in some]
        for b in ready:
            number = numbers[(b.series, id(b.level), b.low, b.high)]
            hit, _ = rows[number][bisect_right(ends[number], b.rank - b.before)]
            result[self.names[b.series]][1][b.position] = Row(*names[1:])(*[hit[name] for name in names[1:]])
        return result


def _sketch(number: Column, name: str) -> Column:
    return F.percentile_approx(number, [i / GRID for i in range(GRID + 1)], ACCURACY).alias(name)


def _sortable(value) -> tuple:
    """Spark's ascending order: null, numbers, NaN; texts by their bytes."""
    if value is None:
        return (0, 0)
    if isinstance(value, float) and value != value:
        return (2, 0)
    return (1, value.encode() if isinstance(value, str) else value)


def exact_quantiles(df: DataFrame, column: str, probabilities: list[float]) -> list[float | None]:
    """Interpolated quantiles of the non-null values of a column, exact at any size. NaN stands above all numbers."""
    found = order_statistics(
        df.filter(F.col(column).isNotNull()), {"all": [F.col(column).cast("double")]}, lambda n: _neighbours(n, probabilities)
    )
    if not found:
        return [None] * len(probabilities)
    n, at = found["all"]
    return [_interpolate(at, p * (n - 1)) for p in probabilities]


def _neighbours(n: int, probabilities: list[float]) -> list[int]:
    ranks = [p * (n - 1) for p in probabilities]
    return [edge for r in ranks for edge in (math.floor(r), math.ceil(r))]


def _interpolate(at: dict[int, Row], rank: float) -> float:
    low, high = at[math.floor(rank)]["v0"], at[math.ceil(rank)]["v0"]
    share = rank - math.floor(rank)
    if low == high or not share:
        return low
    if not (math.isfinite(low) and math.isfinite(high)):
        return low * (1 - share) + high * share
    # One rounding for the low term and the sum together (a fused multiply-add).
    return float(Fraction(low) * Fraction(1 - share) + Fraction(high * share))


def ntile_starts(n: int, tiles: int) -> list[int]:
    """0-based position at which tiles 2..k begin; tiles that stay empty are left out."""
    size, extra = divmod(n, tiles)
    starts = [t * size + min(t, extra) for t in range(1, tiles)]
    return [s for s in starts if s < n]


def with_ntiles(df: DataFrame, scores: dict[str, Column], tie: str, tiles: int) -> DataFrame:
    """Add one ``NTILE(tiles) OVER (ORDER BY score, tie)`` column per score.

    Each score is a numeric expression, ascending; NULL and NaN come last. Whole and decimal scores
    are compared as decimals, others as doubles. ``tie`` must be
    unique per row, so that the tiles are reproducible. No row is shuffled; the tiles are
    read off by comparing each row with the few cut rows, inside the scan of ``df``. ``df``
    is read a few times (``order_statistics``): pass a materialized frame.
    """
    values = {name: F.coalesce(*value) for name, value in _comparable(df, scores).items()}
    orders = {name: [value, F.col(tie)] for name, value in values.items()}
    found = order_statistics(df, orders, lambda n: ntile_starts(n, tiles))
    tie_type = df.schema[tie].dataType

    def tile(name: str) -> Column:
        _, cuts = found.get(name, (0, {}))
        value, key = values[name], F.col(tie)
        reached = [
            (value > cut["v0"]) | ((value == cut["v0"]) & (key >= F.lit(cut["v1"]).cast(tie_type)))
            for cut in cuts.values()
        ]
        return reduce(lambda a, b: a + b, [passed.cast("int") for passed in reached], F.lit(1))

    return df.withColumns({name: tile(name) for name in scores})


def _comparable(df: DataFrame, scores: dict[str, Column]) -> dict[str, tuple[Column, Column]]:
    """Each score in one type for all of them, and what stands for NULL: the largest value of that type."""
    types = [f.dataType for f in df.select(*[score.alias(name) for name, score in scores.items()]).schema]
    if all(isinstance(t, (T.IntegralType, T.DecimalType)) for t in types):
        scale = max(getattr(t, "scale", 0) for t in types)
        digits = max(getattr(t, "precision", 19) - getattr(t, "scale", 0) for t in types)
        if digits + scale < 38:
            kind = T.DecimalType(38, scale)
            last = F.lit(Decimal(10 ** (38 - scale) - 1)).cast(kind)
            return {name: (score.cast(kind), last) for name, score in scores.items()}
    # NaN sorts above every number.
    return {name: (score.cast("double"), F.lit(float("nan"))) for name, score in scores.items()}
