"""CSV load that keeps every broken row in sight, and reads quoted line breaks in parallel.

Rows that don't fit the declared columns (too short, too long, a value of the wrong type) go to a reject
table with the reason, whatever columns are read later: rows are parsed whole and stored once, so
that neither ``count()`` nor a narrow select can pass over a broken one.

A text with line breaks stops Spark's reader from splitting a file. Here files are read as lines, in byte ranges as
any text, and two passes find out which line breaks end a row. The first pass reduces each range to what it
does to a reader who comes in outside a quoted value, and to one who comes in inside; a prefix over the ranges of a
file then says how every range really begins. The second pass cuts the ranges into rows; what a row has in
several ranges is joined by its place. Nothing but a row or two per range leaves the task that reads it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from threading import Lock

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tradewind.lazy import Frames
from tradewind.operators.scratch import materialize
from tradewind.sources.raw import CORRUPT, MULTILINE, RAW_SCHEMAS

BROADCAST_RANGES = 100_000  # some hundred bytes each; more are joined and put in order again
WHOLE, HEAD, TAIL, MIDDLE, HEADER = 0, 1, 2, 3, 4

# A quoted field that is closed, or an unquoted one, up to the next comma. What follows a closing quote belongs to
# the field; a quote inside an unquoted field is an ordinary character.
_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:"{_QUOTED}"|(?!"))[^,]*+'
_OPENED = re.compile(rf'(?:{_FIELD},)*+"{_QUOTED}\Z').match
_CLOSED = re.compile(rf'{_QUOTED}"[^,]*+').match
OUTSIDE, INSIDE = 0, 1


def ends(line: str) -> tuple[int, int]:
    """The state at the end of a line that begins outside a quoted value, and of one that begins inside."""
    outside = INSIDE if _OPENED(line) else OUTSIDE
    closed = _CLOSED(line)
    if not closed:
        return outside, INSIDE
    rest = line[closed.end() :]
    return outside, INSIDE if rest and _OPENED(rest[1:]) else OUTSIDE


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, list[str], list[int]]]:
    """Stretches of lines of one range: file, range, the lines and which of them have a quote."""
    lines, files, ranges = (batch.column(c) for c in ("line", "file", "range"))
    marked = pc.match_substring(lines, '"').to_pylist()
    lines, files, ranges = lines.to_pylist(), files.to_pylist(), ranges.to_pylist()
    begin = 0
    for at in range(1, len(lines) + 1):
        if at == len(lines) or (ranges[at], files[at]) != (ranges[begin], files[begin]):
            quoted = [i - begin for i in range(begin, at) if marked[i]]
            yield files[begin], ranges[begin], lines[begin:at], quoted
            begin = at


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per stretch of a range: where it takes each of the two states; stretches are numbered as they come."""
    number = 0
    for batch in batches:
        rows = []
        for file, begin, lines, quoted in _runs(batch):
            state = [OUTSIDE, INSIDE]
            for i in quoted:
                after = ends(lines[i])
                state = [after[s] for s in state]
            rows.append((file, begin, number, *state))
            number += 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["file", "range", "part", "outside", "inside"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole rows, and what a range has of rows that begin before it or go on behind it."""
    where, state, first, open_ = None, OUTSIDE, True, []

    def left() -> list[tuple]:
        if not open_:
            return []
        return [(*where, MIDDLE if first else TAIL, "\n".join(open_))]

    for batch in batches:
        found, starts, at = [], batch.column("start").to_pylist(), 0
        for file, begin, lines, quoted in _runs(batch):
            if where != (file, begin):
                found += left()
                where, state, open_ = (file, begin), starts[at], []
                first = state == INSIDE  # nothing of this range has ended a row of an earlier one yet
                fresh = begin == 0
            at += len(lines)
            marked = set(quoted)
            for i, line in enumerate(lines):
                state = ends(line)[state] if i in marked else state
                open_.append(line)
                if state == OUTSIDE:
                    kind = HEAD if first else HEADER if fresh else WHOLE
                    found.append((file, begin, kind, "\n".join(open_)))
                    open_, first, fresh = [], False, False
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["file", "range", "kind", "row"])
    if last := left():
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*last)], names=["file", "range", "kind", "row"])


def _starts(lines: DataFrame) -> DataFrame:
    """(file, range, start): how each range begins, from what all ranges before it do."""
    # A stretch either decides the state, or keeps it, or turns it round.
    schema = "file string, range long, part long, outside long, inside long"
    reduced = materialize(lines.mapInArrow(_reduced, schema), "csv-ranges")
    before = Window.partitionBy("file").orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("outside") == INSIDE) & (F.col("inside") == OUTSIDE)
    turned = reduced.withColumn("turned", F.coalesce(F.count_if(turns).over(before), F.lit(0)))
    decided = F.when(F.col("outside") == F.col("inside"), F.struct("outside", "turned"))
    known = turned.withColumn("last", F.last(decided, ignorenulls=True).over(before))
    state = F.coalesce(F.col("last.outside"), F.lit(OUTSIDE)) + F.col("turned") - F.coalesce(F.col("last.turned"), F.lit(0))
    begin = F.min_by(F.pmod(state, F.lit(2)).cast("int"), "part").alias("start")
    return materialize(known.groupBy("file", "range").agg(begin), "csv-starts")


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """(file, kind, row): the rows of a CSV file or folder as they stand, headers marked, blank ones left out.

    Each range of ``spark.sql.files.maxPartitionBytes`` is a task's. Stored, as two passes must see equal ranges.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range")]
    lines = text.select(F.col("value").alias("line"), *place)
    starts = _starts(lines)
    if starts.count() <= BROADCAST_RANGES:
        started = lines.join(F.broadcast(starts), ["file", "range"])
    else:
        numbered = lines.withColumn("at", F.monotonically_increasing_id())
        started = numbered.join(starts.hint("merge"), ["file", "range"]).sortWithinPartitions("file", "range", "at")
    cut = started.select("line", "file", "range", "start").mapInArrow(_rows, "file string, range long, kind long, row string")
    cut = materialize(cut, "csv-rows")

    pieces = cut.filter(F.col("kind").isin(HEAD, TAIL, MIDDLE))
    # Within a range the end of an earlier row stands before the begin of a later one.
    order = [F.col("range"), F.when(F.col("kind") == TAIL, 1).otherwise(0)]
    upto = Window.partitionBy("file").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbers = pieces.select("file", "range", "kind", F.count_if(F.col("kind") == TAIL).over(upto).alias("number"))
    texts = F.array_sort(F.collect_list(F.struct(order[0], order[1].alias("place"), "row")))
    joined = pieces.join(numbers, ["file", "range", "kind"]).groupBy("file", "number").agg(texts.alias("texts"))
    row = F.array_join(F.transform("texts", lambda t: t["row"]), "\n").alias("row")
    across = joined.select("file", F.lit(WHOLE).cast("long").alias("kind"), row)
    every = cut.filter(F.col("kind").isin(WHOLE, HEADER)).select("file", "kind", "row").unionByName(across)
    bare = F.regexp_replace("row", "\r\\z", "")
    return every.withColumn("row", bare).filter(F.trim("row") != "")


def _strings(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def _options(options: Mapping) -> dict[str, str]:
    if changed := {"sep", "delimiter", "quote", "escape", "lineSep"} & set(options):
        raise ValueError(f"rows are cut at commas, double quotes and line breaks; {sorted(changed)} can't be changed")
    fixed = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return fixed | {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items()}


def _check_headers(headers: DataFrame, schema: T.StructType, options: dict[str, str]) -> None:
    """Every file's first row names the declared columns, in their order."""
    names = F.array(*[F.lower(F.col(f"h.{f.name}")) for f in schema], F.col(f"h.{CORRUPT}"))
    wanted = F.array(*[F.lit(f.name.lower()) for f in schema], F.lit(None).cast("string"))
    with_corrupt = T.StructType([*_strings(schema), T.StructField(CORRUPT, T.StringType())])
    row = F.regexp_replace("row", "^\\uFEFF", "")
    parsed = headers.select("file", "row", F.from_csv(row, with_corrupt.toDDL(), options).alias("h"))
    wrong = parsed.filter(~names.eqNullSafe(wanted)).first()
    if wrong:
        raise ValueError(f"the header of {wrong['file']} doesn't name the declared columns: {wrong['row']}")


def _reason(schema: T.StructType, options: dict[str, str]) -> Column:
    """The first declared column whose text is no value of its type, or else that the row's length is wrong."""
    plain = F.from_csv("record", ", ".join(f"`{f.name}` string" for f in schema), options)
    wrong = [
        F.when(plain[f.name].isNotNull() & plain[f.name].try_cast(f.dataType).isNull(), F.concat(F.lit(f"{f.name}: no {f.dataType.simpleString()}: "), plain[f.name]))
        for f in schema
        if not isinstance(f.dataType, T.StringType)
    ]
    return F.coalesce(*wrong, F.lit(f"not {len(schema)} fields"))


@dataclass
class Loaded:
    """A table's stored rows and what had to be left out of them."""

    name: str
    parsed: DataFrame
    schema: T.StructType
    options: dict[str, str]

    @property
    def rows(self) -> DataFrame:
        return self.parsed.filter(F.col(CORRUPT).isNull()).select(*self.schema.names)

    @property
    def rejects(self) -> DataFrame:
        """(table_name, file, record, reason) of each rejected row."""
        broken = self.parsed.filter(F.col(CORRUPT).isNotNull()).withColumn("record", F.col(CORRUPT))
        return broken.select(F.lit(self.name).alias("table_name"), "file", "record", _reason(self.schema, self.options).alias("reason"))

    @property
    def counts(self) -> DataFrame:
        """(table_name, accepted, rejected)."""
        broken = F.col(CORRUPT).isNotNull()
        return self.parsed.agg(F.count_if(~broken).alias("accepted"), F.count_if(broken).alias("rejected")).select(
            F.lit(self.name).alias("table_name"), "accepted", "rejected"
        )


def load_csv(
    spark: SparkSession, path: str, name: str, schema: str, multiline: bool = False, header: bool = True, **options
) -> Loaded:
    """Parses a CSV file or folder once, into a stored table; with ``header``, every file begins with the columns' names."""
    declared, settings = T.StructType.fromDDL(schema), _options(options)
    full = f"{schema}, {CORRUPT} string"
    if multiline:
        found = csv_rows(spark, path)
        if header:
            _check_headers(found.filter(F.col("kind") == HEADER), declared, settings)
            found = found.filter(F.col("kind") == WHOLE)
        rows = found.select("file", F.from_csv("row", full, settings).alias("r"))
        parsed = rows.select("file", *[F.col(f"r.{f}") for f in [*declared.names, CORRUPT]])
    else:
        settings = settings | {"multiLine": "false"}
        reader = spark.read.schema(full).options(header=header, enforceSchema=False, columnPruning=False, **settings)
        parsed = reader.csv(path).select(F.col("_metadata.file_path").alias("file"), *declared.names, CORRUPT)
    return Loaded(name, materialize(parsed, f"raw-{name}"), declared, settings)


class CsvLoad:
    """The raw tables under ``folder/<table>.csv``, each loaded when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str, schemas: Mapping[str, str] = RAW_SCHEMAS, multiline=MULTILINE, **options):
        self._load = lambda t: load_csv(spark, f"{folder}/{t}.csv", t, schemas[t], t in multiline, **options)
        self._loaded: dict[str, Loaded] = {}
        self._locks = {name: Lock() for name in schemas}  # tables may be asked for by several threads
        self.names = list(schemas)

    def __getitem__(self, name: str) -> Loaded:
        with self._locks[name]:
            if name not in self._loaded:
                self._loaded[name] = self._load(name)
            return self._loaded[name]

    @property
    def tables(self) -> Frames:
        return Frames({name: (lambda n=name: self[n].rows) for name in self.names})

    def _all(self, part: str) -> DataFrame:
        first, *others = [getattr(self[name], part) for name in self.names]
        for other in others:
            first = first.unionByName(other)
        return first

    @property
    def rejects(self) -> DataFrame:
        return self._all("rejects")

    @property
    def counts(self) -> DataFrame:
        return self._all("counts")

    def report(self) -> DataFrame:
        """One check per table in the form of the quality report: violations are the rejected rows."""
        n = F.col("rejected")
        return self.counts.select(
            F.when(n == 0, "PASS").otherwise("FAIL").alias("status"),
            F.concat(F.lit("rejected_"), "table_name").alias("check"),
            n.alias("violations"),
            F.concat(F.lit("Every row of "), "table_name", F.lit(" fits the declared columns")).alias("description"),
        )
