"""JSON-array files read by byte ranges.

A foreign store keeps one JSON array per file.  Spark's text source cuts a file into
byte ranges at a record separator; with ``}`` as the separator, ranges end at the
borders of (possibly nested) objects whatever the array's layout, so many tasks
read one file.  Whether a piece starts inside a string, how deep it is nested
and which element it belongs to depends on all that stands before it:

1. every range is reduced to its effect on that state, for a range that starts
   outside of a string and for one that starts inside;
2. the effects of a file's ranges (one small row per range) are put together in
   file order, which gives each range the state that it starts in;
3. every range is cut into elements.  Those that lie in it whole are ready; the
   ends of elements that cross a border are put together by element.

So an element's position is its place in the whole array, and no task holds more
than a range and one element.  A file that is not one closed array of parsable elements yields no rows.

A large array is written as several files of one folder, each a closed array of the
elements between two places (:func:`write_arrays`); read by folders, these are one array again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.filters import _bounded, is_small
from tidewater.session import stage_table

#: What can change the state outside of a string, and what can end a string.
_OUTSIDE, _INSIDE = re.compile(r'["\[\]{},]'), re.compile(r'\\.|"', re.S)
#: Space between tokens.
BLANK = " \t\r\n"
#: Elements of a file of an array that is written, about.
ROWS_PER_FILE = 10_000


class Scan:
    """A reader that stands in an array: in a string or not, how deep, and elements closed so far.

    ``cut(text)`` yields the elements' texts as they close; ``rest`` is the open one's text.
    ``done``: the array has been closed before."""

    def __init__(self, inside: bool = False, depth: int = 0, done: bool = False):
        self.inside, self.depth, self.done = inside, depth, done
        self.index, self.low, self.parts, self.bad = 0, 0, [], False
        self.ended = depth == 1 and not inside  # a range starts after a brace: at depth 1 it closed an element

    def cut(self, text: str) -> Iterator[tuple[int, str]]:
        at = start = 0
        while True:
            m = (_INSIDE if self.inside else _OUTSIDE).search(text, at)
            if self.ended and text[at : m.start() if m else len(text)].strip(BLANK):
                self.bad = True  # text between an element and its comma
            if m is None:
                break
            at, c = m.end(), m[0]
            if self.inside:
                self.inside = c != '"'
                continue
            self.bad |= self.ended and c not in ",]"
            self.ended = False
            if c == '"':
                self.inside = True
            elif c in "[{":
                self.depth += 1
                if self.depth == 1:  # the array itself opens
                    self.bad |= c != "[" or self.done or bool("".join([*self.parts, text[start : m.start()]]).strip(BLANK))
                    self.parts, start = [], at
            elif c == "," and self.depth == 1:
                yield self.index, "".join([*self.parts, text[start : m.start()]])
                self.parts, start, self.index = [], at, self.index + 1
            elif c in "]}":
                self.depth -= 1
                self.low = min(self.low, self.depth)
                self.ended = self.depth == 1
                if self.depth == 0:  # the array closes
                    self.bad |= c != "]"
                    self.done = True
                    yield self.index, "".join([*self.parts, text[start : m.start()]])
                    self.parts, start, self.index = [], at, self.index + 1
        self.parts.append(text[start:])

    @property
    def rest(self) -> str:
        return "".join(self.parts)


def _effect(texts: list[str], inside: bool) -> tuple[bool, int]:
    """Whether a range ends inside a string, and its change of depth."""
    depth = 0
    for text in texts:
        at = 0
        while (m := (_INSIDE if inside else _OUTSIDE).search(text, at)) is not None:
            at, c = m.end(), m[0]
            if inside:
                inside = c != '"'
            elif c == '"':
                inside = True
            else:
                depth += (c in "[{") - (c in "]}")
    return inside, depth


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[str]]]:
    """(file, start, texts) of each byte range of a partition; the texts have to be used up in turn."""
    rows = ((f, s, v) for b in batches for f, s, v in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True))
    row = next(rows, None)
    while row is not None:
        file, start = row[:2]

        def texts():
            nonlocal row
            while row is not None and row[:2] == (file, start):
                value = row[2]
                row = next(rows, None)
                # every record but the file's last one was ended by the separator
                yield value, row is None or row[:2] != (file, start)

        yield file, start, texts()


_EFFECT = "file string, start long, out_in boolean, out_depth long, in_in boolean, in_depth long"
_STATE = "file string, start long, inside boolean, depth long, first boolean, last boolean"
_ELEMENT = "file string, start long, n long, head boolean, tail boolean, fault boolean, value string"
#: Records of a range whose effect is taken at once.
_STEP = 1024


def _effects(batches):
    for file, start, texts in _ranges(batches):
        ends, depths = [False, True], [0, 0]
        for value, _ in texts:
            for k in (0, 1):
                # the last record of a range ends with the separator too, unless it ends the file,
                # where a closed array has a bracket: a brace more or less there is a fault either way
                ends[k], d = _effect([value + "}"], ends[k])
                depths[k] += d
        yield pa.RecordBatch.from_pylist(
            [{"file": file, "start": start, "out_in": ends[0], "out_depth": depths[0], "in_in": ends[1], "in_depth": depths[1]}],
            schema=pa.schema([("file", pa.string()), ("start", pa.int64()), ("out_in", pa.bool_()), ("out_depth", pa.int64()), ("in_in", pa.bool_()), ("in_depth", pa.int64())]),
        )


def _states(rows: pd.DataFrame) -> pd.DataFrame:
    """The state in which each range of a file starts."""
    rows = rows.sort_values("start")
    inside, depth, made = False, 0, []
    for r in rows.itertuples():
        made.append((inside, depth))
        inside, depth = (bool(r.in_in), depth + int(r.in_depth)) if inside else (bool(r.out_in), depth + int(r.out_depth))
    return pd.DataFrame({
        "file": rows["file"], "start": rows["start"], "inside": [m[0] for m in made], "depth": [m[1] for m in made],
        "first": [True] + [False] * (len(rows) - 1), "last": [False] * (len(rows) - 1) + [True],
    })


_PIECES = pa.schema([("file", pa.string()), ("start", pa.int64()), ("n", pa.int64()), ("head", pa.bool_()), ("tail", pa.bool_()), ("fault", pa.bool_()), ("value", pa.string())])


def _elements(batches):
    """Elements of each range, numbered from 0 in the range; the first and the last may be cut.

    A row of number -1 says how many the range closed."""
    states = {}

    def noted():
        for b in batches:
            for f, s, *state in zip(*(b.column(k).to_pylist() for k in (0, 1, 3, 4, 5, 6)), strict=True):
                states[f, s] = state
            yield b.select([0, 1, 2])

    for file, start, texts in _ranges(noted()):
        inside, depth, first, last = states.pop((file, start))
        scan, made = Scan(inside, depth, done=depth == 0 and not first), []
        piece = lambda n, value, tail=False, fault=False: {"file": file, "start": start, "n": n, "head": depth > 0 and n == 0, "tail": tail, "fault": fault, "value": value}  # noqa: B023, E731
        for value, ends in texts:
            made += [piece(n, element) for n, element in scan.cut(value if ends and last else value + "}")]
            if len(made) >= _STEP:
                yield pa.RecordBatch.from_pylist(made, schema=_PIECES)
                made = []
        closed = scan.depth == 0 and not scan.inside
        # an array that closes too often or not at all, or text beside it
        fault = scan.bad or scan.low < 0 or (last and not closed) or (closed and bool(scan.rest.strip(BLANK)))
        if not closed or fault:
            made.append(piece(scan.index, scan.rest, tail=not closed, fault=fault))
        yield pa.RecordBatch.from_pylist([*made, piece(-1, str(scan.index))], schema=_PIECES)


def _bracketed(batches):
    """Rows (run, value) in the order of an array's elements, numbered, with commas and brackets put to them."""
    run, n = None, -1
    for batch in batches:
        out = []
        for r, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if n >= 0 and r != run:
                out.append((run, n, "]"))
                n += 1
            new = n < 0 or r != run
            n += 1
            out.append((r, n, ("[" if new else ",") + value))
            run = r
        yield _numbered(out)
    if n >= 0:
        yield _numbered([(run, n + 1, "]")])


def _numbered(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["run", "n", "value"])


def write_arrays(rows: DataFrame, path: str, value: Column, run: str = "run", order: str = "id", rows_per_file: int = ROWS_PER_FILE) -> str:
    """Write ``value`` (JSON texts), in the order ``order`` of each ``run``, as arrays with one element a line:
    a folder ``run=-NAME`` for each, in it files of about ``rows_per_file`` elements at most whose
    names sort in the order of their elements."""
    files = min(max(1, -(-rows.count() // rows_per_file)), 99_999)  # names have five digits
    # a null run is in a folder of its own, apart from an empty one
    named = F.coalesce(F.concat(F.lit("-"), F.col(run).cast("string")), F.lit(""))
    # parts are ranges of (run, order): a part's files are named by its number
    parts = rows.select(named.alias("run"), F.col(order).alias("order"), value.alias("value")).repartitionByRange(files, "run", "order")
    lines = parts.sortWithinPartitions("run", "order").select("run", "value").mapInArrow(_bracketed, "run string, n long, value string")
    # known as not null, the folder's name is what the rows are sorted by, and the writer sorts them no more
    lines = lines.withColumn("run", F.coalesce("run", F.lit(""))).sortWithinPartitions("run", "n")
    lines.select("run", "value").write.partitionBy("run").text(path)
    return path


def read_array_elements(spark: SparkSession, path: str, pattern: str = "*.json", folders: bool = False) -> DataFrame:
    """Elements of the JSON-array files below ``path``: ``file`` (full path), ``pos`` and ``value`` (JSON text).

    An empty array has no elements; neither has a file that is no closed JSON array,
    or one with an element that Spark can't parse (among them any of 128 MiB or more).

    ``folders``: the files of a folder are one array in the order of their names;
    ``pos`` goes on from file to file, and a file that has no elements by a fault leaves the array with none."""
    raw = spark.read.option("pathGlobFilter", pattern).option("lineSep", "}").text(path)
    raw = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    effects = stage_table(raw.mapInArrow(_effects, _EFFECT), "array-effects")
    # one row per byte range of a file: 40 rows for 5 GB
    states = stage_table(effects.groupBy("file").applyInPandas(_states, _STATE), "array-states")
    columns = ["file", "start", "value", "inside", "depth", "first", "last"]
    if is_small(states):  # a range's rows stay in the scan's own task, in order
        known = raw.join(F.broadcast(states), on=["file", "start"], how="inner").select(columns)
    else:  # a range's rows go to one task (no key has more than a range) and are put in order again
        numbered = raw.withColumn("row", F.monotonically_increasing_id())
        known = numbered.join(states, on=["file", "start"], how="inner").repartition("file", "start").sortWithinPartitions("file", "start", "row").select(columns)
    pieces = stage_table(known.mapInArrow(_elements, _ELEMENT), "array-elements")
    in_file = Window.partitionBy("file").orderBy("start")  # one row per range
    closed = pieces.where("n = -1").select("file", "start", F.col("value").cast("long").alias("closed"))
    before = closed.select(
        "file", "start",
        F.coalesce(F.sum("closed").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
        F.sum("closed").over(Window.partitionBy("file")).alias("total"),
    )
    placed = pieces.where("n >= 0").join(before, on=["file", "start"]).withColumn("pos", F.col("base") + F.col("n"))
    cut = F.col("head") | F.col("tail")
    whole = placed.where(~cut & ~F.col("fault")).select("file", "pos", "total", "value")
    # the elements that cross borders: two pieces a range at most, joined in file order
    crossing = placed.where(cut & ~F.col("fault")).groupBy("file", "pos", "total")
    joined = crossing.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "value"))), lambda p: p["value"]), "").alias("value"))
    blank = F.translate("value", BLANK, "") == ""
    elements = whole.unionByName(joined).where(~(blank & (F.col("total") == 1)))  # [] closes one blank element
    bad = placed.where("fault").select("file").union(elements.where(F.try_parse_json("value").isNull()).select("file"))
    array = F.regexp_extract("file", "^(.*)/[^/]*$", 1) if folders else F.col("file")
    # a row per faulty array; the elements stay where they are: one task an array would not do for a large one
    bad = stage_table(bad.select(array.alias("array")).distinct(), "array-faults")
    elements = elements.withColumn("array", array).join(_bounded(bad), on="array", how="left_anti")
    if folders:
        sizes = stage_table(elements.groupBy("array", "file").agg(F.count(F.lit(1)).alias("size")), "array-sizes")  # one row per file
        earlier = Window.partitionBy("array").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
        first = sizes.select("file", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("first"))
        elements = elements.join(_bounded(first), on="file").withColumn("pos", F.col("first") + F.col("pos"))
    return elements.select("file", "pos", "value")


def parse_elements(elements: DataFrame, schema: T.StructType) -> DataFrame:
    """Elements that are objects as rows: ``file``, ``pos`` and the fields of ``schema`` (absent ones NULL)."""
    objects = elements.where(F.ltrim(F.translate("value", BLANK, "    ")).startswith("{"))
    parsed = objects.select("file", "pos", F.from_json("value", schema).alias("m"))
    return parsed.select("file", "pos", *[F.col("m")[f.name].alias(f.name) for f in schema.fields])


__all__ = ["ROWS_PER_FILE", "write_arrays", "read_array_elements", "parse_elements"]
