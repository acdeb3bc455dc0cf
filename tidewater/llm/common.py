"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import stage_table

#: Rows that one step of a text function sees; bounds the size of its output batch.
ROWS_PER_STEP = 128


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_name(name: str, taken) -> str:
    """``name``, with underscores added until no column of ``taken`` has it (letter case doesn't tell columns apart)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def per_process(key: str, build: Callable):
    """A value built once in each Python worker process and reused by later tasks.

    Functions travel to the workers by value, so a module global would be
    rebuilt for every task; ``sys`` outlives them.
    """
    store = sys.__dict__.setdefault("_tidewater_values", {})
    if key not in store:
        store[key] = build()
    return store[key]


def arrow_type(kind: str) -> pa.DataType:
    """Arrow type of the few SQL types that the operators return."""
    return {
        "int": pa.int32(),
        "long": pa.int64(),
        "double": pa.float64(),
        "boolean": pa.bool_(),
        "string": pa.string(),
        "binary": pa.binary(),
        "array<int>": pa.list_(pa.int32()),
        "array<long>": pa.list_(pa.int64()),
        "array<double>": pa.list_(pa.float64()),
        "array<string>": pa.list_(pa.string()),
    }[kind]


def map_texts(
    docs: DataFrame,
    make: Callable[[], Callable[[list], list]],
    out: dict[str, str],
    keep: list[str],
    text_col: str = "text",
    explode: bool = False,
) -> DataFrame:
    """Apply a function of texts inside the scan's own tasks (no shuffle).

    ``make`` runs once per task and returns ``f(texts) -> columns``, one list
    (or Arrow array) per entry of ``out`` (name -> SQL type).  The columns
    ``keep`` pass through.  With ``explode`` the first returned list holds, for
    each output row, the index of the text that it came from.
    """
    kept = [docs.schema[c] for c in keep]
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in kept]
        + [f for f in T._parse_datatype_string(", ".join(f"`{n}` {k}" for n, k in out.items()))]
    )
    types = [arrow_type(k) for k in out.values()]
    names = [*keep, *out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_STEP):
                part = batch.slice(at, ROWS_PER_STEP)
                made = f(part.column(0).to_pylist())
                held = [part.column(i + 1) for i in range(len(keep))]
                if explode:
                    rows, *made = made
                    held = [c.take(pa.array(rows, pa.int64())) for c in held]
                made = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*held, *made], names=names)

    return docs.select(F.col(text_col).cast("string").alias(free_name("_text_", keep)), *[F.col(c) for c in keep]).mapInArrow(run, schema)


def components(nodes_edges: DataFrame, name: str = "components", max_rounds: int = 100) -> DataFrame:
    """Connected components of an undirected graph given as edges ``(a, b)``.

    Returns ``(node, root)`` for every node with an edge; ``root`` is an
    arbitrary member of the component.  Each round every node takes the least
    of itself and its neighbours (by a hash of the id, so that chains sorted
    by id don't take one round a link) as its new name; edges are renamed and
    those inside one name go.  Edges at least halve in expectation, every
    table is written to the shared folder, and nothing is collected.
    """
    edges = nodes_edges.select("a", "b").where("a <> b")
    both = edges.union(edges.select("b", "a")).distinct()
    ranked = both.select(F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("id")).alias("a"),
                         F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("id")).alias("b"))
    live = stage_table(ranked, f"{name}-edges")
    label = None
    for _ in range(max_rounds):
        if live.isEmpty():
            break
        up = stage_table(live.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("up")), f"{name}-up")
        # one jump: the name of the name
        jump = up.select(F.col("a").alias("up"), F.col("up").alias("top"))
        up = stage_table(up.join(jump, "up", "left").select("a", F.coalesce("top", "up").alias("up")), f"{name}-top")
        if label is None:
            label = up.select(F.col("a").alias("node"), F.col("up").alias("root"))
        else:
            step = up.select(F.col("a").alias("root"), F.col("up").alias("new"))
            label = stage_table(
                label.join(step, "root", "left").select("node", F.coalesce("new", "root").alias("root")), f"{name}-label"
            )
        left = up.select(F.col("a"), F.col("up").alias("a2"))
        right = up.select(F.col("a").alias("b"), F.col("up").alias("b2"))
        live = stage_table(
            live.join(left, "a").join(right, "b").where("a2 <> b2").select(F.col("a2").alias("a"), F.col("b2").alias("b")).distinct(),
            f"{name}-edges",
        )
    else:
        raise RuntimeError("connected components did not settle")
    if label is None:
        label = live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return label.select(F.col("node.id").alias("node"), F.col("root.id").alias("root"))


__all__ = ["ROWS_PER_STEP", "documents", "free_name", "per_process", "arrow_type", "map_texts", "components"]
