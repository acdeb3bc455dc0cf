"""Best-fit-decreasing packing of token pieces into sequences.

Best fit decreasing looks at lengths only, and there are at most ``capacity``
different ones.  So the heavy work (tokenising, ranking the pieces of a length,
looking up places) is distributed, and the packing itself runs over the counts
by length: a segment tree over remaining capacities finds the tightest open
sequence that still holds a piece, and runs of sequences with the same room
take runs of pieces with the same length in one step.  The result is that of
best fit decreasing over all pieces one by one; what reaches the driver is
bounded by ``capacity``, not by the number of documents.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import map_texts
from tidewater.llm.vocab import Vocabulary
from tidewater.session import stage_table

#: Id put after each document.
END_ID = 2
#: Pieces of one length that one task ranks, about; there are 64 buckets at least.
BUCKET_ROWS, LEAST_BUCKETS = 200_000, 64


def token_pieces(
    docs: DataFrame, vocab: Vocabulary, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 (and ``ids`` if asked for).

    A document's ids are its text's (null: none) and ``end_id``.  Only a longer
    one than ``capacity`` is cut: into full pieces, the first of which may be shorter.
    """
    end = np.array([end_id], "<u4").tobytes()

    def make():
        encoder = vocab.encoder()

        def f(texts):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(texts):
                raw = encoder.encode_text(text or "") + end
                n = len(raw) // 4
                first = (n - 1) % capacity + 1
                for k, at in enumerate(range(first - capacity, n, capacity)):
                    part = raw[4 * max(at, 0) : 4 * (at + capacity)]
                    row.append(i)
                    piece.append(k)
                    start.append(max(at, 0))
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").tolist())
            return [row, piece, start, length, crc, *([ids] if with_ids else [])]

        return f

    out = {"piece": "int", "start": "long", "length": "long", "ids_crc32": "long"} | ({"ids": "array<int>"} if with_ids else {})
    return map_texts(docs, make, out, [id_col], text_col, explode=True)


class _Room:
    """Segment tree over remaining capacities: which of them have an open sequence."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.size)

    def mark(self, room: int, on: bool) -> None:
        at = room + self.size
        self.any[at] = on
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def tightest(self, length: int) -> int | None:
        """The least capacity of ``length`` or more that has an open sequence."""
        at = length + self.size
        if self.any[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def best_fit_plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Best fit decreasing over counts by length.

    Returns steps ``(length, first rank, pieces, per sequence, first sequence,
    offset)`` and the number of sequences: the pieces of that length with ranks
    from the first on go, so many to a sequence, into sequences in a row.
    """
    open_runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # remaining capacity -> runs (first sequence, number)
    room, steps, opened = _Room(capacity), [], 0

    def put(left: int, first: int, n: int) -> None:
        if n and left:
            open_runs[left].append((first, n))
            room.mark(left, True)

    for length in sorted(counts, reverse=True):
        rank, rest = 0, counts[length]
        while rest:
            left = room.tightest(length)
            if left is None:
                left = capacity
                first, n = opened, -(-rest // (capacity // length))
                opened += n
            else:
                first, n = open_runs[left].pop()
                room.mark(left, bool(open_runs[left]))
            each = left // length
            full = min(n, rest // each)
            if full:
                steps.append((length, rank, full * each, each, first, capacity - left))
                put(left - each * length, first, full)
                rank, rest = rank + full * each, rest - full * each
            if full < n:
                if rest:  # fewer than one sequence takes
                    steps.append((length, rank, rest, rest, first + full, capacity - left))
                    put(left - rest * length, first + full, 1)
                    full, rank, rest = full + 1, rank + rest, 0
                put(left, first + full, n - full)
    return steps, opened


def pack(pieces: DataFrame, capacity: int = 1024, length_col: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: as best fit decreasing places them.

    Pieces of equal length are interchangeable; a piece without a length, or with
    none from 1 to ``capacity``, gets nulls.  Columns of the input with the results'
    names are replaced; all others stay as they are.
    """
    spark = pieces.sparkSession
    # the input's columns travel inside one, so no name of theirs meets one used here
    rows = stage_table(
        pieces.select(
            F.col(length_col).cast("long").alias("length"), F.struct(*[F.col(c) for c in pieces.columns]).alias("piece"), F.monotonically_increasing_id().alias("rid")
        ),
        "pack-pieces",
    )
    fits = rows.where(F.col("length").between(1, capacity))
    odd = rows.where(~F.coalesce(F.col("length").between(1, capacity), F.lit(False)))
    counts = {int(r[0]): int(r[1]) for r in fits.groupBy("length").count().collect()}  # capacity rows at most
    total = sum(counts.values())
    full = counts.pop(capacity, 0)  # each fills a sequence; needs no place among others
    steps, opened = best_fit_plan(counts, capacity)
    whole = fits.where(F.col("length") == capacity).select("piece", (F.lit(opened) + F.col("rid")).alias("sequence"), F.lit(0).cast("long").alias("place"))
    # dense ranks within a length without one task a length: ranks in buckets, and the buckets' totals before them
    buckets = max(LEAST_BUCKETS, -(-(total - full) // BUCKET_ROWS))
    part = fits.where(F.col("length") < capacity).withColumn("bucket", F.pmod(F.xxhash64("rid"), F.lit(buckets)))
    sums = part.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = sums.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("base"))
    ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("rid")) - 1)
    ranked = ranked.join(before, ["length", "bucket"]).select("length", (F.col("rank") + F.col("base")).cast("long").alias("rank"), "piece")
    order = sorted(steps)
    plan = spark.sparkContext.broadcast(np.array(order, dtype=np.int64).reshape(-1, 6))  # bounded by capacity
    wide = max([1, *counts.values()]) + 1
    longs = [T.StructField(c, T.LongType()) for c in ("sequence", "place")]
    schema = T.StructType([T.StructField("piece", rows.schema["piece"].dataType), *longs])
    names = schema.names

    def place(batches):
        p = plan.value
        starts = p[:, 0].astype(object) * wide + p[:, 1] if wide * (capacity + 1) >= 1 << 62 else p[:, 0] * wide + p[:, 1]
        for batch in batches:
            length, rank = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(length):
                continue
            s = p[np.searchsorted(starts, length * wide + rank, side="right") - 1]
            nth = rank - s[:, 1]
            sequence, offset = s[:, 4] + nth // s[:, 3], s[:, 5] + nth % s[:, 3] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(sequence), pa.array(offset)], names=names)

    placed = ranked.mapInArrow(place, schema)
    none = odd.select("piece", *[F.lit(None).cast("long").alias(c) for c in ("sequence", "place")])
    made = whole.unionByName(placed).unionByName(none)
    kept = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    return made.select(*[F.col("piece").getField(c).alias(c) for c in kept], F.col("sequence").alias("sequence_id"), F.col("place").alias("offset"))


__all__ = ["END_ID", "token_pieces", "best_fit_plan", "pack"]
