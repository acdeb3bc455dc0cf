"""Counts and marks of a fixed size, gathered from all rows of a frame."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A table travels in so many rows a task.
BLOCKS = 64
#: Bits of one bitmap that Spark's ``bitmap_construct_agg`` makes.
BITMAP = 32768


def fixed_table(df: DataFrame, size: int, places, kind: str = "<u4") -> np.ndarray:
    """Counts of a fixed size: ``places(batch)`` yields arrays of indices to count.

    Every task counts its own rows, blocks of counters are added up in a second
    stage, and ``size`` numbers reach the driver.  Counts end at the kind's largest number.
    """
    width, most = size // BLOCKS, np.iinfo(kind).max

    # a task counts few of each, so most bytes are zeros
    def pack(raw: bytes) -> bytes:
        return zstandard.ZstdCompressor(level=1).compress(raw)

    def unpack(raw: bytes) -> np.ndarray:
        return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)

    def rows(found: dict[int, np.ndarray]):
        for b, v in found.items():
            raw = pack(np.minimum(v, most).astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([raw], pa.binary())], names=["block", "counts"])

    def count(batches):
        total = np.zeros(size, np.uint32)
        for batch in batches:
            for at in places(batch):
                np.add.at(total, at, 1)
        blocks = total.reshape(BLOCKS, width)
        yield from rows({int(b): blocks[b] for b in np.nonzero(blocks.any(axis=1))[0]})

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[b] = total.get(b, 0) + unpack(raw).astype(np.int64)
        yield from rows(total)

    row = "block int, counts binary"
    made = df.mapInArrow(count, row).repartition(BLOCKS, "block").mapInArrow(add, row)
    out = np.zeros(size, kind)
    for r in made.collect():  # BLOCKS rows, size numbers in all
        out[r.block * width : (r.block + 1) * width] = unpack(r.counts)
    return out


def marks(df: DataFrame, size: int, place: Column) -> np.ndarray:
    """Bits of a fixed size (a multiple of ``BITMAP``): set where ``place``, a number below it, points.

    Every task makes the bitmaps of its own rows and these are put together by bucket:
    a task sends ``size`` bits at most, and so many reach the driver.
    """
    at = df.select(place.alias("at"))
    made = at.groupBy(F.expr(f"at div {BITMAP}").alias("bucket")).agg(F.bitmap_construct_agg(F.col("at") % BITMAP).alias("bits"))
    out = np.zeros(size // BITMAP, f"V{BITMAP // 8}")
    for r in made.collect():  # size bits
        out[r.bucket] = bytes(r.bits)
    return out.view(np.uint8)


def is_marked(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def low_bits(number: Column, size: int) -> Column:
    """The place of a 64-bit number in a table of ``size``, a power of two."""
    return number.bitwiseAND(F.lit(size - 1))


def name_place(name: Column, size: int) -> Column:
    """The place of a digest in a table of ``size``, a power of two up to 2^24; ``name_places`` is the same in a task."""
    return low_bits(F.conv(F.hex(F.substring(name, 1, 3)), 16, 10).cast("long"), size)


def name_places(names: list[bytes], size: int) -> np.ndarray:
    return np.array([int.from_bytes(x[:3], "big") & (size - 1) for x in names], np.int64)


__all__ = ["BITMAP", "BLOCKS", "fixed_table", "marks", "is_marked", "low_bits", "name_place", "name_places"]
