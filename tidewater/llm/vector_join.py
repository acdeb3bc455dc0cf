"""Embedding near-duplicates by a subspace pigeonhole join.

Vectors are scaled to length one, so a cosine of ``t`` or more is a squared
distance of ``2 - 2t`` or less.  A fixed random rotation spreads the variance
evenly, and the rotated dimensions are split into low-dimensional blocks.  If
two vectors are within the budget, then in one block at least they are within
the block's share of it (shares are proportional to the blocks' dimensions).
So each block is range-joined on its own: both sides are sorted by the block's
first coordinate, only the band within the block's radius is compared, and what
stays within the block's share is a candidate.  The union of the candidates of
all blocks is verified by the cosine in double precision.

Equal vectors are one member with a count.  Members are dealt to tiles by a
hash, and each pair of tiles is a task of bounded size, so a group of near
copies is spread like everything else.  A task returns, per vector, how many it
is linked with and one member of its group there: never the pairs.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import components
from tidewater.session import stage_table

#: Dimensions of a block; rows that are compared with a band at a time.
BLOCK_DIMS, STRIP = 16, 128
#: Members of a tile: no fewer than the first while there are tasks for all cores, no more than the
#: second, nor than take so many bytes.  A task holds two tiles and one byte per pair of their members.
LEAST_ROWS, MOST_ROWS, TILE_BYTES = 2_048, 8_192, 1 << 25
#: Tasks that pairs of tiles are dealt to, at most.
MOST_TASKS = 20_000
#: Slack of the filters, far above the errors of single precision; the verification has none.
SLACK = 1e-4


def rotation(dims: int, seed: int = 20_240_229) -> np.ndarray:
    """A random orthogonal matrix, the same in every process."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _blocks(dims: int, width: int = BLOCK_DIMS) -> list[tuple[int, int]]:
    n = max(1, dims // width)
    cuts = [dims * i // n for i in range(n + 1)]
    return list(zip(cuts, cuts[1:], strict=False))


def _candidates(a: np.ndarray, b: np.ndarray, blocks, share: np.ndarray) -> np.ndarray:
    """Which pairs of rows meet one block's share at least, as a table of len(a) x len(b)."""
    met = np.zeros((len(a), len(b)), bool)
    for (lo, hi), most in zip(blocks, share, strict=True):
        oa, ob = np.argsort(a[:, lo]), np.argsort(b[:, lo])
        xa, xb = a[oa, lo:hi], b[ob, lo:hi]
        # |x|^2 - 2xy + |y|^2 - share in one product
        left = np.concatenate([-2 * xa, np.ones((len(xa), 1)), (xa**2).sum(1, keepdims=True) - most - SLACK], axis=1).astype(np.float32)
        right = np.concatenate([xb, (xb**2).sum(1, keepdims=True), np.ones((len(xb), 1))], axis=1).astype(np.float32).T.copy()
        radius = math.sqrt(most + SLACK)
        for at in range(0, len(xa), STRIP):
            part = xa[at : at + STRIP, 0]
            s, e = np.searchsorted(xb[:, 0], part[0] - radius), np.searchsorted(xb[:, 0], part[-1] + radius, side="right")
            if s == e:
                continue
            over = left[at : at + STRIP] @ right[:, s:e]
            some = np.flatnonzero(over.min(1) <= 0)
            i, j = np.nonzero(over[some] <= 0)
            met[oa[at + some[i]], ob[s + j]] = True
    return met


def _linked(a: np.ndarray, b: np.ndarray, met: np.ndarray, cosine: float):
    """The candidates whose cosine in double precision is enough, a strip of rows at a time."""
    for at in range(0, len(a), STRIP):
        i, j = np.nonzero(met[at : at + STRIP])
        if not len(i):
            continue
        if 16 * len(i) > min(STRIP, len(a) - at) * len(b):
            enough = (a[at : at + STRIP] @ b.T)[i, j] >= cosine
        else:
            enough = np.concatenate([np.einsum("ij,ij->i", a[at + i[k : k + 65_536]], b[j[k : k + 65_536]]) for k in range(0, len(i), 65_536)]) >= cosine
        if enough.any():
            yield at + i[enough], j[enough]


def _group(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index of each index's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _matrices(column: pa.ListArray):
    """(rows, vectors) per length of the vectors that count: not null, empty or zero, all components finite."""
    length = column.value_lengths().fill_null(0).to_numpy()
    flat = column.flatten()
    kind = np.float32 if pa.types.is_float32(flat.type) else np.float64
    flat = flat.cast(pa.from_numpy_dtype(kind)).fill_null(math.nan).to_numpy()
    begin = np.cumsum(length) - length
    for dims in np.unique(length[length > 0]).tolist():
        rows = np.flatnonzero(length == dims)
        made = flat[begin[rows][:, None] + np.arange(dims)]
        good = np.isfinite(made).all(1) & (made != 0).any(1)
        yield rows[good], made[good]


def _units(made: np.ndarray) -> np.ndarray:
    """The rows at length one, in double precision."""
    made = made.astype(np.float64)
    made /= np.abs(made).max(1, keepdims=True)  # no overflow or underflow of squares
    return made / np.sqrt((made * made).sum(1, keepdims=True))


def embedding_links(
    vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", tile_rows: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, counts, roots): each row's id and member ``key`` (null if it links with
    nothing), per key the number of links to other keys' rows, and components over keys.
    Vectors of different lengths never link.  ``tile_rows`` sets the members of a tile;
    without it tiles are as large as leaves two tasks for each core, within the fixed limits."""
    spark = vectors.sparkSession
    shown, number = vectors.schema[id_col].dataType.simpleString(), vectors.schema[vector_col].dataType.elementType.simpleString()
    kind = np.float32 if number == "float" else np.float64

    def read(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                key, dims, raw = [None] * part.num_rows, [0] * part.num_rows, [None] * part.num_rows
                for rows, made in _matrices(part.column(1)):
                    units = _units(made) + 0.0
                    for k, row in enumerate(rows.tolist()):
                        key[row], raw[row] = hashlib.blake2b(units[k].tobytes(), digest_size=16).hexdigest(), made[k].tobytes()
                        dims[row] = made.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(key, pa.string()), pa.array(dims, pa.int32()), pa.array(raw, pa.binary())], names=["id", "key", "dims", "vector"]
                )

    table = vectors.select(F.col(id_col).alias("id"), F.col(vector_col)).mapInArrow(read, f"id {shown}, key string, dims int, vector binary")
    table = stage_table(table, "vector-rows")
    rows = table.select("id", "key")
    members = table.where("key is not null").groupBy("key").agg(F.first("dims").alias("dims"), F.first("vector").alias("vector"), F.count("*").alias("copies"))
    members = stage_table(members, "vector-members")
    if tile_rows:
        tiles = F.ceil(F.count("*") / tile_rows)
    else:
        most = F.least(F.lit(MOST_ROWS), F.greatest(F.lit(1), F.floor(F.lit(TILE_BYTES) / (8 * F.col("dims")))))
        busy = math.ceil(math.sqrt(4 * spark.sparkContext.defaultParallelism))
        tiles = F.greatest(F.ceil(F.count("*") / most), F.least(F.ceil(F.count("*") / LEAST_ROWS), F.lit(busy)))
    sizes = members.groupBy("dims").agg(tiles.cast("int").alias("tiles"))
    dealt = members.join(sizes, "dims").withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("dims", F.least("tile", "other").alias("p"), F.greatest("tile", "other").alias("q"), "tile", "key", "vector", "copies")
    budget = 2 - 2 * cosine

    def link(group: pa.Table) -> pa.Table:
        dims, p, q = (group.column(c)[0].as_py() for c in ("dims", "p", "q"))
        blocks = _blocks(dims)
        share = np.array([budget * (e - s) / dims for s, e in blocks])
        key, copies = group.column("key").to_pylist(), group.column("copies").to_numpy()
        unit = _units(np.frombuffer(b"".join(group.column("vector").to_pylist()), kind).reshape(-1, dims))
        turned = unit @ rotation(dims)
        tile = group.column("tile").to_numpy()
        left, right = np.flatnonzero(tile == p), np.flatnonzero(tile == q)
        met = _candidates(turned[left], turned[right], blocks, share)
        if p == q:
            met = np.triu(met, 1)
        links = np.zeros(len(key), np.int64)
        ends = []
        for i, j in _linked(unit[left], unit[right], met, cosine):
            i, j = left[i], right[j]
            links += np.bincount(i, copies[j], len(key)).astype(np.int64) + np.bincount(j, copies[i], len(key)).astype(np.int64)
            # of a strip's links only what joins its members, so their number has no square in it
            root = _group(len(key), i, j)
            some = np.flatnonzero(root != np.arange(len(key)))
            ends.append(np.stack([some, root[some]]))
        i, j = np.concatenate(ends, axis=1) if ends else np.zeros((2, 0), np.int64)
        some = np.flatnonzero(links)
        root = _group(len(key), i, j)[some]
        return pa.table(
            {"key": pa.array([key[x] for x in some], pa.string()), "links": pa.array(links[some]), "root": pa.array([key[x] for x in root], pa.string())}
        )

    pairs = sizes.agg(F.sum(F.col("tiles").cast("long") * (F.col("tiles") + 1) / 2)).first()[0]
    tasks = int(min(max(pairs or 1, 1), MOST_TASKS))  # small in bytes, not in work: not for Spark to put together
    found = dealt.repartition(tasks, "dims", "p", "q").groupBy("dims", "p", "q").applyInArrow(link, "key string, links long, root string")
    found = stage_table(found, "vector-links")
    counts = found.groupBy("key").agg(F.sum("links").alias("links"))
    return rows, counts, components(found.select(F.col("key").alias("a"), F.col("root").alias("b")).distinct(), "vector")


def embedding_components(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector: id, ``n_links`` (other vectors at ``cosine`` or more), ``component_id``
    (least id reachable by links, itself included), ``kept`` (whether it is that one).

    Null, empty and zero vectors, and those with null or non-finite components, link
    with nothing.  Rows that share an id are vectors of their own.  A null id is never
    the least unless all ids of the component are null.
    """
    rows, counts, roots = embedding_links(vectors, cosine, id_col, vector_col)
    keys = rows.where("key is not null").groupBy("key").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
    keys = keys.join(counts, "key", "left").join(roots.withColumnRenamed("node", "key"), "key", "left")
    keys = stage_table(
        keys.select("key", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "key").alias("root")), "vector-keys"
    )
    least = keys.groupBy("root").agg(F.min("least").alias("component_id"))
    known = keys.join(least, "root").select("key", "n_links", "component_id")
    lone = F.col("key").isNull()
    return rows.join(known, "key", "left").select(
        F.col("id").alias(id_col),
        F.when(lone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.when(lone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.when(lone, F.lit(True)).otherwise(F.col("id") == F.col("component_id")), F.lit(False)).alias("kept"),
    )


__all__ = ["rotation", "embedding_links", "embedding_components"]
