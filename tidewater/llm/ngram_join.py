"""N-gram Jaccard join: which documents share nearly all of their word n-grams.

The documents are the rows and the n-grams the columns of a sparse incidence
matrix; its product with its own transpose holds the overlaps.  Only cells that
can reach the threshold are computed:

* equal sets are one row (its documents are its members);
* a row keeps as many columns as a partner within the threshold cannot miss
  altogether (prefix bound), rarest first by a fixed-size table of column
  counts; a column and two neighbouring size classes are a block, so sizes too
  far apart never meet, and a block with one row is left out before any shuffle of cells;
* the product is taken blockwise over those columns: partial overlaps are
  summed per pair, and pairs below the size-derived bound go;
* each row also has a bitmap of the parities of its columns by place; two rows differ in as
  many columns at least as their bitmaps in bits, so pairs whose bitmaps differ too much go;
* what is left is verified over all columns, from the texts: these are found again by their
  hash and travel packed, which is a fraction of their columns.

A column is a gram's hash cut to 32 bits: grams that share one give a candidate
more, never one less.

A block with very many rows (a large group of near copies) would give all its
pairs.  So the first pass takes only the pairs of each row with the blocks'
hubs (a few rows per size class), and of these the ones with most columns in
common.  Rows joined by a verified link need no other link between them, since
the result is the components.  The second pass takes all pairs of rows that
are still in different components: a group whose rows were joined has none.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import components, map_texts
from tidewater.llm.tables import fixed_table, is_marked, low_bits, marks
from tidewater.session import scratch_path, scratch_scope, stage_table

#: Counters of the table by which columns are ordered: rarer ones first (4 bytes each).
COUNTERS = 1 << 20
#: Bits of the table that marks blocks with two rows or more; fixed size (8 MB).
BLOCK_MARKS = 1 << 26
#: Tell a column's blocks apart: each has two places in the table, by other bits of the column.
_CLASS, _CLASS_2, _SHIFT_2 = 0x9E3779B1, 0x85EBCA6B, 6
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Hubs of a block and size class in the first pass, by how much of them others share, in steps of
#: so many thousandths (the last: by a hash alone); a row is compared with two of them.
HUB_SHARES = (1, 50, 2_000)
#: Bits of the table that marks the texts to fetch; fixed size (8 MB).
MARKS = 1 << 26
#: Sets that a task keeps while it verifies pairs; those of a hub follow each other.
RECENT = 16
#: Bits of a row's bitmap of parities (64 bytes).
PARITIES = 512


def gram_hashes(text: str | None, n: int) -> np.ndarray:
    """Sorted different 64-bit hashes of the word n-grams; A-Z are lower-cased, words are
    cut at ASCII white space; of fewer than n words, the whole sequence is the one gram."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    wide = min(n, len(h))
    out = np.full(len(h) - wide + 1, wide, dtype=np.uint64) * _B
    for k in range(wide):
        out = (out ^ h[k : len(h) - wide + 1 + k]) * _A
        out ^= out >> np.uint64(29)
    out = out * _B
    return np.unique(out ^ (out >> np.uint64(32)))


def least_overlap(size: np.ndarray, percent: int) -> np.ndarray:
    """Grams that a row shares at least with any partner."""
    return -(-size * percent // 100)


def _counter(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(44)).astype(np.int64)


def _name(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _key(text: str | None) -> int:
    """By which a text is found again; texts that share one are told apart by the names of their sets."""
    import xxhash

    return xxhash.xxh3_64_intdigest((text or "").encode())


def _keys(texts: list) -> np.ndarray:
    return np.array([_key(t) for t in texts], np.uint64).view(np.int64)


def _parities(grams: np.ndarray) -> bytes:
    """Bit i: whether an odd number of the grams has place i."""
    return np.packbits(np.bincount((grams >> np.uint64(33)).astype(np.int64) & (PARITIES - 1), minlength=PARITIES) & 1).tobytes()


def jaccard_rows(
    docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """(keep..., _n_shingles, _row, _key, _bits, _prefix): each document's set size, the name of its set
    (null without words), its text's hash, its bitmap and the columns that a partner can't miss altogether."""
    grams = docs.select(F.col(text_col).cast("string"))
    rare_ = docs.sparkSession.sparkContext.broadcast(  # COUNTERS numbers
        fixed_table(grams, COUNTERS, lambda batch: (_counter(gram_hashes(t, n)) for t in batch.column(0).to_pylist()))
    )

    def make():
        rare = rare_.value

        def f(texts):
            sizes, names, bits, prefixes = [], [], [], []
            for t in texts:
                s = gram_hashes(t, n)
                sizes.append(len(s))
                names.append(_name(s) if len(s) else None)
                bits.append(_parities(s))
                wide = len(s) - int(least_overlap(np.int64(len(s)), percent)) + 1 if len(s) else 0
                prefixes.append(s[np.lexsort((s, rare[_counter(s)]))[:wide]].astype(np.uint32).view(np.int32))
            return [sizes, names, _keys(texts), bits, pa.array(prefixes, pa.list_(pa.int32()))]

        return f

    return map_texts(docs, make, {"_n_shingles": "long", "_row": "binary", "_key": "long", "_bits": "binary", "_prefix": "array<int>"}, [id_col] if keep is None else keep, text_col)


def jaccard_links(docs: DataFrame, rows: DataFrame, n: int = 3, percent: int = 90, text_col: str = "text") -> DataFrame:
    """Components ``(node, root)`` over the names of sets: those with a link to another set.
    ``rows`` is what ``jaccard_rows`` gave for ``docs``, kept in a table."""
    spark = docs.sparkSession
    path = scratch_path(spark, "jaccard-links")
    with scratch_scope(spark):  # what the links are made from goes with them written
        _links(docs.select(F.col(text_col).cast("string").alias("_t")), rows, n, percent).write.parquet(path)
    return spark.read.parquet(path)


def _links(docs: DataFrame, rows: DataFrame, n: int, percent: int) -> DataFrame:
    firsts = [F.first(f"_{c}").alias(c) for c in ("key", "bits", "prefix")]
    sets = rows.where("_row is not null").groupBy(F.col("_row").alias("name")).agg(F.first("_n_shingles").alias("size"), *firsts)
    # a number is shorter than a name, and like numbers lie side by side; the table keeps them
    sets = stage_table(sets.withColumn("row", F.monotonically_increasing_id()), "jaccard-rows-once")
    # size classes are wider than what may lie between the sizes of partners, so these are
    # of one class or of neighbouring ones: a row is in the blocks of its own and the next lower one
    sets = sets.withColumn("class", F.floor(F.log(F.col("size").cast("double")) / math.log(1.01 * 100 / percent)))
    # a block with one row has no product; what the table marks besides does no harm
    counted = sets.select(F.explode("prefix").alias("gram"), "class").repartition("gram").groupBy("gram", "class").agg(F.count("*").alias("rows"))
    follows = F.lead("class").over(Window.partitionBy("gram").orderBy("class")) == F.col("class") + 1
    shared = counted.withColumn("follows", F.coalesce(follows, F.lit(False))).where("rows > 1 or follows")
    both = F.array(F.col("class"), F.col("class") - 1)
    shared = shared.select("gram", F.explode(F.when(F.col("rows") > 1, both).otherwise(F.slice(both, 1, 1))).alias("class"))
    gram = F.col("gram").cast("long")
    places = F.array(gram.bitwiseXOR(F.col("class") * _CLASS), F.shiftright(gram, _SHIFT_2).bitwiseXOR(F.col("class") * _CLASS_2))
    shared = shared.select(F.explode(places).alias("block"))
    bits_ = docs.sparkSession.sparkContext.broadcast(marks(shared, BLOCK_MARKS, low_bits(F.col("block"), BLOCK_MARKS)))

    def in_block(bits, grams, classes):
        one = is_marked(bits, (grams ^ (classes * _CLASS)) & (BLOCK_MARKS - 1))
        return one & is_marked(bits, ((grams >> _SHIFT_2) ^ (classes * _CLASS_2)) & (BLOCK_MARKS - 1))

    def filter_cells(batches):
        bits = bits_.value
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            lists = batch.column(2)
            grams = lists.flatten().to_numpy()
            wide = lists.value_lengths().to_numpy()
            owner = np.repeat(np.arange(len(wide)), wide)
            classes = batch.column(3).to_numpy()[owner]
            some = in_block(bits, grams, classes) | in_block(bits, grams, classes - 1)
            # the part of a row's columns that other rows have: all of them for a text that its copies were made from
            share = 1000 * np.bincount(owner[some], minlength=len(wide)) // np.maximum(wide, 1)
            place = np.arange(len(owner)) - (np.cumsum(wide) - wide)[owner]
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[some]), batch.column(0).take(pa.array(owner[some])), pa.array(sizes[owner[some]]), pa.array(classes[some]), pa.array(share[owner[some]]), pa.array(place[some])],
                names=["gram", "row", "size", "class", "share", "place"],
            )

    cells = sets.select("row", "size", "prefix", "class").mapInArrow(filter_cells, "gram int, row long, size long, class long, share long, place long")
    cells = stage_table(cells, "jaccard-cells")

    # first pass: each row with hubs of its own and the next lower size class
    seeds = [
        F.max(F.struct(F.floor(F.col("share") / coarse).alias("s"), F.hash("row", F.lit(k)).alias("h"), "row", "size")).alias(f"hub{k}")
        for k, coarse in enumerate(HUB_SHARES)
    ]
    hubs = cells.groupBy("gram", "class").agg(*seeds)
    hubs = hubs.select("gram", "class", F.explode(F.array_distinct(F.array(
        *[F.struct(F.col(f"hub{k}.row").alias("other"), F.col(f"hub{k}.size").alias("other_size")) for k in range(len(HUB_SHARES))]))).alias("hub"))
    reach = cells.select("gram", "row", "size", F.explode(F.array(F.col("class"), F.col("class") - 1)).alias("class"))
    near = reach.join(hubs.select("gram", "class", "hub.*"), ["gram", "class"]).where("row <> other")
    near = _products(near, percent)
    # a hub is one in most of the blocks that it shares with a row, not in all
    near = near.where(2 * F.col("common") >= F.col("least"))
    best = near.groupBy("row").agg(F.max(F.struct("common", "other")).alias("a"), F.min(F.struct((-F.col("common")).alias("common"), F.col("other"))).alias("b"))
    best = stage_table(best.select("row", F.explode(F.array_distinct(F.array("a.other", "b.other"))).alias("other")), "jaccard-best")
    stars = _verified(docs, _close(best, sets, percent), n, percent)
    first = stage_table(components(_edges(stars), "jaccard-first"), "jaccard-roots")

    # second pass: all pairs of rows in different components
    label = first.withColumnRenamed("node", "row")
    cells = cells.join(label, "row", "left").withColumn("root", F.coalesce("root", "row"))
    mixed = cells.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("gram")
    cells = stage_table(cells.join(mixed, "gram"), "jaccard-mixed")
    other = cells.select("gram", *[F.col(c).alias(f"other_{c}") for c in ("size", "root", "place")], F.col("row").alias("other"))
    larger = (F.col("size") > F.col("other_size")) | ((F.col("size") == F.col("other_size")) & (F.col("row") > F.col("other")))
    # a pair that shares ``both`` columns shares one of the first size - both + 1 of either
    # row; a row that starts with columns of its own meets no partner of its size
    a, b = F.col("size"), F.col("other_size")
    both = _both(a, b, percent)
    early = (F.col("place") + both <= a) & (F.col("other_place") + both <= b)
    cross = cells.join(other, "gram").where((F.col("root") != F.col("other_root")) & larger & (b * 100 >= a * percent) & early)
    met = stage_table(cross.select("row", "other").distinct(), "jaccard-met")
    # overlaps over all kept columns of those pairs that met and are close
    close = _close(met, sets, percent)
    own = sets.select("row", "size", "prefix")
    own = own.join(close.select("row").union(close.select(F.col("other").alias("row"))).distinct(), "row", "left_semi")
    sized = close.join(own, "row").join(own.select(F.col("row").alias("other"), F.col("size").alias("other_size"), F.col("prefix").alias("other_prefix")), "other")
    # columns that became one by their cut count once here
    common = F.size(F.array_intersect("prefix", "other_prefix")) + F.size("prefix") - F.size(F.array_distinct("prefix"))
    near = sized.where(common >= _least(a, b, percent))
    more = _verified(docs, near.select("row", "other", "name", "other_name", "key", "other_key"), n, percent)
    roots = components(_edges(stars).unionByName(_edges(more)), "jaccard-all")
    named = sets.select(F.col("row").alias("node"), "name")
    roots = roots.join(named, "node").select("root", F.col("name").alias("node"))
    return roots.join(named.withColumnRenamed("node", "root"), "root").select("node", F.col("name").alias("root"))


def _both(a, b, percent: int):
    """Columns that two rows of these sizes have in common at least if they link."""
    return F.ceil((a + b) * percent / (100 + percent))


def _least(a, b, percent: int):
    """Those among the kept columns: beyond them both have fewer than t times the larger size in common."""
    return _both(a, b, percent) - F.ceil(F.greatest(a, b) * percent / 100) + 1


def _products(met: DataFrame, percent: int) -> DataFrame:
    """Overlaps in the kept columns per pair, summed over the blocks, and the least that a link needs."""
    a, b = F.col("size"), F.col("other_size")
    near = met.where(F.least(a, b) * 100 >= F.greatest(a, b) * percent)
    return near.groupBy("row", "other", _least(a, b, percent).alias("least")).agg(F.count("*").alias("common"))


def _close(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those ``pairs`` of rows that may link by their sizes and bitmaps, with the names and hashes of both."""
    wanted = pairs.select("row").union(pairs.select(F.col("other").alias("row"))).distinct()
    one = stage_table(sets.select("row", "size", "bits", "name", "key").join(wanted, "row", "left_semi"), "jaccard-paired")
    other = one.select(*[F.col(c).alias(f"other_{c}" if c != "row" else "other") for c in one.columns])
    met = pairs.join(one, "row").join(other, "other")
    met = met.select("row", "other", "name", "other_name", "size", "other_size", "bits", "other_bits", "key", "other_key")

    def few(batches):
        for batch in batches:
            size = batch.column(4).to_numpy() + batch.column(5).to_numpy()
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(-1, PARITIES // 64) for i in (6, 7))
            differ = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
            # sets that differ in so many have half of the rest in common at most
            close = (size - differ) // 2 >= -(-size * percent // (100 + percent))
            yield batch.select(["row", "other", "name", "other_name", "key", "other_key"]).filter(pa.array(close))

    return stage_table(met.mapInArrow(few, "row long, other long, name binary, other_name binary, key long, other_key long"), "jaccard-close")


def _edges(pairs: DataFrame) -> DataFrame:
    return pairs.where("linked").select(F.col("row").alias("a"), F.col("other").alias("b"))


def _verified(docs: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """``pairs`` (row, other, name, other_name, key, other_key) with ``linked``: whether the overlap over
    all grams reaches the bound.

    A text of each row that is in a pair is found again by its hash and met with the pairs by the
    name of its set, first the one side and then the other; the sets are made where both meet.
    """
    pairs = stage_table(pairs, "jaccard-pairs")
    wanted = pairs.select("key").union(pairs.select("other_key")).distinct()
    bits_ = docs.sparkSession.sparkContext.broadcast(marks(wanted, MARKS, low_bits(F.col("key"), MARKS)))  # MARKS bits

    def found():
        bits, packer = bits_.value, zstandard.ZstdCompressor()

        def f(texts):
            some = np.flatnonzero(is_marked(bits, _keys(texts) & (MARKS - 1))).tolist()
            return [some, [_name(gram_hashes(texts[i], n)) for i in some], [packer.compress((texts[i] or "").encode()) for i in some]]

        return f

    full = map_texts(docs, found, {"name": "binary", "packed": "binary"}, [], "_t", explode=True)
    full = stage_table(full.dropDuplicates(["name"]), "jaccard-sets")  # the few that are marked by chance find no pair
    met = pairs.select("row", "other", "name", "other_name").join(full, "name")
    met = met.join(full.select(F.col("name").alias("other_name"), F.col("packed").alias("other_packed")), "other_name")

    def overlap(batches):
        unpacker = zstandard.ZstdDecompressor()
        grams = lru_cache(RECENT)(lambda packed: gram_hashes(unpacker.decompress(packed).decode(), n))
        for batch in batches:
            linked = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = grams(a), grams(b)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["row", "other", "linked"])

    return stage_table(
        met.select("row", "other", "packed", "other_packed").mapInArrow(overlap, "row long, other long, linked boolean"), "jaccard-tried"
    )


def jaccard_components(docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, ``n_shingles`` and ``component_id``,
    the smallest id reachable by links of ``percent`` or more (itself included).

    Documents without words (null or empty text) link with nothing and are their own
    component.  Rows with a null id take part, but name a component only if all its ids are null.
    """
    members = stage_table(jaccard_rows(docs, n, percent, id_col, text_col, [id_col]), "jaccard-rows")
    roots = jaccard_links(docs, members, n, percent, text_col).select(F.col("node").alias("_row"), F.col("root").alias("_root"))
    least = members.where("_row is not null").groupBy("_row").agg(F.min(id_col).alias("_least"))
    named = stage_table(least.join(roots, "_row", "left").withColumn("_root", F.coalesce("_root", "_row")), "jaccard-named")
    smallest = named.groupBy("_root").agg(F.min("_least").alias("_smallest"))
    lookup = named.join(smallest, "_root").select("_row", "_smallest")
    return members.join(lookup, "_row", "left").select(
        id_col, F.col("_n_shingles").alias("n_shingles"), F.when(F.col("_row").isNull(), F.col(id_col)).otherwise(F.col("_smallest")).alias("component_id")
    )


def drop_near_copies(docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component: the one with the smallest id (null ids last; of rows
    that share it, any one).  Documents without words stay."""
    # the input's columns travel inside one, so no name of theirs meets one used here
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"), F.struct(*[F.col(c) for c in docs.columns]).alias("doc"),
        F.monotonically_increasing_id().alias("rid"),
    )
    members = stage_table(jaccard_rows(rows, n, percent, "id", "t", ["id", "doc", "rid"]), "jaccard-rows")
    texts = members.select(F.col("doc").getField(text_col).alias("t"))
    roots = jaccard_links(texts, members, n, percent, "t").select(F.col("node").alias("_row"), "root")
    lead = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("rid").alias("rid"))
    best = members.where("_row is not null").groupBy("_row").agg(F.min(lead).alias("lead")).join(roots, "_row", "left")
    best = best.groupBy(F.coalesce("root", "_row")).agg(F.min("lead").alias("lead")).select(F.col("lead.rid").alias("rid"))
    stay = members.where("_row is not null").join(best, "rid", "left_semi").select("doc").unionByName(members.where("_row is null").select("doc"))
    return stay.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


__all__ = ["drop_near_copies", "gram_hashes", "jaccard_components", "jaccard_links", "jaccard_rows"]
