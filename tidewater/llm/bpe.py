"""Byte-level BPE encoding and decoding by overlapping chunks.

A long text is cut into overlapping chunks that are pre-tokenised in parallel,
each from its own first character, which need not be a true boundary.  The
pattern looks only ahead, so two runs of it that once share a boundary agree
from there on: neighbouring chunks are stitched at the first boundary that
both found in their overlap, and each stretch between two stitches is encoded
by itself.  Where an overlap holds no common boundary (one pre-token spans
it), that text is encoded as one piece of work.  Decoding concatenates the
raw bytes of the ids.

A null text counts as empty.  Rows that share a text share the work.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import ROWS_PER_STEP, free_name, map_texts
from tidewater.llm.vocab import Vocabulary
from tidewater.session import stage_table

#: Characters of a chunk, and how far it reads into the next one.
CHUNK, OVERLAP = 65_536, 1_024
#: A pre-token that ends this close to the end of what its chunk reads may not be whole.
MARGIN = 8


def _lists(parts: list[bytes]) -> pa.Array:
    """Little-endian uint32 bytes -> Arrow lists of int."""
    ends = np.cumsum([0, *[len(p) // 4 for p in parts]])
    values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _cuts(pieces: list[str]) -> np.ndarray:
    return np.cumsum([0, *map(len, pieces)])


def _chunked(long: DataFrame, text_col: str, vocab: Vocabulary, chunk: int, overlap: int) -> DataFrame:
    """(key, ids) of each different text of ``long``."""

    def cut():
        def f(texts):
            row, key, at, last, window = [], [], [], [], []
            for i, text in enumerate(texts):
                name = hashlib.sha256(text.encode()).hexdigest()
                for k in range(0, max(1, -(-len(text) // chunk))):
                    row.append(i)
                    key.append(name)
                    at.append(k)
                    last.append((k + 1) * chunk >= len(text))
                    window.append(text[k * chunk : (k + 1) * chunk + overlap])
            return [row, key, at, last, window]

        return f

    windows = map_texts(
        long, cut, {"key": "string", "chunk": "int", "last": "boolean", "window": "string"}, [], text_col, explode=True
    ).dropDuplicates(["key", "chunk"])

    def split():
        encoder = vocab.encoder()

        def f(found):
            heads, tails, cuts = [], [], []
            for window in found:
                at = _cuts(encoder.split(window))
                sure = at[at <= len(window) - MARGIN - encoder.longest_added]
                heads.append(sure[sure < overlap].tolist())
                tails.append((sure[sure >= chunk] - chunk).tolist())
                cuts.append(at.tolist())
            return [heads, tails, cuts]

        return f

    pieces = stage_table(
        map_texts(
            windows, split, {"head": "array<int>", "tail": "array<int>", "cuts": "array<int>"}, ["key", "chunk", "last", "window"], "window"
        ),
        "bpe-chunks",
    )
    # the stitch after each chunk: narrow rows, met by (key, chunk)
    after = pieces.select("key", "chunk", "last", "tail")
    before = pieces.select("key", (F.col("chunk") - 1).alias("chunk"), "head")
    stitch = after.join(before, ["key", "chunk"], "left").select(
        "key", "chunk", "last", F.array_min(F.array_intersect("tail", "head")).alias("end")
    )
    stitch = stage_table(stitch, "bpe-stitch")
    whole = stitch.where("not last and end is null").select("key").distinct()
    start = stitch.select("key", (F.col("chunk") + 1).alias("chunk"), F.col("end").alias("begin"))
    parts = (
        pieces.join(stitch.select("key", "chunk", "end"), ["key", "chunk"])
        .join(start, ["key", "chunk"], "left")
        .join(whole, "key", "left_anti")
        .select("key", "chunk", "window", "cuts", F.coalesce("begin", F.lit(0)).alias("begin"),
                F.coalesce(F.col("end") + chunk, F.lit(-1)).alias("end"))
    )

    def encode(batches):
        encoder = vocab.encoder()
        for batch in batches:
            for key, k, window, cuts, begin, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = np.array(cuts, dtype=np.int64)
                at = at[(at >= begin) & (at <= (end if end >= 0 else len(window)))].tolist()
                got = encoder.encode_pieces([window[a:b] for a, b in zip(at, at[1:])])
                yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([k], pa.int32()), _lists([got])], names=["key", "chunk", "ids"])

    some = parts.mapInArrow(encode, "key string, chunk int, ids array<int>").groupBy("key").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"])).alias("ids")
    )
    if whole.isEmpty():
        return some
    rest = long.select(F.sha2(F.col(text_col), 256).alias("key"), F.col(text_col).alias("_t_")).join(whole, "key", "left_semi").dropDuplicates(["key"])
    return some.unionByName(_direct(rest, "_t_", vocab, ["key"]).select("key", "ids"))


def _direct(docs: DataFrame, text_col: str, vocab: Vocabulary, keep: list[str]) -> DataFrame:
    def make():
        encoder = vocab.encoder()
        return lambda texts: [_lists([encoder.encode_text(t or "") for t in texts])]

    return map_texts(docs, make, {"ids": "array<int>"}, keep, text_col)


def bpe_encode(
    docs: DataFrame, vocab: Vocabulary, text_col: str = "text", keep: list[str] | None = None, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """The columns ``keep`` (default: all but the text and ``ids``) and ``ids``, the token ids of the whole text."""
    keep = [c for c in docs.columns if c not in (text_col, "ids")] if keep is None else keep
    text = F.coalesce(F.col(text_col), F.lit(""))
    t, key, got = (free_name(c, keep) for c in ("_text", "_key", "_ids"))
    rows = docs.select(text.alias(t), *[F.col(c) for c in keep])
    short = _direct(rows.where(F.length(t) <= chunk), t, vocab, keep)
    long = rows.where(F.length(t) > chunk)
    done = _chunked(long.select(t), t, vocab, chunk, overlap).withColumnRenamed("key", key).withColumnRenamed("ids", got)
    spread = long.select(F.sha2(t, 256).alias(key), *keep).join(done, key).select(*keep, F.col(got).alias("ids"))
    return short.unionByName(spread)


def bpe_decode(encoded: DataFrame, vocab: Vocabulary, ids_col: str = "ids", keep: list[str] | None = None, with_text: bool = False) -> DataFrame:
    """The columns ``keep`` (default: all but the results) and ``decoded``, the raw bytes of the
    ids (null ids: none); ``with_text`` adds ``ids_text``, the ids in decimals with one space between."""
    out = ["decoded", "ids_text"] if with_text else ["decoded"]
    keep = [c for c in encoded.columns if c not in out] if keep is None else keep
    schema = T.StructType([*encoded.select(*keep).schema.fields, T.StructField("decoded", T.BinaryType())])
    if with_text:
        schema = T.StructType([*schema.fields, T.StructField("ids_text", T.StringType())])

    def run(batches):
        encoder = vocab.encoder()
        decimals = [str(i) for i in range(len(encoder.table))]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_STEP):
                part = batch.slice(at, ROWS_PER_STEP)
                lists = part.column(0).fill_null([])
                ends = np.cumsum([0, *lists.value_lengths().to_pylist()]).tolist()
                ids = lists.flatten().to_numpy(zero_copy_only=False).tolist()
                rows = [ids[s:e] for s, e in zip(ends, ends[1:])]
                made = [pa.array([encoder.decode(r) for r in rows], pa.binary())]
                if with_text:
                    made.append(pa.array([" ".join(map(decimals.__getitem__, r)) for r in rows], pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *made], names=[*keep, *out])

    return encoded.select(F.col(ids_col).alias("_ids_"), *keep).mapInArrow(run, schema)


__all__ = ["CHUNK", "OVERLAP", "bpe_encode", "bpe_decode"]
