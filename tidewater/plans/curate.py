"""Prebatch (dedup) and batch plans over stored runs."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.scalars import present_fields
from tidewater.functions.tokens import LengthTokenizer, LocalTokenizer, Tokenizer
from tidewater.operators.batching import (
    DEFAULT_ROWS_PER_CHUNK,
    assign_batches,
    batch_items,
    oversized_rows,
)
from tidewater.operators.dedup import prebatch
from tidewater.session import stage_table
from tidewater.sources.store import render_batches, store_batches, write_prebatch


def prebatch_runs(
    messages: DataFrame,
    text: str = "text",
    pos: str = "pos",
    run: str = "run",
    method: str = "hash",
) -> DataFrame:
    """Dedup every run at once: first copy kept, ``dup_count`` appended."""
    return prebatch(messages, text=text, order=pos, partition=run, method=method)


def run_prebatch(messages: DataFrame, out_path: str, **kwargs) -> str:
    """Dedup and store under the same run values."""
    return write_prebatch(prebatch_runs(messages, **kwargs), out_path)


def with_tokens(
    df: DataFrame,
    fields: Sequence[str],
    tokenizer: Tokenizer | None = None,
    tokens: str = "tokens",
) -> DataFrame:
    """Token count of each row's JSON record made of ``fields``."""
    tok = tokenizer or LocalTokenizer()
    return df.withColumn(tokens, tok.count_record(list(fields)))


def batch_runs(
    prebatched: DataFrame,
    cap: int,
    fields: Sequence[str],
    tokenizer: Tokenizer | None = None,
    run: str = "run",
    pos: str = "pos",
    tokens: str = "tokens",
    rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK,
) -> tuple[DataFrame, DataFrame]:
    """Token-count, set oversized rows aside, and batch every run.

    Returns ``(batched, oversized)``; ``batched`` carries ``batch_no``,
    ``batch_idx``, ``total_batches`` and ``file_name``.
    """
    # counted once: a model tokenizer must not see every text twice
    counted = stage_table(with_tokens(prebatched, fields, tokenizer, tokens), "counted")
    batched = assign_batches(counted, cap, tokens=tokens, run=run, pos=pos, rows_per_chunk=rows_per_chunk, stage=False)
    return batch_items(batched, run), oversized_rows(counted, cap, tokens)


def run_batch(
    prebatched: DataFrame,
    cap: int,
    fields: Sequence[str],
    out_path: str,
    tokenizer: Tokenizer | None = None,
    run: str = "run",
    pos: str = "pos",
    per_batch_folders: bool = False,
) -> tuple[str, DataFrame]:
    """Batch and store the batches' documents as their rows pass (:func:`store_batches`);
    returns the path and the oversized rows (reported, not stored)."""
    batched, oversized = batch_runs(prebatched, cap, fields, tokenizer, run, pos)
    return store_batches(batched, fields, out_path, run, per_batch_folders), oversized


def batch_documents(batched: DataFrame, fields: Sequence[str], run: str = "run") -> DataFrame:
    return render_batches(batched, fields, run)


def survivor_tokens(
    messages: DataFrame,
    fields: Sequence[str],
    tokenizer: Tokenizer | None = None,
    run: str = "run",
    pos: str = "pos",
    text: str = "text",
    carry: Sequence[str] = (),
    count_col: str = "dup_count",
) -> DataFrame:
    """First copy of every text per run: ``run, pos, dup_count, tokens``
    (+ ``carry`` columns of that copy); tokens of its record ``fields`` +
    ``dup_count``.

    With a length tokenizer no text moves: a survivor's token count depends
    only on its compact ``to_json`` length, its number of present fields and
    the digits of its copy count.  The scan reduces each row to
    ``(run, pos, sha256(text), length, fields)``, the dedup aggregate keeps
    the first copy's values with ``min_by`` and the record length with the
    count appended is a formula.  Other tokenizers count the survivors'
    record texts after a regular dedup.
    """
    tok = tokenizer or LocalTokenizer()
    if not isinstance(tok, LengthTokenizer):
        pre = prebatch_runs(messages, text=text, pos=pos, run=run)
        counted = with_tokens(pre, [*fields, count_col], tok)
        return counted.select(run, pos, count_col, "tokens", *carry)
    compact = F.to_json(F.struct(*[F.col(f) for f in fields]))
    length = F.octet_length(compact) if tok.unit == "bytes" else F.char_length(compact)
    rows = messages.select(
        F.col(run),
        F.col(pos),
        F.sha2(F.col(text).cast("binary"), 256).alias("__h"),
        length.cast("long").alias("__len"),
        present_fields(fields).alias("__n"),
        *[F.col(c) for c in carry],
    )
    firsts = rows.groupBy(run, "__h").agg(
        F.count(F.lit(1)).alias(count_col),
        F.min(pos).alias(pos),
        F.min_by("__len", pos).alias("__len"),
        F.min_by("__n", pos).alias("__n"),
        *[F.min_by(c, pos).alias(c) for c in carry],
    )
    key = len(json.dumps(count_col)) + 1  # "dup_count":
    digits = F.length(F.col(count_col).cast("string"))
    comma = F.when(F.col("__n") > 0, 1).otherwise(0)
    # compact record with the count appended, then Python's separator spaces
    spaced = F.col("__len") + key + digits + comma + 2 * (F.col("__n") + 1) - 1
    return firsts.select(run, pos, count_col, tok.count_length(spaced).alias("tokens"), *carry)


def curate(
    messages: DataFrame,
    cap: int,
    fields: Sequence[str],
    tokenizer: Tokenizer | None = None,
    run: str = "run",
    pos: str = "pos",
    text: str = "text",
    rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK,
) -> DataFrame:
    """Dedup then batch: per-batch rows, tokens, copies and file names.

    Length tokenizers take the text-free path of :func:`survivor_tokens`;
    any other tokenizer counts the survivors' record texts.
    """
    counted = survivor_tokens(messages, fields, tokenizer, run, pos, text)
    batched = batch_items(
        assign_batches(counted, cap, tokens="tokens", run=run, pos=pos, rows_per_chunk=rows_per_chunk), run
    )
    return batched.groupBy(run, "batch_no", "total_batches", "file_name").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("tokens").cast("long").alias("batch_tokens"),
        F.sum("dup_count").cast("long").alias("n_copies"),
    )


__all__ = [
    "prebatch_runs",
    "run_prebatch",
    "with_tokens",
    "survivor_tokens",
    "batch_runs",
    "run_batch",
    "batch_documents",
    "curate",
]
