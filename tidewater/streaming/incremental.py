"""Incremental pull as Structured Streaming.

The polling high-water mark becomes the streaming checkpoint: a file
source remembers which landed files it has processed, ``availableNow``
processes everything new and stops (one "fetch"), and each micro-batch is
one run.  ``foreachBatch`` applies the batch operators to the micro-batch
and overwrites the run's partition (``run`` = batch id), so a replayed
micro-batch after a failure rewrites the same partition — idempotent.

Unlike the polling mark, a late file (rows dated before the last run) is
still picked up, because the checkpoint tracks files, not dates.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.tokens import LocalTokenizer, Tokenizer
from tidewater.operators.filters import _bounded, only_dated_messages
from tidewater.operators.ordering import merge_sorted
from tidewater.plans.curate import curate
from tidewater.plans.fetch import to_messages
from tidewater.session import is_file, path_exists, scratch_path, scratch_scope
from tidewater.sources.adapters import messages_from_documents

BatchFn = Callable[[DataFrame, int], DataFrame]


def run_incremental(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    process: BatchFn,
    sink_path: str,
    checkpoint_path: str,
    source_format: str = "parquet",
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    sink_format: str = "parquet",
    partition: str = "run",
    max_batches: int | None = None,
    restarts: int = 0,
) -> int:
    """Process every landed file not seen before, one run per micro-batch; returns the micro-batches stored.

    ``max_batches`` stops the poll after so many of them; the next call goes on where it
    stopped.  A poll that breaks off is started again from its checkpoint up to
    ``restarts`` times: the micro-batch that was open runs again under its old
    number and replaces what it had stored, so no row is lost or doubled."""
    reader = spark.readStream.format(source_format).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source_path)

    done = [0]

    def sink(batch: DataFrame, batch_id: int) -> None:
        if max_batches is not None and done[0] >= max_batches:
            raise _Enough
        with scratch_scope(spark):  # what the micro-batch staged goes once it is stored
            out = process(batch, batch_id)
            (
                out.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(partition)
                .format(sink_format)
                .save(sink_path)
            )
        done[0] += 1

    for attempt in range(restarts + 1):
        query = (
            stream.writeStream.foreachBatch(sink)
            .option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True)
            .start()
        )
        try:
            query.awaitTermination()
            break
        except StreamingQueryException:
            if max_batches is not None and done[0] >= max_batches:
                break  # the micro-batch that was turned away stays open in the checkpoint
            if attempt == restarts:
                raise
    return done[0]


class _Enough(Exception):
    """Ends a poll that has stored its number of micro-batches."""


def pull_batch(dialog_handles: DataFrame) -> BatchFn:
    """Micro-batch of raw source rows → merged messages of that run.

    ``dialog_handles``: ``(channel_id, channel_handle, channel_ord)`` of the
    requested channels (small, broadcast).
    """

    # the requested channels: row count checked once before broadcasting
    side = _bounded(dialog_handles)

    def process(batch: DataFrame, batch_id: int) -> DataFrame:
        rows = only_dated_messages(batch).join(side, on="channel_id", how="inner")
        return merge_sorted(to_messages(rows)).drop("channel_ord").withColumn("run", F.lit(str(batch_id)))

    return process


def curate_batch(
    cap: int,
    fields: Sequence[str],
    tokenizer: Tokenizer | None = None,
    to_messages: Callable[[DataFrame], DataFrame] | None = None,
) -> BatchFn:
    """Micro-batch of messages → per-batch stats of its runs (``run`` = epoch/run).

    ``to_messages`` maps the landed rows to messages with ``run`` and ``pos``
    (default: they are messages already)."""

    def process(batch: DataFrame, batch_id: int) -> DataFrame:
        msgs = batch if to_messages is None else to_messages(batch)
        stats = curate(msgs, cap, list(fields), tokenizer or LocalTokenizer())
        return stats.withColumn("epoch", F.lit(batch_id).cast("long")).withColumn(
            "run", F.concat(F.lit(f"{batch_id}/"), F.col("run"))
        )

    return process


def streaming_curate(spark: SparkSession, sf_dir: str, cap: int, fields: Sequence[str]) -> DataFrame:
    """Stream the landed ``documents`` table, a file or a folder of files, through dedup + batching.

    What has landed is one micro-batch however many files hold it: copies of a text
    are told, and batches filled, over the whole run."""
    source = f"{sf_dir.rstrip('/')}/documents.parquet"
    schema = spark.read.parquet(source).schema
    sink = scratch_path(spark, "stream-sink")
    ckpt = scratch_path(spark, "stream-ckpt")
    # a stream starts at a folder: a table that is one file is picked out of the folder that it lies in
    folder, glob = (sf_dir, "documents.parquet") if is_file(spark, source) else (source, None)
    run_incremental(spark, folder, schema, curate_batch(cap, fields, to_messages=messages_from_documents), sink, ckpt, glob=glob)
    return _read_sink(spark, sink, CURATED_SCHEMA)


def _read_sink(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    """The stored micro-batches; no rows if there has been none."""
    return spark.read.schema(schema).parquet(sink) if path_exists(spark, sink) else spark.createDataFrame([], schema)


_LONGS = ("n_rows", "batch_tokens", "n_copies", "epoch")
CURATED_SCHEMA = T.StructType(
    [
        T.StructField("batch_no", T.LongType()),
        T.StructField("total_batches", T.LongType()),
        T.StructField("file_name", T.StringType()),
        *[T.StructField(name, T.LongType()) for name in _LONGS],
        T.StructField("run", T.StringType()),
    ]
)
PULLED_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("channel_id", T.LongType()),
        T.StructField("channel_handle", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("run", T.StringType()),
    ]
)


def streaming_pull(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    dialog_handles: DataFrame,
    glob: str | None = None,
    to_raw: Callable[[DataFrame], DataFrame] | None = None,
    polls: Sequence[int | None] = (None,),
) -> DataFrame:
    """Stream landed source files through the pull: one run per micro-batch, one file each.

    ``polls``: micro-batches of each poll (None: all that is there); every poll
    after the first starts from the checkpoint of the one before."""
    sink = scratch_path(spark, "pull-sink")
    ckpt = scratch_path(spark, "pull-ckpt")
    step = pull_batch(dialog_handles)
    process = step if to_raw is None else (lambda batch, batch_id: step(to_raw(batch), batch_id))
    for most in polls:
        run_incremental(spark, source_dir, schema, process, sink, ckpt, glob=glob, max_files_per_trigger=1, max_batches=most)
    return _read_sink(spark, sink, PULLED_SCHEMA)


__all__ = ["run_incremental", "pull_batch", "curate_batch", "streaming_curate", "streaming_pull", "PULLED_SCHEMA"]
