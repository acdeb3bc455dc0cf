"""Row filters and validation predicates."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.scalars import is_iso_time

# Broadcast a target list only when it is a driver-side list or a frame
# whose rows and bytes have been checked against these bounds.
MAX_BROADCAST_TARGETS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20


def _lit_ts(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.lit(value).cast("timestamp")
    if isinstance(value, _dt.datetime) and value.tzinfo is None:
        # naive values are UTC wall-clock, like the TIMESTAMP_NTZ inputs
        return F.lit(value).cast("timestamp_ntz")
    return F.lit(value)


def only_channels(dialogs: DataFrame, kind: str = "kind") -> DataFrame:
    """Keep dialogs whose entity is a broadcast channel."""
    return dialogs.filter(F.col(kind) == F.lit("Channel"))


def is_dated_message(kind: str = "kind", date: str = "date") -> Column:
    """Real message with a date (service rows and undated rows are skipped)."""
    return (F.col(kind) == F.lit("Message")) & F.col(date).isNotNull()


def only_dated_messages(raw: DataFrame, kind: str = "kind", date: str = "date") -> DataFrame:
    return raw.filter(is_dated_message(kind, date))


def since(df: DataFrame, start, ts: str = "date", end=None) -> DataFrame:
    """Rows strictly newer than ``start`` (and not newer than ``end`` if given).

    Plain comparisons on the column, so Parquet receives them as pushed
    filters and row groups outside the window are skipped.
    """
    cond = F.col(ts) > _lit_ts(start)
    if end is not None:
        cond = cond & (F.col(ts) <= _lit_ts(end))
    return df.filter(cond)


def targets_frame(spark, handles: Sequence[str], handle: str = "handle") -> DataFrame:
    """Requested handles with their list position (``channel_ord``)."""
    rows = [(h, i) for i, h in enumerate(handles)]
    return spark.createDataFrame(rows, f"{handle} string, channel_ord long")


def is_small(df: DataFrame) -> bool:
    """Whether a frame's rows and bytes are within the bounds of a broadcast."""
    width = sum(
        (F.coalesce(F.octet_length(f.name), F.lit(0)) if isinstance(f.dataType, T.StringType) else F.lit(8) for f in df.schema.fields), F.lit(16)
    )
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("size")).first()
    return row["n"] <= MAX_BROADCAST_TARGETS and row["size"] <= MAX_BROADCAST_BYTES


def _bounded(targets: DataFrame) -> DataFrame:
    return F.broadcast(targets) if is_small(targets) else targets


def target_channels(
    channels: DataFrame,
    targets: DataFrame | Sequence[str],
    handle: str = "handle",
) -> DataFrame:
    """Channels whose handle was requested, with ``channel_ord`` (list order).

    A Python list is tiny by construction and is broadcast; a DataFrame of
    targets is broadcast only after its row count is checked.
    """
    spark = channels.sparkSession
    if not isinstance(targets, DataFrame):
        tf = F.broadcast(targets_frame(spark, list(targets), handle))
    else:
        if "channel_ord" not in targets.columns:
            targets = targets.withColumn("channel_ord", F.lit(0).cast("long"))
        tf = _bounded(targets.select(handle, "channel_ord"))
    return channels.join(tf, on=handle, how="inner")


def unknown_targets(
    channels: DataFrame, targets: DataFrame | Sequence[str], handle: str = "handle"
) -> DataFrame:
    """Requested handles that match no channel (reported, not silently dropped)."""
    spark = channels.sparkSession
    tf = targets if isinstance(targets, DataFrame) else targets_frame(spark, list(targets), handle)
    return tf.join(channels.select(handle), on=handle, how="left_anti")


def is_valid_message(
    id: str = "id",
    channel_id: str = "channel_id",
    channel_handle: str = "channel_handle",
    time: str = "time",
    text: str = "text",
) -> Column:
    """Typed fields present and ``time`` an extended ISO time."""
    return (
        F.col(id).isNotNull()
        & F.col(channel_id).isNotNull()
        & F.col(channel_handle).isNotNull()
        & F.col(text).isNotNull()
        & is_iso_time(time)
    )


def validate_messages(df: DataFrame, flag: str = "is_valid") -> DataFrame:
    return df.withColumn(flag, is_valid_message())


def is_valid_channel(id: str = "id", title: str = "title", handle: str = "handle") -> Column:
    """All three fields present (an empty handle is valid)."""
    return F.col(id).isNotNull() & F.col(title).isNotNull() & F.col(handle).isNotNull()


def validate_channels(df: DataFrame, flag: str = "is_valid") -> DataFrame:
    return df.withColumn(flag, is_valid_channel())


__all__ = [
    "only_channels",
    "is_dated_message",
    "only_dated_messages",
    "since",
    "targets_frame",
    "target_channels",
    "unknown_targets",
    "is_valid_message",
    "validate_messages",
    "is_valid_channel",
    "validate_channels",
    "MAX_BROADCAST_TARGETS",
]
