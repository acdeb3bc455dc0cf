"""Channel directory: joined dialogs that are channels, as (id, title, handle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.scalars import format_handle
from tidewater.operators.filters import is_valid_channel, only_channels


def channel_directory(
    dialogs: DataFrame,
    id: str = "id",
    title: str = "title",
    username: str = "username",
    kind: str = "kind",
    with_validity: bool = False,
) -> DataFrame:
    """``(id, title, handle)`` of every channel dialog; handle = ``@name`` or ``''``."""
    out = only_channels(dialogs, kind).select(
        F.col(id).cast("long").alias("id"),
        F.col(title).alias("title"),
        format_handle(username).alias("handle"),
    )
    if with_validity:
        out = out.withColumn("is_valid", is_valid_channel())
    return out


__all__ = ["channel_directory"]
