"""Pull statistics: messages per channel and in total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fetch_stats(
    messages: DataFrame,
    channel: str = "channel_handle",
    per_channel_cap: int | None = None,
    source_counts: DataFrame | None = None,
) -> DataFrame:
    """Rows per channel plus a total row (``channel`` NULL), via ROLLUP.

    With ``per_channel_cap`` and the per-channel row counts of the source
    (``source_counts``: channel, n_source) a ``truncated`` flag marks the
    channels whose older rows the cap left unread.
    """
    out = messages.rollup(channel).agg(F.count(F.lit(1)).alias("n_messages"))
    if per_channel_cap is not None and source_counts is not None:
        out = out.join(source_counts, on=channel, how="left").withColumn(
            "truncated", F.coalesce(F.col("n_source") > F.lit(per_channel_cap), F.lit(False))
        ).drop("n_source")
    return out


__all__ = ["fetch_stats"]
