"""Total order of a run and a dense position column without a global window.

``row_number()`` over an unpartitioned window runs in one task.  Here the
rows are range-sorted across all tasks and the sorted data is written once to
the shared folder, so the partition contents are fixed.  One small table then holds,
per sort partition (and run, if positions restart in every run), where its rows start in the
partition and how many rows of the run stand in partitions before it.  A row's
position is its place in the partition, shifted by its entry in that table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import stage_table


def message_order(
    time: str = "time", channel_ord: str = "channel_ord", id: str = "id"
) -> list[Column]:
    """Stable order of the merged pull: ISO time string, then channel order,
    then newest id first (the order rows had before the stable sort)."""
    return [F.col(time).asc(), F.col(channel_ord).asc(), F.col(id).desc()]


def dense_position(
    df: DataFrame,
    order: Sequence[Column | str],
    pos: str = "pos",
    partition: str | None = None,
    start: int = 0,
) -> DataFrame:
    """Add ``pos`` = rank of each row in ``order`` (dense, from ``start``).

    With ``partition`` the position restarts in every partition value
    (it is then the first sort key).  Ties in ``order`` get distinct, arbitrary positions.
    """
    spark = df.sparkSession
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    if partition is not None:
        keys = [F.col(partition).asc_nulls_first(), *keys]
    sorted_df = (
        df.orderBy(*keys)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__mono", F.monotonically_increasing_id())
    )
    # fix the partition contents once (columnar copy in the shared folder)
    sorted_df = stage_table(sorted_df, "ordered")
    keys = ["__part"] if partition is None else ["__part", "__run"]
    if partition is not None:
        # never NULL, so the join below is a plain one; a struct holds NULL as a value
        sorted_df = sorted_df.withColumn("__run", F.struct(F.col(partition)))
    places = sorted_df.groupBy(*keys).agg(F.min("__mono").alias("__first"), F.count(F.lit(1)).alias("__n"))
    if partition is None:
        # one row per sort partition: bounded by the partition count, not the data
        counts = sorted((r["__part"], r["__first"], r["__n"]) for r in places.collect())
        offsets, total = [], 0
        for part, first, n in counts:
            offsets.append((part, total - first))
            total += n
        shifts = F.broadcast(spark.createDataFrame(offsets, "__part int, __shift long"))
    else:
        # a run's rows before a partition: its entries are as many as the partitions it spans
        before = Window.partitionBy("__run").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        shifts = places.select(*keys, (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    # (partition, run) names rows of one sort partition, so no key is hot
    out = sorted_df.join(shifts, on=keys, how="inner")
    return out.withColumn(pos, (F.col("__mono") + F.col("__shift") + F.lit(start)).cast("long")).drop(*keys, "__mono", "__shift")


def merge_sorted(
    df: DataFrame,
    pos: str = "pos",
    time: str = "time",
    channel_ord: str = "channel_ord",
    id: str = "id",
    partition: str | None = None,
    start: int = 0,
) -> DataFrame:
    """Merge all channels into one time-ordered run with an explicit ``pos``."""
    return dense_position(df, message_order(time, channel_ord, id), pos, partition, start)


def input_position(df: DataFrame, pos: str = "pos", run: str = "run", **order_cols) -> DataFrame:
    """Position of each row inside its run in the merged order (0-based)."""
    return merge_sorted(df, pos=pos, partition=run, **order_cols)


__all__ = ["message_order", "dense_position", "merge_sorted", "input_position"]
