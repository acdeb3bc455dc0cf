"""Joins of many rows with a table that has one row per key.

Where that table is too large to broadcast, rows and table meet by a shuffle on
the key, and a key with a third of all rows would land in one task.  Keys
with more than ``hot_share`` of the rows are hot: there are at most
``1 / hot_share`` of them (a proven bound, so they are flagged by a broadcast),
their rows are dealt to as many salts as there are shuffle partitions, and their one
table row is repeated once per salt.  All other rows have salt 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.session import stage_table

#: Share of all rows from which a key is hot.
HOT_SHARE = 0.001


def hot_keys(rows: DataFrame, key: str, hot_share: float = HOT_SHARE) -> DataFrame:
    """Keys with more than ``hot_share`` of the rows (at most ``1 / hot_share``), staged."""
    counts = stage_table(rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n")), "key-counts")
    total = counts.agg(F.sum("__n")).first()[0] or 0
    return stage_table(counts.where(F.col("__n") > total * hot_share).select(key), "hot-keys")


def spread(rows: DataFrame, hot: DataFrame, key: str, salts: int, by: Column) -> DataFrame:
    """``rows`` with ``__salt``: 0, or one of ``salts`` by the hash of ``by`` where the key is hot."""
    flags = hot.select(F.col(key).alias("__hot"))
    flagged = rows.join(F.broadcast(flags), rows[key] == F.col("__hot"), "left")
    salt = F.when(F.col("__hot").isNotNull(), F.pmod(F.xxhash64(by), F.lit(salts))).otherwise(F.lit(0).cast("long"))
    return flagged.withColumn("__salt", salt).drop("__hot")


def repeated(side: DataFrame, hot: DataFrame, key: str, salts: int) -> DataFrame:
    """``side`` with ``__salt``: its rows once, those of hot keys once per salt."""
    flags = hot.select(F.col(key).alias("__hot"))
    flagged = side.join(F.broadcast(flags), side[key] == F.col("__hot"), "left")
    every = F.when(F.col("__hot").isNotNull(), F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    return flagged.withColumn("__salt", F.explode(every)).drop("__hot")


def join_by_key(rows: DataFrame, side: DataFrame, key: str, by: str, how: str = "inner", hot_share: float = HOT_SHARE) -> DataFrame:
    """``rows`` joined with ``side`` (one row per ``key``) by shuffle, hot keys spread by the hash of column ``by``.

    ``how``: ``inner``, ``left``, ``left_semi`` or ``left_anti``.  NULL keys match nothing."""
    salts = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = hot_keys(rows.select(key), key, hot_share)
    spreaded, sides = spread(rows, hot, key, salts, F.col(by)), repeated(side, hot, key, salts)
    return spreaded.join(sides, on=[key, "__salt"], how=how).drop("__salt")


__all__ = ["HOT_SHARE", "hot_keys", "spread", "repeated", "join_by_key"]
