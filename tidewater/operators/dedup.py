"""Exact text dedup inside a run (first copy wins, copies counted)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import stage_table


def _keys(partition: str | Sequence[str] | None) -> list[str]:
    if partition is None:
        return []
    if isinstance(partition, str):
        return [partition]
    return list(partition)


def text_counts(
    df: DataFrame,
    text: str = "text",
    partition: str | Sequence[str] | None = "run",
    count_col: str = "dup_count",
) -> DataFrame:
    """Exact number of rows per distinct ``text`` (within each partition key).

    A hash aggregate: partial counts are combined map-side before the
    shuffle, so a text repeated in a third of all rows costs one row per
    map task, not one row per copy.
    """
    keys = _keys(partition)
    return df.groupBy(*keys, text).agg(F.count(F.lit(1)).alias(count_col))


HOT_SALTS = 64


def add_dup_count(
    df: DataFrame,
    text: str = "text",
    partition: str | Sequence[str] | None = "run",
    count_col: str = "dup_count",
    hot_share: float = 0.001,
) -> DataFrame:
    """Every row with the number of rows sharing its text (column replaced
    if present).

    Counts come from a partially aggregated digest count, staged once.
    Attaching them back is a join on ``(key, digest)``, where one text may
    hold a third of all rows, so hot texts are salted: a text with more
    than ``hot_share`` of all rows is hot (at most ``1 / hot_share`` of
    them, a proven bound, flagged map-side by a broadcast); its rows are
    spread over ``HOT_SALTS`` salt values and its count row is replicated
    once per salt.  The single shuffle join on ``(key, digest, salt)`` is
    then free of hot keys, and the wide rows are read once.
    """
    keys = _keys(partition)
    base = df.drop(count_col) if count_col in df.columns else df
    digest = F.sha2(F.col(text).cast("binary"), 256)
    counts = stage_table(
        base.select(*keys, digest.alias("__h")).groupBy(*keys, "__h").agg(F.count(F.lit(1)).alias("__cnt")),
        "text-counts",
    )
    total = counts.agg(F.sum("__cnt")).first()[0] or 0
    threshold = max(1, int(total * hot_share))
    hot = counts.filter(F.col("__cnt") > threshold).select(
        *[F.col(k).alias(f"__s{i}") for i, k in enumerate(keys)], F.col("__h").alias("__sh"), F.lit(True).alias("__hot")
    )
    tagged = base.withColumn("__h", digest).withColumn("__row", F.monotonically_increasing_id())
    flag = [tagged[k].eqNullSafe(hot[f"__s{i}"]) for i, k in enumerate(keys)] + [tagged["__h"].eqNullSafe(hot["__sh"])]
    flagged = tagged.join(F.broadcast(hot), flag, "left")
    salted = flagged.withColumn(
        "__salt",
        F.when(F.col("__hot"), F.pmod(F.xxhash64("__row"), F.lit(HOT_SALTS))).otherwise(F.lit(0)),
    )
    replicas = F.when(
        F.col("__cnt") > threshold, F.sequence(F.lit(0), F.lit(HOT_SALTS - 1))
    ).otherwise(F.array(F.lit(0)))
    side = counts.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.col("__h").alias("__kh"),
        F.col("__cnt"),
        F.explode(replicas).alias("__ksalt"),
    )
    cond = (
        [salted[k].eqNullSafe(side[f"__k{i}"]) for i, k in enumerate(keys)]
        + [salted["__h"].eqNullSafe(side["__kh"]), salted["__salt"] == side["__ksalt"]]
    )
    joined = salted.join(side, cond, "inner")
    return joined.select(*[salted[c] for c in base.columns], F.col("__cnt").alias(count_col))


def prebatch(
    df: DataFrame,
    text: str = "text",
    order: str = "pos",
    partition: str | Sequence[str] | None = "run",
    count_col: str = "dup_count",
    method: str = "hash",
) -> DataFrame:
    """Keep the first row (lowest ``order``) of every distinct ``text``.

    The kept row gets ``count_col`` = number of copies in its partition key
    (an existing column of that name is replaced, other columns pass
    through unchanged and the count is the last column).  Equality is
    byte-exact; NULL texts form one group.

    ``method="hash"`` (default, for scale) aggregates ``(key, sha256(text))``
    to ``(copies, first order)`` — only 32-byte digests and longs cross the
    shuffle and hot texts are combined map-side — then joins the survivors
    back on ``(key, order)``, a unique key, so the join cannot skew.
    ``method="exact"`` aggregates on the text itself instead of its digest.
    ``method="window"`` is the textbook two-window form, kept for checking.
    ``(key, order)`` must identify a row: a NULL ``order`` or a repeated pair
    raises (inside a task, where Spark reports it as the job's failure), with
    every method.  The rows are dealt by ``(key, order)`` for the join back anyway, and
    the check counts them there, so it costs no shuffle of its own.
    """
    keys = _keys(partition)
    base = df.drop(count_col) if count_col in df.columns else df
    # NULL keys are a group of their own; a struct holds NULL as a value, so
    # the check and the join back have the same plain key
    base = base.withColumn("__key", F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0))
    names = ", ".join([*keys, order])
    base = _checked(base, order, names)
    if method == "window":
        group = Window.partitionBy(*keys, text)
        first = Window.partitionBy(*keys, text).orderBy(order)
        return (
            base.withColumn("__rn", F.row_number().over(first))
            .withColumn(count_col, F.count(F.lit(1)).over(group))
            .filter(F.col("__rn") == 1)
            .drop("__rn", "__key")
        )
    if method not in ("hash", "exact"):
        raise ValueError(f"unknown method {method!r}")
    # "exact" groups on the text itself (no digest assumption; the shuffle
    # then carries one copy of each distinct text per map task)
    digest = F.sha2(F.col(text).cast("binary"), 256) if method == "hash" else F.col(text)
    narrow = df.select(F.struct(*[F.col(k) for k in keys]).alias("__key") if keys else F.lit(0).alias("__key"), _known(df, order, names).alias("__o"), digest.alias("__h"))
    firsts = narrow.groupBy("__key", "__h").agg(F.count(F.lit(1)).alias("__copies"), F.min("__o").alias("__o")).drop("__h")
    joined = base.join(firsts.withColumnRenamed("__o", order), on=["__key", order], how="inner")
    return joined.select(*[F.col(c) for c in base.columns if c != "__key"], F.col("__copies").alias(count_col))


def _fault(order: str, names: str) -> Column:
    at = F.coalesce(F.col(order).cast("string"), F.lit("NULL"))
    return F.raise_error(F.concat(F.lit(f"({names}) must identify a row, it is NULL or repeated at "), at))


def _known(df: DataFrame, order: str, names: str) -> Column:
    """``order``; evaluating a NULL fails (the join back would just drop its row)."""
    return F.when(F.col(order).isNull(), _fault(order, names).cast(df.schema[order].dataType)).otherwise(F.col(order))


def _checked(base: DataFrame, order: str, names: str) -> DataFrame:
    """``base``; evaluating a row fails where ``(__key, order)`` doesn't name one row."""
    alone = F.count(F.lit(1)).over(Window.partitionBy("__key", order)) == 1
    checked = base.withColumn("__alone", alone & F.col(order).isNotNull())
    return checked.filter(F.when(F.col("__alone"), F.lit(True)).otherwise(_fault(order, names).cast("boolean"))).drop("__alone")


__all__ = ["text_counts", "add_dup_count", "prebatch", "HOT_SALTS"]
