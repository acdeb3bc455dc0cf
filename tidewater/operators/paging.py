"""Per-channel pull since a high-water mark, with the source's paging rules.

The source hands out a channel's rows newest first (by id) in pages of
``limit`` rows, service rows included.  A channel stops at the first real
message dated at or before the mark (older ids are never read, even when
newer-dated), and at most ``max_pages`` pages are read.  In parity mode
(``early_stop=True``) a page that keeps fewer than ``limit`` rows also
ends the channel — a service row or an undated row makes a page short, so
older unread rows are lost; the default mode keeps them.

Scale: the stop id is a per-channel ``max`` (partial aggregation, a hot
channel costs one row per map task).  Without a page cap and in the
default mode no window is needed at all.  With a cap, ranks come from a
two-level narrow top-N (``row_number() <= max_pages * limit`` per
``(channel, salt)`` and then per channel, each a map-side
``WindowGroupLimit``) over ``(channel, id, ok)`` only; the page rules run
on those few rows and the pulled rows are recovered by a semi-join on the
unique ``(channel, id)``.  Parity mode without a
cap finds the first short page with aggregates plus a top-``limit``
window, again bounded per channel, over one staged copy of the increment
(rows above the stop row) so the history is scanned only for the stop ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.filters import _lit_ts
from tidewater.records import MAX_PAGES, PAGE_SIZE
from tidewater.session import stage_table


# Salt buckets of the first top-N level: a hot channel's candidates are
# spread over this many tasks before the per-channel merge.
TOP_SALTS = 64
# Salt buckets of a join of rows with per-channel values.
JOIN_SALTS = 16


def top_ids(
    df: DataFrame,
    n: int,
    channel: str = "channel_id",
    id: str = "id",
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """``(channel, id, __r, *extra)`` of the newest ``n`` ids per channel.

    Two narrow top-N levels: per ``(channel, salt)`` and then per channel.
    Both run as map-side ``WindowGroupLimit``, so a channel holding a third
    of all rows sends at most ``n`` ids per task to each level and the
    final merge sees at most ``n * TOP_SALTS`` ids — no text moves.
    """
    narrow = df.select(channel, id, *extra).withColumn("__salt", F.pmod(F.xxhash64(id), F.lit(TOP_SALTS)))
    w1 = Window.partitionBy(channel, "__salt").orderBy(F.col(id).desc())
    level1 = narrow.withColumn("__r1", F.row_number().over(w1)).filter(F.col("__r1") <= n).drop("__r1", "__salt")
    w2 = Window.partitionBy(channel).orderBy(F.col(id).desc())
    return level1.withColumn("__r", F.row_number().over(w2)).filter(F.col("__r") <= n)


def cap_per_channel(
    df: DataFrame, n: int, channel: str = "channel_id", id: str = "id"
) -> DataFrame:
    """Newest ``n`` rows (by id) of every channel.

    Ranks on ``(channel, id)`` only (:func:`top_ids`), then keeps the rows
    by a semi-join on that unique key — hot channels cannot skew it."""
    keep = top_ids(df, n, channel, id).select(channel, id)
    return df.join(keep, on=[channel, id], how="left_semi")


def channel_stops(
    raw: DataFrame,
    mark,
    channel: str = "channel_id",
    id: str = "id",
    kind: str = "kind",
    date: str = "date",
    previous: DataFrame | None = None,
    bounded_channels: bool = False,
) -> DataFrame:
    """``(channel, stop)``: id of the newest real message dated at or before
    ``mark`` — the row where a newest-first pull of the channel stops.

    ``previous`` (stops as of an earlier mark) saves the history: a channel's
    new stop is its old one or a row with a larger id dated at or before
    ``mark``, however late that row landed.  Rows are taken by id, not by the
    dates between the two marks, so late rows give the same stop as a full
    scan.  A channel whose old stop is NULL or absent is read in full.
    """
    ok = (F.col(kind) == F.lit("Message")) & F.col(date).isNotNull()
    rows = raw.filter(ok & (F.col(date) <= _lit_ts(mark)))
    if previous is not None:
        old = previous.select(channel, F.col("stop").alias("__old"))
        rows = _with_channel(rows, old, channel, id, bounded_channels)
        rows = rows.filter(F.col("__old").isNull() | (F.col(id) > F.col("__old")))
    stops = rows.groupBy(channel).agg(F.max(id).alias("stop"))
    if previous is not None:
        stops = (
            stops.unionByName(previous.select(channel, "stop"))
            .groupBy(channel)
            .agg(F.max("stop").alias("stop"))
        )
    return stops


def _with_channel(rows: DataFrame, per_channel: DataFrame, channel: str, id: str, bounded: bool) -> DataFrame:
    """Left join of rows with one row per channel.

    A size-checked set of channels is broadcast.  Otherwise the few
    per-channel rows are repeated once per salt, so the rows of a hot channel
    are spread over ``JOIN_SALTS`` tasks."""
    if bounded:
        return rows.join(F.broadcast(per_channel), on=channel, how="left")
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(id), F.lit(JOIN_SALTS)).cast("int"))
    side = per_channel.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(JOIN_SALTS - 1))))
    return salted.join(side, on=[channel, "__salt"], how="left").drop("__salt")


def _fresh(
    raw: DataFrame,
    last_fetch,
    channel: str,
    id: str,
    kind: str,
    date: str,
    stops: DataFrame | None = None,
    bounded_channels: bool = False,
) -> DataFrame:
    """Rows above the channel's stop row (first real message at/below the mark)."""
    if stops is None:
        stops = channel_stops(raw, last_fetch, channel, id, kind, date)
    stops = stops.select(channel, F.col("stop").alias("__stop"))
    joined = _with_channel(raw, stops, channel, id, bounded_channels)
    return joined.filter(F.col("__stop").isNull() | (F.col(id) > F.col("__stop"))).drop("__stop")


def paged_pull(
    raw: DataFrame,
    last_fetch,
    limit: int = PAGE_SIZE,
    max_pages: int | None = MAX_PAGES,
    early_stop: bool = False,
    channel: str = "channel_id",
    id: str = "id",
    kind: str = "kind",
    date: str = "date",
    stops: DataFrame | None = None,
    bounded_channels: bool = False,
) -> DataFrame:
    """Real messages the paged pull returns, with every input column kept.

    ``stops`` (from :func:`channel_stops`) skips recomputing the stop rows
    from the whole history.  ``bounded_channels=True`` states that ``raw``
    holds only a size-checked set of channels, so per-channel tables may be
    broadcast."""
    if limit <= 0:
        raise ValueError("limit must be positive")
    ok = (F.col(kind) == F.lit("Message")) & F.col(date).isNotNull()
    if stops is None:
        stops = channel_stops(raw, last_fetch, channel, id, kind, date)
    # A real message above the stop row is newer than the mark (the stop row is
    # the largest id that isn't), so whole rows are read above that date only.
    newer = raw.filter(ok & (F.col(date) > _lit_ts(last_fetch)))
    if max_pages is None and not early_stop:
        return _fresh(newer, last_fetch, channel, id, kind, date, stops, bounded_channels)
    # the page rules also count service and undated rows: narrow columns of all of them
    fresh = _fresh(raw.select(channel, id, kind, date), last_fetch, channel, id, kind, date, stops, bounded_channels)

    if max_pages is not None:
        n = max_pages * limit
        # rank narrow (channel, id, ok) rows only; at most n per channel remain
        ranked = top_ids(fresh.withColumn("__ok", ok.cast("int")), n, channel, id, extra=("__ok",))
        if early_stop:
            page = F.floor((F.col("__r") - 1) / limit)
            ranked = ranked.withColumn("__page", page)
            per_page = Window.partitionBy(channel, "__page")
            per_channel = Window.partitionBy(channel)
            ranked = ranked.withColumn("__kept", F.sum("__ok").over(per_page))
            ranked = ranked.withColumn(
                "__pstop", F.min(F.when(F.col("__kept") < limit, F.col("__page"))).over(per_channel)
            )
            ranked = ranked.filter(F.col("__pstop").isNull() | (F.col("__page") <= F.col("__pstop")))
        keep = ranked.filter(F.col("__ok") == 1).select(channel, id)
        # (channel, id) is unique: the semi-join spreads a hot channel evenly
        return newer.join(keep, on=[channel, id], how="left_semi")

    # parity mode, no page cap: everything above the first non-message row
    # is kept, plus the rows that share its page.  The increment is staged
    # once (the history is scanned only for the stop ids) and the page rules
    # run on its narrow (channel, id, ok) projection.
    keys = stage_table(fresh.select(channel, id, ok.cast("int").alias("__ok")), "pull-increment")
    bad = keys.filter(F.col("__ok") == 0).groupBy(channel).agg(F.max(id).alias("__bad"))
    tagged = _with_channel(keys, bad, channel, id, bounded_channels)
    before = (
        tagged.filter(F.col("__bad").isNotNull() & (F.col(id) > F.col("__bad")))
        .groupBy(channel)
        .agg(F.count(F.lit(1)).alias("__before"))
    )
    tagged = _with_channel(tagged, before, channel, id, bounded_channels).withColumn(
        "__before", F.coalesce(F.col("__before"), F.lit(0))
    )
    head = tagged.filter(F.col("__bad").isNull() | (F.col(id) > F.col("__bad")))
    # rows left on the bad row's page after it: at most limit - 1 per channel
    rest = (F.lit(limit) - (F.col("__before") + 1) % limit) % limit
    tail = top_ids(
        tagged.filter(F.col("__bad").isNotNull() & (F.col(id) < F.col("__bad"))),
        limit - 1,
        channel,
        id,
        extra=("__ok", "__before"),
    ).filter(F.col("__r") <= rest)
    keep = (
        head.select(channel, id, "__ok")
        .unionByName(tail.select(channel, id, "__ok"))
        .filter(F.col("__ok") == 1)
        .select(channel, id)
    )
    return newer.join(keep, on=[channel, id], how="left_semi")


def pull_stats(
    raw: DataFrame,
    last_fetch,
    limit: int = PAGE_SIZE,
    max_pages: int | None = MAX_PAGES,
    channel: str = "channel_id",
    id: str = "id",
    kind: str = "kind",
    date: str = "date",
) -> DataFrame:
    """Per channel: source rows above the stop row, real messages among
    them, and whether a page cap leaves some of them unread (``truncated``).

    Pure aggregates (partial aggregation, no window)."""
    ok = (F.col(kind) == F.lit("Message")) & F.col(date).isNotNull()
    fresh = _fresh(raw, last_fetch, channel, id, kind, date)
    out = fresh.groupBy(channel).agg(
        F.count(F.lit(1)).alias("n_source"),
        F.sum(ok.cast("long")).alias("n_messages"),
    )
    cap = None if max_pages is None else max_pages * limit
    flag = F.lit(False) if cap is None else F.col("n_source") > F.lit(cap)
    return out.withColumn("truncated", flag)


__all__ = ["TOP_SALTS", "top_ids", "cap_per_channel", "channel_stops", "paged_pull", "pull_stats"]
