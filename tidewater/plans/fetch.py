"""Incremental pull (batch form): landed source rows since the stored mark
→ one merged, time-ordered run → run store, then the new mark."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.scalars import iso_time, strip_text
from tidewater.operators.channels import channel_directory
from tidewater.operators.filters import _lit_ts, is_small, target_channels, unknown_targets
from tidewater.operators.joins import join_by_key
from tidewater.operators.ordering import merge_sorted
from tidewater.operators.paging import channel_stops, paged_pull
from tidewater.records import DEFAULT_LOOKBACK_DAYS, MAX_PAGES, PAGE_SIZE
from tidewater.session import delete_path, scratch_scope, stage_table
from tidewater.sources.store import (
    read_stops,
    read_watermark,
    read_window,
    write_messages,
    write_stops,
    write_watermark,
    write_window,
)


# Unknown handles that an error message names.
SHOWN_HANDLES = 20


def resolve_window(
    mark: _dt.datetime | None,
    now: _dt.datetime,
    lookback_days: int = DEFAULT_LOOKBACK_DAYS,
) -> tuple[_dt.datetime, _dt.datetime]:
    """``(start, end)`` = ``(mark or now - lookback, now)``."""
    start = mark if mark is not None else now - _dt.timedelta(days=lookback_days)
    return start, now


def next_watermark(end: _dt.datetime) -> _dt.datetime:
    """The new mark is the window end chosen before the pull, not the newest row."""
    return end


def _iso(value: _dt.datetime) -> str:
    if value.tzinfo is None:
        value = value.replace(tzinfo=_dt.timezone.utc)
    return value.isoformat()


def run_value(start: _dt.datetime, end: _dt.datetime) -> str:
    """``{start}~{end}``: the run's name (a partition value, not a file name)."""
    return f"{_iso(start)}~{_iso(end)}"


def to_messages(pulled: DataFrame, date_source: str = "ntz") -> DataFrame:
    """Pulled source rows (with channel_handle) → the stored message record."""
    return pulled.select(
        F.col("id").cast("long").alias("id"),
        F.col("channel_id").cast("long").alias("channel_id"),
        F.col("channel_handle"),
        iso_time("date", source=date_source).alias("time"),
        strip_text("message").alias("text"),
        F.col("channel_ord"),
    )


def fetch(
    raw: DataFrame,
    dialogs: DataFrame,
    targets: DataFrame | Sequence[str],
    start,
    end=None,
    limit: int = PAGE_SIZE,
    max_pages: int | None = None,
    early_stop: bool = False,
    date_source: str = "ntz",
    run: str | None = None,
    strict: bool = False,
    stops: DataFrame | None = None,
) -> DataFrame:
    """Messages of the requested channels newer than ``start``, merged.

    ``end`` given: the source is read as of ``end`` (rows dated later are
    left for the next run, so runs whose windows follow on one another neither
    overlap nor miss rows); ``end=None`` reads everything newer than ``start``.
    Defaults are lossless (``max_pages=None``, ``early_stop=False``); pass
    ``max_pages=30, early_stop=True`` for the source's exact paging.
    Output: ``id, channel_id, channel_handle, time, text, pos[, run]``.
    ``strict=True`` raises ``ValueError`` when a requested handle matches no
    channel (the live source fails on unknown handles); by default they are
    skipped and can be listed with ``unknown_targets``.
    ``stops`` (``channel_id, stop`` as of ``start``, see ``channel_stops``)
    replaces the history scan that finds each channel's stop row.
    """
    side, bounded = _requested(dialogs, targets, strict)
    src = raw
    if stops is not None:
        # every requested channel has a known stop id: rows at or below the
        # smallest one can never be pulled, and the bound reaches the scan
        bound = _id_floor(side, stops)
        if bound is not None:
            src = src.filter(F.col("id") > F.lit(bound))
    if end is not None:
        src = src.filter(F.col("date").isNull() | (F.col("date") <= _lit_ts(end)))
    src = _of_channels(src, side, bounded, "inner")
    # src holds only the requested channels, whose number was checked above
    pulled = paged_pull(
        src, start, limit=limit, max_pages=max_pages, early_stop=early_stop, stops=stops, bounded_channels=bounded
    )
    msgs = merge_sorted(to_messages(pulled, date_source)).drop("channel_ord")
    if run is not None:
        msgs = msgs.withColumn("run", F.lit(run))
    return msgs


def _of_channels(rows: DataFrame, side: DataFrame, bounded: bool, how: str) -> DataFrame:
    """Rows of the channels in ``side``: a broadcast join if their number is proven small,
    else a shuffle join in which a hot channel's rows are spread."""
    if bounded:
        return rows.join(side, on="channel_id", how=how)
    return join_by_key(rows, side, "channel_id", "id", how)


def requested_channels(dialogs: DataFrame, targets, strict: bool = False) -> DataFrame:
    """Requested channels ``(channel_id, channel_handle, channel_ord)``,
    broadcast-ready: a driver-side list is small by construction, a frame
    is counted first."""
    return _requested(dialogs, targets, strict)[0]


def _requested(dialogs: DataFrame, targets, strict: bool = False) -> tuple[DataFrame, bool]:
    """``requested_channels`` plus whether their number is proven small."""
    channels = channel_directory(dialogs)
    if strict:
        unknown = unknown_targets(channels, targets)
        some = [r[0] for r in unknown.take(SHOWN_HANDLES)]
        if some:
            raise ValueError(f"{unknown.count()} unknown channel handles, among them: {some}")
    wanted = target_channels(channels, targets).select(
        F.col("id").alias("channel_id"),
        F.col("handle").alias("channel_handle"),
        F.col("channel_ord"),
    )
    if isinstance(targets, DataFrame):
        wanted = stage_table(wanted, "requested")
        small = is_small(wanted)
        return (F.broadcast(wanted) if small else wanted), small
    return F.broadcast(wanted), True


def _id_floor(wanted: DataFrame, stops: DataFrame) -> int | None:
    """Smallest stop id over the requested channels, or None when one of
    them has no stop (then all its rows are candidates)."""
    row = (
        wanted.select("channel_id")
        .join(stops.select("channel_id", "stop"), on="channel_id", how="left")
        .agg(F.count(F.lit(1)).alias("n"), F.count("stop").alias("known"), F.min("stop").alias("floor"))
        .first()
    )
    if row is None or row["n"] == 0 or row["known"] < row["n"]:
        return None
    return int(row["floor"])


def fetch_state(
    raw: DataFrame,
    dialogs: DataFrame,
    targets,
    mark,
    previous: DataFrame | None = None,
) -> DataFrame:
    """Stop ids of the requested channels as of ``mark`` (NULL: no message
    at or before it).  With an earlier state only the rows above the stops it
    holds are read (late ones included, so the result is that of a full scan),
    plus the full history of any requested channel it does not cover."""
    wanted, bounded = _requested(dialogs, targets)
    wanted_ids = wanted.select("channel_id")
    mine = _of_channels(raw, wanted_ids, bounded, "left_semi")
    if previous is None:
        stops = channel_stops(mine, mark)
    else:
        # a channel without a stored stop is read in full by channel_stops
        known = previous.join(wanted_ids, on="channel_id", how="left_semi").select("channel_id", "stop")
        floor = _id_floor(wanted, known)
        if floor is not None:
            mine = mine.filter(F.col("id") > F.lit(floor))
        stops = channel_stops(mine, mark, previous=known, bounded_channels=bounded)
    return wanted_ids.join(stops, on="channel_id", how="left").select("channel_id", "stop")


def run_fetch(
    raw: DataFrame,
    dialogs: DataFrame,
    targets: DataFrame | Sequence[str],
    store_path: str,
    mark_path: str,
    now: _dt.datetime,
    lookback_days: int = DEFAULT_LOOKBACK_DAYS,
    state_path: str | None = None,
    **pull_options,
) -> tuple[str, _dt.datetime]:
    """One polling step: read mark, pull, store the run, then advance the mark.

    Before any data the window is recorded beside the mark (``{mark_path}-window``),
    then come the run, the mark, and the record goes.  A call that finds the
    record of a poll that broke off before its mark takes that window again, whatever its own
    ``now``: it rewrites the same run, so runs never overlap.  What is newer is
    left for the next call.  A window without messages is a run of zero rows.

    With ``state_path`` the per-channel stop ids are kept next to the mark
    (as of the mark), so the next call reads only the rows above the smallest
    stop id — a pushed-down range instead of the whole history.  The state
    never changes which rows are pulled.  A state that does not belong to the
    stored mark is ignored (recomputed from the history).  Intermediate
    copies are deleted when the run is stored.
    """
    spark = raw.sparkSession
    mark = read_watermark(spark, mark_path)
    window_path = f"{mark_path.rstrip('/')}-window"
    pending = read_window(spark, window_path, mark)
    start, end = pending or resolve_window(mark, now, lookback_days)
    if pending is None:
        write_window(spark, window_path, mark, start, end)
    name = run_value(start, end)
    with scratch_scope(spark):
        stops = None
        if state_path is not None:
            stored = read_stops(spark, state_path) if mark is not None else None
            known = stored[0] if stored is not None and stored[1] == start else None
            # one row per requested channel; staged so both uses read it once
            stops = stage_table(fetch_state(raw, dialogs, targets, _naive_utc(start), known), "stops")
        msgs = fetch(raw, dialogs, targets, _naive_utc(start), _naive_utc(end), run=name, stops=stops, **pull_options)
        write_messages(msgs, store_path, run=name)
        if state_path is not None:
            write_stops(spark, state_path, fetch_state(raw, dialogs, targets, _naive_utc(end), stops), end)
        write_watermark(spark, mark_path, next_watermark(end))
        delete_path(spark, window_path)
    return name, end


def _naive_utc(value: _dt.datetime) -> _dt.datetime:
    if value.tzinfo is not None:
        value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return value


__all__ = [
    "resolve_window",
    "next_watermark",
    "run_value",
    "to_messages",
    "fetch",
    "run_fetch",
    "fetch_state",
    "requested_channels",
    "PAGE_SIZE",
    "MAX_PAGES",
]
