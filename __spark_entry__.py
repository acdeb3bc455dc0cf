"""

Every query reads the given tables (whole tables, whole texts) through the
adapters in ``tidewater.sources.adapters``.  Parameters shared by a query
and its oracle are defined once below.
"""

from __future__ import annotations

import datetime as _dt
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.scalars import (
    base_name,
    default_start,
    is_iso_time,
    iso_time,
    message_from_json,
    message_to_json,
    parse_iso,
    parse_target_list,
    run_name,
    run_stem,
    strip_text,
)
from tidewater.functions.tokens import CharTokenizer, LocalTokenizer, PandasTokenizer
from tidewater.operators.batching import assign_batches, batch_items, batch_stats, oversized_rows
from tidewater.operators.channels import channel_directory
from tidewater.operators.dedup import add_dup_count, prebatch, text_counts
from tidewater.operators.filters import (
    is_valid_message,
    only_dated_messages,
    since,
    unknown_targets,
)
from tidewater.operators.joins import join_by_key
from tidewater.operators.ordering import input_position, merge_sorted
from tidewater.operators.paging import cap_per_channel, channel_stops, paged_pull, pull_stats
from tidewater.operators.stats import fetch_stats
from tidewater.plans.curate import curate, run_prebatch, survivor_tokens, with_tokens
from tidewater.plans.fetch import (
    fetch,
    next_watermark,
    requested_channels,
    resolve_window,
    run_fetch,
    to_messages,
)
from tidewater.records import PY_WS
from tidewater.sources.adapters import (
    dialogs_from_customers,
    messages_from_documents,
    raw_from_events,
    table,
)
from tidewater.session import scratch_path
from tidewater.sources.json_arrays import write_arrays
from tidewater.sources.store import (
    list_store_runs,
    read_batches,
    read_json_docs,
    read_message_files,
    read_messages,
    read_prompts,
    read_runs,
    read_store_run,
    read_watermark,
    render_batches,
    store_batches,
    write_json,
    write_messages,
    write_watermark,
)
from tidewater.streaming.incremental import streaming_curate, streaming_pull

FLAGSHIP_SF = "/root/testdata/sf0.001"

# --- parameters shared by queries and oracles -------------------------------
CAP = 8000  # token budget per batch
MARK = _dt.datetime(2024, 1, 15)  # stored high-water mark (UTC)
EARLIER_MARK = _dt.datetime(2024, 1, 10)  # the mark before it
END = _dt.datetime(2024, 1, 22)  # window end
PAGE = 7  # source page size
PAGES = 5  # page cap in the parity pulls
TOP = 25  # per-channel row cap
RECORD = ["id", "channel_id", "channel_handle", "time", "text"]
TARGET_SEGMENT = "BUILDING"
HIDDEN_RUNS = ["es"]
LATE_TYPE = "purchase"  # events of this type land after the first poll
CHUNK_ROWS = 100  # small chunks force the split-run path of the batcher
PIECE_ROWS = 16  # rows of a stored batch line
LANDED_FILES = 6  # files of the streamed landing folder
MARK_SQL = "TIMESTAMP '2024-01-15 00:00:00'"
END_SQL = "TIMESTAMP '2024-01-22 00:00:00'"


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


PY_WS_SQL = _sql_str(PY_WS)


# --- shared inputs -----------------------------------------------------------
def _docs(spark, sf):
    return messages_from_documents(table(spark, sf, "documents"))


def _raw(spark, sf):
    return raw_from_events(table(spark, sf, "events"))


def _dialogs(spark, sf):
    return dialogs_from_customers(table(spark, sf, "customer"))


def _targets(spark, sf):
    """Handles of the channel dialogs of one market segment (data-derived)."""
    cust = table(spark, sf, "customer").filter(F.col("c_mktsegment") == TARGET_SEGMENT)
    return (
        channel_directory(dialogs_from_customers(cust))
        .filter(F.col("handle") != "")
        .select("handle", F.col("id").alias("channel_ord"))
    )


def _prebatched(spark, sf):
    return prebatch(_docs(spark, sf), text="text", order="pos", partition="run")


def _batched(spark, sf, rows_per_chunk=None, one_run=False, keep=None):
    """Batched survivors.  ``keep`` (narrow columns of the first copy) takes
    the text-free path; ``keep=None`` carries the whole record through."""
    docs = _docs(spark, sf)
    if one_run:
        docs = docs.withColumn("run", F.lit("all"))
    if keep is not None:
        counted = survivor_tokens(docs, RECORD, LocalTokenizer(), carry=keep)
    else:
        pre = prebatch(docs, text="text", order="pos", partition="run")
        counted = with_tokens(pre, [*RECORD, "dup_count"], LocalTokenizer())
    kwargs = {} if rows_per_chunk is None else {"rows_per_chunk": rows_per_chunk}
    return assign_batches(counted, CAP, tokens="tokens", run="run", pos="pos", **kwargs)


# --- queries -------------------------------------------------------------------
def q_channel_directory(spark, sf):
    return channel_directory(_dialogs(spark, sf), with_validity=True)


def q_parse_target_list(spark, sf):
    docs = table(spark, sf, "documents")
    parts = parse_target_list("text")
    return docs.select(
        F.col("doc_id"),
        F.size(parts).cast("long").alias("n_parts"),
        F.md5(F.array_join(parts, "\u0001")).alias("parts_md5"),
    )


def q_strip_text(spark, sf):
    docs = table(spark, sf, "documents")
    padded = F.concat(F.lit("\t\u00a0 "), F.col("text"), F.lit("\u3000\n\u2029"))
    stripped = strip_text(padded)
    return docs.select(
        F.col("doc_id"),
        F.char_length(stripped).cast("long").alias("n_chars"),
        F.md5(stripped).alias("text_md5"),
        (stripped == F.col("text")).alias("same_as_source"),
    )


def q_iso_time(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select(F.col("event_id"), iso_time("ts").alias("time"))


def _varied_times(spark, sf):
    """Message times written in four ways, one per language run."""
    m = _docs(spark, sf)
    num = F.regexp_extract("channel_handle", r"(\d+)$", 1)
    t = (
        F.when(F.col("run") == "en", F.col("time"))
        .when(F.col("run") == "fr", F.regexp_replace("time", r"\+00:00$", "Z"))
        .when(F.col("run") == "de", F.concat(F.lit("2024-"), F.lpad(num, 2, "0"), F.lit("-15T10:00:00")))
        .otherwise(F.concat(F.lit("2024-02-"), num))
    )
    return m.withColumn("time", t)


def q_run_names(spark, sf):
    """Each event's default window (ts - 7 days, ts] as a run file name."""
    ev = table(spark, sf, "events")
    start = iso_time(default_start(F.col("ts"), 7))
    name = run_name(start, iso_time("ts"))
    path = F.concat(F.lit("/store/fetches/"), name)
    return ev.select("event_id", base_name(path).alias("file_name"), run_stem(path).alias("run"))


def q_validate_messages(spark, sf):
    return _varied_times(spark, sf).select("id", "time", is_valid_message().alias("is_valid"))


def q_parse_iso(spark, sf):
    m = _varied_times(spark, sf)
    return m.select("id", is_iso_time("time").alias("parses"), iso_time(parse_iso("time"), source="ltz").alias("instant"))


def q_incremental_since(spark, sf):
    return since(_raw(spark, sf), MARK, ts="date").select("id", "channel_id", iso_time("date").alias("time"))


def q_incremental_bounded(spark, sf):
    return since(_raw(spark, sf), MARK, ts="date", end=END).select(
        "id", "channel_id", iso_time("date").alias("time")
    )


def q_target_messages(spark, sf):
    side = requested_channels(_dialogs(spark, sf), _targets(spark, sf))  # size-checked broadcast
    raw = only_dated_messages(_raw(spark, sf)).join(side, on="channel_id", how="inner")
    return to_messages(raw).drop("channel_ord")


def q_unknown_targets(spark, sf):
    cust = table(spark, sf, "customer").filter(F.col("c_mktsegment").isin(TARGET_SEGMENT, "MACHINERY"))
    requested = (
        dialogs_from_customers(cust)
        .select(F.concat(F.lit("@"), F.col("username")).alias("handle"))
        .filter(F.col("handle").isNotNull())
    )
    return unknown_targets(channel_directory(_dialogs(spark, sf)), requested)


def q_cap_per_channel(spark, sf):
    return cap_per_channel(_raw(spark, sf), TOP).select("id", "channel_id")


def q_paged_pull(spark, sf):
    return paged_pull(_raw(spark, sf), MARK, limit=PAGE, max_pages=PAGES, early_stop=True).select("id", "channel_id")


def q_paged_pull_uncapped(spark, sf):
    return paged_pull(_raw(spark, sf), MARK, limit=PAGE, max_pages=None, early_stop=True).select("id", "channel_id")


def q_paged_pull_lossless(spark, sf):
    return paged_pull(_raw(spark, sf), MARK, limit=PAGE, max_pages=None, early_stop=False).select("id", "channel_id")


def q_paged_pull_capped_lossless(spark, sf):
    return paged_pull(_raw(spark, sf), MARK, limit=PAGE, max_pages=PAGES, early_stop=False).select("id", "channel_id")


def q_pull_stats(spark, sf):
    return pull_stats(_raw(spark, sf), MARK, limit=PAGE, max_pages=PAGES)


def q_channel_stops(spark, sf):
    return channel_stops(_raw(spark, sf), MARK)


def q_channel_stops_incremental(spark, sf):
    raw = _raw(spark, sf)
    earlier = channel_stops(raw, EARLIER_MARK)
    return channel_stops(raw, MARK, previous=earlier)


def q_merge_sorted(spark, sf):
    msgs = only_dated_messages(_raw(spark, sf)).select(
        "id", "channel_id", iso_time("date").alias("time"), F.col("channel_id").alias("channel_ord")
    )
    return merge_sorted(msgs).select("id", "channel_id", "time", "pos")


def q_fetch_run(spark, sf):
    return fetch(_raw(spark, sf), _dialogs(spark, sf), _targets(spark, sf), MARK, END)


def q_fetch_run_parity(spark, sf):
    return fetch(
        _raw(spark, sf), _dialogs(spark, sf), _targets(spark, sf), MARK, END,
        limit=PAGE, max_pages=PAGES, early_stop=True,
    )


def q_fetch_stats(spark, sf):
    return fetch_stats(q_fetch_run(spark, sf))


def q_text_counts(spark, sf):
    return text_counts(_docs(spark, sf), text="text", partition="run")


def q_prebatch(spark, sf):
    return prebatch(_docs(spark, sf))


def q_prebatch_hashed(spark, sf):
    return _prebatched(spark, sf)


def q_prebatch_all_runs(spark, sf):
    return prebatch(_docs(spark, sf), text="text", order="pos", partition=None)


def q_token_counts(spark, sf):
    m = _docs(spark, sf)
    return m.select(
        "id",
        LocalTokenizer().count_record(RECORD).alias("tokens_local_json"),
        LocalTokenizer().count("text").alias("tokens_local_text"),
        CharTokenizer().count("text").alias("tokens_chars_text"),
        CharTokenizer().count_record(RECORD).alias("tokens_chars_json"),
    )


def q_oversized_rows(spark, sf):
    counted = survivor_tokens(_docs(spark, sf), RECORD, LocalTokenizer(), carry=["id"])
    return oversized_rows(counted, CAP).select("id", "run", "tokens")


def q_assign_batches(spark, sf):
    return _batched(spark, sf, keep=[]).select("run", "pos", "batch_no", "batch_idx", "total_batches")


def q_assign_batches_chunked(spark, sf):
    return _batched(spark, sf, rows_per_chunk=CHUNK_ROWS, keep=[]).select(
        "run", "pos", "batch_no", "batch_idx", "total_batches"
    )


def q_batches_one_run(spark, sf):
    return _batched(spark, sf, rows_per_chunk=CHUNK_ROWS, one_run=True, keep=[]).select(
        "run", "pos", "batch_no", "batch_idx", "total_batches"
    )


def q_add_dup_count(spark, sf):
    return add_dup_count(_docs(spark, sf)).select("id", "run", "dup_count")


def q_batch_items(spark, sf):
    return batch_items(_batched(spark, sf, keep=[])).select("run", "pos", "batch_no", "batch_idx", "file_name")


def q_batch_stats(spark, sf):
    return batch_stats(_batched(spark, sf, keep=[])).select("run", "batch_no", "n_rows", "batch_tokens", "file_name")


def q_batch_documents(spark, sf):
    return render_batches(_batched(spark, sf, keep=["id"]), ["id"]).select("run", "batch_no", "file_name", "document")


def q_batch_documents_full(spark, sf):
    docs = render_batches(_batched(spark, sf), [*RECORD, "dup_count"])
    return docs.select(
        "run",
        "batch_no",
        "file_name",
        F.size(F.from_json("document", "map<string,string>")).cast("long").alias("n_items"),
        F.md5("document").alias("doc_md5"),
    )


def q_json_round_trip(spark, sf):
    conv = table(spark, sf, "conversations")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in conv.schema.fields])
    encoded = conv.select(message_to_json(conv.columns).alias("j"))
    decoded = encoded.select(message_from_json("j", schema).alias("m"))
    return decoded.select(*[F.col("m")[c].alias(c) for c in conv.columns])


def _stored_runs(spark, sf):
    """A store that holds the documents' messages, one run per language."""
    return write_messages(_docs(spark, sf), scratch_path(spark, "runs"))


def q_run_listing(spark, sf):
    return list_store_runs(spark, _stored_runs(spark, sf))


def q_hidden_runs(spark, sf):
    return list_store_runs(spark, _stored_runs(spark, sf), hide=HIDDEN_RUNS)


def q_run_by_index(spark, sf):
    return read_store_run(spark, _stored_runs(spark, sf), 0).select("id", "run", "pos")


def q_store_round_trip(spark, sf):
    """Runs written twice and read back whole; the second write replaces the first."""
    path = _stored_runs(spark, sf)
    write_messages(_docs(spark, sf), path)
    return read_messages(spark, path).select("id", "channel_id", "channel_handle", "time", F.md5("text").alias("text_md5"), "pos", "run")


def q_prebatch_store(spark, sf):
    path = run_prebatch(_docs(spark, sf), scratch_path(spark, "prebatch"))
    return read_runs(spark, path).select("id", "run", "pos", "dup_count")


def q_json_sink(spark, sf):
    conv = table(spark, sf, "conversations")
    path = write_json(conv, scratch_path(spark, "json"))
    return spark.read.schema(conv.schema).json(path)


def q_json_docs(spark, sf):
    """One JSON document per language, written as text files and read back as documents."""
    docs = table(spark, sf, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))
    path = scratch_path(spark, "json-docs")
    docs.select(F.col("lang").alias("part"), F.to_json(F.struct("lang", "n", "chars")).alias("value")).write.partitionBy("part").text(path)
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("n", T.LongType()), T.StructField("chars", T.LongType())])
    return read_json_docs(spark, path, schema).select("doc.lang", "doc.n", "doc.chars")


def q_prompt_files(spark, sf):
    """The longest text of each source as a prompt file, read back byte for byte."""
    path = scratch_path(spark, "prompts")
    longest = table(spark, sf, "documents").groupBy("source").agg(F.max_by("text", F.struct("n_chars", "doc_id")).alias("value"))
    longest.select("source", "value").write.partitionBy("source").option("lineSep", "\n").text(path)
    return read_prompts(spark, path).select(F.md5("text").alias("text_md5"), F.octet_length("text").cast("long").alias("n_bytes"))


def q_mark_window(spark, sf):
    """The window of a poll at the newest event, from a stored mark that was replaced once."""
    first, last = table(spark, sf, "events").agg(F.min("ts"), F.max("ts")).first()
    path = scratch_path(spark, "mark")
    utc = lambda t: t.replace(tzinfo=_dt.timezone.utc)
    write_watermark(spark, path, utc(last))
    write_watermark(spark, path, utc(first))
    start, end = resolve_window(read_watermark(spark, path), utc(last))
    return spark.createDataFrame(
        [(start.isoformat(), end.isoformat(), next_watermark(end).isoformat())], "window_start string, window_end string, next_mark string"
    )


def _late_poll(spark, sf, state):
    """The second of two polls; rows of one type land only after the first, however old they are."""
    raw, base = _raw(spark, sf), scratch_path(spark, "late-poll")
    late = table(spark, sf, "events").filter(F.col("event_type") == LATE_TYPE).select(F.col("event_id").alias("id"))
    state_path = f"{base}/state" if state else None
    utc = lambda t: t.replace(tzinfo=_dt.timezone.utc)
    for landed, now in ((raw.join(late, on="id", how="left_anti"), MARK), (raw, END)):
        run, _ = run_fetch(
            landed, _dialogs(spark, sf), _targets(spark, sf), f"{base}/runs", f"{base}/mark", utc(now), state_path=state_path
        )
    return read_messages(spark, f"{base}/runs", run=run).select("id", "channel_id", "channel_handle", "time", "text", "pos")


def q_late_rows(spark, sf):
    return _late_poll(spark, sf, state=False)


def q_late_rows_with_state(spark, sf):
    return _late_poll(spark, sf, state=True)


def q_model_tokens(spark, sf):
    """Token counts by a Python counter (words) on the record's text."""
    return _docs(spark, sf).select("id", PandasTokenizer(lambda: lambda text: len(text.split(" "))).count("text").alias("tokens"))


def q_curated_batches(spark, sf):
    return curate(_docs(spark, sf), CAP, RECORD, LocalTokenizer())


def q_streaming_pull(spark, sf):
    handles = requested_channels(_dialogs(spark, sf), _targets(spark, sf))
    schema = table(spark, sf, "events").schema
    return streaming_pull(spark, sf, schema, handles, glob="events.parquet", to_raw=raw_from_events)


def q_target_messages_by_key(spark, sf):
    """The pull of one segment's channels by the join for target sets that are too large to broadcast."""
    wanted = requested_channels(_dialogs(spark, sf), _targets(spark, sf))
    joined = join_by_key(only_dated_messages(_raw(spark, sf)), wanted, "channel_id", "id")
    return to_messages(joined).drop("channel_ord")


def q_run_positions(spark, sf):
    """Position of every message in its run's merged order."""
    msgs = _docs(spark, sf).drop("pos").withColumn("channel_ord", F.col("channel_id"))
    return input_position(msgs).select("id", "run", "pos")


def q_stored_batches(spark, sf):
    """The batches of all runs, written row by row in lines of at most PIECE_ROWS rows, and read back."""
    path = store_batches(_batched(spark, sf), [*RECORD, "dup_count"], scratch_path(spark, "batches"), piece_rows=PIECE_ROWS)
    back = read_batches(spark, path, "id long, time string, text string, dup_count long")
    return back.select("run", "batch_no", "file_name", "batch_idx", "rec.id", "rec.time", F.md5("rec.text").alias("text_md5"), "rec.dup_count")


def q_foreign_arrays(spark, sf):
    """Messages from JSON arrays, one a language in as many files as its size takes (written here, one object a line)."""
    path = write_arrays(_docs(spark, sf), scratch_path(spark, "arrays"), F.to_json(F.struct(*RECORD)))
    back = read_message_files(spark, path, pattern="*.txt", folders=True)
    return back.select("id", "channel_id", "channel_handle", "time", F.md5("text").alias("text_md5"), "pos")


def q_streaming_pull_restarted(spark, sf):
    """Events landed as LANDED_FILES files, pulled by polls that stop and go on from their checkpoint."""
    landing = scratch_path(spark, "landing")
    raw = _raw(spark, sf)
    raw.repartition(LANDED_FILES, "id").write.parquet(landing)
    handles = requested_channels(_dialogs(spark, sf), _targets(spark, sf))
    pulled = streaming_pull(spark, landing, raw.schema, handles, polls=(1, 2, None))
    return pulled.select("id", "channel_id", "channel_handle", "time", "text")


def q_streaming_curate(spark, sf):
    return streaming_curate(spark, sf, cap=CAP, fields=RECORD)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "channel_directory": q_channel_directory,
    "parse_target_list": q_parse_target_list,
    "strip_text": q_strip_text,
    "iso_time": q_iso_time,
    "run_names": q_run_names,
    "validate_messages": q_validate_messages,
    "parse_iso": q_parse_iso,
    "incremental_since": q_incremental_since,
    "incremental_bounded": q_incremental_bounded,
    "target_messages": q_target_messages,
    "unknown_targets": q_unknown_targets,
    "cap_per_channel": q_cap_per_channel,
    "paged_pull": q_paged_pull,
    "paged_pull_uncapped": q_paged_pull_uncapped,
    "paged_pull_lossless": q_paged_pull_lossless,
    "paged_pull_capped_lossless": q_paged_pull_capped_lossless,
    "pull_stats": q_pull_stats,
    "channel_stops": q_channel_stops,
    "channel_stops_incremental": q_channel_stops_incremental,
    "merge_sorted": q_merge_sorted,
    "fetch_run": q_fetch_run,
    "fetch_run_parity": q_fetch_run_parity,
    "fetch_stats": q_fetch_stats,
    "text_counts": q_text_counts,
    "prebatch": q_prebatch,
    "prebatch_hashed": q_prebatch_hashed,
    "prebatch_all_runs": q_prebatch_all_runs,
    "token_counts": q_token_counts,
    "oversized_rows": q_oversized_rows,
    "assign_batches": q_assign_batches,
    "assign_batches_chunked": q_assign_batches_chunked,
    "batches_one_run": q_batches_one_run,
    "add_dup_count": q_add_dup_count,
    "batch_items": q_batch_items,
    "batch_stats": q_batch_stats,
    "batch_documents": q_batch_documents,
    "batch_documents_full": q_batch_documents_full,
    "json_round_trip": q_json_round_trip,
    "run_listing": q_run_listing,
    "run_by_index": q_run_by_index,
    "hidden_runs": q_hidden_runs,
    "store_round_trip": q_store_round_trip,
    "prebatch_store": q_prebatch_store,
    "json_sink": q_json_sink,
    "json_docs": q_json_docs,
    "prompt_files": q_prompt_files,
    "mark_window": q_mark_window,
    "late_rows": q_late_rows,
    "late_rows_with_state": q_late_rows_with_state,
    "model_tokens": q_model_tokens,
    "curated_batches": q_curated_batches,
    "streaming_curate": q_streaming_curate,
    "streaming_pull": q_streaming_pull,
    "streaming_pull_restarted": q_streaming_pull_restarted,
    "target_messages_by_key": q_target_messages_by_key,
    "run_positions": q_run_positions,
    "stored_batches": q_stored_batches,
    "foreign_arrays": q_foreign_arrays,
}


def _optional(name: str):
    """A module that may have been removed with its folder; other import errors surface."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as e:
        if e.name is None or not (name + ".").startswith(e.name + "."):
            raise
        return None


_LLM = _optional("tidewater.llm.queries")
_PIPELINE = _optional("corpus_pipeline") if _LLM else None


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: dedup + token-budgeted batching of every run (sf0.001)."""
    return q_curated_batches(spark, FLAGSHIP_SF)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return (
        dict(_QUERIES)
        | (_LLM.queries() if _LLM else {})
        | ({"pipeline": _PIPELINE.run} if _PIPELINE else {})
    )


_MSGS = r"""
msgs AS (
  SELECT doc_id AS id,
         CAST(regexp_extract(source, '(\d+)$', 1) AS BIGINT) AS channel_id,
         '@' || source AS channel_handle,
         strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id), '%Y-%m-%dT%H:%M:%S+00:00') AS time,
         text, doc_id AS pos, lang AS run
  FROM documents)"""

_PRE = """
pre AS (
  SELECT id, channel_id, channel_handle, time, text, pos, run, dup_count FROM (
    SELECT *, row_number() OVER (PARTITION BY run, text ORDER BY pos) AS rn,
           CAST(count(*) OVER (PARTITION BY run, text) AS BIGINT) AS dup_count
    FROM msgs) WHERE rn = 1)"""

_TOK = f"""
tok AS (
  SELECT *, CAST((strlen(to_json({{'id': id, 'channel_id': channel_id, 'channel_handle': channel_handle,
                  'time': time, 'text': text, 'dup_count': dup_count}})) + 11) // 2 AS BIGINT) AS tokens
  FROM pre)"""

_WALK = f"""
fit AS (
  SELECT run, pos, tokens, dup_count, id, row_number() OVER (PARTITION BY run ORDER BY pos) AS k
  FROM tok WHERE tokens <= {CAP}),
walk(run, k, pos, tokens, dup_count, id, batch_no, fill, batch_idx) AS (
  SELECT run, k, pos, tokens, dup_count, id, CAST(1 AS BIGINT), tokens, CAST(0 AS BIGINT) FROM fit WHERE k = 1
  UNION ALL
  SELECT f.run, f.k, f.pos, f.tokens, f.dup_count, f.id,
         CASE WHEN w.fill + f.tokens > {CAP} THEN w.batch_no + 1 ELSE w.batch_no END,
         CASE WHEN w.fill + f.tokens > {CAP} THEN f.tokens ELSE w.fill + f.tokens END,
         CASE WHEN w.fill + f.tokens > {CAP} THEN CAST(0 AS BIGINT) ELSE w.batch_idx + 1 END
  FROM walk w JOIN fit f ON f.run = w.run AND f.k = w.k + 1),
labeled AS (
  SELECT *, max(batch_no) OVER (PARTITION BY run) AS total_batches FROM walk)"""

_BATCHED = f"WITH RECURSIVE {_MSGS},{_PRE},{_TOK},{_WALK}"

_PRE_ONE_RUN = """
pre AS (
  SELECT id, channel_id, channel_handle, time, text, pos, 'all' AS run, dup_count FROM (
    SELECT *, row_number() OVER (PARTITION BY text ORDER BY pos) AS rn,
           CAST(count(*) OVER (PARTITION BY text) AS BIGINT) AS dup_count
    FROM msgs) WHERE rn = 1)"""

_RAW = """
raw AS (
  SELECT event_id AS id, user_id AS channel_id,
         CASE WHEN event_type = 'error' THEN 'Service' ELSE 'Message' END AS kind,
         ts AS date, props AS message
  FROM events)"""

_DIALOGS = """
dialogs AS (
  SELECT c_custkey AS id,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'User' ELSE 'Channel' END AS kind,
         c_name AS title,
         CASE WHEN c_acctbal > 0 THEN lower(c_name) END AS username,
         c_mktsegment AS segment
  FROM customer),
channels AS (
  SELECT id, title, CASE WHEN coalesce(username, '') <> '' THEN '@' || username ELSE '' END AS handle, segment
  FROM dialogs WHERE kind = 'Channel')"""

_ISO = """CASE WHEN epoch_us({c}) % 1000000 = 0
             THEN strftime({c}, '%Y-%m-%dT%H:%M:%S+00:00')
             ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f+00:00') END"""

_STOPS = f"""
stops AS (
  SELECT channel_id, max(id) AS stop FROM raw
  WHERE kind = 'Message' AND date IS NOT NULL AND date <= {MARK_SQL} GROUP BY channel_id),
fresh AS (
  SELECT r.*, (r.kind = 'Message' AND r.date IS NOT NULL) AS ok
  FROM raw r LEFT JOIN stops s USING (channel_id)
  WHERE s.stop IS NULL OR r.id > s.stop)"""


def _parity_sql(capped: bool, src: str = "fresh") -> str:
    limit = f"WHERE r <= {PAGES * PAGE}" if capped else ""
    return f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY id DESC) AS r FROM {src}),
paged AS (SELECT *, (r - 1) // {PAGE} AS page FROM ranked {limit}),
kept AS (SELECT *, sum(CAST(ok AS INTEGER)) OVER (PARTITION BY channel_id, page) AS pk FROM paged),
stopped AS (
  SELECT *, min(CASE WHEN pk < {PAGE} THEN page END) OVER (PARTITION BY channel_id) AS ps FROM kept),
pulled AS (SELECT * FROM stopped WHERE ok AND (ps IS NULL OR page <= ps))"""


_VARIED = r"""
varied AS (
  SELECT id, run, channel_handle,
         CASE WHEN run = 'en' THEN time
              WHEN run = 'fr' THEN regexp_replace(time, '\+00:00$', 'Z')
              WHEN run = 'de' THEN '2024-' || lpad(regexp_extract(channel_handle, '(\d+)$', 1), 2, '0') || '-15T10:00:00'
              ELSE '2024-02-' || regexp_extract(channel_handle, '(\d+)$', 1) END AS time
  FROM msgs)"""

_ISO_OK = r"""coalesce(regexp_full_match(time, '\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?([+-]\d{2}:\d{2}|Z)?)?')
                    AND try_cast(time AS TIMESTAMPTZ) IS NOT NULL, false)"""

_TARGETED = f"""
targets AS (
  SELECT handle, id AS channel_ord FROM channels WHERE segment = '{TARGET_SEGMENT}' AND handle <> ''),
wanted AS (
  SELECT c.id AS channel_id, c.handle AS channel_handle, t.channel_ord
  FROM channels c JOIN targets t ON c.handle = t.handle)"""


def _fetch_sql(parity: bool) -> str:
    src = f"""
src AS (
  SELECT r.*, w.channel_handle, w.channel_ord FROM raw r JOIN wanted w USING (channel_id)
  WHERE r.date IS NULL OR r.date <= {END_SQL}),
stops AS (
  SELECT channel_id, max(id) AS stop FROM src
  WHERE kind = 'Message' AND date IS NOT NULL AND date <= {MARK_SQL} GROUP BY channel_id),
fresh AS (
  SELECT s.*, (s.kind = 'Message' AND s.date IS NOT NULL) AS ok
  FROM src s LEFT JOIN stops p USING (channel_id)
  WHERE p.stop IS NULL OR s.id > p.stop)"""
    if parity:
        body = _parity_sql(True)
    else:
        body = "\npulled AS (SELECT * FROM fresh WHERE ok)"
    iso = _ISO.format(c="date")
    return f"""WITH {_RAW},{_DIALOGS},{_TARGETED},{src},{body},
msg AS (
  SELECT id, channel_id, channel_handle, {iso} AS time,
         trim(message, {PY_WS_SQL}) AS text, channel_ord
  FROM pulled)
SELECT id, channel_id, channel_handle, time, text,
       CAST(row_number() OVER (ORDER BY time, channel_ord, id DESC) - 1 AS BIGINT) AS pos
FROM msg"""


_ORACLES: dict[str, str] = {
    "channel_directory": f"""WITH {_DIALOGS}
SELECT id, title, handle, (id IS NOT NULL AND title IS NOT NULL AND handle IS NOT NULL) AS is_valid
FROM channels""",
    "parse_target_list": f"""
SELECT doc_id, CAST(len(parts) AS BIGINT) AS n_parts, md5(array_to_string(parts, chr(1))) AS parts_md5
FROM (SELECT doc_id,
             list_filter(list_transform(string_split(text, ','), lambda x: trim(x, {PY_WS_SQL})), lambda x: x <> '') AS parts
      FROM documents)""",
    "strip_text": f"""
SELECT doc_id, CAST(length(s) AS BIGINT) AS n_chars, md5(s) AS text_md5, (s = text) AS same_as_source
FROM (SELECT doc_id, text,
             trim(chr(9) || chr(160) || ' ' || text || chr(12288) || chr(10) || chr(8233), {PY_WS_SQL}) AS s
      FROM documents)""",
    "iso_time": f"SELECT event_id, {_ISO.format(c='ts')} AS time FROM events",
    "run_names": f"""
SELECT event_id, name AS file_name, regexp_replace(name, '[.]json$', '') AS run FROM (
  SELECT event_id,
         {_ISO.format(c="(ts - INTERVAL 7 DAY)")} || '~' || {_ISO.format(c='ts')} || '.json' AS name
  FROM events)""",
    "validate_messages": f"""WITH {_MSGS},{_VARIED}
SELECT id, time, {_ISO_OK} AS is_valid FROM varied""",
    "parse_iso": f"""WITH {_MSGS},{_VARIED}
SELECT id, {_ISO_OK} AS parses,
       CASE WHEN {_ISO_OK} THEN {_ISO.format(c="TRY_CAST(regexp_replace(time, '(Z|[+]00:00)$', '') AS TIMESTAMP)")} END AS instant
FROM varied""",
    "incremental_since": f"""WITH {_RAW}
SELECT id, channel_id, {_ISO.format(c='date')} AS time FROM raw WHERE date > {MARK_SQL}""",
    "incremental_bounded": f"""WITH {_RAW}
SELECT id, channel_id, {_ISO.format(c='date')} AS time FROM raw WHERE date > {MARK_SQL} AND date <= {END_SQL}""",
    "target_messages": f"""WITH {_RAW},{_DIALOGS},{_TARGETED}
SELECT r.id, r.channel_id, w.channel_handle, {_ISO.format(c='r.date')} AS time,
       trim(r.message, {PY_WS_SQL}) AS text
FROM raw r JOIN wanted w USING (channel_id)
WHERE r.kind = 'Message' AND r.date IS NOT NULL""",
    "unknown_targets": f"""WITH {_DIALOGS}
SELECT DISTINCT '@' || username AS handle FROM dialogs
WHERE segment IN ('{TARGET_SEGMENT}', 'MACHINERY') AND username IS NOT NULL
  AND '@' || username NOT IN (SELECT handle FROM channels)""",
    "cap_per_channel": f"""WITH {_RAW}
SELECT id, channel_id FROM (
  SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY id DESC) AS r FROM raw) WHERE r <= {TOP}""",
    "paged_pull": f"WITH {_RAW},{_STOPS},{_parity_sql(True)}\nSELECT id, channel_id FROM pulled",
    "paged_pull_uncapped": f"WITH {_RAW},{_STOPS},{_parity_sql(False)}\nSELECT id, channel_id FROM pulled",
    "paged_pull_lossless": f"WITH {_RAW},{_STOPS}\nSELECT id, channel_id FROM fresh WHERE ok",
    "paged_pull_capped_lossless": f"""WITH {_RAW},{_STOPS}
SELECT id, channel_id FROM (
  SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY id DESC) AS r FROM fresh)
WHERE ok AND r <= {PAGES * PAGE}""",
    "pull_stats": f"""WITH {_RAW},{_STOPS}
SELECT channel_id, CAST(count(*) AS BIGINT) AS n_source, CAST(sum(CAST(ok AS BIGINT)) AS BIGINT) AS n_messages,
       count(*) > {PAGES * PAGE} AS truncated
FROM fresh GROUP BY channel_id""",
    "channel_stops": f"""WITH {_RAW}
SELECT channel_id, max(id) AS stop FROM raw
WHERE kind = 'Message' AND date IS NOT NULL AND date <= {MARK_SQL} GROUP BY channel_id""",
    "channel_stops_incremental": f"""WITH {_RAW}
SELECT channel_id, max(id) AS stop FROM raw
WHERE kind = 'Message' AND date IS NOT NULL AND date <= {MARK_SQL} GROUP BY channel_id""",
    "streaming_pull": f"""WITH {_RAW},{_DIALOGS},{_TARGETED},
m AS (
  SELECT r.id, r.channel_id, w.channel_handle, {_ISO.format(c='r.date')} AS time,
         trim(r.message, {PY_WS_SQL}) AS text, w.channel_ord
  FROM raw r JOIN wanted w USING (channel_id)
  WHERE r.kind = 'Message' AND r.date IS NOT NULL)
SELECT id, channel_id, channel_handle, time, text,
       CAST(row_number() OVER (ORDER BY time, channel_ord, id DESC) - 1 AS BIGINT) AS pos, '0' AS run
FROM m""",
    "merge_sorted": f"""WITH {_RAW},
m AS (SELECT id, channel_id, {_ISO.format(c='date')} AS time FROM raw
      WHERE kind = 'Message' AND date IS NOT NULL)
SELECT id, channel_id, time, CAST(row_number() OVER (ORDER BY time, channel_id, id DESC) - 1 AS BIGINT) AS pos
FROM m""",
    "fetch_run": _fetch_sql(False),
    "fetch_run_parity": _fetch_sql(True),
    "fetch_stats": f"""WITH f AS ({_fetch_sql(False)})
SELECT channel_handle, CAST(count(*) AS BIGINT) AS n_messages FROM f GROUP BY ROLLUP (channel_handle)""",
    "text_counts": f"""WITH {_MSGS}
SELECT run, text, CAST(count(*) AS BIGINT) AS dup_count FROM msgs GROUP BY run, text""",
    "prebatch": f"WITH {_MSGS},{_PRE}\nSELECT * FROM pre",
    "prebatch_hashed": f"WITH {_MSGS},{_PRE}\nSELECT * FROM pre",
    "prebatch_all_runs": f"""WITH {_MSGS}
SELECT id, channel_id, channel_handle, time, text, pos, run, dup_count FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY pos) AS rn,
         CAST(count(*) OVER (PARTITION BY text) AS BIGINT) AS dup_count
  FROM msgs) WHERE rn = 1""",
    "token_counts": f"""WITH {_MSGS}
SELECT id,
  CAST((strlen(to_json({{'id': id, 'channel_id': channel_id, 'channel_handle': channel_handle,
        'time': time, 'text': text}})) + 9) // 2 AS BIGINT) AS tokens_local_json,
  CAST(strlen(text) // 2 AS BIGINT) AS tokens_local_text,
  CAST(length(text) // 4 AS BIGINT) AS tokens_chars_text,
  CAST((length(to_json({{'id': id, 'channel_id': channel_id, 'channel_handle': channel_handle,
        'time': time, 'text': text}})) + 9) // 4 AS BIGINT) AS tokens_chars_json
FROM msgs""",
    "oversized_rows": f"WITH {_MSGS},{_PRE},{_TOK}\nSELECT id, run, tokens FROM tok WHERE tokens > {CAP}",
    "assign_batches": f"{_BATCHED}\nSELECT run, pos, batch_no, batch_idx, total_batches FROM labeled",
    "assign_batches_chunked": f"{_BATCHED}\nSELECT run, pos, batch_no, batch_idx, total_batches FROM labeled",
    "batches_one_run": f"""WITH RECURSIVE {_MSGS},{_PRE_ONE_RUN},{_TOK},{_WALK}
SELECT run, pos, batch_no, batch_idx, total_batches FROM labeled""",
    "add_dup_count": f"""WITH {_MSGS}
SELECT id, run, CAST(count(*) OVER (PARTITION BY run, text) AS BIGINT) AS dup_count FROM msgs""",
    "batch_items": f"""{_BATCHED}
SELECT run, pos, batch_no, batch_idx, batch_no || 'of' || total_batches || '.json' AS file_name FROM labeled""",
    "batch_stats": f"""{_BATCHED}
SELECT run, batch_no, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(tokens) AS BIGINT) AS batch_tokens,
       batch_no || 'of' || max(total_batches) || '.json' AS file_name
FROM labeled GROUP BY run, batch_no""",
    "batch_documents": f"""{_BATCHED}
SELECT run, batch_no, batch_no || 'of' || max(total_batches) || '.json' AS file_name,
       '{{' || string_agg('"' || batch_idx || '":{{"id":' || id || '}}', ',' ORDER BY batch_idx) || '}}' AS document
FROM labeled GROUP BY run, batch_no""",
    "batch_documents_full": f"""{_BATCHED},
docs AS (
  SELECT l.run, l.batch_no, max(l.total_batches) AS total_batches,
         '{{' || string_agg('"' || l.batch_idx || '":' ||
             to_json({{'id': p.id, 'channel_id': p.channel_id, 'channel_handle': p.channel_handle,
                       'time': p.time, 'text': p.text, 'dup_count': p.dup_count}}), ',' ORDER BY l.batch_idx) || '}}' AS document,
         count(*) AS n_items
  FROM labeled l JOIN pre p ON p.run = l.run AND p.pos = l.pos
  GROUP BY l.run, l.batch_no)
SELECT run, batch_no, batch_no || 'of' || total_batches || '.json' AS file_name,
       CAST(n_items AS BIGINT) AS n_items, md5(document) AS doc_md5
FROM docs""",
    "stored_batches": f"""{_BATCHED}
SELECT l.run, l.batch_no, l.batch_no || 'of' || l.total_batches || '.json' AS file_name, l.batch_idx, p.id, p.time,
       md5(p.text) AS text_md5, p.dup_count
FROM labeled l JOIN pre p ON p.run = l.run AND p.pos = l.pos""",
    "foreign_arrays": f"""WITH {_MSGS}
SELECT id, channel_id, channel_handle, time, md5(text) AS text_md5,
       CAST(row_number() OVER (PARTITION BY run ORDER BY id) - 1 AS BIGINT) AS pos
FROM msgs""",
    "run_positions": f"""WITH {_MSGS}
SELECT id, run, CAST(row_number() OVER (PARTITION BY run ORDER BY time, channel_id, id DESC) - 1 AS BIGINT) AS pos FROM msgs""",
    "json_round_trip": "SELECT conv_id, turn, role, text FROM conversations",
    "run_listing": """
SELECT idx, run, idx || ': ' || run AS line FROM (
  SELECT CAST(row_number() OVER (ORDER BY lang) - 1 AS BIGINT) AS idx, lang AS run
  FROM (SELECT DISTINCT lang FROM documents))""",
    "run_by_index": """
SELECT doc_id AS id, lang AS run, doc_id AS pos FROM documents
WHERE lang = (SELECT min(lang) FROM documents)""",
    "hidden_runs": f"""
SELECT idx, run, idx || ': ' || run AS line FROM (
  SELECT CAST(row_number() OVER (ORDER BY lang) - 1 AS BIGINT) AS idx, lang AS run
  FROM (SELECT DISTINCT lang FROM documents WHERE lang NOT IN ({', '.join(_sql_str(r) for r in HIDDEN_RUNS)})))""",
    "store_round_trip": f"""WITH {_MSGS}
SELECT id, channel_id, channel_handle, time, md5(text) AS text_md5, pos, run FROM msgs""",
    "prebatch_store": f"WITH {_MSGS},{_PRE}\nSELECT id, run, pos, dup_count FROM pre",
    "json_sink": "SELECT conv_id, turn, role, text FROM conversations",
    "json_docs": """
SELECT lang, CAST(count(*) AS BIGINT) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang""",
    "prompt_files": """
SELECT md5(t) AS text_md5, CAST(strlen(t) AS BIGINT) AS n_bytes
FROM (SELECT arg_max(text, (n_chars, doc_id)) || chr(10) AS t FROM documents GROUP BY source)""",
    "mark_window": """
SELECT s AS window_start, e AS window_end, e AS next_mark FROM (
  SELECT strftime(min(ts), '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(min(ts)) % 1000000 = 0 THEN '' ELSE strftime(min(ts), '.%f') END || '+00:00' AS s,
         strftime(max(ts), '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(max(ts)) % 1000000 = 0 THEN '' ELSE strftime(max(ts), '.%f') END || '+00:00' AS e
  FROM events)""",
    "model_tokens": f"""WITH {_MSGS}
SELECT id, CAST(len(string_split(text, ' ')) AS BIGINT) AS tokens FROM msgs""",
    "curated_batches": f"""{_BATCHED}
SELECT run, batch_no, max(total_batches) AS total_batches,
       batch_no || 'of' || max(total_batches) || '.json' AS file_name,
       CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(tokens) AS BIGINT) AS batch_tokens,
       CAST(sum(dup_count) AS BIGINT) AS n_copies
FROM labeled GROUP BY run, batch_no""",
    "streaming_curate": f"""{_BATCHED}
SELECT '0/' || run AS run, batch_no, max(total_batches) AS total_batches,
       batch_no || 'of' || max(total_batches) || '.json' AS file_name,
       CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(tokens) AS BIGINT) AS batch_tokens,
       CAST(sum(dup_count) AS BIGINT) AS n_copies, CAST(0 AS BIGINT) AS epoch
FROM labeled GROUP BY run, batch_no""",
}


for _name in ("late_rows", "late_rows_with_state"):
    _ORACLES[_name] = _ORACLES["fetch_run"]
for _name in ("target_messages_by_key", "streaming_pull_restarted"):
    _ORACLES[_name] = _ORACLES["target_messages"]


def oracle_sql() -> dict[str, str]:
    return (
        dict(_ORACLES)
        | (_LLM.oracle_sql() if _LLM else {})
        | ({"pipeline": _PIPELINE.ORACLE_SQL} if _PIPELINE and _PIPELINE.ORACLE_SQL else {})
    )
