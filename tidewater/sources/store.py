"""Run store: messages, prebatched rows and batches, partitioned by ``run``.

A run is one pull window.  Its name ``{start}~{end}`` is a partition
*value* (Spark escapes the ``:`` of ISO times in folder names and restores
it on read); it is never put into a file name, which Hadoop paths cannot
hold.  Writes use dynamic partition overwrite, so rewriting one run leaves
the others untouched.  A write that names its run also stores a run without
rows: whatever the run held before goes, it is listed, and it reads as zero
rows.

Foreign JSON-array files (one indented array per run, as a single-node
tool writes them) can be ingested with :func:`read_message_files`.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.scalars import batch_file_name, listing_line, run_stem
from tidewater.records import MESSAGE_SCHEMA, WATERMARK_FIELD
from tidewater.session import delete_path, list_names, path_exists
from tidewater.sources.json_arrays import parse_elements, read_array_elements

RUN = "run"


# ------------------------------------------------------------------ writes
def _write(df: DataFrame, path: str, fmt: str, partition: str | None = RUN, name: str | None = None) -> str:
    if partition is not None:
        # rows of a partition come together (large ones in several tasks), so
        # there are few files per run and not one per task and run
        df = df.hint("rebalance", partition)
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write if name is not None else df.write
    writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if partition is not None:
        writer = writer.partitionBy(partition)
    writer.format(fmt).save(path)
    if name is not None and not seen.get.get("n"):
        # dynamic overwrite leaves a partition alone that gets no rows
        empty = df.sparkSession.createDataFrame([], T.StructType([f for f in df.schema.fields if f.name != partition]))
        empty.write.mode("overwrite").option("partitionOverwriteMode", "static").format(fmt).save(f"{path}/{partition}={_escaped(df.sparkSession, name)}")
    return path


def _escaped(spark: SparkSession, value: str) -> str:
    """A partition value as Spark writes it in a folder's name."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def _unescaped(spark: SparkSession, folder: str) -> str:
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(folder)


def _decoded(path: Column | str) -> Column:
    """A name from ``_metadata`` (an encoded URI) as it is in the file system."""
    return F.url_decode(F.replace(F.col(path) if isinstance(path, str) else path, F.lit("+"), F.lit("%2B")))


def write_messages(df: DataFrame, path: str, fmt: str = "parquet", run: str | None = None) -> str:
    """Store one or more runs of messages (rewrites only the runs present).

    ``run`` names the one run that ``df`` holds; it is stored even without rows."""
    return _write(df, path, fmt, name=run)


def write_prebatch(df: DataFrame, path: str, fmt: str = "parquet", run: str | None = None) -> str:
    """Store deduplicated rows under the same run value as their input."""
    return _write(df, path, fmt, name=run)


def write_json(df: DataFrame, path: str, partition: str | None = None) -> str:
    """Generic JSON Lines sink (UTF-8, non-ASCII kept as is)."""
    return _write(df, path, "json", partition)


def render_batches(
    batched: DataFrame,
    fields: Sequence[str],
    run: str = RUN,
) -> DataFrame:
    """One row per batch: ``run, batch_no, total_batches, file_name, document``.

    ``document`` is the batch as a JSON object keyed ``"0"``, ``"1"``, … by
    position in the batch.  A batch holds at most ``cap`` tokens, so what is
    collected per batch is bounded by the budget as long as every row counts for
    a token at least; :func:`store_batches` has no such limit.
    """
    rec = F.struct(*[F.col(f) for f in fields])
    entries = F.array_sort(F.collect_list(F.struct(F.col("batch_idx"), rec.alias("rec"))))
    keyed = F.transform(entries, lambda e: F.struct(e["batch_idx"].cast("string"), e["rec"]))
    return (
        batched.groupBy(run, "batch_no", "total_batches")
        .agg(F.to_json(F.map_from_entries(keyed)).alias("document"))
        .withColumn("file_name", batch_file_name("batch_no", "total_batches"))
        .select(run, "batch_no", "total_batches", "file_name", "document")
    )


def write_batches(rendered: DataFrame, path: str, run: str = RUN, per_batch_folders: bool = False) -> str:
    """Store rendered batches; each run's batches live under its own folder.

    ``per_batch_folders=True`` adds one sub-folder per batch
    (``run=…/file_name=1of3.json/``), the closest Hadoop layout to one file
    per batch; use it only when a run has few batches, since it creates
    one small folder per batch.
    """
    if not per_batch_folders:
        return _write(rendered, path, "json", run)
    writer = rendered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(run, "file_name").json(path)
    return path


#: Rows of a batch on one stored line; neighbouring batches that one task writes.
PIECE_ROWS, BATCHES_PER_GROUP = 10_000, 64
_NO_RUN = "__HIVE_DEFAULT_PARTITION__"  # the folder of a NULL partition value


def batch_lines(
    batched: DataFrame, fields: Sequence[str], run: str = RUN, piece_rows: int | None = PIECE_ROWS
) -> DataFrame:
    """Batched rows as the text that they add to their batch's document, in order: ``run, file_name, value``.

    The first row of a piece opens it, the last one closes it; every other row
    follows a comma.  A batch is spread over pieces of ``piece_rows`` rows, each a JSON line
    ``{batch_no, total_batches, file_name, piece, document}`` with the part of the document
    that it holds; ``piece_rows=None`` writes the bare document whole.  Rows only pass by:
    they are sorted inside a task and each looks at the next one, so a batch may have any
    number of rows.
    """
    record = F.to_json(F.struct(*[F.col(f) for f in fields]))
    # names that hide no field: they are made after the record
    rows = batched.select(
        F.coalesce(F.col(run).cast("string"), F.lit(_NO_RUN)).alias("__run"),
        F.coalesce(batch_file_name("batch_no", "total_batches"), F.lit("")).alias("__file"),
        F.col("batch_no").alias("__no"), F.col("total_batches").alias("__of"), F.col("batch_idx").alias("__idx"), record.alias("__rec"),
    )
    if piece_rows is None:
        rows = rows.withColumn("__piece", F.lit(0).cast("long"))
        keys, group = ["__run", "__file"], ["__run", "__file"]
    else:
        rows = rows.withColumn("__piece", F.floor(F.col("__idx") / piece_rows)).withColumn("__group", F.floor(F.col("__no") / BATCHES_PER_GROUP))
        keys, group = ["__run", "__group", "__no", "__piece"], ["__run", "__group"]
    near = Window.partitionBy(*keys).orderBy("__idx")
    ordered = rows.repartition(*group).sortWithinPartitions(*keys, "__idx")
    opens, closes = F.lag("__idx").over(near).isNull(), F.lead("__idx").over(near).isNull()
    entry = F.concat(F.lit('"'), F.col("__idx").cast("string"), F.lit('":'), F.col("__rec"))
    if piece_rows is None:
        head, tail = F.lit("{"), F.lit("}")
    else:
        line = F.to_json(F.struct(F.col("__no").alias("batch_no"), F.col("__of").alias("total_batches"), F.col("__file").alias("file_name"), F.col("__piece").alias("piece")))
        head, tail = F.concat(F.rtrim(line, F.lit("}")), F.lit(',"document":{')), F.lit("}}\n")
    value = F.concat(F.when(opens, head).otherwise(F.lit(",")), entry, F.when(closes, tail).otherwise(F.lit("")))
    return ordered.select(F.col("__run").alias(run), F.col("__file").alias("file_name"), value.alias("value"))


def store_batches(
    batched: DataFrame, fields: Sequence[str], path: str, run: str = RUN, per_batch_folders: bool = False, piece_rows: int = PIECE_ROWS
) -> str:
    """Store the batches of labelled rows as their rows pass (no document is held in memory).

    By default each run's folder holds JSON lines of at most ``piece_rows`` rows, which
    :func:`read_batches` and :func:`list_batches` read.  ``per_batch_folders=True``
    writes each document whole into a folder of its own, ``run=…/file_name=1of3.json/``."""
    lines = batch_lines(batched, fields, run, None if per_batch_folders else piece_rows)
    folders = [run, "file_name"] if per_batch_folders else [run]
    # JSON takes a space between any two tokens, so it can end every row's text
    writer = lines.select(*folders, "value").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("lineSep", " ")
    writer.partitionBy(*folders).text(path)
    return path


def read_batches(spark: SparkSession, path: str, record: T.StructType | str, run: str = RUN) -> DataFrame:
    """Stored batch documents back to rows: ``run, file_name, batch_idx, rec``.

    The document is an object keyed by position, so it is parsed as
    ``MAP<STRING, STRUCT>`` (schema inference would make one column per key).
    """
    rec = T._parse_datatype_string(record) if isinstance(record, str) else record
    docs = spark.read.schema(
        T.StructType(
            [
                T.StructField("batch_no", T.LongType()),
                T.StructField("total_batches", T.LongType()),
                T.StructField("file_name", T.StringType()),
                T.StructField("document", T.StringType()),
                T.StructField(run, T.StringType()),
            ]
        )
    ).json(path)
    parsed = docs.select(
        run, "batch_no", "file_name",
        F.explode(F.from_json("document", T.MapType(T.StringType(), rec))).alias("__k", "rec"),
    )
    return parsed.select(run, "batch_no", "file_name", F.col("__k").cast("long").alias("batch_idx"), "rec")


def list_batches(spark: SparkSession, path: str, run: str = RUN) -> DataFrame:
    """``(run, batch_no, file_name)`` of the stored batches in order; the documents are not read into it."""
    schema = T.StructType(
        [T.StructField("batch_no", T.LongType()), T.StructField("file_name", T.StringType()), T.StructField("piece", T.LongType()), T.StructField(run, T.StringType())]
    )
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema).select(run, "batch_no", "file_name")
    lines = spark.read.schema(schema).json(path).where("coalesce(piece, 0) = 0")
    return lines.select(run, "batch_no", "file_name").orderBy(run, "batch_no")


# ------------------------------------------------------------------- reads
def read_runs(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """All stored runs (an absent store reads as an empty frame)."""
    if not path_exists(spark, path):
        base = schema or MESSAGE_SCHEMA
        return spark.createDataFrame([], T.StructType([*base.fields, T.StructField(RUN, T.StringType())]))
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(RUN, T.StringType())]))
    return reader.load(path)


def read_messages(spark: SparkSession, path: str, run: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Messages of every stored run, or of one run (partition-pruned)."""
    df = read_runs(spark, path, fmt)
    return df if run is None else df.filter(F.col(RUN) == F.lit(run))


def list_store_runs(spark: SparkSession, path: str, hide: Sequence[str] = (), run: str = RUN) -> DataFrame:
    """``(idx, run, line)`` of a store's runs in name order, from its folders: no file is read."""
    names = sorted(_run_names(spark, path, run) - set(hide), key=lambda n: n.encode())
    rows = [(i, n, f"{i}: {n}") for i, n in enumerate(names)]
    return spark.createDataFrame(rows, f"idx long, {run} string, line string")


def _run_names(spark: SparkSession, path: str, run: str) -> set[str]:
    prefix = f"{run}="
    return {_unescaped(spark, n[len(prefix):]) for n in list_names(spark, path) if n.startswith(prefix)}


def read_store_run(spark: SparkSession, path: str, idx: int, fmt: str = "parquet", run: str = RUN) -> DataFrame:
    """Rows of the ``idx``-th run of a store in name order (0 = oldest); IndexError if none."""
    names = sorted(_run_names(spark, path, run), key=lambda n: n.encode())
    if not 0 <= idx < len(names):
        raise IndexError("Invalid run index")
    return read_runs(spark, path, fmt).filter(F.col(run) == F.lit(names[idx]))


def list_runs(runs: DataFrame, run: str = RUN, hide: Sequence[str] = ()) -> DataFrame:
    """``(idx, run, line)`` in name order, 0-based, with the printed form
    ``"{idx}: {run}"``; the few run names are ranked after a distinct, so
    the global window sees one row per run."""
    names = runs.select(run).distinct()
    if hide:
        names = names.filter(~F.col(run).isin(list(hide)))
    w = Window.orderBy(F.col(run).asc())
    ranked = names.withColumn("idx", (F.row_number().over(w) - 1).cast("long"))
    return ranked.select("idx", run, listing_line("idx", run).alias("line"))


def read_run_by_index(runs: DataFrame, idx: int, run: str = RUN) -> DataFrame:
    """Rows of the ``idx``-th run in name order (0 = oldest); IndexError if none.

    The lookup touches only the distinct run names; the returned frame is
    a filter on the partition column, so only that run's files are read.
    """
    if idx < 0:
        raise IndexError("Invalid run index")
    hit = list_runs(runs, run).filter(F.col("idx") == idx).select(run).take(1)
    if not hit:
        raise IndexError("Invalid run index")
    return runs.filter(F.col(run) == F.lit(hit[0][run]))


def read_message_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType = MESSAGE_SCHEMA,
    pattern: str = "*.json",
    folders: bool = False,
) -> DataFrame:
    """Foreign JSON-array files → message rows with ``run`` (file stem) and ``pos``.

    Each file is one JSON array in any layout.  It is read by byte ranges that many
    tasks share (:mod:`tidewater.sources.json_arrays`); ``pos`` is the place in the
    whole array.  Elements that are no objects are passed over.  An
    unreadable file yields no rows; a missing folder yields an empty frame.

    ``folders``: an array is a folder of files, each with the elements between two places
    of it, in the order of their names; ``run`` is the folder's name.
    """
    out_schema = T.StructType(
        [*schema.fields, T.StructField(RUN, T.StringType()), T.StructField("pos", T.LongType())]
    )
    if not path_exists(spark, path):
        return spark.createDataFrame([], out_schema)
    rows = parse_elements(read_array_elements(spark, path, pattern, folders), schema)
    name = _decoded(F.element_at(F.split("file", "/"), -2 if folders else -1))
    return rows.select(*[f.name for f in schema.fields], (name if folders else run_stem(name)).alias(RUN), "pos")


def read_json_docs(spark: SparkSession, path: str, schema: T.DataType) -> DataFrame:
    """Whole JSON documents → ``(file_name, doc)``; malformed → NULL doc."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField("file_name", T.StringType()), T.StructField("doc", schema)]))
    raw = spark.read.text(path, wholetext=True).select(
        _decoded("_metadata.file_name").alias("file_name"), F.col("value")
    )
    # from_json fills a malformed document with NULL fields; a document that
    # is not JSON at all reads as a NULL doc, like a failed load
    valid = F.try_parse_json("value").isNotNull()
    return raw.select("file_name", F.when(valid, F.from_json("value", schema)).alias("doc"))


def read_prompts(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Prompt files as ``(prompt_name, text)``; line ends are kept as they are.
    A file without a byte has no row; :func:`load_prompt` reads it as empty."""
    schema = T.StructType([T.StructField("prompt_name", T.StringType()), T.StructField("text", T.StringType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return _text_files(spark, path).select(
        _decoded("_metadata.file_name").alias("prompt_name"), F.decode("content", encoding).alias("text")
    )


def _text_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)


def load_prompt(spark: SparkSession, path: str, name: str, encoding: str = "UTF-8") -> str:
    """One prompt's text; FileNotFoundError when there is no such file."""
    full = f"{path.rstrip('/')}/{name}"
    if not path_exists(spark, full):
        raise FileNotFoundError(f"Prompt file not found: {full}")
    # a file's name may hold what a path reads as a pattern, so it is picked among the folder's names
    found = read_prompts(spark, path, encoding).filter(F.col("prompt_name") == F.lit(name)).select("text").take(1)
    return found[0]["text"] if found else ""


# --------------------------------------------------------------- watermark
def write_watermark(spark: SparkSession, path: str, last_fetch: _dt.datetime) -> str:
    """Store the mark as one ISO string row (written after the run's data).

    Each mark is a new folder; older ones go once it is complete, so there is
    a readable mark at every moment."""
    if last_fetch.tzinfo is None:
        last_fetch = last_fetch.replace(tzinfo=_dt.timezone.utc)
    old = _versions(spark, path)
    df = spark.createDataFrame([(last_fetch.isoformat(),)], f"{WATERMARK_FIELD} string")
    df.coalesce(1).write.mode("overwrite").json(f"{path}/{_VERSION}{max([0, *old]) + 1:012d}")
    for v in old:
        delete_path(spark, f"{path}/{_VERSION}{v:012d}")
    return path


_VERSION = "mark-"


def _versions(spark: SparkSession, path: str, prefix: str = _VERSION, complete: bool = False) -> list[int]:
    """Numbers of the stored versions, newest first; ``complete``: only those whose write has ended."""
    tails = [n[len(prefix):] for n in list_names(spark, path) if n.startswith(prefix)]
    found = sorted((int(t) for t in tails if t.isdigit()), reverse=True)
    return [v for v in found if not complete or path_exists(spark, f"{path}/{prefix}{v:012d}/_SUCCESS")]


def _write_version(df: DataFrame, path: str, prefix: str) -> str:
    """Store a frame as the next version; older ones go once it is complete, so a
    complete version can be read at every moment, whenever a write breaks off."""
    spark = df.sparkSession
    old = _versions(spark, path, prefix)
    df.write.mode("overwrite").parquet(f"{path}/{prefix}{max([0, *old]) + 1:012d}")
    for v in old:
        delete_path(spark, f"{path}/{prefix}{v:012d}")
    return path


def _read_version(spark: SparkSession, path: str, prefix: str) -> DataFrame | None:
    """The newest complete version, None if there is none."""
    found = _versions(spark, path, prefix, complete=True)
    return spark.read.parquet(f"{path}/{prefix}{found[0]:012d}") if found else None


def read_watermark(spark: SparkSession, path: str) -> _dt.datetime | None:
    """Stored mark, or None when absent, empty or unparsable (an unfinished newer one is passed over)."""
    if not path_exists(spark, path):
        return None
    folders = [f"{path}/{_VERSION}{v:012d}" for v in _versions(spark, path)] or [path]
    return next((m for m in (_read_mark(spark, f) for f in folders) if m is not None), None)


def _read_mark(spark: SparkSession, path: str) -> _dt.datetime | None:
    try:
        rows = spark.read.schema(f"{WATERMARK_FIELD} string").json(path).take(1)
    except Exception:  # unreadable store behaves like no mark
        return None
    if not rows or rows[0][WATERMARK_FIELD] is None:
        return None
    try:
        return _dt.datetime.fromisoformat(rows[0][WATERMARK_FIELD])
    except ValueError:
        return None


_STOPS, _WINDOW = "stops-", "window-"


def _utc_iso(value: _dt.datetime) -> str:
    return (value if value.tzinfo is not None else value.replace(tzinfo=_dt.timezone.utc)).isoformat()


def write_stops(spark: SparkSession, path: str, stops: DataFrame, as_of: _dt.datetime) -> str:
    """Store per-channel stop ids with the mark they belong to, as a new complete version."""
    return _write_version(stops.select("channel_id", "stop").withColumn("as_of", F.lit(_utc_iso(as_of))), path, _STOPS)


def read_stops(spark: SparkSession, path: str) -> tuple[DataFrame, _dt.datetime] | None:
    """``(stops, as_of)`` of the newest complete version, or None when no state is stored."""
    df = _read_version(spark, path, _STOPS)
    row = df.select("as_of").take(1) if df is not None else None
    if not row:
        return None
    return df.select("channel_id", "stop"), _dt.datetime.fromisoformat(row[0]["as_of"])


def write_window(spark: SparkSession, path: str, mark: _dt.datetime | None, start: _dt.datetime, end: _dt.datetime) -> str:
    """Record the window that a poll is about to store, with the mark that it starts from."""
    row = (None if mark is None else _utc_iso(mark), _utc_iso(start), _utc_iso(end))
    return _write_version(spark.createDataFrame([row], "mark string, start string, end string").coalesce(1), path, _WINDOW)


def read_window(spark: SparkSession, path: str, mark: _dt.datetime | None) -> tuple[_dt.datetime, _dt.datetime] | None:
    """The recorded window of a poll that did not end: one that starts from the mark as it still is."""
    df = _read_version(spark, path, _WINDOW)
    row = df.take(1) if df is not None else None
    if not row or row[0]["mark"] != (None if mark is None else _utc_iso(mark)):
        return None
    return _dt.datetime.fromisoformat(row[0]["start"]), _dt.datetime.fromisoformat(row[0]["end"])


__all__ = [
    "RUN",
    "write_stops",
    "read_stops",
    "write_window",
    "read_window",
    "batch_lines",
    "store_batches",
    "write_messages",
    "write_prebatch",
    "write_json",
    "render_batches",
    "write_batches",
    "list_batches",
    "read_batches",
    "read_runs",
    "read_messages",
    "list_runs",
    "list_store_runs",
    "read_store_run",
    "read_run_by_index",
    "read_message_files",
    "read_json_docs",
    "read_prompts",
    "load_prompt",
    "write_watermark",
    "read_watermark",
]
