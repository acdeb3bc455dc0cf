import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidewater.operators.batching import assign_batches
from tidewater.plans.curate import batch_runs, run_batch
from tidewater.plans.fetch import fetch, resolve_window, run_fetch, run_value
from tidewater.sources.store import (
    list_batches,
    list_runs,
    load_prompt,
    read_json_docs,
    read_message_files,
    read_messages,
    read_prompts,
    read_run_by_index,
    read_runs,
    read_watermark,
    render_batches,
    write_messages,
    write_watermark,
)
from tidewater.streaming.incremental import pull_batch, run_incremental, streaming_curate, streaming_pull
from tidewater.records import RAW_MESSAGE_SCHEMA

NOW = dt.datetime(2024, 3, 8, 12, 0, tzinfo=dt.timezone.utc)


def test_prompt_round_trip(spark, tmp_dir):
    texts = {"sum up + rank 50%.txt": "Sum up.\r\nThen rank:\n{rows}", "kürzen.md": "Kürze.\n", "empty file": ""}
    for name, text in texts.items():
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(text.encode())
    # Spark's readers pass over files without a byte
    assert {r.prompt_name: r.text for r in read_prompts(spark, tmp_dir).collect()} == {n: t for n, t in texts.items() if t}
    for name, text in texts.items():
        assert load_prompt(spark, tmp_dir, name) == text
    with open(os.path.join(tmp_dir, "latin"), "wb") as f:
        f.write("Größe".encode("latin-1"))
    assert load_prompt(spark, tmp_dir, "latin", encoding="ISO-8859-1") == "Größe"
    with pytest.raises(FileNotFoundError):
        load_prompt(spark, tmp_dir, "nothing here")


def test_runs_store_and_index(spark, tmp_dir):
    path = os.path.join(tmp_dir, "fetches")
    a = run_value(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc), dt.datetime(2024, 1, 8, tzinfo=dt.timezone.utc))
    b = run_value(dt.datetime(2024, 1, 8, tzinfo=dt.timezone.utc), dt.datetime(2024, 1, 15, tzinfo=dt.timezone.utc))
    rows = [(1, 1, "@c", "t", "x", a), (2, 1, "@c", "t", "y", b)]
    schema = "id long, channel_id long, channel_handle string, time string, text string, run string"
    write_messages(spark.createDataFrame(rows, schema), path)
    # rewriting one run leaves the other untouched
    write_messages(spark.createDataFrame([(3, 1, "@c", "t", "z", b)], schema), path)
    runs = read_runs(spark, path)
    assert sorted((r["run"], r["id"]) for r in runs.collect()) == [(a, 1), (b, 3)]
    assert [tuple(r) for r in list_runs(runs).orderBy("idx").collect()] == [(0, a, f"0: {a}"), (1, b, f"1: {b}")]
    assert [r["id"] for r in read_run_by_index(runs, 1).collect()] == [3]
    with pytest.raises(IndexError):
        read_run_by_index(runs, 2)
    with pytest.raises(IndexError):
        read_run_by_index(runs, -1)
    assert read_runs(spark, os.path.join(tmp_dir, "none")).count() == 0


def test_foreign_json_arrays(spark, tmp_dir):
    msgs = [{"id": i, "channel_id": 5, "channel_handle": "@c", "time": "2024-01-01T00:00:00+00:00", "text": t}
            for i, t in enumerate(["b", "a", "c"])]
    with open(os.path.join(tmp_dir, "window1.json"), "w", encoding="utf-8") as f:
        json.dump(msgs, f, ensure_ascii=False, indent=2)
    with open(os.path.join(tmp_dir, "notes.txt"), "w") as f:
        f.write("ignore me")
    out = sorted((r["run"], r["pos"], r["text"]) for r in read_message_files(spark, tmp_dir).collect())
    assert out == [("window1", 0, "b"), ("window1", 1, "a"), ("window1", 2, "c")]
    assert read_message_files(spark, os.path.join(tmp_dir, "missing")).count() == 0
    docs = read_json_docs(spark, os.path.join(tmp_dir, "window1.json"), "array<struct<id:long,text:string>>")
    assert len(docs.first()["doc"]) == 3


def test_watermark(spark, tmp_dir):
    path = os.path.join(tmp_dir, "mark")
    assert read_watermark(spark, path) is None
    write_watermark(spark, path, NOW)
    assert read_watermark(spark, path) == NOW
    start, end = resolve_window(None, NOW)
    assert (start, end) == (NOW - dt.timedelta(days=7), NOW)


def test_render_and_write_batches(spark, tmp_dir):
    rows = [("r", i, f"m{i}", 1) for i in range(12)]
    df = spark.createDataFrame(rows, "run string, pos long, text string, tokens long")
    batched = assign_batches(df, 100)
    doc = render_batches(batched, ["text"]).first()
    parsed = json.loads(doc["document"])
    assert list(parsed) == [str(i) for i in range(12)]
    assert parsed["11"] == {"text": "m11"} and doc["file_name"] == "1of1.json"

    pre = spark.createDataFrame(
        [("@chan1", f"2023-01-01 10:0{i}", f"msg{i + 1}", i, "2025-05-19_1330~2025-05-26_1323") for i in range(6)],
        "channel string, time string, text string, pos long, run string",
    )
    from tidewater.functions.tokens import CharTokenizer

    # six messages of 16 tokens each, budget 32: three full batches
    batched, oversized = batch_runs(pre, 32, ["channel", "time", "text"], CharTokenizer())
    assert oversized.count() == 0
    names = sorted(r["file_name"] for r in batched.select("file_name").distinct().collect())
    assert names == ["1of3.json", "2of3.json", "3of3.json"]
    out, _ = run_batch(pre, 32, ["channel", "time", "text"], os.path.join(tmp_dir, "batches"), CharTokenizer())
    listed = [tuple(r) for r in list_batches(spark, out).collect()]
    assert listed == sorted(listed) and [n for _, n, _ in listed] == list(range(1, len(listed) + 1))
    assert [f for _, _, f in listed] == [f"{n}of{len(listed)}.json" for _, n, _ in listed]
    stored = spark.read.json(out).collect()
    assert len(stored) == 3 and {r["run"] for r in stored} == {"2025-05-19_1330~2025-05-26_1323"}


def _landed(spark):
    dialogs = spark.createDataFrame(
        [(1, "Channel", "One", "one"), (2, "Channel", "Two", None), (3, "User", "Me", "me"), (4, "Channel", "Four", "four")],
        "id long, kind string, title string, username string",
    )
    base = dt.datetime(2024, 3, 1)
    raw = []
    rid = 0
    for ch in (1, 2, 3, 4):
        for h in range(0, 24 * 9, 6):
            rid += 1
            kind = "Service" if rid % 11 == 0 else "Message"
            raw.append((rid, ch, kind, base + dt.timedelta(hours=h), f"  msg {rid}\n"))
    return dialogs, spark.createDataFrame(raw, RAW_MESSAGE_SCHEMA)


def test_fetch_twice(spark, tmp_dir):
    dialogs, raw = _landed(spark)
    store = os.path.join(tmp_dir, "fetches")
    mark = os.path.join(tmp_dir, "last_fetch")
    name1, end1 = run_fetch(raw, dialogs, ["@one", "@four"], store, mark, NOW)
    assert read_watermark(spark, mark) == end1 == NOW
    runs = read_runs(spark, store)
    rows = sorted(runs.collect(), key=lambda r: r["pos"])
    start = NOW - dt.timedelta(days=7)
    assert rows and all(r["channel_handle"] in ("@one", "@four") for r in rows)
    assert all(dt.datetime.fromisoformat(r["time"]) > start for r in rows)
    assert all(r["text"] == r["text"].strip() for r in rows)
    times = [r["time"] for r in rows]
    assert times == sorted(times)
    later = NOW + dt.timedelta(days=2)
    name2, _ = run_fetch(raw, dialogs, ["@one", "@four"], store, mark, later)
    second = read_run_by_index(read_runs(spark, store), 1).collect()
    assert all(dt.datetime.fromisoformat(r["time"]) > NOW for r in second)
    assert sorted(r["run"] for r in list_runs(read_runs(spark, store)).collect()) == sorted([name1, name2])


def test_streaming_runs(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    sink = os.path.join(tmp_dir, "sink")
    ckpt = os.path.join(tmp_dir, "ckpt")
    handles = spark.createDataFrame([(1, "@one", 0)], "channel_id long, channel_handle string, channel_ord long")
    t = dt.datetime(2024, 1, 1)

    def land(name, rows):
        spark.createDataFrame(rows, RAW_MESSAGE_SCHEMA).coalesce(1).write.parquet(os.path.join(landing, name))

    def step():
        run_incremental(spark, landing + "/*", RAW_MESSAGE_SCHEMA, pull_batch(handles), sink, ckpt)

    land("a", [(1, 1, "Message", t, "x"), (2, 1, "Message", t, "y"), (3, 2, "Message", t, "z")])
    step()
    assert spark.read.parquet(sink).count() == 2
    land("b", [(4, 1, "Message", t, "w")])
    step()
    out = spark.read.parquet(sink)
    assert sorted((str(r["run"]), r["id"]) for r in out.collect()) == [("0", 1), ("0", 2), ("1", 4)]
    step()  # nothing new: no micro-batch, nothing rewritten
    assert spark.read.parquet(sink).count() == 3


@pytest.mark.parametrize("files", [None, 1, 3])
def test_streaming_curate_over_a_file_or_a_folder(spark, tmp_dir, files):
    rows = [(i, f"text {i % 7}", "en" if i % 3 else None, f"src{i % 2}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    if files:
        docs.repartition(files).write.parquet(f"{tmp_dir}/documents.parquet")
    else:  # the table is one file
        docs.coalesce(1).write.parquet(f"{tmp_dir}/made")
        (made,) = [n for n in os.listdir(f"{tmp_dir}/made") if n.endswith(".parquet")]
        os.rename(f"{tmp_dir}/made/{made}", f"{tmp_dir}/documents.parquet")
    got = streaming_curate(spark, tmp_dir, 8000, ["id", "text"]).groupBy("run").agg(F.sum("n_rows"), F.sum("n_copies"), F.max("epoch")).collect()
    # a text is kept once a run, in whichever files its copies are
    assert sorted(tuple(r) for r in got if r.run) == [("0/en", 7, 20, 0)]
    assert [tuple(r)[1:] for r in got if not r.run] == [(7, 10, 0)]


def test_streaming_curate_of_nothing(spark, tmp_dir):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_dir}/documents.parquet")
    assert streaming_curate(spark, tmp_dir, 8000, ["id", "text"]).count() == 0


def test_streaming_pull_of_a_folder_without_files(spark, tmp_dir):
    handles = spark.createDataFrame([(1, "@one", 0)], "channel_id long, channel_handle string, channel_ord long")
    os.mkdir(f"{tmp_dir}/landing")
    assert streaming_pull(spark, f"{tmp_dir}/landing", RAW_MESSAGE_SCHEMA, handles).count() == 0


def test_fetch_strict_unknown(spark):
    dialogs, raw = _landed(spark)
    with pytest.raises(ValueError):
        fetch(raw, dialogs, ["@one", "@nobody"], dt.datetime(2024, 3, 1), strict=True)
    assert fetch(raw, dialogs, ["@one", "@nobody"], dt.datetime(2024, 3, 1)).count() > 0


def test_per_batch_folders(spark, tmp_dir):
    rows = [("r", i, f"m{i}", 10) for i in range(5)]
    df = spark.createDataFrame(rows, "run string, pos long, text string, tokens long")
    from tidewater.sources.store import write_batches

    rendered = render_batches(assign_batches(df, 20), ["text"])
    out = write_batches(rendered, os.path.join(tmp_dir, "b"), per_batch_folders=True)
    names = sorted(os.listdir(os.path.join(out, "run=r")))
    assert names == ["file_name=1of3.json", "file_name=2of3.json", "file_name=3of3.json"]


def test_batches_round_trip(spark, tmp_dir):
    from tidewater.sources.store import read_batches, write_batches

    rows = [("r", i, f"m{i}", 7, i % 3) for i in range(9)]
    df = spark.createDataFrame(rows, "run string, pos long, text string, tokens long, dup_count long")
    batched = assign_batches(df, 20)
    path = write_batches(render_batches(batched, ["text", "dup_count"]), os.path.join(tmp_dir, "bb"))
    back = read_batches(spark, path, "text string, dup_count long").collect()
    got = sorted((r["batch_no"], r["batch_idx"], r["rec"]["text"], r["rec"]["dup_count"]) for r in back)
    exp = sorted((r["batch_no"], r["batch_idx"], r["text"], r["dup_count"]) for r in batched.collect())
    assert got == exp and len(got) == 9


def test_pull_stats(spark):
    from tidewater.operators.paging import pull_stats

    t = dt.datetime(2024, 1, 5)
    rows = [(i, 1, "Message", t, "m") for i in range(1, 8)] + [(8, 1, "Service", t, "s"), (9, 2, "Message", t, "m")]
    df = spark.createDataFrame(rows, RAW_MESSAGE_SCHEMA)
    got = {r["channel_id"]: (r["n_source"], r["n_messages"], r["truncated"]) for r in pull_stats(df, dt.datetime(2024, 1, 1), limit=3, max_pages=2).collect()}
    assert got == {1: (8, 7, True), 2: (1, 1, False)}


def test_prebatch_and_json_sinks(spark, tmp_dir):
    from tidewater.plans.curate import run_prebatch
    from tidewater.sources.store import write_json

    msgs = spark.createDataFrame(
        [("a", "1", "same", 0, "r1"), ("b", "2", "same", 1, "r1"), ("c", "3", "x", 0, "r2")],
        "channel string, time string, text string, pos long, run string",
    )
    out = run_prebatch(msgs, os.path.join(tmp_dir, "pre"))
    back = sorted((r["run"], r["text"], r["dup_count"]) for r in spark.read.parquet(out).collect())
    assert back == [("r1", "same", 2), ("r2", "x", 1)]
    path = write_json(msgs.select("text"), os.path.join(tmp_dir, "js"))
    lines = [json.loads(x) for f in os.listdir(path) if f.endswith(".json") for x in open(os.path.join(path, f), encoding="utf-8")]
    assert sorted(d["text"] for d in lines) == ["same", "same", "x"]


def test_malformed_json_doc_is_null(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "bad.json"), "w") as f:
        f.write("{not json")
    with open(os.path.join(tmp_dir, "good.json"), "w") as f:
        f.write('{"last_fetch": "2024-01-01T00:00:00+00:00"}')
    docs = {r["file_name"]: r["doc"] for r in read_json_docs(spark, tmp_dir, "last_fetch string").collect()}
    assert docs["bad.json"] is None and docs["good.json"]["last_fetch"].startswith("2024-01-01")


def test_default_start(spark):
    from tidewater.functions.scalars import default_start

    row = spark.sql("select timestamp_ntz'2024-03-08 12:00:00' as now").select(default_start(F.col("now"), 7)).first()
    assert row[0] == dt.datetime(2024, 3, 1, 12, 0)


def test_fetch_with_stop_state(spark, tmp_dir):
    from tidewater.plans.fetch import fetch, fetch_state

    dialogs, raw = _landed(spark)
    raw.write.parquet(os.path.join(tmp_dir, "raw"))
    raw = spark.read.parquet(os.path.join(tmp_dir, "raw"))
    targets = ["@one", "@two", "@four"]
    t1, t2, t3 = NOW, NOW + dt.timedelta(days=1), NOW + dt.timedelta(days=2, hours=5)
    plain, stated = os.path.join(tmp_dir, "plain"), os.path.join(tmp_dir, "stated")
    for now in (t1, t2, t3):
        run_fetch(raw, dialogs, targets, plain, os.path.join(tmp_dir, "m1"), now)
        run_fetch(raw, dialogs, targets, stated, os.path.join(tmp_dir, "m2"), now,
                  state_path=os.path.join(tmp_dir, "state"))
    a = sorted(tuple(r) for r in read_runs(spark, plain).collect())
    b = sorted(tuple(r) for r in read_runs(spark, stated).collect())
    assert a == b and len({r[-1] for r in a}) == 3
    # the stored state as of t3 equals the stops computed from the whole history
    from tidewater.sources.store import read_stops

    stored, as_of = read_stops(spark, os.path.join(tmp_dir, "state"))
    assert as_of == t3
    full = fetch_state(raw, dialogs, targets, t3.replace(tzinfo=None))
    assert sorted(tuple(r) for r in stored.collect()) == sorted(tuple(r) for r in full.collect())
    # with a complete state the history scan is bounded by a pushed id filter
    from tidewater.plans.fetch import _id_floor, requested_channels

    floor = _id_floor(requested_channels(dialogs, targets), stored)
    assert floor == min(r["stop"] for r in stored.collect())
    plan = raw.filter(F.col("id") > floor)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id," in plan


def test_cleanup_scratch(spark):
    from tidewater.session import cleanup_scratch, path_exists, stage_table

    staged = stage_table(spark.range(10), "probe")
    assert staged.count() == 10
    path = staged.inputFiles()[0].rsplit("/", 1)[0]
    assert cleanup_scratch(spark) >= 1
    assert not path_exists(spark, path)


def test_fetch_without_broadcast_fallback(spark, monkeypatch):
    import tidewater.operators.filters as filters_mod
    import tidewater.plans.fetch as fetch_mod

    dialogs, raw = _landed(spark)
    targets = spark.createDataFrame([("@one", 0), ("@four", 1)], "handle string, channel_ord long")
    start = dt.datetime(2024, 3, 2)
    with_bc = sorted(tuple(r) for r in fetch(raw, dialogs, targets, start).collect())
    monkeypatch.setattr(filters_mod, "MAX_BROADCAST_TARGETS", 0)
    side, bounded = fetch_mod._requested(dialogs, targets)
    assert bounded is False
    without = sorted(tuple(r) for r in fetch(raw, dialogs, targets, start).collect())
    assert with_bc == without and len(with_bc) > 0


def test_shared_dir_requires_setting_on_cluster():
    from tidewater.session import shared_dir

    class _Ctx:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Session:
        sparkContext = _Ctx()
        conf = _Conf()

    with pytest.raises(RuntimeError):
        shared_dir(_Session())


def test_empty_runs_are_listed_and_replaced(spark, tmp_dir):
    from tidewater.sources.store import list_store_runs, read_store_run

    store = os.path.join(tmp_dir, "runs")
    message = "id long, channel_id long, channel_handle string, time string, text string, pos long, run string"
    some = [(1, 7, "@a", "2024-01-01T00:00:00+00:00", "x", 0, "a~b:c")]
    write_messages(spark.createDataFrame([], message), store, run="a~b:c")
    assert [tuple(r) for r in list_store_runs(spark, store).collect()] == [(0, "a~b:c", "0: a~b:c")]
    assert read_messages(spark, store).count() == 0 and read_store_run(spark, store, 0).count() == 0
    write_messages(spark.createDataFrame(some, message), store, run="a~b:c")
    write_messages(spark.createDataFrame([(*some[0][:-1], "z")], message), store, run="z")
    assert read_store_run(spark, store, 0).count() == 1
    write_messages(spark.createDataFrame([], message), store, run="a~b:c")
    assert [r["run"] for r in read_messages(spark, store).collect()] == ["z"]
    assert list_store_runs(spark, store).count() == 2 and list_store_runs(spark, store, hide=["z"]).count() == 1
    with pytest.raises(IndexError):
        read_store_run(spark, store, 2)


def test_unfinished_mark_is_passed_over(spark, tmp_dir):
    path = os.path.join(tmp_dir, "mark")
    write_watermark(spark, path, NOW)
    os.makedirs(os.path.join(path, "mark-000000000009", "_temporary"))  # a write that did not end
    assert read_watermark(spark, path) == NOW
    later = NOW + dt.timedelta(days=1)
    write_watermark(spark, path, later)
    assert read_watermark(spark, path) == later
    assert len([n for n in os.listdir(path) if n.startswith("mark-")]) == 1


def test_late_rows_give_the_same_run_with_and_without_state(spark, tmp_dir):
    day = lambda d: dt.datetime(2024, 1, d)
    dialogs = spark.createDataFrame([(1, "Channel", "One", "one")], "id long, kind string, title string, username string")
    kind = "id long, channel_id long, kind string, date timestamp_ntz, message string"
    first = [(i, 1, "Message", day(i), f"m{i}") for i in (1, 2, 3)]
    late = [(4, 1, "Message", day(5), "late"), (5, 1, "Message", day(12), "new")]
    runs = []
    for state in (None, os.path.join(tmp_dir, "state")):
        base = os.path.join(tmp_dir, str(len(runs)))
        for rows, now in ((first, day(11)), (first + late, day(20))):
            run, _ = run_fetch(
                spark.createDataFrame(rows, kind), dialogs, ["@one"], f"{base}/runs", f"{base}/mark",
                now.replace(tzinfo=dt.timezone.utc), lookback_days=30, state_path=state,
            )
        runs.append([r["id"] for r in read_messages(spark, f"{base}/runs", run=run).collect()])
    assert runs == [[5], [5]]


def test_scratch_belongs_to_its_scope(spark):
    from tidewater.session import path_exists, scratch_path, scratch_scope, stage_table

    outside = scratch_path(spark, "mine")
    spark.range(3).write.parquet(outside)
    with scratch_scope(spark):
        stage_table(spark.range(2), "inner")
        inside = scratch_path(spark, "kept")
        spark.range(1).write.parquet(inside)
    assert path_exists(spark, outside) and not path_exists(spark, inside)


def test_many_tokenizers_do_not_share_a_counter(spark):
    import gc

    from tidewater.functions.tokens import PandasTokenizer

    for k in range(6):
        tokenizer = PandasTokenizer(lambda k=k: lambda text: len(text) + k)
        assert spark.createDataFrame([("abc",)], "t string").select(tokenizer.count("t")).first()[0] == 3 + k
        del tokenizer
        gc.collect()


def test_json_that_is_none_reads_as_null(spark):
    from tidewater.functions.scalars import message_from_json

    rows = spark.createDataFrame([('{"a": 1}',), ("no json",), (None,)], "j string").select(message_from_json("j", "a long").alias("m")).collect()
    assert [None if r.m is None else r.m.a for r in rows] == [1, None, None]
