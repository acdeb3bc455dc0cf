"""Mechanisms for inputs that one task or one window can't hold, and for polls that break off."""

import datetime as dt
import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators.batching import assign_batches
from tidewater.operators.dedup import prebatch
from tidewater.operators.joins import hot_keys, join_by_key, repeated, spread
from tidewater.operators.ordering import dense_position
from tidewater.plans import fetch as fetch_mod
from tidewater.plans.curate import run_batch
from tidewater.plans.fetch import run_fetch
from tidewater.records import RAW_MESSAGE_SCHEMA
from tidewater.sources import store
from tidewater.sources.json_arrays import write_arrays
from tidewater.sources.store import batch_lines, list_batches, list_store_runs, read_batches, read_message_files, read_messages, read_stops, read_watermark, store_batches, write_stops
from tidewater.streaming.incremental import pull_batch, run_incremental

UTC = dt.timezone.utc


# -- batch documents written row by row --------------------------------------
def test_stored_batches_hold_every_row_in_order(spark, tmp_dir):
    rows = [("r" if i % 3 else None, i, f'm"{i}\n\u00e9', i % 4) for i in range(90)]
    df = assign_batches(spark.createDataFrame(rows, "run string, pos long, text string, tokens long"), 9)
    want = sorted((r.run or "", r.batch_no, r.batch_idx, r.text, r.pos) for r in df.collect())
    path = store_batches(df, ["text", "pos"], f"{tmp_dir}/lines", piece_rows=4)
    back = read_batches(spark, path, "text string, pos long")
    assert sorted((r.run or "", r.batch_no, r.batch_idx, r.rec.text, r.rec.pos) for r in back.collect()) == want
    batches = {(r.run, r.batch_no, f"{r.batch_no}of{r.total_batches}.json") for r in df.collect()}
    listed = [tuple(r) for r in list_batches(spark, path).collect()]
    assert set(listed) == batches and len(listed) == len(batches)
    store_batches(df, ["text"], f"{tmp_dir}/files", per_batch_folders=True)
    files = glob.glob(f"{tmp_dir}/files/run=*/file_name=*/*.txt")
    assert len(files) == len(batches)
    for name in files:
        with open(name, encoding="utf-8") as f:
            document = json.load(f)
        assert list(document) == [str(i) for i in range(len(document))]
    # a second write of one run leaves the other alone
    store_batches(df.where("run IS NULL"), ["text", "pos"], path, piece_rows=1000)
    assert read_batches(spark, path, "text string").count() == 90


def test_a_batch_of_a_million_rows_is_stored_without_collecting_it(spark, tmp_dir):
    n = 1_000_000
    rows = spark.range(n).select(F.lit("z").alias("run"), F.col("id").alias("pos"), F.lit(0).alias("tokens"), F.concat(F.lit("t"), "id").alias("text"))
    batched = assign_batches(rows, 10)
    plan = batch_lines(batched, ["text"])._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Aggregate" not in plan
    back = read_batches(spark, store_batches(batched, ["text"], f"{tmp_dir}/b"), "text string")
    assert back.agg(F.count("*"), F.countDistinct("batch_no"), F.sum(F.when(F.expr("rec.text = concat('t', batch_idx)"), 1))).first()[:] == (n, 1, n)


def test_no_batches_are_stored_as_none(spark, tmp_dir):
    none = spark.createDataFrame([], "run string, pos long, text string")
    from tidewater.functions.tokens import CharTokenizer

    path, aside = run_batch(none, 10, ["text"], f"{tmp_dir}/none", CharTokenizer())
    assert aside.count() == 0 and list_batches(spark, path).count() == 0


# -- positions that restart in every run --------------------------------------
def test_positions_restart_in_runs_that_cross_partitions(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, "a", "hot", "hot", "hot"]), rng.randrange(50), i) for i in range(600)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the hot run spans several partitions
    try:
        out = dense_position(spark.createDataFrame(rows, "run string, k long, id long"), ["k", "id"], partition="run", start=5)
        got = {(r.run, r.id): r.pos for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = {}
    for run in (None, "a", "hot"):
        for p, (_, _, i) in enumerate(sorted((r for r in rows if r[0] == run), key=lambda r: r[1:])):
            want[run, i] = p + 5
    assert got == want
    assert all("__part" in line for line in plan.splitlines() if "Join" in line)  # no join on the run alone


# -- targets that are too many to broadcast ------------------------------------
def test_a_hot_channel_is_spread(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cold = spark.range(60_000).select(F.col("id"), (F.col("id") % 4_000 + 10).alias("channel_id"))
    rows = cold.union(spark.range(60_000, 100_000).select("id", F.lit(7).cast("long")))  # two fifths of all rows
    side = spark.range(10_000).select(F.col("id").alias("channel_id"), F.concat(F.lit("@"), "id").alias("handle"))
    hot = hot_keys(rows, "channel_id")
    assert [r.channel_id for r in hot.collect()] == [7]
    spreaded = spread(rows, hot, "channel_id", 8 * parts, F.col("id"))
    # Spark's own partition of each row by the keys of the join
    loads = [r["count"] for r in spreaded.groupBy(F.expr(f"pmod(hash(channel_id, __salt), {parts})")).count().collect()]
    plain = [r["count"] for r in rows.groupBy(F.expr(f"pmod(hash(channel_id), {parts})")).count().collect()]
    assert max(loads) < 2 * sorted(loads)[len(loads) // 2] and max(plain) > 3 * sorted(plain)[len(plain) // 2]
    assert repeated(side, hot, "channel_id", 9).count() == 10_000 + 8
    for how in ("inner", "left", "left_semi", "left_anti"):
        ours, theirs = join_by_key(rows, side, "channel_id", "id", how), rows.join(side, "channel_id", how)
        assert ours.columns == theirs.columns and ours.exceptAll(theirs).isEmpty() and ours.count() == theirs.count()
    plan = join_by_key(rows, side.hint("merge"), "channel_id", "id")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(channel_id#" in plan and "__salt" in plan


# -- polls that break off ------------------------------------------------------
def _landed(spark):
    dialogs = spark.createDataFrame([(1, "Channel", "One", "one")], "id long, kind string, title string, username string")
    rows = [(i, 1, "Message", dt.datetime(2024, 1, 1) + dt.timedelta(days=i), f"m{i}") for i in range(1, 21)]
    return dialogs, spark.createDataFrame(rows, RAW_MESSAGE_SCHEMA)


def _poll(spark, tmp_dir, day, state=None):
    dialogs, raw = _landed(spark)
    now = dt.datetime(2024, 1, day, tzinfo=UTC)
    return run_fetch(raw, dialogs, ["@one"], f"{tmp_dir}/runs", f"{tmp_dir}/mark", now, lookback_days=30, state_path=state)


@pytest.mark.parametrize("breaks", ["write_messages", "write_stops", "write_watermark", "delete_path"])
def test_a_retry_with_a_later_now_leaves_one_run(spark, tmp_dir, monkeypatch, breaks):
    state = f"{tmp_dir}/state"
    _poll(spark, tmp_dir, 5, state)

    def broken(*a, **k):
        if breaks == "write_messages":  # the run's data is there, but the call never returns
            real(*a, **k)
        raise RuntimeError("lost")

    real = getattr(fetch_mod, breaks)
    with monkeypatch.context() as m:
        m.setattr(fetch_mod, breaks, broken)
        with pytest.raises(RuntimeError, match="lost"):
            _poll(spark, tmp_dir, 9, state)
    name, end = _poll(spark, tmp_dir, 12, state)
    if breaks == "delete_path":  # the mark was there: the window has ended, the next one starts at it
        assert end == dt.datetime(2024, 1, 12, tzinfo=UTC)
    else:
        assert end == dt.datetime(2024, 1, 9, tzinfo=UTC)
        _poll(spark, tmp_dir, 12, state)
    runs = [r.run for r in list_store_runs(spark, f"{tmp_dir}/runs").collect()]
    assert len(runs) == 3 and all(a.split("~")[1] == b.split("~")[0] for a, b in zip(runs, runs[1:], strict=False))
    ids = sorted(r.id for r in read_messages(spark, f"{tmp_dir}/runs").collect())
    assert ids == list(range(1, 12))
    assert read_watermark(spark, f"{tmp_dir}/mark") == dt.datetime(2024, 1, 12, tzinfo=UTC)


def test_a_first_poll_that_broke_off_keeps_its_window(spark, tmp_dir, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(fetch_mod, "write_watermark", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            _poll(spark, tmp_dir, 5)
    assert _poll(spark, tmp_dir, 7)[1] == dt.datetime(2024, 1, 5, tzinfo=UTC)
    assert list_store_runs(spark, f"{tmp_dir}/runs").count() == 1


def test_an_unfinished_stop_state_is_passed_over(spark, tmp_dir, monkeypatch):
    path, noon = f"{tmp_dir}/stops", dt.datetime(2024, 1, 5, 12, tzinfo=UTC)
    assert read_stops(spark, path) is None
    stops = spark.createDataFrame([(1, 10), (2, None)], "channel_id long, stop long")
    write_stops(spark, path, stops, noon)
    os.makedirs(f"{path}/stops-000000000002/_temporary")  # a write that did not end
    kept, as_of = read_stops(spark, path)
    assert as_of == noon and {tuple(r) for r in kept.collect()} == {(1, 10), (2, None)}
    # the old version goes only after the new one is complete
    with monkeypatch.context() as m:
        m.setattr(store, "delete_path", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            write_stops(spark, path, stops.where("stop = 10"), noon + dt.timedelta(days=1))
    assert read_stops(spark, path)[1] == noon + dt.timedelta(days=1) and read_stops(spark, path)[0].count() == 1
    write_stops(spark, path, stops, noon + dt.timedelta(days=2))
    assert len(glob.glob(f"{path}/stops-*")) == 1
    # an empty state is one without channels, of no known time: the history is read again
    write_stops(spark, path, stops.limit(0), noon)
    assert read_stops(spark, path) is None


# -- streams that stop, break and go on ------------------------------------------
def test_streams_over_several_files_lose_and_double_nothing(spark, tmp_dir):
    landing, sink, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    handles = spark.createDataFrame([(1, "@one", 0)], "channel_id long, channel_handle string, channel_ord long")
    at = dt.datetime(2024, 1, 1)

    def land(k):
        rows = [(10 * k + i, 1, "Message", at, f"m{k}") for i in range(3)]
        spark.createDataFrame(rows, RAW_MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(landing)

    seen = []
    step = pull_batch(handles)

    def process(batch, batch_id):
        seen.append(batch_id)
        out = step(batch, batch_id)
        if seen.count(batch_id) == 1 and batch_id in (1, 4):
            # breaks off after the run's data has been stored
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(sink)
            raise RuntimeError("lost")
        return out

    poll = lambda **k: run_incremental(spark, landing, RAW_MESSAGE_SCHEMA, process, sink, ckpt, max_files_per_trigger=1, **k)
    for k in range(4):
        land(k)
    with pytest.raises(Exception, match="lost"):
        poll()
    assert poll(max_batches=2) == 2  # the open micro-batch again, and one more
    land(4)
    land(5)
    assert poll(restarts=1) == 3
    assert poll() == 0
    rows = spark.read.parquet(sink).collect()
    assert sorted(r.id for r in rows) == sorted(10 * k + i for k in range(6) for i in range(3))
    assert sorted({str(r.run) for r in rows}) == [str(k) for k in range(6)]
    assert seen == [0, 1, 1, 2, 3, 4, 4, 5]


# -- rows that their key doesn't identify ------------------------------------------
@pytest.mark.parametrize("method", ["hash", "exact", "window"])
def test_prebatch_raises_where_positions_do_not_identify_rows(spark, method):
    kind = "run string, pos long, text string"
    good = spark.createDataFrame([(None, 0, "a"), (None, 1, "a"), ("b", 0, None), ("b", 1, None)], kind)
    assert sorted((r.run or "", r.pos, r.dup_count) for r in prebatch(good, method=method).collect()) == [("", 0, 2), ("b", 0, 2)]
    for bad in ([("a", 0, "p"), ("a", 0, "q")], [("a", None, "p"), ("a", 1, "q")], [(None, 3, "p"), (None, 3, "p")]):
        with pytest.raises(Exception, match="must identify a row"):
            prebatch(spark.createDataFrame(bad, kind), method=method).collect()


def test_the_key_check_adds_no_shuffle(spark):
    rows = spark.range(1000).select(F.lit("r").alias("run"), F.col("id").alias("pos"), (F.col("id") % 9).cast("string").alias("text"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = prebatch(rows)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 3  # the counts, and both sides of the join back


# -- foreign JSON arrays by byte ranges ----------------------------------------------
BROKEN = ['[{"id":1},', '{"id":1}', '[{"id":1}] [', '[{"id":1}]]', '[{"id":1},]', '[{"id":1} x]', "hello", '[{"id":1}]{"a":1}', "", '[{"id":"}]', '[{"id":1}', '[{"id":1}}']


@pytest.mark.parametrize("range_bytes", ["128m", "1500"])
def test_arrays_are_read_by_ranges(spark, tmp_dir, range_bytes):
    rng = random.Random(3)
    says = lambda: rng.choice(["x", '}{][,"\\', '"},', " : {", "\u00e9\n\t\\\\", "", 'a\\"}' * 3, "z" * rng.randint(0, 300)])
    arrays = {}
    for i, n in enumerate([0, 1, 9, 120]):
        made = [{"id": j, "channel_id": i, "channel_handle": "@" + says(), "time": "t", "text": says(), "more": {"a": [1, {"b": []}], "c": says()}} for j in range(n)]
        made = [m if rng.random() < 0.95 else rng.choice([None, 3, "s}", [1, [2]]]) for m in made]
        arrays[f"f{i}"] = made
        with open(f"{tmp_dir}/f{i}.json", "w", encoding="utf-8") as f:
            f.write(json.dumps(made, indent=[None, 2, 0, 4][i], ensure_ascii=bool(i % 2)) + "\n" * (i % 3))
    for k, text in enumerate(BROKEN):
        with open(f"{tmp_dir}/broken{k}.json", "w") as f:
            f.write(text)
    settings = {"spark.sql.files.maxPartitionBytes": range_bytes, "spark.sql.files.openCostInBytes": "1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = {}
        for r in read_message_files(spark, tmp_dir).collect():
            got.setdefault(r.run, []).append((r.pos, r.id, r.channel_handle, r.text))
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert not [r for r in got if r.startswith("broken")]
    for run, made in arrays.items():
        assert sorted(got.get(run, [])) == [(p, m["id"], m["channel_handle"], m["text"]) for p, m in enumerate(made) if isinstance(m, dict)]


def test_arrays_are_written_as_files_that_stay_small(spark, tmp_dir):
    rows = [(i, r, f'say "{i}" ]}}{{[,') for i, r in enumerate([None, "", "a/b", "en"] * 5 + ["en"] * 80)]
    df = spark.createDataFrame(rows, "id long, run string, text string").repartition(5)
    path = write_arrays(df, f"{tmp_dir}/arrays", F.to_json(F.struct("id", "text")), rows_per_file=10)
    files = [(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".txt")]
    assert len(files) >= 10  # the large run's too: no task writes a whole array
    for d, f in files:
        with open(os.path.join(d, f)) as opened:
            assert 1 <= len(json.load(opened)) <= 40
    got = {r.id: r.pos for r in read_message_files(spark, path, pattern="*.txt", folders=True).collect()}
    want = {}
    for i, r, _ in rows:
        want.setdefault(r, []).append(i)
    assert got == {i: k for ids in want.values() for k, i in enumerate(ids)}


def test_an_array_in_files_goes_with_each_of_them(spark, tmp_dir):
    made = {"a": ['[{"id":1},null]', "[]", ' [ {"id":2} ]\n'], "b": ['[{"id":3}]', '[{"id":4}'], "c": ["[7]", '[{"id":5}]']}
    for run, texts in made.items():
        os.mkdir(f"{tmp_dir}/run={run}")
        for k, text in enumerate(texts):
            with open(f"{tmp_dir}/run={run}/{k}.json", "w") as f:
                f.write(text)
    got = sorted((r.run, r.pos, r.id) for r in read_message_files(spark, tmp_dir, folders=True).collect())
    # null and 7 have places; the second file of "b" is not closed
    assert got == [("run=a", 0, 1), ("run=a", 2, 2), ("run=c", 1, 5)]
