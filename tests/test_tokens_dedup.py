import json

from pyspark.sql import functions as F

from tidewater.functions.tokens import CharTokenizer, LocalTokenizer, PandasTokenizer
from tidewater.operators.batching import assign_batches
from tidewater.operators.dedup import prebatch, text_counts

# fixed values: the ten-message batching fixture (channel, text, dup_count)
SWEEP = [
    ("A", "hello", 1),
    ("A", "world", None),
    ("A", "hi there, this is a long message for token testing.", 3),
    ("B", "에어드랍 참여법을 알려주세요.", 42),
    ("B", "멀티라인\n메시지\ntest!", None),
    ("B", "# Markdown Title\n- Item1\n- Item2\nEnd.", 18),
    ("C", "Short", 1),
    ("C", "x" * 80, 1),
    ("C", "한글" * 10, 0),
    ("C", "Final quick test.", 1),
]
FIELDS = ["channel", "time", "text", "dup_count"]


def _sweep_df(spark):
    rows = [(c, f"2025-01-01 12:{i:02d}", t, d, i, "run") for i, (c, t, d) in enumerate(SWEEP)]
    return spark.createDataFrame(rows, "channel string, time string, text string, dup_count long, pos long, run string")


def test_char_tokens_on_records(spark):
    df = _sweep_df(spark).withColumn("tokens", CharTokenizer().count_record(FIELDS))
    got = [r["tokens"] for r in df.orderBy("pos").collect()]
    expect = []
    for i, (c, t, d) in enumerate(SWEEP):
        rec = {"channel": c, "time": f"2025-01-01 12:{i:02d}", "text": t}
        if d is not None:
            rec["dup_count"] = d
        expect.append(len(json.dumps(rec, ensure_ascii=False)) // 4)
    assert got == expect == [19, 15, 30, 22, 18, 28, 19, 38, 23, 22]


def test_cap_sweep_batches(spark):
    df = _sweep_df(spark).withColumn("tokens", CharTokenizer().count_record(FIELDS))
    derived = {
        40: [[0, 1], [2], [3, 4], [5], [6], [7], [8], [9]],
        90: [[0, 1, 2, 3], [4, 5, 6], [7, 8, 9]],
        25: [[0], [1], [3], [4], [6], [8], [9]],
    }
    for cap, batches in derived.items():
        out = assign_batches(df, cap).collect()
        got = {}
        for r in out:
            got.setdefault(r["batch_no"], []).append(r["pos"])
        assert [sorted(got[k]) for k in sorted(got)] == batches
        for r in out:
            assert r["total_batches"] == len(batches)
        totals = {}
        for r in out:
            totals[r["batch_no"]] = totals.get(r["batch_no"], 0) + r["tokens"]
        assert all(v <= cap for v in totals.values())


def test_pandas_tokenizer_hook(spark):
    df = _sweep_df(spark)
    tok = PandasTokenizer(lambda: (lambda s: len(s.encode("utf-8")) // 2))
    a = df.select("pos", tok.count_record(FIELDS).alias("a"))
    b = df.select("pos", LocalTokenizer().count_record(FIELDS).alias("b"))
    got = {r["pos"]: r["a"] for r in a.collect()}
    exp = {r["pos"]: r["b"] for r in b.collect()}
    assert got == exp


def _msgs(spark, rows):
    data = [(c, t, x, i, "r") for i, (c, t, x) in enumerate(rows)]
    return spark.createDataFrame(data, "channel string, time string, text string, pos long, run string")


def test_prebatch_fixture(spark):
    df = _msgs(spark, [("a", "1", "same"), ("b", "2", "same"), ("c", "3", "unique")])
    for method in ("hash", "window"):
        out = {r["text"]: r for r in prebatch(df, method=method).collect()}
        assert len(out) == 2
        assert out["same"]["dup_count"] == 2 and out["same"]["pos"] == 0
        assert out["unique"]["dup_count"] == 1
        # time is not a date here and must pass through untouched
        assert out["same"]["time"] == "1"


def test_prebatch_no_duplicates(spark):
    df = _msgs(spark, [("a", "1", "x"), ("b", "2", "y")])
    out = prebatch(df).collect()
    assert len(out) == 2 and all(r["dup_count"] == 1 for r in out)


def test_prebatch_overwrites_dup_count_and_keeps_columns(spark):
    df = _msgs(spark, [("a", "1", "x"), ("b", "2", "x")]).withColumn("dup_count", F.lit(99).cast("long"))
    out = prebatch(df)
    assert out.columns == ["channel", "time", "text", "pos", "run", "dup_count"]
    assert [r["dup_count"] for r in out.collect()] == [2]


def test_prebatch_null_text_is_one_group(spark):
    df = spark.createDataFrame(
        [(None, 0, "r"), (None, 1, "r"), ("a", 2, "r")], "text string, pos long, run string"
    )
    for method in ("hash", "window"):
        got = sorted((r["pos"], r["dup_count"]) for r in prebatch(df, method=method).collect())
        assert got == [(0, 2), (2, 1)]


def test_prebatch_scope_is_per_run(spark):
    df = spark.createDataFrame(
        [("x", 0, "r1"), ("x", 1, "r2"), ("x", 2, "r2")], "text string, pos long, run string"
    )
    got = sorted((r["run"], r["pos"], r["dup_count"]) for r in prebatch(df).collect())
    assert got == [("r1", 0, 1), ("r2", 1, 2)]


def test_hash_equals_window_on_documents(spark):
    from tidewater.sources.adapters import messages_from_documents, table

    msgs = messages_from_documents(table(spark, "/root/testdata/sf0.01", "documents"))
    a = {tuple(r) for r in prebatch(msgs, method="hash").collect()}
    b = {tuple(r) for r in prebatch(msgs, method="window").collect()}
    c = {tuple(r) for r in prebatch(msgs, method="exact").collect()}
    assert a == b == c and len(a) == 927
    counts = text_counts(msgs).agg(F.sum("dup_count")).first()[0]
    assert counts == 1000


def test_prebatch_null_run_kept(spark):
    df = spark.createDataFrame(
        [("x", 0, None), ("x", 1, None), ("y", 2, None), ("x", 3, "r")], "text string, pos long, run string"
    )
    for method in ("hash", "window"):
        got = sorted((r["run"] or "", r["pos"], r["dup_count"]) for r in prebatch(df, method=method).collect())
        assert got == [("", 0, 2), ("", 2, 1), ("r", 3, 1)]


def test_text_free_curation_equals_text_path(spark):
    """The length-only curation equals counting tokens on the record texts."""
    from tidewater.plans.curate import curate
    from tidewater.sources.adapters import messages_from_documents, table

    msgs = messages_from_documents(table(spark, "/root/testdata/sf0.01", "documents"))
    fields = ["id", "channel_id", "channel_handle", "time", "text"]
    for length_tok, text_tok in [
        (LocalTokenizer(), PandasTokenizer(lambda: (lambda s: len(s.encode("utf-8")) // 2))),
        (CharTokenizer(), PandasTokenizer(lambda: (lambda s: len(s) // 4))),
    ]:
        a = {tuple(r) for r in curate(msgs, 3000, fields, length_tok).collect()}
        b = {tuple(r) for r in curate(msgs, 3000, fields, text_tok).collect()}
        assert a == b and len(a) > 100


def test_add_dup_count_hot_split(spark):
    from tidewater.operators.dedup import add_dup_count

    rows = [("hot", i, "r") for i in range(300)] + [(f"t{i % 40}", 300 + i, "r") for i in range(200)]
    rows += [(None, 900 + i, "r") for i in range(3)] + [("hot", 1000, None)]
    df = spark.createDataFrame(rows, "text string, pos long, run string")
    for share in (0.001, 0.5, 1.0):
        got = {r["pos"]: r["dup_count"] for r in add_dup_count(df, hot_share=share).collect()}
        assert len(got) == len(rows)
        assert got[0] == 300 and got[300] == 5 and got[900] == 3 and got[1000] == 1
    none = {r["pos"]: r["dup_count"] for r in add_dup_count(df, partition=None).collect()}
    assert none[0] == 301 and none[1000] == 301
