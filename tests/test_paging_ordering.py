import datetime as dt
import random

from tidewater.operators.ordering import dense_position, merge_sorted
from tidewater.operators.paging import cap_per_channel, paged_pull

MARK = dt.datetime(2024, 1, 10)


def _page_loop(rows, mark, limit, max_pages, early_stop):
    """Plain page loop over one channel's rows, newest id first."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = []
    pages = 0
    i = 0
    while i < len(rows):
        if max_pages is not None and pages >= max_pages:
            break
        page = rows[i : i + limit]
        i += limit
        pages += 1
        kept = 0
        stop = False
        for rid, kind, date in page:
            if kind != "Message" or date is None:
                continue
            if date <= mark:
                stop = True
                break
            out.append(rid)
            kept += 1
        if stop:
            break
        if early_stop and kept < limit:
            break
    return sorted(out)


def _df(spark, rows):
    return spark.createDataFrame(rows, "id long, channel_id long, kind string, date timestamp_ntz")


def test_page_stop_fixture(spark):
    d = lambda day: dt.datetime(2024, 1, day)
    rows = []
    for i in range(1, 11):
        kind = "Service" if i == 7 else "Message"
        date = MARK if i <= 2 else d(10 + i)
        rows.append((i, 1, kind, date))
    df = _df(spark, rows)
    lossless = sorted(r["id"] for r in paged_pull(df, MARK, limit=3, max_pages=None).collect())
    assert lossless == [3, 4, 5, 6, 8, 9, 10]
    for pages in (None, 30):
        parity = sorted(r["id"] for r in paged_pull(df, MARK, limit=3, max_pages=pages, early_stop=True).collect())
        assert parity == [5, 6, 8, 9, 10]


def test_paged_pull_matches_page_loop(spark):
    rnd = random.Random(5)
    rows = []
    rid = 0
    for ch in range(40):
        for _ in range(rnd.randint(0, 40)):
            rid += 1
            kind = rnd.choice(["Message"] * 6 + ["Service"])
            date = None if rnd.random() < 0.05 else MARK + dt.timedelta(hours=rnd.randint(-48, 96))
            rows.append((rid, ch, kind, date))
    df = _df(spark, rows)
    by_ch = {}
    for r in rows:
        by_ch.setdefault(r[1], []).append((r[0], r[2], r[3]))
    configs = [(3, None, False), (3, None, True), (4, 2, True), (5, 3, False), (100, 30, True),
               (1, None, True), (1, 4, True), (2, None, True), (2, 3, False)]
    for limit, max_pages, early in configs:
        got = sorted(r["id"] for r in paged_pull(df, MARK, limit=limit, max_pages=max_pages, early_stop=early).collect())
        exp = sorted(x for ch in by_ch.values() for x in _page_loop(ch, MARK, limit, max_pages, early))
        assert got == exp, (limit, max_pages, early)


def test_cap_per_channel(spark):
    rows = [(i, i % 3, "Message", MARK) for i in range(30)]
    got = sorted(r["id"] for r in cap_per_channel(_df(spark, rows), 2).collect())
    assert got == [24, 25, 26, 27, 28, 29]


def test_dense_position_and_merge(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.randint(0, 5), f"2024-01-0{rnd.randint(1, 9)}T00:00:00+00:00", rnd.randint(0, 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, channel_id long, time string, channel_ord long").repartition(7)
    out = merge_sorted(df).collect()
    expect = sorted(rows, key=lambda r: (r[2], r[3], -r[0]))
    got = sorted(out, key=lambda r: r["pos"])
    assert [r["pos"] for r in got] == list(range(200))
    assert [r["id"] for r in got] == [r[0] for r in expect]


def test_dense_position_per_partition(spark):
    rows = [(i, "a" if i % 2 else "b", i * 7 % 13) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, run string, k long")
    out = dense_position(df, ["k", "id"], partition="run").collect()
    for run in ("a", "b"):
        mine = sorted((r for r in out if r["run"] == run), key=lambda r: r["pos"])
        assert [r["pos"] for r in mine] == list(range(len(mine)))
        assert [(r["k"], r["id"]) for r in mine] == sorted((r["k"], r["id"]) for r in mine)


def test_dense_position_null_partition(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id long, run string")
    out = sorted((r["run"] or "", r["id"], r["pos"]) for r in dense_position(df, ["id"], partition="run").collect())
    assert out == [("", 1, 0), ("", 2, 1), ("a", 3, 0)]


def test_dense_position_random_partitions(spark):
    rnd = random.Random(21)
    rows = [(i, rnd.choice(["a", "b", "c", None]), rnd.randint(0, 30)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, run string, k long").repartition(5)
    out = dense_position(df, ["k", "id"], partition="run").collect()
    by_run = {}
    for r in out:
        by_run.setdefault(r["run"], []).append(r)
    for run, items in by_run.items():
        items.sort(key=lambda r: r["pos"])
        assert [r["pos"] for r in items] == list(range(len(items)))
        assert [(r["k"], r["id"]) for r in items] == sorted((r["k"], r["id"]) for r in items)
    assert sum(len(v) for v in by_run.values()) == 300
