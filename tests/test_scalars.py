import datetime as dt
import json
from pathlib import Path

import pytest

from tidewater.functions.scalars import (
    base_name,
    batch_file_name,
    format_handle,
    is_iso_time,
    iso_time,
    json_record,
    json_record_length,
    parse_target_list,
    run_stem,
    strip_text,
    token_count_chars,
    token_count_local,
)
from tidewater.records import PY_WS

# fixed values: mixed-language token-count fixture texts (goldens 33, 53, 54
# for the first three; the fourth was rewritten, so its count is computed)
TOKEN_TEXTS = [
    "안녕하세요. This is a mixed sentence with English and 한글.",
    "🚀 에어드랍 참여 가이드:\n1. 채널 가입\n2. 폼 작성\n3. 인증 완료\n\n#에어드랍 #토큰",
    "긴 문단 테스트입니다. 마크다운 예시:\n```python\ndef hello():\n    print('hi')\n```\n여기까지.",
    "1. Visit https://example.com\n2. Follow @someone\n3. Claim now!\n\n🔥 Hurry up!",
]


def test_py_ws_is_python_strip_set():
    ws = "".join(chr(i) for i in range(0x110000) if chr(i).strip() == "")
    assert sorted(PY_WS) == sorted(ws)


def test_local_token_goldens(spark):
    df = spark.createDataFrame([(t,) for t in TOKEN_TEXTS], "t string")
    got = [r[0] for r in df.select(token_count_local("t")).collect()]
    assert got[:3] == [33, 53, 54]
    assert got == [len(t.encode()) // 2 for t in TOKEN_TEXTS]
    chars = [r[0] for r in df.select(token_count_chars("t")).collect()]
    assert chars == [len(t) // 4 for t in TOKEN_TEXTS]


def test_format_handle(spark):
    df = spark.createDataFrame([("abc",), ("",), (None,)], "u string")
    assert [r[0] for r in df.select(format_handle("u")).collect()] == ["@abc", "", ""]


@pytest.mark.parametrize(
    "text",
    ["  a b  ", "　x ", "\t\n\x1c y \x85", "  z  ", "", "   ", "no-space", "​keep​"],
)
def test_strip_text_matches_python(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(strip_text("t")).first()[0] == text.strip()


def test_iso_time(spark):
    df = spark.sql(
        "select timestamp_ntz'2025-01-01 01:02:03' a, timestamp_ntz'2025-01-01 01:02:03.000450' b,"
        " timestamp'2025-01-01 01:02:03.5' c"
    )
    row = df.select(iso_time("a"), iso_time("b"), iso_time("c", source="ltz")).first()
    assert row[0] == dt.datetime(2025, 1, 1, 1, 2, 3, tzinfo=dt.timezone.utc).isoformat()
    assert row[1] == dt.datetime(2025, 1, 1, 1, 2, 3, 450, tzinfo=dt.timezone.utc).isoformat()
    assert row[2] == "2025-01-01T01:02:03.500000+00:00"


@pytest.mark.parametrize(
    "text,ok",
    [
        ("2025-01-01T01:02:03+00:00", True),
        ("2025-01-01T01:02:03.123456+00:00", True),
        ("2025-01-01 12:00", True),
        ("2025-01-01", True),
        ("2025-01-01T10:00:00Z", True),
        ("2025-01-01T10:00Z", True),
        ("2025-01-01T10:00:00+23:59", True),
        ("2025-01-01T10:00:00+05:99", True),
        ("2025-01-01T10:00:00+24:00", False),
        ("0000-01-01", False),
        ("2025-01-01T23:59:60", False),
        ("2025-13-01T10:00:00", False),
        ("2025-02-30", False),
        ("2025", False),
        ("20240524_1000", False),
        ("1", False),
        ("", False),
        (None, False),
    ],
)
def test_is_iso_time(spark, text, ok):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(is_iso_time("t")).first()[0] is ok


RECORDS = [
    {"channel": "A", "time": "2025-01-01 12:00", "text": "hello", "dup_count": 1},
    {"channel": "A", "time": "2025-01-01 12:01", "text": "world"},
    {"channel": "B", "time": "x", "text": 'q"uo\\te \x01 \n 한글 🚀   /', "dup_count": 42},
    {"channel": "C", "time": "y", "text": "", "dup_count": 0},
]


def test_json_record_is_python_dumps(spark):
    rows = [(r["channel"], r["time"], r["text"], r.get("dup_count")) for r in RECORDS]
    df = spark.createDataFrame(rows, "channel string, time string, text string, dup_count long")
    fields = ["channel", "time", "text", "dup_count"]
    got = df.select(
        json_record(fields).alias("j"),
        json_record_length(fields, "bytes").alias("b"),
        json_record_length(fields, "chars").alias("c"),
    ).collect()
    for rec, row in zip(RECORDS, got):
        expect = json.dumps(rec, ensure_ascii=False)
        assert row["j"] == expect
        assert row["b"] == len(expect.encode())
        assert row["c"] == len(expect)


def test_names(spark):
    paths = ["/a/b/2025-05-19_1330~2025-05-26_1323.json", "x.tar.gz", "plain", "dir/.hidden"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = df.select(base_name("p"), run_stem("p")).collect()
    assert [r[0] for r in got] == [Path(p).name for p in paths]
    assert [r[1] for r in got] == [Path(p).stem for p in paths]
    n = spark.createDataFrame([(2, 3)], "i long, n long").select(batch_file_name("i", "n")).first()[0]
    assert n == "2of3.json"


def test_parse_target_list(spark):
    raw = " @a , @b,,\t@c　 , "
    expect = [c.strip() for c in raw.split(",") if c.strip()]
    df = spark.createDataFrame([(raw,)], "s string")
    assert df.select(parse_target_list("s")).first()[0] == expect


def test_json_record_random_strings(spark):
    import random

    rnd = random.Random(13)
    alphabet = [chr(c) for c in range(0, 0x80)] + ["é", "한", "🚀", " ", " ", " ", "﻿", "\u0085"]
    rows = []
    for i in range(400):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))
        rows.append((i, text if rnd.random() > 0.05 else None, rnd.choice([None, 0, -5, 2**40])))
    df = spark.createDataFrame(rows, "id long, text string, n long")
    fields = ["id", "text", "n"]
    out = df.select("id", "text", "n", json_record(fields).alias("j"), json_record_length(fields, "bytes").alias("b"),
                    json_record_length(fields, "chars").alias("c")).collect()
    for r in out:
        rec = {k: r[k] for k in fields if r[k] is not None}
        expect = json.dumps(rec, ensure_ascii=False)
        assert r["j"] == expect
        assert r["b"] == len(expect.encode()) and r["c"] == len(expect)


def test_json_record_escaped_backslash_u(spark):
    texts = ["\\u001A literal", "\x1a ctrl", "\\\x1f mixed", "\\\\u001B"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(json_record(["text"])).collect()]
    assert got == [json.dumps({"text": t}, ensure_ascii=False) for t in texts]
