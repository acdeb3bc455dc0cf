"""Record shapes and fixed values shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the behaviour being reproduced) -------------
# Python's str.strip() whitespace set, as code points:
# U+0009-000D, U+001C-001F, U+0020, U+0085, U+00A0, U+1680, U+2000-200A,
# U+2028, U+2029, U+202F, U+205F, U+3000.
PY_WS = (
    "\u0009\u000a\u000b\u000c\u000d"
    "\u001c\u001d\u001e\u001f"
    "\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Source paging limits and window defaults of the polling fetch.
PAGE_SIZE = 100
MAX_PAGES = 30
DEFAULT_LOOKBACK_DAYS = 7
# Declared model budget (never wired to batching; ``cap`` is an argument).
CONTEXT_WINDOW_TOKENS = 1_000_000
TARGET_WINDOW_SHARE = 0.80
# Extended ISO-8601 form accepted for a message ``time``.
ISO_TIME_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?([+-]\d{2}:\d{2}|Z)?)?$"
)
# Name of the stored high-water mark field / file.
WATERMARK_FIELD = "last_fetch"
# -------------------------------------------------------------------------

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("channel_id", T.LongType()),
        T.StructField("channel_handle", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

CHANNEL_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("handle", T.StringType()),
    ]
)

DIALOG_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("username", T.StringType()),
    ]
)

RAW_MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("channel_id", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("date", T.TimestampType()),
        T.StructField("message", T.StringType()),
    ]
)

WATERMARK_SCHEMA = T.StructType([T.StructField(WATERMARK_FIELD, T.TimestampType())])

MESSAGE_FIELDS = [f.name for f in MESSAGE_SCHEMA.fields]
