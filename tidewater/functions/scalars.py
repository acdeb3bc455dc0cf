"""Column-level scalar functions (all JVM-side, codegen friendly).

Each function takes and returns ``Column`` objects so it composes inside
``select``/``withColumn``/``filter`` and stays in whole-stage codegen.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.records import ISO_TIME_PATTERN, PY_WS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_handle(username: Column | str) -> Column:
    """``@name`` for a non-empty user name, otherwise the empty string."""
    u = F.coalesce(_col(username), F.lit(""))
    return F.when(u != "", F.concat(F.lit("@"), u)).otherwise(F.lit(""))


def strip_text(text: Column | str) -> Column:
    """Python ``str.strip()``: trims the full Unicode whitespace set, not just spaces."""
    return F.btrim(_col(text), F.lit(PY_WS))


def iso_time(ts: Column | str, source: str = "ntz") -> Column:
    """``datetime.isoformat()`` of a UTC instant.

    ``2025-01-01T01:02:03+00:00``; the ``.ffffff`` part appears only when
    the microseconds are not zero, as Python does.  The result does not
    depend on the session zone: ``source="ntz"`` takes a TIMESTAMP_NTZ that
    already holds UTC wall-clock time, ``source="ltz"`` converts a
    TIMESTAMP instant to UTC first.
    """
    c = _col(ts)
    if source == "ltz":
        c = F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast(T.TimestampNTZType()))
    else:
        c = c.cast(T.TimestampNTZType())
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(c, "SSSSSS")
    body = F.when(frac == "000000", whole).otherwise(F.concat(whole, F.lit("."), frac))
    return F.concat(body, F.lit("+00:00"))


def _iso_parts(t: Column) -> tuple[Column, Column]:
    """Local date-time part (offset removed) and a flag for a valid offset.

    Python accepts offsets below 24 h and years from 1; Spark's parser
    stops at ±18:00 and takes year 0, so those two rules are checked here
    and only the local part goes through Spark's parser.  ``parse_iso``
    still hands offsets beyond ±18:00 to Spark, which returns NULL.
    """
    local = F.regexp_replace(t, r"([+-]\d{2}:\d{2}|Z)$", "")
    off_h = F.regexp_extract(t, r"[+-](\d{2}):\d{2}$", 1)
    off_m = F.regexp_extract(t, r"[+-]\d{2}:(\d{2})$", 1)
    # Python takes any two-digit minutes as long as the offset stays under 24 h
    offset_ok = F.when(off_h == "", F.lit(True)).otherwise(
        off_h.try_cast("int") * 60 + off_m.try_cast("int") < 24 * 60
    )
    return local, offset_ok & (F.substring(t, 1, 4) != "0000")


def parse_iso(text: Column | str) -> Column:
    """``datetime.fromisoformat`` for the extended ISO form; NULL when invalid.

    The offset is applied by Spark's parser (session zone when absent)."""
    t = _col(text)
    _, rules_ok = _iso_parts(t)
    return F.when(t.rlike(ISO_TIME_PATTERN) & rules_ok, F.try_to_timestamp(t))


def is_iso_time(text: Column | str) -> Column:
    """True when ``text`` is an extended ISO time Python would accept."""
    t = _col(text)
    local, rules_ok = _iso_parts(t)
    return F.coalesce(t.rlike(ISO_TIME_PATTERN) & rules_ok & F.try_to_timestamp(local).isNotNull(), F.lit(False))


def default_start(now: Column, days: int) -> Column:
    """``now - N days`` (window start when no mark is stored)."""
    return now - F.make_dt_interval(F.lit(days))


def json_scalar(value: Column | str) -> Column:
    """JSON text of one scalar value (string quoted and escaped, number bare)."""
    arr = F.to_json(F.array(_col(value)))
    return arr.substr(F.lit(2), F.length(arr) - F.lit(2))


def _python_escapes(json_text: Column) -> Column:
    r"""Spark writes ``\u001E``-style escapes in upper case, Python in lower
    case; only control characters are escaped that way, so the hex digit
    that can differ is the last one, after ``\u000`` or ``\u001``.  A
    backslash run of even length is an escaped backslash, not an escape."""
    out = json_text
    for upper in "ABCDEF":
        out = F.regexp_replace(out, r"(?<!\\)((?:\\\\)*\\u00[01])" + upper, "$1" + upper.lower())
    return out


def json_record(fields: Sequence[str]) -> Column:
    """``json.dumps(record, ensure_ascii=False)`` with Python's default separators.

    A NULL field is left out, like a key the dict never had.  Only needed
    when a real tokenizer must see the exact text; length-based tokenizers
    use :func:`json_record_length` instead and never build the string.
    """
    parts = [
        F.when(
            F.col(f).isNotNull(),
            F.concat(F.lit(json.dumps(f, ensure_ascii=False) + ": "), json_scalar(f)),
        )
        for f in fields
    ]
    return _python_escapes(F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}")))


def present_fields(fields: Sequence[str]) -> Column:
    """Number of non-NULL fields among ``fields``."""
    total = F.lit(0)
    for f in fields:
        total = total + F.when(F.col(f).isNotNull(), 1).otherwise(0)
    return total


def json_record_length(fields: Sequence[str], unit: str = "bytes") -> Column:
    """Length of :func:`json_record` without building it.

    Spark's compact ``to_json`` drops NULL fields and escapes strings like
    Python; Python's default separators add one space after each ``:`` and
    each ``,`` → ``+ 2n - 1`` for ``n`` present fields (``{}`` when n = 0).
    """
    compact = F.to_json(F.struct(*[F.col(f) for f in fields]))
    n = present_fields(fields)
    extra = F.greatest(2 * n - 1, F.lit(0))
    base = F.octet_length(compact) if unit == "bytes" else F.char_length(compact)
    return (base + extra).cast("long")


def message_to_json(fields: Sequence[str]) -> Column:
    """Row → compact JSON object text of ``fields`` (NULL fields left out)."""
    return F.to_json(F.struct(*[F.col(f) for f in fields]))


def message_from_json(text: Column | str, schema: T.StructType | str) -> Column:
    """JSON object text → struct column; text that is no JSON gives NULL."""
    return F.when(F.try_parse_json(_col(text)).isNotNull(), F.from_json(_col(text), schema))


def run_name(start: Column, end: Column) -> Column:
    """``{start}~{end}.json`` from two ISO strings."""
    return F.concat(start, F.lit("~"), end, F.lit(".json"))


def base_name(path: Column | str) -> Column:
    """``Path(p).name``: the last path component."""
    return F.regexp_extract(_col(path), r"([^/]*)/*$", 1)


def run_stem(path: Column | str) -> Column:
    """``Path(p).stem``: file name without its last extension."""
    name = base_name(path)
    return F.when(name.rlike(r"^.+\.[^.]+$"), F.regexp_extract(name, r"^(.+)\.[^.]+$", 1)).otherwise(name)


def batch_file_name(batch_no: Column | str, total_batches: Column | str) -> Column:
    """``{i}of{N}.json`` with a 1-based batch number."""
    return F.concat(_col(batch_no).cast("string"), F.lit("of"), _col(total_batches).cast("string"), F.lit(".json"))


def listing_line(idx: Column | str, name: Column | str) -> Column:
    """``{idx}: {name}`` — one line of a numbered run listing."""
    return F.concat(_col(idx).cast("string"), F.lit(": "), _col(name))


def parse_target_list(text: Column | str) -> Column:
    """Comma list → array of stripped, non-empty handles (order kept)."""
    parts = F.transform(F.split(_col(text), ","), lambda x: F.btrim(x, F.lit(PY_WS)))
    return F.filter(parts, lambda x: x != "")


def token_count_local(text: Column | str) -> Column:
    """Local stand-in tokenizer: UTF-8 bytes // 2."""
    return F.floor(F.octet_length(_col(text)) / 2).cast("long")


def token_count_chars(text: Column | str) -> Column:
    """Test stand-in tokenizer: code points // 4."""
    return F.floor(F.char_length(_col(text)) / 4).cast("long")
