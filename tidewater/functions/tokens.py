"""Pluggable token counters.

A tokenizer turns one message record into a token count.  The batcher
only ever sees the resulting ``LONG`` column, so any counter can be
injected:

* :class:`LocalTokenizer` (UTF-8 bytes // 2) and :class:`CharTokenizer`
  (code points // 4) are pure length formulas; on a record they use the
  length of the record's JSON text, computed from Spark's ``to_json``
  without building the spaced string, so they stay JVM-side.
* :class:`PandasTokenizer` wraps any Python ``count(text) -> int`` in an
  iterator pandas UDF: the model is loaded once per Python worker and
  texts arrive in Arrow batches.  It sees the exact record text.
"""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.scalars import json_record, json_record_length


class Tokenizer:
    """Base hook: count tokens of a text column or of a JSON record."""

    def count(self, text: Column | str) -> Column:  # pragma: no cover - abstract
        raise NotImplementedError

    def count_record(self, fields: Sequence[str]) -> Column:
        """Tokens of ``json.dumps(record, ensure_ascii=False)``."""
        return self.count(json_record(fields))


class LengthTokenizer(Tokenizer):
    """Tokens = length of the text in ``unit`` // ``per_token``."""

    unit = "bytes"
    per_token = 1

    def count_length(self, length: Column) -> Column:
        """Tokens of a text whose length (in ``unit``) is ``length``."""
        return F.floor(length / self.per_token).cast("long")


class LocalTokenizer(LengthTokenizer):
    """UTF-8 byte length // 2."""

    unit = "bytes"
    per_token = 2

    def count(self, text: Column | str) -> Column:
        c = F.col(text) if isinstance(text, str) else text
        return F.floor(F.octet_length(c) / 2).cast("long")

    def count_record(self, fields: Sequence[str]) -> Column:
        return F.floor(json_record_length(fields, "bytes") / 2).cast("long")


class CharTokenizer(LengthTokenizer):
    """Code-point length // 4 (the stand-in used by the batching tests)."""

    unit = "chars"
    per_token = 4

    def count(self, text: Column | str) -> Column:
        c = F.col(text) if isinstance(text, str) else text
        return F.floor(F.char_length(c) / 4).cast("long")

    def count_record(self, fields: Sequence[str]) -> Column:
        return F.floor(json_record_length(fields, "chars") / 4).cast("long")


_CACHE_MODULE = "_tidewater_worker_cache"


def _counter_for(key: str, factory: Callable[[], Callable[[str], int]]) -> Callable[[str], int]:
    """One counter per Python worker process (models load once, not per task).

    Task code arrives pickled by value, which gives every task fresh module
    globals, so the cache lives in a process-wide entry of ``sys.modules``.
    """
    holder = sys.modules.get(_CACHE_MODULE)
    if holder is None:
        holder = types.ModuleType(_CACHE_MODULE)
        holder.counters = {}
        sys.modules[_CACHE_MODULE] = holder
    counter = holder.counters.get(key)
    if counter is None:
        counter = factory()
        holder.counters[key] = counter
    return counter


class PandasTokenizer(Tokenizer):
    """Any Python counter, run as an Arrow-batched iterator pandas UDF.

    ``factory`` builds the counter (for example by loading a tokenizer
    model); it runs once per Python worker process and the counter is
    reused by every task that process serves.  The counter maps one string
    to an int; NULL text counts as 0.
    """

    def __init__(self, factory: Callable[[], Callable[[str], int]]):
        self._factory = factory
        # ids of objects are reused after collection; a worker outlives them
        key = uuid.uuid4().hex
        factory_ref = factory

        @F.pandas_udf(T.LongType())
        def _count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            counter = _counter_for(key, factory_ref)
            for s in batches:
                yield s.map(lambda t: 0 if t is None else int(counter(t))).astype("int64")

        self._udf = _count

    def count(self, text: Column | str) -> Column:
        c = F.col(text) if isinstance(text, str) else text
        return self._udf(c)


def tokenizer_from_name(name: str) -> Tokenizer:
    """``local`` or ``chars``."""
    if name == "local":
        return LocalTokenizer()
    if name == "chars":
        return CharTokenizer()
    raise ValueError(f"unknown tokenizer {name!r}")
