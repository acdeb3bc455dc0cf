"""Landed source tables, and views of the driver tables in those shapes.

The live chat-service pull is not part of this library; its rows are
expected as landed tables:

* ``dialogs(id, kind, title, username)`` — joined chats (``kind`` is
  ``Channel`` for broadcast channels),
* ``raw_messages(id, channel_id, kind, date, message)`` — ``kind`` is
  ``Message`` for real messages, anything else is a service row.

The adapters below present the repository's test tables in these shapes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.scalars import iso_time
from tidewater.records import DIALOG_SCHEMA, RAW_MESSAGE_SCHEMA

DOC_EPOCH_SECONDS = 1_704_067_200  # 2024-01-01T00:00:00Z


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_dialogs(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(DIALOG_SCHEMA).load(path)


def read_raw_messages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(RAW_MESSAGE_SCHEMA).load(path)


def messages_from_documents(documents: DataFrame) -> DataFrame:
    """``documents`` as stored messages of one run per language.

    id = doc_id, channel = the document source (``src7`` → id 7, handle
    ``@src7``), time = 2024-01-01 + doc_id minutes, pos = doc_id, run = lang.
    """
    ts = F.timestamp_seconds(F.lit(DOC_EPOCH_SECONDS) + F.col("doc_id") * 60)
    return documents.select(
        F.col("doc_id").alias("id"),
        F.regexp_extract("source", r"(\d+)$", 1).cast("long").alias("channel_id"),
        F.concat(F.lit("@"), F.col("source")).alias("channel_handle"),
        iso_time(ts, source="ltz").alias("time"),
        F.col("text"),
        F.col("doc_id").alias("pos"),
        F.col("lang").alias("run"),
    )


def raw_from_events(events: DataFrame) -> DataFrame:
    """``events`` as raw source rows: one channel per user, errors are service rows."""
    return events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("channel_id"),
        F.when(F.col("event_type") == "error", F.lit("Service")).otherwise(F.lit("Message")).alias("kind"),
        F.col("ts").alias("date"),
        F.col("props").alias("message"),
    )


def dialogs_from_customers(customer: DataFrame) -> DataFrame:
    """``customer`` as joined dialogs: MACHINERY rows are private users,
    the rest channels; only customers with a positive balance have a user name."""
    return customer.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("User")).otherwise(F.lit("Channel")).alias("kind"),
        F.col("c_name").alias("title"),
        F.when(F.col("c_acctbal") > 0, F.lower("c_name")).alias("username"),
    )


__all__ = [
    "table",
    "read_dialogs",
    "read_raw_messages",
    "messages_from_documents",
    "raw_from_events",
    "dialogs_from_customers",
]
