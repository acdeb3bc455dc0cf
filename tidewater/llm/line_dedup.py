"""Line dedup by winnowing over line hashes (DataFrame functions only).

A document is its sequence of lines with a word.  A repeated run is a stretch of
consecutive lines, of ``min_words`` words or more, that stands line for line at an
earlier place too, and that no neighbouring line extends.  Later runs go; the
first occurrence stays.

Winnowing: a window holds a line and the lines next to it up to ``min_words``
words.  Its fingerprint is its least line hash, so two documents that share a run
share the fingerprints in it, and most lines are no fingerprint.  Fingerprints are
joined by value; one that stands in one place of the corpus can't be in a repeated
run.  From the others the match is extended both ways: each line's window to its
right and its window to its left, as far as ``min_words`` words need, are compared
line for line (by 128 bits) with their first occurrence.  A line belongs to a
repeated run exactly if one of the windows that hold it is a repeat: a run around
a line can be cut from the left and the right until its outer lines are needed,
and what is left is a window of that line or of one of the outer lines.  Adjoining
repeats are joined to the runs that go.

"Before" is by document id, then by a hash of the text, then by line; documents
with a null id come last.  Rows that agree in id and text are documents of their
own: the first one (any of them) keeps what is first, all others repeat it whole.
Lines without a word are no part of the sequence and stay, but for those between
lines of one stretch that goes.  A null or empty text stays as it is; an empty table
gives an empty table.  Columns of the input, whatever their names, stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import stage_table

#: Words of a run that is worth deleting.
MIN_WORDS = 50
#: Line number after the last line of any text.
_END = (1 << 31) - 1
_WORD = r"[^\x20\x09-\x0D]"


def _words(line: Column) -> Column:
    """Words of a line: runs without ASCII white space."""
    return F.regexp_count(line, F.lit(_WORD + "+"))


def _windows(lines: DataFrame, over, total: Column, keep: Column) -> DataFrame:
    """The window of each line that ``over`` takes in, for those with ``keep``."""
    return (
        lines.withColumn("first_line", F.min("line").over(over))
        .withColumn("last", F.max(F.struct("at", "w", "line", "beyond")).over(over))
        .withColumn("start", F.min("at").over(over))
        .withColumn("low", F.min(F.struct("h", "line")).over(over))
        .withColumn("in_all", F.collect_list(F.struct("h", "h2")).over(over))
        .withColumn("words", total)
        .where(keep)
        .select(
            "d", "text_hash", F.col("first_line").alias("first"), F.col("last.line").alias("last"), F.col("last.beyond").alias("beyond"),
            F.col("low.h").alias("fingerprint"), F.col("low.line").alias("place"), F.xxhash64("in_all").alias("w1"), F.xxhash64("in_all", F.lit(7)).alias("w2"),
        )
    )


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(d, text_hash, runs): the stretches of lines to delete as structs (first, last), for documents that have
    any; ``d`` is the id in a struct.  Rows that agree in id and text count once here."""
    texts = docs.select(F.struct(F.col(id_col).alias("id")).alias("d"), F.col(text_col).cast("string").alias("t")).where(F.length("t") > 0)
    lines = texts.select("d", F.xxhash64("t").alias("text_hash"), F.posexplode(F.split("t", "\n")).alias("line", "s"))
    lines = lines.select("d", "text_hash", "line", F.xxhash64("s").alias("h"), F.xxhash64("s", F.lit(1)).alias("h2"), _words("s").cast("long").alias("w"))
    # rows that are listed more than once come together here
    lines = lines.where("w > 0").dropDuplicates(["d", "text_hash", "line"])
    doc = Window.partitionBy("d", "text_hash").orderBy("line")
    lines = lines.withColumn("at", F.sum("w").over(doc) - F.col("w"))  # words before the line
    lines = lines.withColumn("beyond", F.coalesce(F.lead("line").over(doc), F.lit(_END)))
    # to the right: the lines that start within min_words words of a line
    ahead = Window.partitionBy("d", "text_hash").orderBy("at").rangeBetween(0, min_words - 1)
    total = F.col("last.at") + F.col("last.w") - F.col("start")
    windows = _windows(lines, ahead, total, F.col("words") >= min_words)
    # to the left: those that end within min_words words of its end; one that needs its last line is also the window from its first
    behind = Window.partitionBy("d", "text_hash").orderBy("until").rangeBetween(1 - min_words, 0)
    windows = windows.unionByName(_windows(lines.withColumn("until", F.col("at") + F.col("w")), behind, total, F.col("words") - F.col("w") >= min_words))
    windows = stage_table(windows, "line-windows")
    # fingerprints that stand in two places at least; neighbouring windows mostly share one place
    place = F.struct(F.col("d.id").isNull().alias("n"), "d", "text_hash", "place")
    again = windows.groupBy("fingerprint").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo <> hi").select("fingerprint")
    near = windows.join(again, "fingerprint", "left_semi")
    # extension: the whole window, compared with its first occurrence
    order = F.struct(F.col("d.id").isNull().alias("n"), F.col("d.id").alias("id"), F.col("text_hash").alias("t"), F.col("first").alias("f"))
    firsts = near.groupBy("w1", "w2").agg(F.count("*").alias("n"), F.min(order).alias("lead")).where("n > 1").drop("n")
    later = near.join(firsts, ["w1", "w2"]).where(order > F.col("lead")).select("d", "text_hash", "first", "last", "beyond").distinct()
    # repeats that overlap, or that only lines without a word part, are one stretch
    by_first = Window.partitionBy("d", "text_hash").orderBy("first", "last")
    reach = F.max("beyond").over(by_first.rowsBetween(Window.unboundedPreceding, -1))
    later = later.withColumn("reach", reach)
    later = later.withColumn("stretch", F.sum(F.when(F.col("first") <= F.col("reach"), 0).otherwise(1)).over(by_first))
    runs = later.groupBy("d", "text_hash", "stretch").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return runs.groupBy("d", "text_hash").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))


def _without_repeats(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """The rows as ``doc``, with ``left``, the text that is left, ``n_lines`` and ``n_removed``."""
    # the input's columns travel inside one, so no name of theirs meets one used here
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), F.struct(F.col(id_col).alias("id")).alias("d"), F.col(text_col).cast("string").alias("t"),
        F.monotonically_increasing_id().alias("rid"),
    ).withColumn("text_hash", F.xxhash64("t"))
    runs = repeated_runs(docs, min_words, id_col, text_col)
    listed = rows.where(F.length("t") > 0).groupBy("d", "text_hash").agg(F.count("*").alias("n"), F.min("rid").alias("lead")).where("n > 1")
    side = runs.join(listed.select("d", "text_hash", "lead"), ["d", "text_hash"], "full")
    met = rows.join(side, ["d", "text_hash"], "left")
    lines = F.split("t", "\n")
    # a row listed before goes from its first to its last line with a word
    worded = F.transform(lines, lambda s: s.rlike(_WORD))
    whole = F.array(F.struct((F.array_position(worded, True) - 1).cast("int").alias("first"), (F.size(lines) - F.array_position(F.reverse(worded), True)).cast("int").alias("last")))
    again = (F.col("rid") != F.col("lead")) & (_words(F.col("t")) >= min_words)
    met = met.withColumn("runs", F.when(F.coalesce(again, F.lit(False)), whole).otherwise(F.col("runs")))
    gone = F.flatten(F.transform("runs", lambda r: F.sequence(r["first"], r["last"])))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    left = F.array_join(F.transform(stay, lambda i: F.element_at(lines, i + 1)), "\n")
    return met.select(
        "doc",
        F.when(F.col("runs").isNull(), F.col("t")).otherwise(left).alias("left"),
        F.when(F.col("t").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col("runs").isNull(), F.lit(0)).otherwise(F.size(gone)).cast("long").alias("n_removed"),
    )


def line_report(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the id, ``n_lines``, ``n_removed`` (lines) and ``kept``, the text that is left."""
    made = _without_repeats(docs.select(id_col, text_col), min_words, id_col, text_col)
    return made.select(F.col("doc").getField(id_col).alias(id_col), "n_lines", "n_removed", F.col("left").alias("kept"))


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without repeated lines; a document goes when all its lines with a word were repeats."""
    made = _without_repeats(docs, min_words, id_col, text_col).where((F.col("n_removed") == 0) | F.col("left").rlike(_WORD))
    return made.select(*[F.col("left").alias(c) if c == text_col else F.col("doc").getField(c).alias(c) for c in docs.columns])


__all__ = ["MIN_WORDS", "repeated_runs", "line_report", "drop_repeated_lines"]
