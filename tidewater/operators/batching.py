"""Greedy next-fit batching under a token budget.

Semantics (per run, rows in ``pos`` order): a row whose own count exceeds
``cap`` is set aside (it neither joins nor closes a batch); otherwise the
row joins the open batch when ``fill + tokens <= cap``, else the open batch
is closed and the row opens the next one.  A batch may total exactly
``cap``.

How it runs on Spark
--------------------
The running sum resets, so no window frame expresses it.  Only the narrow
``(run, pos, tokens)`` projection enters Python; labels are joined back on
``(run, pos)``, a unique key, so that join cannot skew.

* Small input (``rows <= rows_per_chunk``): hash-partition by run and label
  every run in one numpy pass.
* Large input: range-partition on ``(run, pos)`` into chunks of about
  ``rows_per_chunk`` rows, so one run holding a third of all rows is split
  over many tasks.  Inside a chunk the batch that starts at row ``i`` ends
  right before ``next(i)`` = first row whose inclusive prefix sum exceeds
  ``prefix_before(i) + cap`` (one vectorised ``searchsorted``).  The only
  thing a chunk needs from its predecessor is the open batch's fill ``c``;
  ``c`` decides at which row the first new batch starts, and from there the
  chain of ``next`` pointers is fixed.  Pass 1 summarises, per chunk, the
  outcome for every possible ``c`` as a small step function (pointer
  doubling gives batch counts along every chain; chains from different
  start rows often merge; where they don't, as with equal counts, the
  function has up to one step a row of the first batch).  Step functions
  compose, so the summaries are composed in a tree: a task joins ``FAN_IN``
  neighbours to one summary, level by level, until one group is left.  Back
  down the tree every group hands each member its incoming state and the
  number of batches of the run that it ends in, and pass 2 labels each chunk
  from what it got.  No task sees more than ``FAN_IN`` summaries, none reaches
  the driver, and chunks grow with the table, so their number grows with its root.
  Both passes read one checkpoint in the shared folder, so they see identical
  chunks and a lost executor recomputes nothing upstream.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.scalars import batch_file_name
from tidewater.session import cut_lineage, stage_table

DEFAULT_ROWS_PER_CHUNK = 500_000
# Neighbouring summaries that one task composes to the next level's summary.
FAN_IN = 64


# ---------------------------------------------------------------- kernels
def _prefix(tok: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inclusive prefix, exclusive prefix, and next batch start for each row."""
    if len(tok) and tok.min() < 0:
        # prefix sums must not decrease, or the searchsorted steps are wrong
        raise ValueError("token counts must be >= 0")
    inc = np.cumsum(tok, dtype=np.int64)
    exc = inc - tok
    nxt = np.searchsorted(inc, exc + cap, side="right")
    return inc, exc, nxt


def _chain_depth(nxt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Batches on the chain from each row (itself included) and its last start."""
    m = len(nxt)
    here = np.arange(m)
    parent = np.where(nxt >= m, here, nxt)
    hops = (nxt < m).astype(np.int64)
    while True:
        grand = parent[parent]
        if np.array_equal(grand, parent):
            break
        hops = hops + hops[parent]
        parent = grand
    return hops + 1, parent


def _first_close(inc: np.ndarray, cap: int, fill: int) -> int:
    """First row that no longer fits into an open batch holding ``fill``."""
    return int(np.searchsorted(inc, cap - fill, side="right"))


def _label_segment(tok: np.ndarray, cap: int, state: tuple[int, int, int]):
    """Label one run segment given the incoming ``(batches, fill, rows_in_open)``.

    Returns ``(batch_no, batch_idx, out_state)``.
    """
    m = len(tok)
    b, c, r = state
    inc, exc, nxt = _prefix(tok, cap)
    batch = np.empty(m, dtype=np.int64)
    idx = np.empty(m, dtype=np.int64)
    j = 0 if b == 0 else _first_close(inc, cap, c)
    batch[:j] = b
    idx[:j] = r + np.arange(j)
    if j >= m:
        return batch, idx, (b, c + int(inc[-1]) if m else c, r + m)
    starts = []
    i = j
    while i < m:
        starts.append(i)
        i = int(nxt[i])
    starts_arr = np.asarray(starts, dtype=np.int64)
    flag = np.zeros(m - j, dtype=np.int64)
    flag[starts_arr - j] = 1
    k = np.cumsum(flag)
    batch[j:] = b + k
    idx[j:] = np.arange(j, m) - starts_arr[k - 1]
    last = int(starts_arr[-1])
    return batch, idx, (b + len(starts), int(inc[-1] - exc[last]), m - last)


def _step_function(tok: np.ndarray, cap: int):
    """Outcome of a segment for every incoming fill, as steps over ``cap - fill``.

    Step ``k`` applies when ``thr[k] <= cap - fill`` (last such ``k``).  A step
    with ``depth == 0`` means no new batch opens: add ``out_c``/``out_r`` to
    the incoming fill/rows; otherwise ``depth`` batches open and the segment
    ends with fill ``out_c`` and ``out_r`` rows in the open batch.
    """
    m = len(tok)
    inc, exc, nxt = _prefix(tok, cap)
    lo = int(np.searchsorted(inc, 0, side="right"))
    hi = int(np.searchsorted(inc, cap, side="right"))
    thr: list[int] = []
    depth_out: list[int] = []
    out_c: list[int] = []
    out_r: list[int] = []
    top = min(hi, m - 1)
    if lo <= top:
        depth, root = _chain_depth(nxt)
        cand = np.arange(lo, top + 1)
        d = depth[cand]
        rt = root[cand]
        change = np.ones(len(cand), dtype=bool)
        change[1:] = (d[1:] != d[:-1]) | (rt[1:] != rt[:-1])
        for a in cand[change]:
            a = int(a)
            thr.append(-1 if a == lo else int(inc[a - 1]))
            depth_out.append(int(depth[a]))
            out_c.append(int(inc[-1] - exc[root[a]]))
            out_r.append(int(m - root[a]))
    if hi >= m:
        thr.append(-1 if lo >= m else int(inc[m - 1]))
        depth_out.append(0)
        out_c.append(int(inc[-1]))
        out_r.append(m)
    return thr, depth_out, out_c, out_r


# ----------------------------------------------------------- chunk helpers
def _segments(runs: pd.Series) -> list[tuple[int, int]]:
    n = len(runs)
    if n == 0:
        return []
    codes, _ = pd.factorize(runs, use_na_sentinel=False)
    cut = np.flatnonzero(codes[1:] != codes[:-1]) + 1
    starts = np.concatenate([[0], cut])
    ends = np.concatenate([cut, [n]])
    return list(zip(starts.tolist(), ends.tolist()))


def _read_chunks(batches: Iterator[pd.DataFrame], run: str, pos: str):
    """Group the rows of one Spark partition by chunk id, ordered by (run, pos)."""
    frames = [b for b in batches if len(b)]
    if not frames:
        return
    pdf = pd.concat(frames, ignore_index=True)
    for chunk, part in pdf.groupby("__chunk", sort=True):
        part = part.reset_index(drop=True)
        if not _in_run_order(part[run], part[pos]):
            part = part.sort_values([run, pos], kind="stable", na_position="first").reset_index(drop=True)
            if part.duplicated([run, pos]).any():
                raise ValueError(f"({run}, {pos}) is repeated; it must identify a row")
        yield int(chunk), part


def _in_run_order(runs: pd.Series, positions: pd.Series) -> bool:
    """True when each run's rows are contiguous and ascending in ``pos``.

    Spark hands the rows over sorted by (run, pos); this O(n) check lets
    the chunk skip a second sort in pandas and keeps the order as Spark
    sorted it (runs in Spark's order)."""
    if len(runs) < 2:
        return True
    codes, _ = pd.factorize(runs, use_na_sentinel=False)
    if (np.diff(codes) < 0).any():
        return False
    same = codes[1:] == codes[:-1]
    step = np.diff(positions.to_numpy())
    return bool((step[same] > 0).all())


def _same_run(a, b) -> bool:
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return a == b


class _Summary:
    """What a stretch of neighbouring chunks does to the state of the run that enters it.

    ``single``: it holds rows of one run only.  ``steps`` and ``first_fresh`` are the
    outcome of its first run's rows for an open batch that comes in, and for none;
    ``last_fresh`` is the state in which its last run leaves it (of ``first_fresh`` if single)."""

    def __init__(self, chunk, single, first_run, last_run, first_fresh, last_fresh, steps):
        self.chunk, self.single, self.first_run, self.last_run = int(chunk), bool(single), first_run, last_run
        self.first_fresh, self.last_fresh = (tuple(int(x) for x in f) for f in (first_fresh, last_fresh))
        self.steps = steps

    @classmethod
    def read(cls, frame: pd.DataFrame) -> list[_Summary]:
        """The summaries of a frame in chunk order."""
        rows = frame.sort_values("chunk").itertuples(index=False)
        return [
            cls(r.chunk, r.single, r.first_run, r.last_run, r.first_fresh, r.last_fresh, tuple(np.asarray(x, np.int64) for x in (r.thr, r.depth, r.out_c, r.out_r)))
            for r in rows
        ]

    def row(self) -> dict:
        thr, depth, out_c, out_r = (list(x) for x in self.steps)
        return {
            "chunk": self.chunk, "single": self.single, "first_run": self.first_run, "last_run": self.last_run, "first_fresh": list(self.first_fresh),
            "last_fresh": list(self.last_fresh), "thr": thr, "depth": depth, "out_c": out_c, "out_r": out_r,
        }


def _then(first, second, cap: int):
    """The step function of two stretches of one run, one after the other."""
    thr, depth, out_c, out_r = (np.asarray(x, np.int64) for x in first)
    thr2, depth2, c2, r2 = (np.asarray(x, np.int64) for x in second)
    opens = depth > 0
    # where the first stretch opens a batch, it leaves one fill, whatever came in
    k = np.searchsorted(thr2, cap - out_c[opens], side="right") - 1
    more = depth2[k] > 0
    parts = [(thr[opens], depth[opens] + depth2[k], np.where(more, c2[k], out_c[opens] + c2[k]), np.where(more, r2[k], out_r[opens] + r2[k]))]
    for t, total, rows in zip(thr[~opens], out_c[~opens], out_r[~opens], strict=True):
        # it opens none: the second one sees the room less the first one's tokens
        j = max(0, int(np.searchsorted(thr2, t - total, side="right")) - 1)
        more = depth2[j:] > 0
        parts.append((np.maximum(thr2[j:] + total, t), depth2[j:], np.where(more, c2[j:], total + c2[j:]), np.where(more, r2[j:], rows + r2[j:])))
    made = [np.concatenate(x) for x in zip(*parts, strict=True)]
    new = np.ones(len(made[0]), bool)
    new[1:] = (np.diff(made[1]) != 0) | (np.diff(made[2]) != 0) | (np.diff(made[3]) != 0)
    return tuple(x[new] for x in made)


def _walk(members: list[_Summary], state, total: int | None, cap: int):
    """Forward and back over neighbours: each member's incoming state, and the total
    batches of the run that it starts in and of the one that it ends in.

    ``state`` comes in to the first member, ``total`` is that of the last member's last run (None: it ends there)."""
    ins, firsts, outs, continues = [], [], [], []
    run = None
    for k, m in enumerate(members):
        goes_on = k > 0 and _same_run(m.first_run, run)
        ins.append(state if k == 0 or goes_on else (0, 0, 0))
        continues.append(goes_on)
        firsts.append(_step(m.steps, ins[-1], m.first_fresh, cap))
        state = firsts[-1] if m.single else m.last_fresh
        outs.append(state)
        run = m.last_run
    totals = [0] * len(members)
    for k in range(len(members) - 1, -1, -1):
        if k == len(members) - 1:
            totals[k] = outs[k][0] if total is None else total
        elif continues[k + 1]:
            totals[k] = totals[k + 1] if members[k + 1].single else firsts[k + 1][0]
        else:
            totals[k] = outs[k][0]
    return ins, [t if m.single else f[0] for m, f, t in zip(members, firsts, totals, strict=True)], totals, outs


def _compose(members: list[_Summary], chunk: int, cap: int) -> _Summary:
    """One summary of neighbouring members."""
    head = members[0]
    steps, fresh, single, at = head.steps, head.first_fresh, head.single, 1
    while single and at < len(members) and _same_run(members[at].first_run, head.first_run):
        fresh = _step(members[at].steps, fresh, members[at].first_fresh, cap)
        steps, single, at = _then(steps, members[at].steps, cap), members[at].single, at + 1
    last = _walk(members, (0, 0, 0), None, cap)[3][-1]
    return _Summary(chunk, single and at == len(members), head.first_run, members[-1].last_run, fresh, last, steps)


def _step(steps, state, fresh, cap):
    b, c, r = state
    if b == 0:
        return fresh
    thr, depth, out_c, out_r = steps
    k = int(np.searchsorted(thr, cap - c, side="right")) - 1
    if depth[k] == 0:
        return (b, c + int(out_c[k]), r + int(out_r[k]))
    return (b + int(depth[k]), int(out_c[k]), int(out_r[k]))


# --------------------------------------------------------------- operator
def _label_schema(run_type: T.DataType, pos_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("__run", run_type),
            T.StructField("__pos", pos_type),
            T.StructField("batch_no", T.LongType()),
            T.StructField("batch_idx", T.LongType()),
            T.StructField("total_batches", T.LongType()),
        ]
    )


def _label_chunk(part: pd.DataFrame, cap, run, pos, tok, state=(0, 0, 0), first_total=None, last_total=None) -> pd.DataFrame:
    """Labels of one chunk's rows, given what it gets from the chunks before and after."""
    segs = _segments(part[run])
    toks = part[tok].to_numpy(dtype=np.int64)
    out_batch, out_idx, out_total = (np.empty(len(part), dtype=np.int64) for _ in range(3))
    for si, (a, e) in enumerate(segs):
        batch, idx, out = _label_segment(toks[a:e], cap, state if si == 0 else (0, 0, 0))
        total = out[0]
        if si == 0 and first_total is not None:
            total = first_total
        elif si == len(segs) - 1 and last_total is not None:
            total = last_total
        out_batch[a:e] = batch
        out_idx[a:e] = idx
        out_total[a:e] = total
    return pd.DataFrame(
        {"__run": part[run], "__pos": part[pos], "batch_no": out_batch, "batch_idx": out_idx, "total_batches": out_total}
    )


def _make_labeller(cap, run, pos, tok):
    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, part in _read_chunks(batches, run, pos):
            yield _label_chunk(part, cap, run, pos, tok)

    return label


_PLAN_SCHEMA = "__chunk long, b long, c long, r long, first_total long, last_total long"


def _plan_frame(members: list[_Summary], state, total: int | None, cap: int) -> pd.DataFrame:
    ins, firsts, lasts, _ = _walk(members, state, total, cap)
    rows = [(m.chunk, *s, f, t) for m, s, f, t in zip(members, ins, firsts, lasts, strict=True)]
    return pd.DataFrame(rows, columns=["__chunk", "b", "c", "r", "first_total", "last_total"]).astype("int64")


def _make_composer(cap, fan_in):
    """Summaries of one group to the group's summary."""

    def compose(frame: pd.DataFrame) -> pd.DataFrame:
        members = _Summary.read(frame)
        return pd.DataFrame([_compose(members, members[0].chunk // fan_in, cap).row()])

    return compose


def _make_root(cap):
    """The last group: nothing comes in, and its last run ends in it."""
    return lambda frame: _plan_frame(_Summary.read(frame), (0, 0, 0), None, cap)


def _make_expander(cap):
    """What a group got from above, handed on to its members."""

    def expand(frame: pd.DataFrame, plan: pd.DataFrame) -> pd.DataFrame:
        got = plan.iloc[0]
        return _plan_frame(_Summary.read(frame), (int(got["b"]), int(got["c"]), int(got["r"])), int(got["last_total"]), cap)

    return expand


def _plan_tree(summaries: DataFrame, chunks: int, cap: int, fan_in: int) -> DataFrame:
    """Summaries of ``chunks`` chunks to each chunk's incoming state and totals, by composing neighbours level by level."""
    levels = [summaries]
    group = F.floor(F.col("chunk") / fan_in).cast("long").alias("__group")
    while chunks > fan_in:
        above = levels[-1].groupBy(group).applyInPandas(_make_composer(cap, fan_in), summaries.schema)
        levels.append(stage_table(above, "batch-summaries"))
        chunks = -(-chunks // fan_in)
    plan = levels.pop().groupBy(F.lit("root")).applyInPandas(_make_root(cap), _PLAN_SCHEMA)
    while levels:
        below = levels.pop().groupBy(group)
        plan = below.cogroup(stage_table(plan, "batch-plan").groupBy(F.col("__chunk").alias("__group"))).applyInPandas(_make_expander(cap), _PLAN_SCHEMA)
    return plan


def _make_chunk_labeller(cap, run, pos, tok):
    def label(part: pd.DataFrame, plan: pd.DataFrame) -> pd.DataFrame:
        if part.empty:
            return pd.DataFrame(columns=["__run", "__pos", "batch_no", "batch_idx", "total_batches"])
        row = plan.iloc[0]
        (_, part), = _read_chunks(iter([part]), run, pos)
        return _label_chunk(
            part, cap, run, pos, tok, (int(row["b"]), int(row["c"]), int(row["r"])), int(row["first_total"]), int(row["last_total"])
        )

    return label


def _summary_schema(run_type: T.DataType) -> T.StructType:
    longs = T.ArrayType(T.LongType())
    return T.StructType(
        [
            T.StructField("chunk", T.LongType()),
            T.StructField("single", T.BooleanType()),
            T.StructField("first_run", run_type),
            T.StructField("last_run", run_type),
            T.StructField("first_fresh", longs),
            T.StructField("last_fresh", longs),
            T.StructField("thr", longs),
            T.StructField("depth", longs),
            T.StructField("out_c", longs),
            T.StructField("out_r", longs),
        ]
    )


def _make_summariser(cap, run, pos, tok):
    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        for chunk, part in _read_chunks(batches, run, pos):
            segs = _segments(part[run])
            toks = part[tok].to_numpy(dtype=np.int64)
            a, e = segs[0]
            first = toks[a:e]
            _, _, first_fresh = _label_segment(first, cap, (0, 0, 0))
            steps = _step_function(first, cap)
            if len(segs) > 1:
                la, le = segs[-1]
                _, _, last_fresh = _label_segment(toks[la:le], cap, (0, 0, 0))
            else:
                last_fresh = first_fresh
            runs = part[run]
            rows.append(_Summary(chunk, len(segs) == 1, runs.iloc[a], runs.iloc[segs[-1][0]], first_fresh, last_fresh, steps).row())
        if rows:
            yield pd.DataFrame(rows)

    return summarise


def oversized_rows(df: DataFrame, cap: int, tokens: str = "tokens") -> DataFrame:
    """Rows that are never batched: their own token count exceeds ``cap`` or is unknown (NULL)."""
    return df.filter(F.col(tokens).isNull() | (F.col(tokens) > F.lit(cap)))


def drop_oversized(df: DataFrame, cap: int, tokens: str = "tokens") -> tuple[DataFrame, DataFrame]:
    """``(kept, oversized)``: rows that can be batched and rows set aside."""
    return df.filter(F.col(tokens) <= F.lit(cap)), oversized_rows(df, cap, tokens)


def chunk_count(rows: int, rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> int:
    """Chunks of a table: of ``rows_per_chunk`` rows, or of the root of its rows once that is more,
    so a table of 100 times the rows has at most 10 times the chunks from there on."""
    return max(1, math.ceil(rows / max(rows_per_chunk, math.isqrt(rows))))


def assign_batches(
    df: DataFrame,
    cap: int,
    tokens: str = "tokens",
    run: str = "run",
    pos: str = "pos",
    rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK,
    stage: bool = True,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """Label each row that fits (``tokens <= cap``) with its batch.

    Adds ``batch_no`` (1-based within the run), ``batch_idx`` (0-based
    position inside the batch) and ``total_batches`` (batches in the run).
    ``(run, pos)`` must identify a row: a NULL ``pos`` or a repeated pair raises
    ``ValueError`` (inside a task, where Spark reports it as the job's failure).
    ``tokens`` must be >= 0; rows with NULL tokens are not batched but
    reported by :func:`oversized_rows`.
    Inputs of more than ``rows_per_chunk`` rows are cut into chunks of that many,
    or of the root of the number of rows if that is more; ``fan_in`` (2 or more)
    neighbouring summaries meet in a task.
    ``stage=False`` skips the Parquet copy of the input (the input plan is
    then evaluated twice: once for the labels, once for the join back).
    """
    if cap < 0:
        raise ValueError("cap must be >= 0")
    if fan_in < 2:
        raise ValueError("fan_in must be >= 2")
    spark = df.sparkSession
    fits = df.filter(F.col(tokens) <= F.lit(cap))
    if stage:
        # one written copy feeds the row count, the narrow labelling input
        # (column-pruned read) and the join back; the upstream plan runs once
        fits = stage_table(fits, "batch-input")
    narrow = fits.select(F.col(run), F.col(pos), F.col(tokens).cast("long").alias(tokens))
    run_type = narrow.schema[run].dataType
    pos_type = narrow.schema[pos].dataType
    schema = _label_schema(run_type, pos_type)

    n, known = narrow.agg(F.count(F.lit(1)), F.count(pos)).first()
    if known < n:
        raise ValueError(f"{n - known} rows have no {pos!r}; it must identify a row of its run")
    if n <= rows_per_chunk:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
        keyed = (
            narrow.repartition(parts, run)
            .withColumn("__chunk", F.spark_partition_id().cast("long"))
            .sortWithinPartitions(run, pos)
        )
        labels = keyed.mapInPandas(_make_labeller(cap, run, pos, tokens), schema)
    else:
        k = chunk_count(n, rows_per_chunk)
        ranged = (
            narrow.repartitionByRange(k, F.col(run).asc_nulls_first(), F.col(pos).asc())
            .sortWithinPartitions(run, pos)
            .withColumn("__chunk", F.spark_partition_id().cast("long"))
        )
        # both passes must see identical chunks: materialise them once
        ranged = cut_lineage(ranged)
        summaries = stage_table(
            ranged.mapInPandas(_make_summariser(cap, run, pos, tokens), _summary_schema(run_type)), "batch-summaries"
        )
        walked = _plan_tree(summaries, k, cap, fan_in)
        labels = ranged.groupBy("__chunk").cogroup(walked.groupBy("__chunk")).applyInPandas(
            _make_chunk_labeller(cap, run, pos, tokens), schema
        )

    cond = (F.col(run).eqNullSafe(F.col("__run"))) & (F.col(pos) == F.col("__pos"))
    return fits.join(labels, cond, "inner").drop("__run", "__pos")


def batch_items(batched: DataFrame, run: str = "run") -> DataFrame:
    """Add the batch file name ``{batch_no}of{total_batches}.json``."""
    return batched.withColumn("file_name", batch_file_name("batch_no", "total_batches"))


def batch_stats(batched: DataFrame, tokens: str = "tokens", run: str = "run") -> DataFrame:
    """Rows and tokens per batch (tokens must be <= cap), with its file name."""
    return batched.groupBy(run, "batch_no", "total_batches").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(tokens).cast("long").alias("batch_tokens"),
    ).withColumn("file_name", batch_file_name("batch_no", "total_batches"))


__all__ = [
    "assign_batches",
    "chunk_count",
    "oversized_rows",
    "drop_oversized",
    "batch_items",
    "batch_stats",
    "DEFAULT_ROWS_PER_CHUNK",
]
