"""Conversation structure repair: cheapest edits by auction shortest paths.

A conversation is a row of turns.  Keeping a row costs 0, a new role 3, deleting
a row 4 and inserting an empty turn 3; blank and repeated rows have to go, and a
truncated row that stays costs 3 more.  The roles that are left have to read
``(s?(ua)+)?`` by their initials.  Costs are integers on a lattice of (row, state)
nodes, where the state is what the roles so far end in.

Blocks of rows are solved by Bertsekas' auction: a path starts at an entry of the
block and grows along its cheapest arc while the node's price holds; where the
price is below the best arc, the price is raised to it and the path gives up its
last node.  When the path reaches the exit, the prices are a dual solution
(price <= arc + next price everywhere), so an arc lies on a shortest path only if it is
tight.  The least letters along tight arcs that lead to the exit are the
ASCII-least audit: D(elete), I(nsert), K(eep), R(erole).

At scale: rows are reduced to a class of one letter and sorted by conversation and
turn over range partitions, so a conversation with a third of all rows is dealt to
many tasks.  Each task works from its last block back to its first; what a
conversation that crosses partitions costs from each state to each state is put
together per conversation from one matrix of 4 x 4 numbers a partition (never more
than there are partitions), then every piece is traced on its own.  Only the
digest and the audit string, which are one value for a conversation, need its rows
in order in one task; they stream by, one at a time.

Nulls in the conversation, turn, role or text are fine: null turns come first, null
conversations are one conversation, a null role or text counts as one space.
Rows of equal turn are ordered by role and text; rows equal in all of them are
repeats of the first.  An empty table gives an empty table.  Other columns of the
input, whatever their names, are left alone and not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import stage_table

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: nothing yet, after system, after user, after assistant.
STATES = 4
#: The role that comes next by state, and the state after it.
NEXT = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
KEEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: What is left to pay after the last row by state, and the edits that it takes.
TAIL, TAIL_EDITS = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")
#: Pairs of neighbouring initials that are in order.
LEGAL = frozenset(("su", "ua", "au"))
#: Rows of a block; solved blocks that a worker remembers (a block's answer depends on its letters alone).
BLOCK, REMEMBERED = 16, 1 << 15
INF = float("inf")


def arcs(row: int, state: int, classes: str) -> Iterator[tuple[str, int, int, int]]:
    """(edit, cost, row, state) of the arcs that leave a node.

    Classes: ``x`` has to go; else the initial of the role (``o``: another one), as a capital if truncated."""
    c = classes[row]
    yield "D", DELETE, row + 1, state
    role, after = NEXT[state]
    yield "I", INSERT, row, after
    if c != "x":
        extra = TRUNCATED if c.isupper() else 0
        kept = KEEPS.get((state, c.lower()))
        if kept is not None:
            yield "K", extra, row + 1, kept
        yield "R", REROLE + extra, row + 1, after


def auction(classes: str, ends: tuple[float, ...]) -> list[list[float]]:
    """Dual prices of a block's nodes after every entry has been connected to the exit.

    ``ends`` is what each state pays from the block's end on (infinite: no way).  Prices of entries are exact."""
    n = len(classes)
    out = [[list(arcs(r, s, classes)) for s in range(STATES)] for r in range(n)]
    # nodes without a way to the exit are left out: their prices would rise for ever
    price = [[INF] * STATES for _ in range(n)] + [list(ends)]
    for r in range(n - 1, -1, -1):
        for _ in range(STATES):
            for s in range(STATES):
                if any(price[i][j] < INF for _, _, i, j in out[r][s]):
                    price[r][s] = 0
    for entry in range(STATES):
        if price[0][entry] == INF:
            continue
        path = [(0, entry)]
        while path[-1][0] < n:
            r, s = path[-1]
            best, at = min((cost + price[i][j], (i, j)) for _, cost, i, j in out[r][s])
            if price[r][s] < best:
                price[r][s] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(at)
    return price


@lru_cache(maxsize=REMEMBERED)
def solve(classes: str, ends: tuple[float, ...]) -> tuple[tuple[float, ...], tuple]:
    """Prices of a block's entries and, by entry, the least edits among the cheapest and the state they end in."""
    n, price = len(classes), auction(classes, ends)
    # tight arcs, and the nodes from which they lead to the exit
    leads = [[False] * STATES for _ in range(n)] + [[e < INF for e in ends]]
    tight: dict[tuple[int, int], list] = {}
    for r in range(n - 1, -1, -1):
        for s in range(STATES):
            tight[r, s] = sorted(a for a in arcs(r, s, classes) if price[r][s] < INF and price[r][s] == a[1] + price[a[2]][a[3]])
        for _ in range(STATES):  # an insert stays in its row
            for s in range(STATES):
                leads[r][s] = any(leads[i][j] for _, _, i, j in tight[r, s])
    traces = []
    for entry in range(STATES):
        r, s, edits = 0, entry, []
        if not leads[0][entry]:
            traces.append(None)
            continue
        while r < n:
            edit, _, r, s = next(a for a in tight[r, s] if leads[a[2]][a[3]])
            edits.append(edit)
        traces.append(("".join(edits), s))
    return tuple(price[0]), tuple(traces)


def _based(ends: tuple[float, ...]) -> tuple[tuple[float, ...], float]:
    """Ends less their least, so that equal blocks at different distances are solved once."""
    least = min(ends)
    return tuple(e - least for e in ends), least


def entry_prices(classes: str, ends: tuple[float, ...]) -> list[tuple[float, ...]]:
    """What each state has to pay from the start of every block on, and from the end on."""
    out = [ends]
    for at in reversed(range(0, len(classes), BLOCK)):
        based, least = _based(out[-1])
        out.append(tuple(p + least for p in solve(classes[at : at + BLOCK], based)[0]))
    return out[::-1]


def matrix(classes: str) -> list[float]:
    """Cheapest way from each state (rows) to each state (columns) over a piece."""
    columns = [entry_prices(classes, tuple(0 if s == e else INF for s in range(STATES)))[0] for e in range(STATES)]
    return [columns[e][s] for s in range(STATES) for e in range(STATES)]


def trace(classes: str, ends: tuple[float, ...], entry: int) -> tuple[str, int, float]:
    """Edits of a piece from a state, the state after it, and what is left to pay at its start."""
    prices, edits, state = entry_prices(classes, ends), [], entry
    for k, at in enumerate(range(0, len(classes), BLOCK)):
        made, state = solve(classes[at : at + BLOCK], _based(prices[k + 1])[0])[1][state]
        edits.append(made)
    return "".join(edits), state, prices[0][entry]


def repaired(edits: str, state: int, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of what the edits leave of the rows, from a state on."""
    for e in edits:
        role, text = next(rows) if e != "I" else ("", "")
        if e == "D":
            continue
        if e != "K":
            role = NEXT[state][0]
        state = KEEPS[state, role[:1]]
        yield e, role, text


# -- the distributed part -------------------------------------------------

_KEY = "conv string, turn long, role string, digest binary, id long"
_PIECE = (
    "conv string, part int, classes string, first_initial string, last_initial string, first_turn long, last_turn long, "
    "low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, turn long, role string, digest binary, id long"
)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn to one row a conversation, within a partition."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    now, made = None, []

    def close(p):
        p["classes"] = "".join(p["classes"])
        return p

    for batch in batches:
        for r in batch.to_pylist():
            if now is None or now["conv"] != r["conv"]:
                if now is not None:
                    made.append(close(now))
                now = {"conv": r["conv"], "part": part, "classes": [], "first_initial": r["initial"], "last_initial": None, "first_turn": r["turn"], "last_turn": None, "low": None, "high": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turn": r["turn"], "role": r["role"], "digest": r["digest"], "id": r["id"]}
            turn, initial = r["turn"], r["initial"]
            if turn is not None and turn != now["last_turn"]:
                now["turns"] += 1
                now["low"] = turn if now["low"] is None else now["low"]
                now["high"] = turn
            now["last_turn"] = turn
            for copy in range(r["copies"]):
                if now["last_initial"] is not None and now["last_initial"] + initial not in LEGAL:
                    now["illegal"] += 1
                now["last_initial"] = initial
                fault = "blank" if r["blank"] else "duplicate" if copy or not r["is_first"] else "truncated" if r["truncated"] else None
                if fault:
                    now[fault] += 1
                kind = initial if initial in ("s", "u", "a") else "o"
                now["classes"].append("x" if fault in ("blank", "duplicate") else kind.upper() if fault else kind)
        if len(made) >= 1000:
            yield _table(made, _PIECE)
            made = []
    if now is not None:
        made.append(close(now))
    if made:
        yield _table(made, _PIECE)


def _table(rows: list[dict], ddl: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}
    fields = [f.strip().split(" ") for f in ddl.split(",")]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([(n, kinds[k]) for n, k in fields]))


def _join_counts(rows: pd.DataFrame) -> dict:
    """Counts of a conversation from its pieces in order."""
    out = {k: int(rows[k].sum()) for k in ("blank", "duplicate", "truncated", "illegal", "turns")}
    low, high = rows["low"].min(), rows["high"].max()
    for before, after in zip(rows.iloc[:-1].to_dict("records"), rows.iloc[1:].to_dict("records"), strict=True):
        out["illegal"] += before["last_initial"] + after["first_initial"] not in LEGAL
        out["turns"] -= before["last_turn"] == after["first_turn"] and not pd.isna(before["last_turn"])
    out["gaps"] = 0 if pd.isna(low) else int(high - low + 1 - out["turns"])
    return out


def _split_audits(pieces: DataFrame) -> DataFrame:
    """Audits of conversations that cross partitions: matrices meet per conversation, pieces are traced apart."""

    def matrices(batches):
        for batch in batches:
            rows = batch.to_pylist()
            yield _table([{"conv": r["conv"], "part": r["part"], "matrix": matrix(r["classes"])} for r in rows], "conv string, part int, matrix array<double>")

    def ends(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        made, price = [], list(map(float, TAIL))
        for m in reversed(rows["matrix"].tolist()):
            made.append(list(price))
            price = [min(m[STATES * s + e] + price[e] for e in range(STATES)) for s in range(STATES)]
        return pd.DataFrame({"conv": rows["conv"], "part": rows["part"], "ends": made[::-1]})

    def traces(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ways = [trace(r["classes"], tuple(r["ends"]), s) for s in range(STATES)]
                out.append({"conv": r["conv"], "part": r["part"], "audits": [w[0] for w in ways], "states": [w[1] for w in ways], "cost": [w[2] for w in ways]})
            yield _table(out, "conv string, part int, audits array<string>, states array<int>, cost array<double>")

    def entries(rows: pd.DataFrame) -> pd.DataFrame:
        rows, state, made = rows.sort_values("part"), 0, []
        for states in rows["states"]:
            made.append(state)
            state = int(states[state])
        costs = [int(c) for c in rows["cost"].iloc[0][:1]] + [None] * (len(rows) - 1)
        return pd.DataFrame({"conv": rows["conv"], "part": rows["part"], "entry": made, "last": [False] * (len(rows) - 1) + [True], "state": [state] * len(rows), "cost": costs})

    where = pieces.select("conv", "part", "classes").mapInArrow(matrices, "conv string, part int, matrix array<double>")
    where = where.groupBy("conv").applyInPandas(ends, "conv string, part int, ends array<double>")
    ways = stage_table(
        pieces.select("conv", "part", "classes").join(where, ["conv", "part"]).mapInArrow(traces, "conv string, part int, audits array<string>, states array<int>, cost array<double>"),
        "repair-ways",
    )
    chosen = ways.select("conv", "part", "states", "cost").groupBy("conv").applyInPandas(entries, "conv string, part int, entry int, last boolean, state int, cost long")
    tail = F.when(F.col("last"), F.element_at(F.array(*map(F.lit, TAIL_EDITS)), F.col("state") + 1)).otherwise("")
    return ways.drop("cost").join(chosen, ["conv", "part"]).select(
        "conv", "part", F.concat(F.element_at("audits", F.col("entry") + 1), tail).alias("audit"), F.col("entry").alias("state"), F.col("cost")
    )


def _whole_audits(pieces: DataFrame) -> DataFrame:
    """Audits of conversations that lie in one partition."""

    def run(batches):
        for batch in batches:
            out = []
            for conv, part, classes in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                edits, state, cost = trace(classes, TAIL, 0)
                out.append({"conv": conv, "part": part, "audit": edits + TAIL_EDITS[state], "state": 0, "cost": int(cost)})
            yield _table(out, "conv string, part int, audit string, state int, cost long")

    return pieces.select("conv", "part", "classes").mapInArrow(run, "conv string, part int, audit string, state int, cost long")


_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long"


def _counts(pieces: DataFrame, split: DataFrame) -> DataFrame:
    """Counts by conversation; those of pieces are joined where there are several."""
    names = [f.split(" ")[0] for f in _COUNTS.split(", ")]
    narrow = pieces.drop("classes", "turn", "role", "digest", "id")
    one = narrow.join(split, "conv", "left_anti").withColumn("gaps", F.coalesce(F.expr("high - low + 1 - turns"), F.lit(0)))
    many = narrow.join(split, "conv", "left_semi").groupBy("conv").applyInPandas(
        lambda rows: pd.DataFrame([{"conv": rows["conv"].iloc[0], **_join_counts(rows.sort_values("part"))}])[["conv", *names]], f"conv string, {_COUNTS}"
    )
    return one.select("conv", *names).union(many)


def _streamed(rows_out: bool):
    """Streams a partition in which each piece's audit stands before its rows, as digests or as repaired rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conv, made = None, None, []

        def left(lines, position):
            """Takes rows one by one (sent in) and writes what the edits leave of them."""
            for edit, role, text in lines:
                if rows_out:
                    made.append({"conv": conv, "position": position[0], "edit": edit, "role": role, "text": text})
                else:
                    position[1].update((b"\n" if position[0] else b"") + f"{role}:{text}".encode())
                position[0] += 1

        class Feed:
            """Edits of a piece, applied as its rows come."""

            def __init__(self, edits, state, position):
                self.edits, self.at, self.state, self.position = edits, 0, state, position

            def inserts(self):
                end = self.at
                while end < len(self.edits) and self.edits[end] == "I":
                    end += 1
                self.apply(end, iter(()))

            def apply(self, end, rows):
                for edit, role, text in (lines := list(repaired(self.edits[self.at : end], self.state, rows))):
                    self.state = KEEPS[self.state, role[:1]]
                left(lines, self.position)
                self.at = end

            def row(self, role, text):
                self.inserts()
                self.apply(self.at + 1, iter([(role, text)]))

        position, audit = None, []

        def close():
            if now is not None:
                now.inserts()
                if not rows_out:
                    made.append({"conv": conv, "audit": "".join(audit), "sha256": position[1].hexdigest()})

        ddl = "conv string, position long, edit string, role string, text string" if rows_out else "conv string, audit string, sha256 string"
        for batch in batches:
            for r in batch.to_pylist():
                if r["audit"] is not None:
                    if conv is None or r["conv"] != conv:
                        if now is not None:
                            close()
                        conv, audit, position = r["conv"], [], [0, hashlib.sha256()]
                    elif now is not None:
                        now.inserts()
                    audit.append(r["audit"])
                    now = Feed(r["audit"], r["state"], position)
                else:
                    for _ in range(r["copies"]):
                        now.row(r["shown_role"], r["text"])
            if len(made) >= 256:
                yield _table(made, ddl)
                made.clear()
        close()
        if made:
            yield _table(made, ddl)

    return run


class Repair:
    """Repair of all conversations of a table; ``digests()`` and ``rows()`` are its results.

    ``copies_col`` (optional) tells how many times a row stands there, one after the other."""

    def __init__(self, rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies_col: str | None = None):
        # a null conversation is told from every other by the mark in front
        conv = F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("-"))
        role, text = F.coalesce(F.col(role_col), F.lit(" ")), F.coalesce(F.col(text_col), F.lit(" "))
        base = rows.select(
            conv.alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"),
            (F.col(copies_col).cast("int") if copies_col else F.lit(1)).alias("copies"), F.monotonically_increasing_id().alias("id"),
        )
        self.rows_in = stage_table(
            base.withColumn("digest", F.unhex(F.sha2(F.concat_ws("\0", F.length("conv").cast("string"), "conv", F.length("role").cast("string"), "role", "text"), 256))),
            "repair-rows",
        )
        self.schema_of_conv = rows.schema[conv_col].dataType
        key = ["conv", "turn", "role", "digest", "id"]
        firsts = self.rows_in.groupBy("digest").agg(F.min(F.struct("turn", "id")).alias("first")).select(F.col("first.id").alias("id"), F.lit(True).alias("is_first"))
        narrow = self.rows_in.select(
            *key, "copies", F.substring("role", 1, 1).alias("initial"),
            (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
            (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
        ).join(firsts, "id", "left").withColumn("is_first", F.coalesce("is_first", F.lit(False)))
        ordered = narrow.select(*key, "copies", "initial", "blank", "truncated", "is_first").repartitionByRange(*key).sortWithinPartitions(*key)
        self.pieces = stage_table(ordered.mapInArrow(_pieces, _PIECE), "repair-pieces")
        # at most one conversation crosses each border between partitions
        self.split = self.pieces.groupBy("conv").count().where("count > 1").select("conv")
        whole, many = self.pieces.join(self.split, "conv", "left_anti"), self.pieces.join(self.split, "conv", "left_semi")
        self.audits = stage_table(_whole_audits(whole).union(_split_audits(many).select("conv", "part", "audit", "state", "cost")), "repair-audits")

    def _stream(self, rows_out: bool, ddl: str) -> DataFrame:
        heads = self.audits.join(self.pieces.select("conv", "part", "turn", "role", "digest", "id"), ["conv", "part"])
        key = ["conv", "turn", "role", "digest", "id"]
        nothing = lambda kind, name: F.lit(None).cast(kind).alias(name)
        both = heads.select(*key, "audit", "state", nothing("int", "copies"), nothing("string", "shown_role"), nothing("string", "text")).union(
            self.rows_in.select(*key, nothing("string", "audit"), nothing("int", "state"), "copies", F.col("role").alias("shown_role"), "text")
        )
        # an audit stands before the first row of its piece, whose key it has
        return both.repartition("conv").sortWithinPartitions(*key, F.col("audit").isNull()).drop("turn", "role", "digest", "id").mapInArrow(_streamed(rows_out), ddl)

    def _named(self, out: DataFrame, conv_col: str) -> DataFrame:
        conv = F.when(F.col("conv") != "-", F.substring("conv", 2, 1 << 30)).cast(self.schema_of_conv)
        return out.select(conv.alias(conv_col), *[c for c in out.columns if c != "conv"])

    def digests(self, conv_col: str = "conv_id") -> DataFrame:
        """Per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 (of ``role:text`` lines)."""
        cost = self.audits.where("cost IS NOT NULL").select("conv", "cost")
        counts = _counts(self.pieces, self.split).join(cost, "conv")
        made = self._stream(False, "conv string, audit string, sha256 string").withColumnRenamed("sha256", "repaired_sha256")
        return self._named(counts.join(made, "conv"), conv_col)

    def rows(self, conv_col: str = "conv_id") -> DataFrame:
        """The repaired conversations: conversation, position (from 0), edit, role and text."""
        return self._named(self._stream(True, "conv string, position long, edit string, role string, text string"), conv_col)


def cheapest_edits(classes: str) -> tuple[str, float]:
    """Audit and cost of one conversation given by its classes."""
    edits, state, cost = trace(classes, TAIL, 0)
    return edits + TAIL_EDITS[state], cost


__all__ = ["Repair", "cheapest_edits", "matrix", "trace", "solve"]
