"""Periodic runs of words: Lyndon arrays by Baier's grouping, roots extended into runs.

A run is a stretch of words with smallest period q that no neighbour extends.
Every run holds a longest Lyndon word of length q under one of two orders, the
order of the words or its reverse.  Phase one of Baier's suffix sorter groups
suffixes by their Lyndon prefixes: groups are taken from the greatest down, each
member looks for the nearest smaller suffix on its left, and that parent's
prefix grows by the group's.  A group's context, when its turn comes, is the
longest Lyndon word at each of its members, so the Lyndon array falls out of the
phase itself; no suffix array is made.  Each Lyndon root is then extended to both
sides by longest common extensions, and a result of enough periods is a run.

Runs asked for have ``min_periods`` periods (4 by default).  Inside such a run
every three neighbouring words come back min_periods - 1 times in the same text, so
stretches of words whose triples are rarer hold no run and are left out first, exactly.

All work on a text is linear or n log n in its words and happens in the scan's
own task.  A null, empty or blank text has no words: no runs, and an empty
collapsed text.  Every row gives one row, so repeated rows and ids are kept; an empty
table gives an empty table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tidewater.llm.common import map_texts

#: Words that one comparison of an extension starts with.
FIRST_STRIDE = 32


def lyndon_lengths(symbols: list[int], count: int) -> list[int]:
    """Length of the longest Lyndon word at each place, by phase one of Baier's suffix sorter.

    ``symbols`` are ranks below ``count``; the end is smaller than all of them.
    """
    n = len(symbols)
    group = [*symbols, 0]  # of each place, -1 once its group is done; the last entry stops searches at place -1
    members: list[list[int]] = [[] for _ in range(count)]
    for i, s in enumerate(symbols):
        members[s].append(i)
    length = [1] * count
    below, above = list(range(-1, count - 1)), [*range(1, count), -1]
    smaller, out = [0] * n, [0] * n
    now = count - 1
    while now >= 0:
        here = [i for i in members[now] if group[i] == now]
        members[now] = []
        if here:
            here.sort()
            size = length[now]
            children: dict[int, int] = {}
            for i in here:
                group[i] = -1
                out[i] = size
                p = i - 1
                while group[p] < 0:
                    p = smaller[p]
                smaller[i] = p
                if p >= 0:
                    children[p] = children.get(p, 0) + 1
            # a parent's prefix w grows to w a^m: above w, by m
            grown: dict[tuple[int, int], list[int]] = {}
            for p, m in children.items():
                grown.setdefault((group[p], m), []).append(p)
            for g, m in sorted(grown, reverse=True):
                new = len(members)
                members.append(grown[g, m])
                length.append(length[g] + m * size)
                up = above[g]
                # taken from the greatest m down, each lands right above w and below the one before
                above[g] = new
                below.append(g)
                above.append(up)
                if up >= 0:
                    below[up] = new
                for p in grown[g, m]:
                    group[p] = new
        now = below[now]
    return out


def common_extension(words: np.ndarray, a: int, b: int) -> int:
    """Longest common prefix of ``words[a:]`` and ``words[b:]`` for a < b, by doubling strides."""
    n, done, stride = len(words), 0, FIRST_STRIDE
    while b + done < n:
        k = min(stride, n - b - done)
        differ = words[a + done : a + done + k] != words[b + done : b + done + k]
        if differ.any():
            return done + int(differ.argmax())
        done, stride = done + k, stride * 2
    return done


def runs_in(symbols: np.ndarray, min_length: int, min_periods: int) -> set[tuple[int, int, int]]:
    """(start, length, period) of every run in a stretch of words given as numbers."""
    _, ranks = np.unique(symbols, return_inverse=True)
    n, count = len(ranks), int(ranks.max()) + 1
    back = np.ascontiguousarray(ranks[::-1])
    found: set[tuple[int, int, int]] = set()
    for order in (ranks, count - 1 - ranks):
        roots = np.array(lyndon_lengths(order.tolist(), count))
        # in a run of four periods or more the first whole root is followed by two as long
        at = np.arange(n)
        one, two = at + roots, at + 2 * roots
        ok = (two + roots <= n) & (roots[np.minimum(one, n - 1)] == roots) & (roots[np.minimum(two, n - 1)] == roots)
        ends: dict[int, int] = {}
        for i in np.flatnonzero(ok).tolist():
            p = int(roots[i])
            if i + p <= ends.get(p, 0):  # inside the run of this period found last
                continue
            right = common_extension(ranks, i, i + p)
            left = common_extension(back, n - i - p, n - i)
            if left + p + right >= max(min_length, min_periods * p):
                ends[p] = i + p + right
                found.add((i - left, left + p + right, p))
    return found


def live_stretches(ids: np.ndarray, owner: np.ndarray, times: int) -> list[tuple[int, int]]:
    """Longest stretches in which every three neighbouring words come ``times`` times in their text.

    ``ids`` differ between texts, ``owner`` numbers the text of each word."""
    n = len(ids)
    if n < 3:
        return []
    span = int(ids.max()) + 1
    _, pair = np.unique(ids[:-1] * span + ids[1:], return_inverse=True)
    _, triple, counts = np.unique(pair[:-1] * span + ids[2:], return_inverse=True, return_counts=True)
    live = (counts[triple] >= times) & (owner[:-2] == owner[2:])
    edges = np.flatnonzero(np.diff(np.concatenate(([0], live.view(np.int8), [0]))))
    # neighbouring stretches of two texts can't touch: the last two places of a text are never live
    return [(int(a), int(b) + 2) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def find_in_texts(texts: list[str | None], min_length: int, min_periods: int) -> list[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Words and sorted runs of each text."""
    words = [(t or "").encode().split() for t in texts]  # bytes split at 20 and 09-0D
    ids, base = [], 0
    for w in words:
        known: dict[bytes, int] = {}
        ids.append(np.fromiter((known.setdefault(x, base + len(known)) for x in w), np.int64, len(w)))
        base += len(known)
    starts = np.cumsum([0, *map(len, words)])
    flat, owner = np.concatenate(ids) if ids else np.zeros(0, np.int64), np.repeat(np.arange(len(words)), [len(w) for w in words])
    runs: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for a, b in live_stretches(flat, owner, min_periods - 1):
        if b - a >= min_length:
            row = int(owner[a])
            runs[row] += [(a - int(starts[row]) + s, n, q) for s, n, q in runs_in(flat[a:b], min_length, min_periods)]
    return [(w, sorted(r, key=lambda x: (x[0], x[2]))) for w, r in zip(words, runs, strict=True)]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by one space, without those that a run holds after its first period."""
    if runs:
        edge = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            edge[start + period] += 1
            edge[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
    return b" ".join(words)


def periodic_runs(
    docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, min_length: int = 6, min_periods: int = 4
) -> DataFrame:
    """The columns ``keep`` (default: all but the text and the results) and, per text, ``n_runs``; ``start``, ``length``,
    ``period`` and ``exponent_milli`` of the longest run (ties: least start, then period; none: nulls); ``runs``, every
    run's ``start,length,period`` and a line feed, by start and period; ``collapsed``, the text without repeated periods.

    Runs have ``min_length`` words and ``min_periods`` (4 or more) periods at least."""
    if min_periods < 4 or min_length <= min_periods:
        raise ValueError("min_periods must be 4 or more, and min_length more than that")
    out = {"n_runs": "long", "start": "long", "length": "long", "period": "long", "exponent_milli": "long", "runs": "string", "collapsed": "string"}
    keep = [c for c in docs.columns if c != text_col and c not in out] if keep is None else keep

    def make():
        def f(texts):
            made = find_in_texts(texts, min_length, min_periods)
            best = [min(r, key=lambda x: (-x[1], x[0], x[2])) if r else (None,) * 3 for _, r in made]
            return [
                [len(r) for _, r in made],
                *([b[k] for b in best] for k in range(3)),
                [None if b[0] is None else 1000 * b[1] // b[2] for b in best],
                ["".join(f"{s},{n},{q}\n" for s, n, q in r) for _, r in made],
                [collapse(w, r).decode() for w, r in made],
            ]

        return f

    return map_texts(docs, make, out, keep, text_col)


__all__ = ["periodic_runs", "lyndon_lengths", "runs_in"]
