"""Chunk protocol of the batcher, driven without Spark (hypothesis)."""

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from next_fit import next_fit_reference

from tidewater.operators.batching import (
    _make_chunk_labeller,
    _make_composer,
    _make_expander,
    _make_labeller,
    _make_root,
    _make_summariser,
)


def _plan(summaries, cap, fan_in):
    """The tree of summaries, level by level, without Spark."""
    levels = [summaries]
    while len(levels[-1]) > fan_in:
        groups = levels[-1].groupby(levels[-1]["chunk"] // fan_in)
        levels.append(pd.concat([_make_composer(cap, fan_in)(g) for _, g in groups], ignore_index=True))
    plan = _make_root(cap)(levels.pop())
    while levels:
        below = levels.pop()
        plan = pd.concat([_make_expander(cap)(g, plan[plan["__chunk"] == k]) for k, g in below.groupby(below["chunk"] // fan_in)], ignore_index=True)
    return plan


def _run_protocol(rows, cap, cuts, fan_in=64):
    """rows: sorted (run, pos, tokens); cuts: chunk boundaries (row indices)."""
    bounds = [0, *sorted(set(c for c in cuts if 0 < c < len(rows))), len(rows)]
    chunks = []
    for k in range(len(bounds) - 1):
        part = rows[bounds[k] : bounds[k + 1]]
        chunks.append(
            pd.DataFrame(
                {
                    "run": [r[0] for r in part],
                    "pos": [r[1] for r in part],
                    "tokens": [r[2] for r in part],
                    "__chunk": [k] * len(part),
                }
            )
        )
    summarise = _make_summariser(cap, "run", "pos", "tokens")
    summaries = pd.concat([out for frame in chunks for out in summarise(iter([frame]))], ignore_index=True)
    plan = _plan(summaries.sample(frac=1.0, random_state=1), cap, fan_in)  # rows of a group come in any order
    label = _make_chunk_labeller(cap, "run", "pos", "tokens")
    got = {}
    for k, frame in enumerate(chunks):
        for r in label(frame, plan[plan["__chunk"] == k]).itertuples(index=False):
            got[(r[0], r[1])] = (r[2], r[3], r[4])
    return got


def _expected(rows, cap):
    exp = {}
    runs = {}
    for run, pos, tok in rows:
        runs.setdefault(run, []).append((pos, tok))
    for run, items in runs.items():
        labels = next_fit_reference([t for _, t in items], cap)
        total = max(labels)
        seen = {}
        for (pos, _), b in zip(items, labels):
            idx = seen.get(b, 0)
            seen[b] = idx + 1
            exp[(run, pos)] = (b, idx, total)
    return exp


@st.composite
def cases(draw):
    cap = draw(st.integers(min_value=0, max_value=40))
    n_runs = draw(st.integers(min_value=1, max_value=4))
    rows = []
    for r in range(n_runs):
        toks = draw(st.lists(st.integers(min_value=0, max_value=cap), min_size=1, max_size=60))
        rows += [(f"r{r}", p, t) for p, t in enumerate(toks)]
    cuts = draw(st.lists(st.integers(min_value=1, max_value=max(1, len(rows) - 1)), max_size=12))
    return rows, cap, cuts


@settings(max_examples=400, deadline=None)
@given(cases(), st.sampled_from([2, 3, 64]))
def test_protocol_equals_fold(case, fan_in):
    rows, cap, cuts = case
    assert _run_protocol(rows, cap, cuts, fan_in) == _expected(rows, cap)


@settings(max_examples=100, deadline=None)
@given(st.integers(min_value=1, max_value=9), st.integers(min_value=2, max_value=6), st.lists(st.integers(1, 200), max_size=10))
def test_periodic_tokens(tok, per_batch, cuts):
    cap = tok * per_batch
    rows = [("hot", p, tok) for p in range(203)]
    assert _run_protocol(rows, cap, cuts) == _run_protocol(rows, cap, cuts, 2) == _expected(rows, cap)


def test_labeller_sorts_unordered_chunks():
    from tidewater.operators.batching import _in_run_order

    rows = [("a", p, (p * 7) % 5) for p in range(20)] + [("b", p, (p * 3) % 4) for p in range(15)]
    ordered = pd.DataFrame({"run": [r[0] for r in rows], "pos": [r[1] for r in rows],
                            "tokens": [r[2] for r in rows], "__chunk": 0})
    assert _in_run_order(ordered["run"], ordered["pos"])
    shuffled = ordered.sample(frac=1.0, random_state=3).reset_index(drop=True)
    assert not _in_run_order(shuffled["run"], shuffled["pos"])
    label = _make_labeller(6, "run", "pos", "tokens")
    a = pd.concat(list(label(iter([ordered])))).sort_values(["__run", "__pos"]).reset_index(drop=True)
    b = pd.concat(list(label(iter([shuffled])))).sort_values(["__run", "__pos"]).reset_index(drop=True)
    assert a.equals(b)
