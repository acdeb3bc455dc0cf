import random

import pytest
from next_fit import next_fit_reference

from tidewater.operators.batching import (
    _chain_depth,
    _label_segment,
    _prefix,
    _step_function,
    assign_batches,
    batch_stats,
    chunk_count,
)


def _spark_labels(spark, rows, cap, rows_per_chunk):
    df = spark.createDataFrame(rows, "run string, pos long, tokens long")
    out = assign_batches(df, cap, tokens="tokens", run="run", pos="pos", rows_per_chunk=rows_per_chunk)
    return {(r["run"], r["pos"]): (r["batch_no"], r["batch_idx"], r["total_batches"]) for r in out.collect()}


def _expected(rows, cap):
    by_run = {}
    for run, pos, tok in rows:
        by_run.setdefault(run, []).append((pos, tok))
    exp = {}
    for run, items in by_run.items():
        items.sort()
        labels = next_fit_reference([t for _, t in items], cap)
        total = max([b for b in labels if b is not None], default=0)
        seen = {}
        for (pos, _), b in zip(items, labels):
            if b is None:
                continue
            idx = seen.get(b, 0)
            seen[b] = idx + 1
            exp[(run, pos)] = (b, idx, total)
    return exp


def _random_rows(seed, n_runs, max_len, cap):
    rnd = random.Random(seed)
    rows = []
    for r in range(n_runs):
        length = rnd.randint(0, max_len)
        positions = rnd.sample(range(10 * max_len + 10), length)
        for p in positions:
            tok = rnd.choice([0, cap, cap + 1, rnd.randint(0, cap), rnd.randint(0, cap // 3 + 1)])
            rows.append((f"r{r:03d}", p, tok))
    return rows


def test_fixture_cap_sweep():
    # tokens of the ten-message fixture (code points of spaced JSON // 4)
    toks = [19, 15, 30, 22, 18, 28, 19, 38, 23, 22]
    assert next_fit_reference(toks, 40) == [1, 1, 2, 3, 3, 4, 5, 6, 7, 8]
    assert next_fit_reference(toks, 90) == [1, 1, 1, 1, 2, 2, 2, 3, 3, 3]
    assert next_fit_reference(toks, 25) == [1, 2, None, 3, 4, None, 5, None, 6, 7]


def test_kernel_matches_fold():
    rnd = random.Random(7)
    for _ in range(300):
        cap = rnd.randint(0, 30)
        toks = [rnd.randint(0, cap) for _ in range(rnd.randint(1, 60))]
        exp = next_fit_reference(toks, cap)
        import numpy as np

        batch, idx, out = _label_segment(np.array(toks), cap, (0, 0, 0))
        assert batch.tolist() == exp
        # step function agrees with a direct re-run for every incoming fill
        steps = _step_function(np.array(toks), cap)
        fresh = out
        for c in range(cap + 1):
            for b in (1, 3):
                got = _plan_step(steps, (b, c, 2), fresh, cap)
                want = _label_segment(np.array(toks), cap, (b, c, 2))[2]
                assert got == want, (toks, cap, c)


def _plan_step(steps, state, fresh, cap):
    from tidewater.operators.batching import _step

    return _step(steps, state, fresh, cap)


def test_chain_depth_small():
    import numpy as np

    toks = np.array([3, 3, 3, 3, 3])
    inc, exc, nxt = _prefix(toks, 6)
    depth, root = _chain_depth(nxt)
    assert nxt.tolist() == [2, 3, 4, 5, 5]
    assert depth.tolist() == [3, 2, 2, 1, 1]
    assert root.tolist() == [4, 3, 4, 3, 4]


@pytest.mark.parametrize("rows_per_chunk", [1_000_000, 7, 40])
def test_assign_batches_matches_fold(spark, rows_per_chunk):
    cap = 20
    rows = _random_rows(11, 25, 60, cap)
    # one hot run that spans many chunks
    rnd = random.Random(3)
    rows += [("hot", p, rnd.randint(0, cap + 1)) for p in range(500)]
    got = _spark_labels(spark, rows, cap, rows_per_chunk)
    assert got == _expected(rows, cap)


def test_assign_batches_periodic_hot_run(spark):
    # equal tokens never let differently started chains merge
    rows = [("a", p, 16) for p in range(301)] + [("b", p, 7) for p in range(50)]
    for per_chunk in (10, 33):
        got = _spark_labels(spark, rows, 32, per_chunk)
        assert got == _expected(rows, 32)


def test_exact_fit_three_batches(spark):
    rows = [("run", p, 16) for p in range(6)]
    df = spark.createDataFrame(rows, "run string, pos long, tokens long")
    out = assign_batches(df, 32)
    stats = batch_stats(out).orderBy("batch_no").collect()
    assert [r["n_rows"] for r in stats] == [2, 2, 2]
    assert [r["file_name"] for r in stats] == ["1of3.json", "2of3.json", "3of3.json"]


def test_empty_input(spark):
    df = spark.createDataFrame([], "run string, pos long, tokens long")
    assert assign_batches(df, 10).count() == 0


def test_invariants_on_documents(spark):
    """Batches of the real documents: within budget, contiguous, greedy-maximal."""
    from tidewater.functions.tokens import LocalTokenizer
    from tidewater.operators.batching import oversized_rows
    from tidewater.operators.dedup import prebatch
    from tidewater.plans.curate import with_tokens
    from tidewater.sources.adapters import messages_from_documents, table

    cap = 8000
    msgs = prebatch(messages_from_documents(table(spark, "/root/testdata/sf0.01", "documents")))
    counted = with_tokens(msgs, ["id", "channel_id", "channel_handle", "time", "text", "dup_count"], LocalTokenizer())
    for per_chunk in (1_000_000, 50):
        batched = assign_batches(counted, cap, rows_per_chunk=per_chunk).collect()
        assert len(batched) + oversized_rows(counted, cap).count() == counted.count()
        by_run = {}
        for r in batched:
            by_run.setdefault(r["run"], []).append(r)
        for rows in by_run.values():
            rows.sort(key=lambda r: r["pos"])
            nos = [r["batch_no"] for r in rows]
            assert nos[0] == 1 and all(b - a in (0, 1) for a, b in zip(nos, nos[1:]))
            assert all(r["total_batches"] == nos[-1] for r in rows)
            totals = {}
            for r in rows:
                totals[r["batch_no"]] = totals.get(r["batch_no"], 0) + r["tokens"]
            assert max(totals.values()) <= cap
            firsts = {}
            for r in rows:
                firsts.setdefault(r["batch_no"], r["tokens"])
            for b in range(1, nos[-1]):
                assert totals[b] + firsts[b + 1] > cap  # next batch's first row did not fit


def test_null_run_chunked(spark):
    rows = [(None, p, (p * 7) % 11) for p in range(120)] + [("b", p, (p * 5) % 9) for p in range(80)]
    for per_chunk in (1_000_000, 13):
        got = _spark_labels(spark, rows, 15, per_chunk)
        assert got == _expected(rows, 15)


def test_negative_tokens_rejected():
    import numpy as np

    with pytest.raises(ValueError):
        _label_segment(np.array([3, -1, 2]), 5, (0, 0, 0))


def test_unknown_tokens_are_reported_and_bad_positions_raise(spark):
    from tidewater.operators.batching import oversized_rows

    kind = "run string, pos long, tokens long"
    df = spark.createDataFrame([("a", 0, 3), ("a", 1, None), ("a", 2, 99), ("b", 0, 2)], kind)
    kept, aside = assign_batches(df, 10), oversized_rows(df, 10)
    assert kept.count() + aside.count() == df.count() and aside.count() == 2
    with pytest.raises(ValueError, match="no 'pos'"):
        assign_batches(spark.createDataFrame([("a", None, 1), ("a", 1, 1)], kind), 10)
    for chunk in (1, 100):
        with pytest.raises(Exception, match="repeated"):
            assign_batches(spark.createDataFrame([("a", 1, 1), ("a", 1, 1), ("a", 2, 1)], kind), 10, rows_per_chunk=chunk).collect()


@pytest.mark.parametrize("tok", [1, 16, 50])
def test_uniform_counts_over_many_chunks(spark, tok):
    rows = [("hot", p, tok) for p in range(3_000)] + [("cold", p, tok) for p in range(70)]
    assert _spark_labels(spark, rows, 8_000, 140) == _expected(rows, 8_000)


@pytest.mark.parametrize("fan_in", [2, 5, 64])
def test_summaries_are_composed_in_a_tree(spark, fan_in):
    # 60 chunks: up to six levels; one run over most of them, then many small ones
    rnd = random.Random(9)
    rows = [("a", p, rnd.randint(0, 12)) for p in range(400)] + [("hot", p, rnd.choice([0, 1, 9, 20])) for p in range(4_000)]
    rows += [(f"r{p % 90:02d}", p, rnd.randint(0, 20)) for p in range(1_500)]
    df = spark.createDataFrame(rows, "run string, pos long, tokens long")
    out = assign_batches(df, 20, rows_per_chunk=97, fan_in=fan_in)
    got = {(r["run"], r["pos"]): (r["batch_no"], r["batch_idx"], r["total_batches"]) for r in out.collect()}
    assert got == _expected(rows, 20)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_chunks_grow_with_the_table():
    assert chunk_count(9_000, 100) == 90
    assert chunk_count(10**8, 100) == 10**4 and chunk_count(10**10, 100) == 10**5
    assert chunk_count(10**9) == 2_000 and chunk_count(0) == 1
