"""Embedding links, suffix dedup, n-gram joins and line dedup against brute force."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from frames import no_documents, odd_documents, prose

from tidewater import session
from tidewater.llm import ngram_join, suffix_dedup
from tidewater.llm.line_dedup import drop_repeated_lines, line_report
from tidewater.llm.ngram_join import drop_near_copies, gram_hashes, jaccard_components
from tidewater.llm.suffix_dedup import Fingerprints, cut_repeats, suffix_ranks
from tidewater.llm.vector_join import embedding_components


def closure(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("dims, tile", [(35, 2_048), (13, 40), (1, 50)])
def test_embeddings_match_all_pairs(spark, dims, tile, monkeypatch):
    rng = np.random.default_rng(dims)
    centres = rng.standard_normal((12, dims))
    x = np.concatenate([c + rng.standard_normal((10, dims)) * s for c, s in zip(centres, np.linspace(0.01, 0.5, 12), strict=True)])
    x = np.concatenate([x, x[:5], x[5:8] * 1e-200, x[8:10] * 1e200])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    n = len(rows)
    odd = [None, [], [0.0] * dims, [float("nan")] * dims, [float("inf")] + [0.0] * (dims - 1), [None] * dims]
    docs = spark.createDataFrame(rows + [(n + k, v) for k, v in enumerate(odd)], "vec_id long, embedding array<double>")
    from tidewater.llm import vector_join

    links = vector_join.embedding_links
    monkeypatch.setattr(vector_join, "embedding_links", lambda v, c, i, e: links(v, c, i, e, tile))
    got = {r.vec_id: r for r in embedding_components(docs).collect()}
    unit = [v / np.abs(v).max() for v in x]
    unit = np.array([v / np.linalg.norm(v) for v in unit])
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    want = closure(range(n), zip(*np.nonzero(near), strict=True))
    assert [got[i].n_links for i in range(n)] == near.sum(1).tolist()
    assert {i: got[i].component_id for i in range(n)} == want
    for k in range(n, n + len(odd)):
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (0, k, True)


def test_embeddings_take_odd_tables(spark):
    kind = "vec_id long, embedding array<float>"
    assert embedding_components(spark.createDataFrame([], kind)).count() == 0
    same = spark.createDataFrame([(None, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (1, [1.0, 0.0, 0.0])], kind)
    rows = sorted((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in embedding_components(same).collect())
    assert rows == [(False, 1, 0, 1, True), (False, 2, 2, 2, True), (False, 2, 2, 2, True), (True, 0, 2, 2, False)]


def brute_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        change = np.zeros(len(r) + 1, int)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                change[i] += 1
                change[i + length] -= 1
        off = np.cumsum(change[:-1]) > 0
        out.append((len(r), int(off.sum()), int((np.diff(off.astype(int), prepend=0) == 1).sum()), np.frombuffer(r, np.uint8)[~off].tobytes()))
    return out


@pytest.mark.parametrize("many, step", [(400, 18), (1, 18), (3, 40)])
def test_suffix_dedup_matches_brute_force(spark, many, step, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MANY", many)
    monkeypatch.setattr(suffix_dedup, "STEP", step)
    shared, period = prose(5, 90), "abcde" * 120
    texts = [
        prose(1, 150) + shared + prose(2, 100), shared[7:], prose(3, 50) + shared[:260] + "é" * 10, period, "zz" + period[3:400], "q" * 500, "q" * 199,
        "q" * 200, None, "", shared, shared, prose(8, 300) + "x" + prose(8, 300), "日本" * 120, "日本" * 100 + "x",
        *[prose(20 + i, 30)[: 140 - 9 * i] + shared[200:330] + prose(40 + i % 2, 60)[: 20 + 9 * i] + prose(60 + i, 20) for i in range(12)],
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in cut_repeats(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute_repeats(texts, 200)


def test_suffix_dedup_takes_odd_tables(spark):
    docs = odd_documents(spark)
    rows = cut_repeats(docs).collect()
    want = Counter((r.doc_id, *w) for r, w in zip(docs.collect(), brute_repeats([r.text for r in docs.collect()], 200), strict=True))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows) == want
    assert cut_repeats(no_documents(spark)).count() == 0


@pytest.mark.parametrize("n, symbols, depth", [(1, 2, 9), (2, 1, 9), (5, 2, 9), (300, 2, 200), (400, 3, 12), (997, 4, 50)])
def test_suffix_ranks_follow_the_text(n, symbols, depth):
    s = np.random.default_rng(n).integers(1, symbols + 1, n)
    order = np.argsort(suffix_ranks(s, depth), kind="stable")
    heads = [tuple(s[i : i + depth].tolist()) for i in order]
    assert heads == sorted(heads)


def test_fingerprints_are_the_same_in_slices(monkeypatch):
    raw = (prose(4, 900) + "ab" * 300).encode()
    whole = Fingerprints().find(raw)
    monkeypatch.setattr(suffix_dedup, "SLICE", 1_000)
    parts = Fingerprints().find(raw)
    windows = {int(p) for p in whole[0]}
    assert windows == {int(p) for p in parts[0]}


def test_each_string_has_one_fingerprint(monkeypatch):
    """Texts in a row have the fingerprints that each has alone, and each start is the one's of a fingerprint."""
    raws = [b"", prose(1, 70).encode(), b"x" * 199, b"y" * 200, ("ab" * 400).encode(), prose(1, 70).encode()]
    for slice_ in (1 << 20, 300):
        monkeypatch.setattr(suffix_dedup, "SLICE", slice_)
        row, owner, place, h, first, last = Fingerprints().find_all(raws)
        assert row == b"".join(raws)
        begin = np.cumsum([0, *(len(r) for r in raws)])
        for i, raw in enumerate(raws):
            own = owner == i
            alone = Fingerprints().find(raw)
            assert (place[own] - begin[i]).tolist() == alone[0].tolist() and h[own].tolist() == alone[1].tolist()
            starts = [s - begin[i] for a, b in zip(first[own], last[own], strict=True) for s in range(a, b + 1)]
            assert starts == list(range(len(raw) - 199))
        assert ((first <= place) & (place + 64 <= first + 200) & (last <= place) & (place + 64 <= last + 200)).all()


@pytest.mark.parametrize("n, symbols", [(300, 2), (997, 4), (50, 1)])
def test_wanted_suffixes_have_their_order(n, symbols):
    rng = np.random.default_rng(n)
    s = rng.integers(1, symbols + 1, n)
    wanted = rng.random(n) < 0.3
    at = np.flatnonzero(wanted)
    order = at[np.argsort(suffix_ranks(s, 60, wanted)[at], kind="stable")]
    heads = [tuple(s[i : i + 60].tolist()) for i in order]
    assert heads == sorted(heads)


def test_numbers_too_large_for_one_sort_are_in_order():
    key = np.array([1 << 62, 5, 1 << 62, 0, (1 << 62) - 1])
    name, many = suffix_dedup._named(key)
    assert name.tolist() == [3, 1, 3, 0, 2] and many == 4
    x, y = np.array([1 << 62, 2, 2]), np.array([2, 1, 1 << 62])
    assert [v.tolist() for v in suffix_dedup._smaller(x, y)] == [[2, 0, 0], [2, 1, 1], [0, 0, 2]]


def test_contexts_are_sorted_whole_in_small_batches(monkeypatch):
    """Groups that lie over the ends of batches are the same, and copies are added up."""
    names = [n.split()[0] for n in suffix_dedup._ROWS.split(", ")]
    types = [pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.int64(), pa.bool_(), pa.binary(), pa.int64()]
    one, two, three = (prose(i, 40)[:20].encode() for i in (1, 2, 3))
    same = prose(4, 90)[:230].encode()
    rows = [
        (1, b"a" * 12, 0, same, 1, False, b"k1", 0), (1, b"b" * 12, 0, same + one, 1, False, b"k2", 5), (1, b"c" * 12, 0, same[:200], 1, False, b"k3", 0),
        (1, b"c" * 12, 0, None, 1, False, None, 9), (2, b"d" * 12, 0, same, 1, False, b"k4", 0), (3, b"e" * 12, 0, same, 1, True, b"k5", 0),
        (3, b"e" * 12, 0, None, 1, True, None, 0), (4, b"f" * 12, 0, same + two, 1, False, b"k6", 0), (4, b"g" * 12, 0, same[:210] + three, 1, False, b"k7", 0),
    ]

    def run(size):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + size], strict=True), types, strict=True)], names=names) for i in range(0, len(rows), size)]
        return [tuple(r.values()) for b in suffix_dedup._order(200)(iter(batches)) for r in b.to_pylist()]

    got = {(r[0], r[1][:1]): (r[3], r[4], r[6], r[8]) for r in run(len(rows))}
    assert got == {
        (1, b"a"): (None, 1, b"k1", [0, 31]), (1, b"b"): (None, 1, b"k2", [0, 31]), (3, b"e"): (same, 2, b"k5", None),
        (4, b"f"): (None, 1, b"k6", [0, 11]), (4, b"g"): (None, 1, b"k7", [0, 11]),
    }
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 1)
    monkeypatch.setattr(suffix_dedup, "BATCH_ROWS", 1)
    assert {(r[0], r[1][:1]): (r[3], r[4], r[6], r[8]) for r in run(2)} == got


def test_suffix_dedup_sorts_no_copies(spark, monkeypatch):
    """Contexts that all come back whole are not sorted; what the spans are made from is deleted with them written."""
    staged = Counter()
    stage = suffix_dedup.stage_table

    def counted(df, name):
        table = stage(df, name)
        staged[name] += table.count()
        return table

    monkeypatch.setattr(suffix_dedup, "stage_table", counted)
    texts = [prose(i // 3, 150) for i in range(12)] + [prose(20 + i, 150) for i in range(5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    with session.scratch_scope(spark):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in cut_repeats(docs).collect()}
        assert [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in session._SCOPES.open[-1]] == ["suffix-spans"]
    assert [got[i] for i in range(len(texts))] == brute_repeats(texts, 200)
    assert staged["suffix-names"] > 0 and staged["suffix-kinds"] == staged["suffix-found"] == 0


def brute_sets(texts, n):
    out = []
    for t in texts:
        words = (t or "").encode().lower().split()
        out.append({tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set())
    return out


def brute_links(sets, percent):
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                yield i, j


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_ngram_join_matches_all_pairs(spark, n, percent):
    rng = np.random.default_rng(n)
    texts = []
    for seed in range(12):
        words = prose(seed, 30 + 25 * seed).split()
        for _ in range(6):
            copy = list(words)
            for at in rng.integers(0, len(copy), rng.integers(0, 1 + len(copy) // 60)):
                copy[at] = "new" + str(rng.integers(1_000_000))
            texts.append(" ".join(copy))
    texts += ["Aa b c", "aA B C", "a b", "A B", "É", "é", None, "", " \n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in jaccard_components(docs, n, percent).collect()}
    sets = brute_sets(texts, n)
    want = closure(range(len(texts)), brute_links(sets, percent))
    assert {i: got[i].component_id for i in got} == want
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    if n == 5:
        kept = sorted(r.doc_id for r in drop_near_copies(docs, n, percent).collect())
        assert kept == sorted(set(want.values()))


def test_ngram_join_fetches_only_sets_that_may_link(spark, monkeypatch):
    """Texts that share half of their grams are told apart by their bitmaps, not by whole sets."""
    staged = Counter()
    stage = ngram_join.stage_table

    def counted(df, name):
        table = stage(df, name)
        staged[name] += table.count()
        return table

    monkeypatch.setattr(ngram_join, "stage_table", counted)
    base = prose(3, 120).split()
    texts = []
    for i in range(20):
        copy = list(base)
        copy[6 * i : 6 * i + 1] = [f"one{i}"]
        for at in range(i % 7, 120, 12):
            copy[at] = f"new{i}of{at}"
        texts.append(" ".join(copy))
    texts.append(" ".join([*base[:-1], "last"]))
    texts.append(" ".join(base))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_components(docs).collect()}
    assert got == closure(range(len(texts)), brute_links(brute_sets(texts, 3), 90)) == {**{i: i for i in range(21)}, 21: 20}
    assert staged["jaccard-pairs"] <= 2 and staged["jaccard-sets"] <= 4


def test_ngram_join_moves_little(spark, monkeypatch):
    """Cells that share no column with a row stay behind though the table of marks fills up; sets travel as packed texts."""
    stage, cells, moved = ngram_join.stage_table, [], []

    def counted(df, name):
        table = stage(df, name)
        if name == "jaccard-cells":
            cells.append(table.count())
        if name == "jaccard-sets":
            moved.extend(len(r[c]) for r in table.collect() for c in table.columns if c != "name")
        return table

    monkeypatch.setattr(ngram_join, "stage_table", counted)
    texts = [prose(i, 300) for i in range(140)]
    texts += [t + f" more{i}" for i, t in enumerate(texts[:40])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {i: i - 140 if i >= 140 else i for i in range(180)}
    for size in (ngram_join.BLOCK_MARKS, 1 << 16):
        monkeypatch.setattr(ngram_join, "BLOCK_MARKS", size)
        assert {r.doc_id: r.component_id for r in jaccard_components(docs).collect()} == want
    alone = 100 * 31  # columns of texts without a copy
    assert cells[0] >= 80 * 20 and cells[1] - cells[0] <= alone * 0.03
    assert moved and sum(moved) < 4 * 300 * len(moved)


def test_texts_with_one_hash_are_told_apart(spark, monkeypatch):
    """All texts share the hash by which they are found again: the names of their sets tell them apart."""
    monkeypatch.setattr(ngram_join, "_keys", lambda texts: np.zeros(len(texts), np.int64))
    texts = [prose(i // 2, 60) + " end" * (i % 2) for i in range(8)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_components(docs).collect()}
    assert got == closure(range(10), brute_links(brute_sets(texts, 3), 90)) and got[1] == 0


def test_parities_differ_in_no_more_bits_than_sets_in_grams():
    rng = np.random.default_rng(1)
    for size in (1, 40, 3_000):
        a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[size // 10 :], rng.integers(0, 1 << 63, size // 5).astype(np.uint64)]))
        x, y = (int.from_bytes(ngram_join._parities(s), "big") for s in (a, b))
        assert (x ^ y).bit_count() <= len(np.setxor1d(a, b)) and ngram_join._parities(a[::-1]) == ngram_join._parities(a)


def test_ngram_join_leaves_only_its_links(spark):
    """The tables that the links are made from are deleted once these are written."""
    docs = spark.createDataFrame([(i, prose(i // 2, 40)) for i in range(6)], "doc_id long, text string")
    rows = ngram_join.jaccard_rows(docs)
    with session.scratch_scope(spark):
        links = ngram_join.jaccard_links(docs, rows)
        left = [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in session._SCOPES.open[-1]]
        assert left == ["jaccard-links"] and links.columns == ["node", "root"]


def test_ngram_join_takes_odd_tables(spark):
    docs = odd_documents(spark)
    assert jaccard_components(docs).count() == docs.count()
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and ids[5] == 0 and ids[7] == 1 and ids[8] == 0 and ids[2] == ids[3] == ids[4] == 1
    assert jaccard_components(no_documents(spark)).count() == 0
    assert drop_near_copies(no_documents(spark)).count() == 0
    assert len(gram_hashes(" a\x1cb  c ", 3)) == 1


def brute_lines(texts, least=50):
    """Lines that go, per document: every line with a word of a run of enough words, of any length, that stood
    before, and lines without a word between two neighbours that go."""
    seen, gone = set(), []
    for t in texts:
        out = set()
        lines = [(i, s, len(s.encode().split())) for i, s in enumerate((t or "").split("\n"))]
        lines = [x for x in lines if x[2]]
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if sum(x[2] for x in lines[a:b]) >= least:
                    key = tuple(x[1] for x in lines[a:b])
                    if key in seen:
                        out |= {x[0] for x in lines[a:b]}
                    seen.add(key)
        out |= {i for x, y in zip(lines, lines[1:]) if x[0] in out and y[0] in out for i in range(x[0], y[0])}
        gone.append(out)
    return gone


def same_lines(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in line_report(docs).collect()}
    gone = brute_lines(texts)
    for i, (t, g) in enumerate(zip(texts, gone, strict=True)):
        left = None if t is None else "\n".join(s for k, s in enumerate(t.split("\n")) if k not in g)
        assert (got[i].kept, got[i].n_removed) == (left, len(g)), i
    return docs, gone


def test_line_dedup_matches_brute_force(spark):
    a, b, c = (prose(i, 20) for i in (1, 2, 3))
    long = prose(4, 70)
    texts = [
        "\n".join([a, b, c, "end"]), "\n".join(["start", a, b, "", c, "tail"]), "\n".join([a, c, b]), long, "\n".join(["x", long, "", "y"]), long,
        "\n".join([long, long, a, a, b]), None, "", "\n\n", "\n".join([a, b, a, b, a, b, a, b]), "\n".join(["", long, " ", long, "", "z", ""]),
    ]
    docs, _ = same_lines(spark, texts)
    assert {r.doc_id for r in drop_repeated_lines(docs).collect()} == set(range(len(texts))) - {5}


def test_line_dedup_takes_whole_runs(spark):
    rng = np.random.default_rng(7)
    pool = [prose(20 + i, int(n)) for i, n in enumerate([60, 5, 1, 49, 30, 12, 50, 20, 3, 45])] + [""]
    texts = ["\n".join([pool[0], pool[1]]), "\n".join([pool[0], pool[1]]), "\n".join([pool[2], pool[0], "", pool[1], "tail"])]
    texts += ["\n".join(pool[k] for k in rng.integers(0, len(pool), rng.integers(1, 11))) for _ in range(120)]
    docs, gone = same_lines(spark, texts)
    assert gone[1] == {0, 1} and gone[2] == {1, 2, 3}
    stay = {r.doc_id: r.text for r in drop_repeated_lines(docs).collect()}
    assert 1 not in stay and stay[2] == "\n".join([pool[2], "tail"])


def test_copies_leave_no_stub(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    twice = spark.createDataFrame([(k, t) for k, t in enumerate(texts + texts)], "doc_id long, text string")
    left = {r.doc_id: r.kept for r in line_report(twice).collect()}
    long = [k for k, t in enumerate(texts) if t and len(t.encode().split()) >= 50]
    assert len(long) > 500 and not [k for k in long if left[len(texts) + k].strip()]


def test_line_dedup_takes_odd_tables(spark):
    docs = odd_documents(spark)
    rows = line_report(docs).collect()
    assert len(rows) == docs.count()
    repeated = [r for r in rows if r.doc_id == 5]
    assert [r.n_removed for r in repeated] == [1, 1]  # both stand after document 1
    copies = spark.createDataFrame([(i, t) for i in (3, 3, None, None) for t in ("\n" + prose(5, 60) + "\n", "short\n\ntext")], "doc_id long, text string")
    left = sorted((r.doc_id is None, r.doc_id, r.n_removed, len(r.kept)) for r in line_report(copies).collect())
    # of the rows that share an id and a text one stays; a text under the least number of words always does
    assert [x[2] for x in left] == [0, 0, 0, 1, 0, 0, 1, 1] and [x[3] for x in left].count(1) == 3
    assert drop_repeated_lines(copies).where("length(text) > 20").count() == 1
    assert [r.n_removed for r in rows if r.doc_id is None and r.n_lines] == [1]  # null ids come last
    assert drop_repeated_lines(docs).columns == docs.columns
    assert line_report(no_documents(spark)).count() == 0
