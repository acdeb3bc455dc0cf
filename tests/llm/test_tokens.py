"""BPE round trips and packing, against the tokenizer library and brute force."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from frames import no_documents, odd_documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewater.llm.bpe import bpe_decode, bpe_encode
from tidewater.llm.packing import best_fit_plan, pack, token_pieces
from tidewater.llm.vocab import Vocabulary, parse_json, parse_tiktoken


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return lambda text: made.encode(text or "", add_special_tokens=False).ids


def vocab(spark, name="byte_bpe_50k.tiktoken"):
    return Vocabulary(spark, public_tokenizers.path(name), public_tokenizers.PATTERN)


def test_both_files_hold_the_same_ranks():
    a, b = (open(public_tokenizers.path(f"byte_bpe_50k.{k}"), "rb").read() for k in ("tiktoken", "json"))
    assert parse_tiktoken(a) == parse_json(b)


@pytest.mark.parametrize("chunk, overlap", [(64, 24), (200, 16), (65_536, 1_024)])
def test_chunks_give_the_ids_of_the_whole_text(spark, library, chunk, overlap):
    texts = [prose(3, 300), "x" * 900, "a  b   c\n\n d" * 60, "don't we'll 'tis " * 40, "日本語テキスト 😀 " * 50, " " * 700, "", None, prose(3, 300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    v = vocab(spark)
    done = bpe_decode(bpe_encode(docs, v, chunk=chunk, overlap=overlap), v, with_text=True)
    rows = {r.doc_id: r for r in done.collect()}
    for i, text in enumerate(texts):
        assert rows[i].ids == library(text), i
        assert bytes(rows[i].decoded) == (text or "").encode()
        assert rows[i].ids_text == " ".join(map(str, rows[i].ids))


def test_encode_takes_odd_rows(spark):
    docs = odd_documents(spark)
    v = vocab(spark)
    rows = bpe_encode(docs, v, keep=["doc_id", "score", "row"], chunk=500).collect()
    assert len(rows) == docs.count()
    assert sorted(len(r.ids) for r in rows if r.doc_id in (2, 3)) == [0, 0]
    assert bpe_encode(no_documents(spark), v, keep=["doc_id"]).count() == 0


def brute_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_plan_is_best_fit_decreasing(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    steps, opened = best_fit_plan(counts, 40)
    rooms, placed = [40] * opened, dict.fromkeys(counts, 0)
    for length, rank, n, each, first, offset in sorted(steps):
        assert rank == placed[length]
        placed[length] += n
    for length, _, n, each, first, offset in steps:
        for k in range(n):
            assert 40 - rooms[first + k // each] == offset + k % each * length
            rooms[first + k // each] -= length
    assert placed == counts
    assert sorted(rooms) == brute_best_fit(lengths, 40)


def test_packed_pieces_are_whole(spark, library):
    docs = odd_documents(spark)
    rows = pack(token_pieces(docs, vocab(spark, "byte_bpe_50k.json"), 128), 128).collect()
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
    want = sorted((r.doc_id is None, r.doc_id or 0, len(library(r.text)) + 1) for r in docs.collect())
    per_doc = {}
    for r in rows:
        per_doc[r.doc_id] = per_doc.get(r.doc_id, 0) + r.length
        assert r.length == 128 or r.piece == 0
    totals = {}
    for none, i, n in want:
        totals[None if none else i] = totals.get(None if none else i, 0) + n
    assert per_doc == totals
    ids = [*library("one"), 2]
    one = [r for r in rows if r.doc_id == 6 and r.length == len(ids)]
    assert zlib.crc32(np.array(ids, "<u4").tobytes()) in [r.ids_crc32 for r in one]
    assert pack(token_pieces(no_documents(spark), vocab(spark, "byte_bpe_50k.json"))).count() == 0


def test_added_tokens_in_a_text_keep_their_ids(spark):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 3, f"{prose(1, 40)}{end}{prose(2, 40)} {end}", "<|endoftext| >", f"  {end}\n\n{end}'s", "no such token", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    v = vocab(spark, "byte_bpe_50k.json")
    rows = {r.doc_id: r for r in token_pieces(docs, v, with_ids=True).collect()}
    done = {r.doc_id: r for r in bpe_decode(bpe_encode(docs, v, chunk=64, overlap=24), v).collect()}
    for i, text in enumerate(texts):
        ids = whole.encode(text, add_special_tokens=False).ids
        assert rows[i].ids == [*ids, 2] and done[i].ids == ids, text
        assert rows[i].ids_crc32 == zlib.crc32(np.array([*ids, 2], "<u4").tobytes())
        assert bytes(done[i].decoded) == text.encode()
    assert rows[0].ids == [64, 220, 50256, 275, 2]


def test_pack_reports_what_has_no_place(spark):
    pieces = spark.createDataFrame([(1, 5), (2, None), (3, 0), (4, 11), (5, 5)], "id long, length long")
    rows = {r.id: r for r in pack(pieces, 10).collect()}
    assert [rows[i].sequence_id for i in (2, 3, 4)] == [None] * 3
    assert rows[1].sequence_id == rows[5].sequence_id and {rows[1].offset, rows[5].offset} == {0, 5}
