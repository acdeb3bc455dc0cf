"""Names that meet, long texts, and what a window or a gate must not lose."""

import random
import time

import public_tokenizers
import pytest
from frames import labels, odd_documents, prose
from pyspark.sql import functions as F

from tidewater.llm.bpe import bpe_encode
from tidewater.llm.fertility import Pieces, quality_rules
from tidewater.llm.learning import excerpt
from tidewater.llm.line_dedup import drop_repeated_lines
from tidewater.llm.ngram_join import drop_near_copies
from tidewater.llm.packing import pack, token_pieces
from tidewater.llm.secrets import _make, find_secrets
from tidewater.llm.toxicity import Lexicon, drop_toxic, features, is_quoted
from tidewater.llm.vocab import Vocabulary

MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: Names that the operators use for columns of their own, and those of their results that they don't replace.
INTERNAL = [
    "_id", "_hash", "_gone", "_n_removed", "_n_lines", "_h", "_row", "_prefix", "_n_shingles", "_rid", "_bucket", "_rank", "_length", "_len", "_text", "_text_", "_key", "_ids",
    "_script", "_of", "_size", "_low", "_high", "_most", "_least_bits", "_score", "_predicted", "_toxic_score", "_", "id", "t", "doc", "rid", "line", "lines", "gone", "text_hash",
    "piece", "rank", "bucket", "n", "base", "sequence", "place", "root", "size", "size_", "key", "copy", "h", "w", "at", "run",
]


def with_internal(df):
    taken = {c.lower() for c in df.columns}
    names = [c for c in INTERNAL if c not in taken]
    return df.select("*", *[F.lit(f"mine:{c}").alias(c) for c in names]), names


def unchanged(df, names):
    rows = df.select(*names).collect()
    assert rows and all(r[c] == f"mine:{c}" for r in rows for c in names)


def test_columns_of_any_name_pass_through(spark):
    docs, names = with_internal(odd_documents(spark).drop("score", "kept", "n_words", "spans", "held_out", "component_id", "n_lines", "row", "length"))
    known = labels(spark)  # none: every score is the same, and none goes
    for made in (drop_repeated_lines(docs), drop_near_copies(docs), drop_toxic(docs, known)):
        assert made.columns == docs.columns
        unchanged(made, names)
    vocab = Vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    unchanged(bpe_encode(docs, vocab, chunk=2_000, overlap=500), names)
    unchanged(quality_rules(spark, docs, MODEL), names)
    pieces, more = with_internal(token_pieces(docs.select("doc_id", "text"), Vocabulary(spark, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN), 64))
    unchanged(pack(pieces, 64), more)
    twice = pack(pack(pieces, 64), 64)
    assert twice.columns.count("sequence_id") == 1 and twice.count() == pieces.count()


# -- secrets -------------------------------------------------------------------
def test_secret_scan_is_linear():
    spans = _make(0.72, 16, 256)
    line = "token=abcdef1234 key: x9Kd82jQpLz71MvNb4q the rest of a line with words\n"
    took = []
    for n in (2_000, 8_000, 32_000):
        text, at = line * n, time.perf_counter()
        assert len(spans(text)) >= n
        took.append(time.perf_counter() - at)
    assert took[2] < 4 * 2.5 * max(took[1], 0.05)
    for hostile in ("a=" * 1_000_000, "key=" * 500_000, "=" * 2_000_000, "A" * 2_000_000):  # ends in a pass or two
        spans(hostile)


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("key = 83920174659201837465", "83920174659201837465"),
        ("session key: 4839201746592018374", "4839201746592018374"),
        ("auth a=short;private_key_value=x9Kd82jQpLz71MvNb4", "x9Kd82jQpLz71MvNb4"),
    ],
)
def test_numbers_and_parts_are_measured(spark, text, wanted):
    spans = find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().spans
    found = {text[int(s) : int(e)] for _, s, e in (x.split(":") for x in spans.split(",") if x)}
    assert any(wanted in f for f in found), spans


def test_numbers_that_follow_no_sensitive_word_are_no_secrets(spark):
    text = "the session began at 20240115093000123456 and order 8392017465920183 was shipped"
    assert find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().n_novel == 0


# -- toxicity --------------------------------------------------------------------
def test_offsets_hold_where_small_letters_are_longer():
    lexicon, text = Lexicon({"grobnik": 3.0}), "İ" * 60 + ' "grobnik"'
    (start, end, _, _), = lexicon.hits(text)[0]
    assert text[start:end] == "grobnik" and is_quoted(text, start, end)
    assert features(lexicon, [text])[0][0] == 0  # a quotation, no abuse


def test_apostrophes_quote_only_at_the_edge_of_a_word():
    at = lambda text: (text.index("grobnik"), text.index("grobnik") + 7)
    for plain in ("you're a grobnik and you're", "l'ami est grobnik d'abord", "that’s a grobnik, isn’t it"):
        assert not is_quoted(plain, *at(plain)), plain
    for quoted in ("a 'grobnik' here", "so-called ‘grobnik’ here", "the word grobnik"):
        assert is_quoted(quoted, *at(quoted)), quoted


def test_misspelt_terms_are_weighed_in_their_window():
    lexicon = Lexicon({"grobnik": 3.0})
    quoted, plain, exact, none = features(lexicon, ['here is "grobnkk"', "a grobnkk here", "a grobnik here", "nothing here"])
    assert quoted[1] == 0 and quoted[3] > 0 and plain[1] > 0 and plain[3] == 0 and (none == 0).all()
    assert 0 < plain[1] < exact[1] and plain[4] > 0 == quoted[4]


# -- samples and caches -------------------------------------------------------------
def test_excerpts_come_from_all_of_a_text(spark):
    long = "".join(f"{i:07d} " for i in range(100_000))
    rows = spark.createDataFrame([(1, long), (2, "short"), (3, "")], "id int, t string").select("id", excerpt(F.col("t"), 1_600, 16).alias("e"))
    made = {r.id: r.e for r in rows.collect()}
    assert made[2] == "short" and made[3] == "" and len(made[1]) == 1_600 + 15
    parts = made[1].split("\n")
    assert parts[0] == long[:100] and parts[-1] == long[-100:] and all(p in long for p in parts)


def test_long_words_are_not_remembered():
    with open(MODEL, "rb") as f:
        pieces = Pieces(f.read())
    words = ["word", "x" * 100_000, "word", "y" * 41]
    first = pieces.tokens(words)
    assert set(pieces.known) == {"word"} and (pieces.tokens(words) == first).all()


def test_bands_of_few_documents_reject_none_of_them(spark):
    rows = [(k, prose(k, 120)) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert quality_rules(spark, docs, MODEL).where("not kept").count() == 0
    noise = random.Random(1)
    rows += [(100 + k, "".join(noise.choice("bcdfgkqxz") for _ in range(8)) + " " + " ".join("".join(noise.choice("qxzkjv") for _ in range(9)) for _ in range(119))) for k in range(1)]
    rows += [(k, prose(k, 120)) for k in range(6, 60)]
    kept = {r.doc_id: r.kept for r in quality_rules(spark, spark.createDataFrame(rows, "doc_id long, text string"), MODEL).collect()}
    assert not kept[100] and sum(kept.values()) >= 57
