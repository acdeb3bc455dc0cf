"""Quality rules: base counts of a text, and the fertility of a public tokeniser.

Fertility is how a public vocabulary splits the words of a text: characters per
token, the share of byte-fallback tokens (letters that the vocabulary lacks),
and the entropy of the tokens.  A document outside its band is rejected.

Bands come from the corpus: quartiles of the three measures over all documents
that pass the base rules (each set of results once, so that copies don't set a
band), by script and by size, as entropy grows with the number of tokens; what
lies FENCE interquartile ranges outside is rejected, more where a band rests on
few documents (FENCE_FEW over the root of their number).  Fixed bands by script,
with wide margins, hold as well: text that a vocabulary was made for gives 3 to 5 characters a token, invented or
rare-language text 1.5 to 3, noise and symbol soup less or far more.

A null text has no words and fails the base rules (fewer than 50 words).  Every row
gives one row, so repeated rows and ids are judged each; an empty table gives an
empty table.  Columns of the input named like a result are left out by default,
all others stay as they are.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import free_name, map_texts, per_process
from tidewater.session import stage_table

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = re.compile(r"[#*$%&|<>]")
#: Words whose tokens a worker remembers, of so many characters at most.
CACHE_WORDS, CACHE_CHARS = 150_000, 40
#: Interquartile ranges from a quartile to the band's end, and what quartiles of n documents add to that, over the root of n.
FENCE, FENCE_FEW = 2.0, 10.0
#: What lies no further from a quartile than this is never outside (characters per token by share of the quartile, byte share, bits).
LEAST_PER, LEAST_SHARE, LEAST_BITS = 0.1, 0.05, 0.25
#: Per script: least and most characters per token, most share of byte-fallback tokens, least entropy (bits a token).
BANDS = {
    "LATIN": (1.35, 9.0, 0.10, 2.0),
    "CYRILLIC": (1.2, 8.0, 0.10, 2.0),
    "GREEK": (0.8, 6.0, 0.30, 2.0),
    "ARABIC": (0.7, 6.0, 0.40, 2.0),
    "HEBREW": (0.7, 6.0, 0.40, 2.0),
    "DEVANAGARI": (0.5, 6.0, 0.60, 2.0),
    "CJK": (0.3, 4.0, 0.70, 2.0),
    "HIRAGANA": (0.3, 4.0, 0.70, 2.0),
    "KATAKANA": (0.3, 4.0, 0.70, 2.0),
    "HANGUL": (0.3, 4.0, 0.70, 2.0),
    "OTHER": (0.25, 9.0, 0.90, 1.5),
}


class Pieces:
    """A sentencepiece model, loaded once a worker; tokens are remembered by word."""

    def __init__(self, proto: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.vocab_size())])
        self.known: dict[str, bytes] = {}

    def tokens(self, words: list[str]) -> np.ndarray:
        known = self.known
        new = list({w for w in words if w not in known})
        long: dict[str, bytes] = {}  # of this text only
        if new:
            if len(known) + len(new) > CACHE_WORDS:
                known.clear()
                new = list(set(words))
            for w, ids in zip(new, self.model.encode(new, num_threads=1), strict=True):
                (known if len(w) <= CACHE_CHARS else long)[w] = np.array(ids, "<i4").tobytes()
        return np.frombuffer(b"".join(known[w] if w in known else long[w] for w in words) if long else b"".join(map(known.__getitem__, words)), "<i4")


_LATIN = re.compile("[A-Za-zÀ-ɏ]")
_LETTER = re.compile(r"[^\W\d_]")


def script_of(text: str) -> str:
    """The script of most letters: the first word of their Unicode names, LATIN or OTHER."""
    letters = len(_LETTER.findall(text)) if not text.isascii() else 0
    if text.isascii() or 2 * len(_LATIN.findall(text)) >= letters:
        return "LATIN"
    names = Counter()
    for c, n in Counter(_LETTER.findall(text)).items():
        names[unicodedata.name(c, "OTHER").split(" ")[0]] += n
    top = names.most_common(1)[0][0]
    return top if top in BANDS else "OTHER"


def repeated_words(words: list[str]) -> int:
    """Words in 3-word windows that occur twice or more in the text, the first included."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    _, pair = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
    _, which, times = np.unique(pair[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    again = times[which] >= 2
    cover = np.zeros(len(words), bool)
    for k in range(3):
        cover[k : k + n] |= again
    return int(cover.sum())


def base_counts(text: str, words: list[str]) -> tuple[int, int, int, int]:
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line.strip(SPACE):
            if line in seen:
                dup += 1
            seen.add(line)
    return sum(map(len, words)), len(SYMBOLS.findall(text)), dup, repeated_words(words)


def split_words(text: str) -> list[str]:
    """Maximal runs without ASCII white space."""
    if text.isascii():
        # str.split() would also cut at the separators 0x1C to 0x1F
        if not re.search("[\x1c-\x1f]", text):
            return text.split()
    return [w.decode() for w in text.encode().split()]


def fertility(words: list[str], pieces: Pieces) -> tuple[float, float, float]:
    """Characters per token, share of byte-fallback tokens, entropy of the tokens in bits."""
    ids = pieces.tokens(words)
    if not len(ids):
        return 0.0, 0.0, 0.0
    counts = np.unique(ids, return_counts=True)[1] / len(ids)
    return sum(map(len, words)) / len(ids), float(pieces.is_byte[ids].mean()), float(-(counts * np.log2(counts)).sum())


def corpus_bands(measured: DataFrame) -> list[tuple[str, int, float, float, float, float, float]]:
    """Script, size and the band (least and most characters per token, most byte share, least and most entropy)
    of all that occur in the results of documents; the driver gets a row for each script and power of two."""
    found = (
        measured.where("not base_failed")
        .select("script", "_size", F.round("chars_per_token", 3).alias("per"), F.round("byte_share", 3).alias("share"), F.round("token_entropy", 3).alias("bits"), "n_words", "word_chars")
        .distinct()
        .groupBy("script", "_size")
        .agg(F.count("*").alias("n"), *[F.percentile(c, [0.25, 0.75]).alias(c) for c in ("per", "share", "bits")])
        .collect()
    )

    def fence(quartiles, least, n):
        low, high = quartiles
        room = max((FENCE + FENCE_FEW / math.sqrt(n)) * (high - low), least)
        return low - room, high + room

    made = []
    for r in found:
        ready = sorted((x for x in found if x.script == r.script), key=lambda x: x["_size"])
        # entropy grows with the size: a smaller size bounds it from below, a larger one from above
        below = [x for x in ready if x["_size"] <= r["_size"]]
        above = [x for x in ready if x["_size"] >= r["_size"]]
        per = fence(r.per, LEAST_PER * r.per[0], r.n)
        bits = min(fence(x.bits, LEAST_BITS, x.n)[0] for x in below[-1:]), max(fence(x.bits, LEAST_BITS, x.n)[1] for x in above[:1])
        made.append((r.script, r["_size"], *per, fence(r.share, LEAST_SHARE, r.n)[1], *bits))
    return made


def quality_rules(
    spark: SparkSession, docs: DataFrame, model_path: str, text_col: str = "text", keep: list[str] | None = None, bands: dict | None = None
) -> DataFrame:
    """The columns ``keep`` (default: all but the text and the results) and the rules' results:
    base counts, ``base_failed``, ``script``, the three measures and ``kept``.
    With ``bands`` these hold alone, and no others are drawn from the corpus."""
    from_corpus, bands = bands is None, BANDS if bands is None else bands
    with open(model_path, "rb") as f:
        content = f.read()
    proto = spark.sparkContext.broadcast(content)  # the model file, under 1 MB
    key = f"pieces:{hash(content)}"
    out = {
        "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
        "base_failed": "boolean", "kept": "boolean", "script": "string", "chars_per_token": "double", "byte_share": "double", "token_entropy": "double",
        "_size": "int",
    }
    results = [c for c in out if c != "_size"]
    keep = [c for c in docs.columns if c != text_col and c not in results] if keep is None else keep

    def make():
        pieces = per_process(key, lambda: Pieces(proto.value))

        def rules(text):
            words = split_words(text)
            n, base = len(words), base_counts(text, words)
            failed = n < 50 or 100 * base[3] > 50 * n
            script = script_of(text)
            per, share, bits = fertility(words, pieces)
            low, high, most, least = bands[script]
            # short texts can't reach a high entropy
            kept = not failed and low <= per <= high and share <= most and bits >= min(least, math.log2(max(n, 2)) - 1)
            size = round(base[0] / per).bit_length() - 1 if per else -1  # tokens, as a power of two
            return n, *base, failed, kept, script, per, share, bits, size

        return lambda texts: [list(c) for c in zip(*(rules(t or "") for t in texts))] if texts else [[]] * len(out)

    # the input's columns travel inside one, so no name of theirs meets one used here
    lead = free_name("_", keep)
    packed = docs.select(F.col(text_col).alias("t"), F.struct(F.lit(0).alias(lead), *[F.col(c) for c in keep]).alias("doc"))
    unpacked = [F.col("doc").getField(c).alias(c) for c in keep]
    measured = map_texts(packed, make, out, ["doc"], "t")
    if not from_corpus:
        return measured.select(*unpacked, *results)
    measured = stage_table(measured, "quality-measures")
    names = ("_low", "_high", "_most", "_least_bits", "_most_bits")
    table = spark.createDataFrame(corpus_bands(measured), "_script string, _of int, " + ", ".join(f"{n} double" for n in names))
    inside = F.col("chars_per_token").between(F.col("_low"), F.col("_high")) & (F.col("byte_share") <= F.col("_most"))
    inside &= F.col("token_entropy").between(F.col("_least_bits"), F.col("_most_bits"))
    met = measured.join(F.broadcast(table), (F.col("script") == F.col("_script")) & (F.col("_size") == F.col("_of")), "left")
    made = met.withColumn("kept", F.col("kept") & F.coalesce(inside, F.lit(True)))
    return made.select(*unpacked, *results)


__all__ = ["BANDS", "corpus_bands", "Pieces", "fertility", "quality_rules", "base_counts", "split_words", "script_of"]
