"""Quality classifier by compression.

Two zstandard dictionaries are built from good and from bad labelled texts.  A
text that compresses better with the good one looks like good text.  The
difference of the compressed sizes, divided by the text's own size, and the
compressed sizes themselves go through a logistic curve fitted on labelled
texts that are in neither dictionary: the calibrated score.

Half of a bounded sample (``learning.SAMPLE_ROWS`` documents per class) fills
the dictionaries, the other half fits the curve.  A null text counts as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import map_texts
from tidewater.llm.learning import SAMPLE_ROWS, fit, fold, labelled_sample

#: Bytes of a dictionary, and of the excerpt that one text adds to it.
DICTIONARY_BYTES, EXCERPT_BYTES = 128 << 10, 768
N_FEATURES = 7


def _dictionary(texts: list[str]) -> bytes:
    parts, n = [], 0
    for text in texts:
        raw = text.encode()
        at = max(0, (len(raw) - EXCERPT_BYTES) // 2)
        part = raw[at : at + EXCERPT_BYTES]
        if n + len(part) > DICTIONARY_BYTES:
            break
        parts.append(part)
        n += len(part) + 1
    return b"\n".join(parts)


class Sizes:
    """Compressed sizes of a text: by itself, primed with good text, primed with bad text."""

    def __init__(self, good: bytes, bad: bytes, level: int = 3):
        import zstandard

        def packer(primer: bytes):
            if len(primer) < 8:
                return zstandard.ZstdCompressor(level=level)
            made = zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(level=level)
            return zstandard.ZstdCompressor(dict_data=made)

        self.plain, self.good, self.bad = zstandard.ZstdCompressor(level=level), packer(good), packer(bad)

    def features(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), N_FEATURES))
        for i, text in enumerate(texts):
            raw = (text or "").encode()
            n = len(raw) + 16
            own, good, bad = (len(p.compress(raw)) for p in (self.plain, self.good, self.bad))
            diff = (bad - good) / n
            out[i] = diff, (bad - good) / (bad + good), own / n, good / n, bad / n, np.log(n), diff * np.log(n)
        return out


def _curve(f: np.ndarray) -> np.ndarray:
    """The features, and their squares and products."""
    pairs = [f[:, i] * f[:, j] for i in range(f.shape[1]) for j in range(i, f.shape[1])]
    return np.concatenate([f, np.stack(pairs, axis=1)], axis=1)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    parts: int = 4,
    held_out: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
    threshold: float = 0.7,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The columns ``keep`` (default: the id), ``held_out``, ``score`` and ``predicted``."""
    keep = [id_col] if keep is None else keep
    spark = docs.sparkSession
    sample, counts = labelled_sample(docs, labels, label, parts, held_out, id_col, text_col, sample_rows)
    sample = sample.select("text", "label", (F.pmod(F.xxhash64("text"), F.lit(2)) == 0).alias("first"))
    # texts for the dictionaries: as many as can fill them; reaches the driver by design, within the documented bound
    half = DICTIONARY_BYTES // 256
    mined = [
        [r[0] for r in sample.where(F.col("first") & (F.col("label") == y)).orderBy(F.xxhash64("text", F.lit(1))).limit(half).select(
            F.expr(f"substring(text, greatest(1, int(length(text) / 2) - {EXCERPT_BYTES // 2}), {EXCERPT_BYTES})")).collect()]
        for y in (0, 1)
    ]
    bad, good = (_dictionary(m) for m in mined)
    primers = spark.sparkContext.broadcast((good, bad))  # 2 * DICTIONARY_BYTES at most

    def measure():
        sizes = Sizes(*primers.value)
        return lambda texts: [pa.array(sizes.features(texts).tolist(), pa.list_(pa.float64()))]

    rows = map_texts(sample.where("not first"), measure, {"f": "array<double>"}, ["label"]).collect()  # 2 * sample_rows at most
    x = np.array([r.f for r in rows], dtype=float).reshape(-1, N_FEATURES)
    model = fit(_curve(x), np.array([r.label for r in rows], dtype=float), counts)

    def score():
        sizes = Sizes(*primers.value)

        def f(texts):
            p = model.score(_curve(sizes.features(texts)))
            return [pa.array(p), pa.array((p >= threshold).astype(np.int32))]

        return f

    made = map_texts(docs, score, {"score": "double", "predicted": "int"}, list(dict.fromkeys([*keep, id_col])), text_col)
    return made.select(*keep, (fold(id_col, parts) == held_out).alias("held_out"), "score", "predicted")


__all__ = ["DICTIONARY_BYTES", "quality_scores"]
