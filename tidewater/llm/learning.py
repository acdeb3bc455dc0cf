"""Labelled samples of a bounded size, and a small logistic model."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents per class that a classifier is fitted on, at most.
SAMPLE_ROWS = 4_000
#: Characters of a text in such a sample; of a longer one, as many from so many places spread over all of it.
SAMPLE_CHARS, SAMPLE_PLACES = 65_536, 16


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts


def excerpt(text: Column, chars: int = SAMPLE_CHARS, places: int = SAMPLE_PLACES) -> Column:
    """A text, or ``chars`` of its characters in ``places`` stretches from the first to the last, one a line."""
    wide = chars // places
    step = (F.length(text) - wide) / (places - 1)
    cut = F.transform(F.sequence(F.lit(0), F.lit(places - 1)), lambda i: F.substring(text, F.floor(i * step).cast("int") + 1, F.lit(wide)))
    return F.when(F.length(text) <= chars, text).otherwise(F.array_join(cut, "\n"))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, parts: int, held_out: int, id_col: str, text_col: str, rows: int = SAMPLE_ROWS
) -> tuple[DataFrame, dict[int, int]]:
    """Texts with their label (``text``, ``label``): at most ``rows`` per class, by a hash of
    the id; and the number of labelled ids per class.  Ids in the fold ``held_out`` and ids
    with contradicting labels are not used."""
    known = (
        labels.where(F.col(label).isin(0, 1) & (fold(id_col, parts) != held_out) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min(label).alias("label"), F.max(label).alias("_most"))
        .where("label = _most")
        .select("_id", F.col("label").cast("int").alias("label"))
    )
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    picked = [known.where(F.col("label") == y).orderBy(F.xxhash64("_id"), "_id").limit(rows) for y in (0, 1)]
    ids = picked[0].unionByName(picked[1]).collect()  # 2 * rows at most
    few = docs.sparkSession.createDataFrame(ids, known.schema)
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(few), "_id").select(excerpt(F.col("text")).alias("text"), "label"), counts


class Logistic:
    """L2-regularised logistic regression on standardised features; ``prior`` moves the
    balance of the sample to that of all labels."""

    def __init__(self, x: np.ndarray, y: np.ndarray, counts: dict[int, int], l2: float = 1.0, steps: int = 50):
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        z = self._design(x)
        w = np.zeros(z.shape[1])
        ridge = np.full(z.shape[1], l2)
        ridge[0] = 1e-6
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
            grad = z.T @ (p - y) + ridge * w
            hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge)
            step = np.linalg.solve(hess, grad)
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        pos, neg = max(y.sum(), 1), max((1 - y).sum(), 1)
        w[0] += np.log(max(counts.get(1, 0), 1) / max(counts.get(0, 0), 1)) - np.log(pos / neg)
        self.w = w

    def _design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([np.ones((len(z), 1)), z], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._design(x) @ self.w, -35, 35)))


class Constant:
    """What is left to say where the labels hold one class or none."""

    def __init__(self, p: float):
        self.p = p

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.p)


def fit(x: np.ndarray, y: np.ndarray, counts: dict[int, int], l2: float = 1.0):
    if len(set(y.tolist())) < 2:
        return Constant(0.5 if not len(y) else float(y[0]) * 0.98 + 0.01)
    return Logistic(x, y, counts, l2)


__all__ = ["SAMPLE_ROWS", "SAMPLE_CHARS", "excerpt", "fold", "labelled_sample", "fit"]
