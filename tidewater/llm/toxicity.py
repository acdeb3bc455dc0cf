"""Toxicity by a lexicon, with misspellings and context.

The lexicon is learned: words, and openings of words, that labelled toxic texts
hold and others don't, by a likelihood ratio.  Its terms form a trie; a
Levenshtein automaton of one edit is intersected with it, so that a word is
walked through both at once and a misspelt term is found without comparing the
word with every term.  (The product's states are made when first needed and
kept, so most words leave it after three or four letters.)

Every hit is weighed by its context window: inside quotation marks, or near a
word of reporting, it counts as quotation, else as abuse.  The sums of both,
per document, go through a logistic curve.  A misspelt term is weighed the same way,
for a share of its term's weight.  A null text counts as empty; every row gives one
row, so repeated rows and ids are scored each; an empty table gives an empty table.
Other columns of the input, whatever their names, are left as they are.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import free_name, map_texts
from tidewater.llm.learning import SAMPLE_ROWS, fit, fold, labelled_sample
from tidewater.session import stage_table

#: Terms of a lexicon, at most; least toxic share of a term.  Its likelihood ratio has to beat
#: what chance gives among all that are tried (2 ln n) by a margin.
LEXICON_TERMS, LEAST_SHARE, RATIO_MARGIN = 4_000, 0.9, 4.0
#: Letters of an opening that may be a term ("abcd*"); least letters for a misspelling.
OPENINGS, LEAST_FUZZY = (4, 5), 5
#: Characters on either side that tell quotation from abuse.
WINDOW = 48
#: Words that report what others said, in the languages at hand.
REPORTING = ("said", "says", "quote", "quoted", "quoting", "wrote", "called", "term", "word", "dit", "écrit", "mot", "dijo", "escribió", "palabra", "sagte", "schrieb", "wort")
#: An apostrophe is a quotation mark only where a word ends or starts.
QUOTES = re.compile("[\"“”„«»‘`]|(?<!\\w)['’]|['’](?!\\w)")
#: What a misspelt term counts of the term itself.
FUZZY_SHARE = 0.5
WORD = re.compile(r"[^\W_]+")
N_FEATURES = 7
#: Words that a worker remembers as no hit.
CACHE_WORDS = 200_000


class Lexicon:
    """Trie of terms, walked together with a Levenshtein automaton of one edit."""

    def __init__(self, terms: dict[str, float], least_fuzzy: int = LEAST_FUZZY):
        self.kids: list[dict[str, int]] = [{}]
        self.whole: dict[int, str] = {}  # node -> term
        self.opening: dict[int, str] = {}
        self.fuzzy: set[int] = set()  # nodes that lie on a term long enough to be misspelt
        self.terms = terms
        for term in sorted(terms):
            letters, node, path = term.rstrip("*"), 0, [0]
            for c in letters:
                if c not in self.kids[node]:
                    self.kids[node][c] = len(self.kids)
                    self.kids.append({})
                node = self.kids[node][c]
                path.append(node)
            if term.endswith("*"):
                self.opening[node] = term
            else:
                self.whole[node] = term
                if len(letters) >= least_fuzzy:
                    self.fuzzy.update(path)
        start = self._close({(0, 0)})
        self.states: list[frozenset] = [start]
        self.number = {start: 0}
        self.next: list[dict[str, int]] = [{}]
        self.none: set[str] = set()

    def _close(self, points: set) -> frozenset:
        """Adds what a skipped letter of a term reaches; drops what can't be misspelt."""
        out = set(points)
        for node, e in points:
            if e == 0 and node in self.fuzzy:
                out.update((k, 1) for k in self.kids[node].values() if k in self.fuzzy)
        return frozenset(out)

    def _step(self, state: int, c: str) -> int:
        """The state after a letter; -1: no term can be reached any more."""
        out = set()
        for node, e in self.states[state]:
            kid = self.kids[node].get(c)
            if kid is not None and (e == 0 or kid in self.fuzzy):
                out.add((kid, e))
            if e == 0 and node in self.fuzzy:
                out.add((node, 1))  # a letter too many
                out.update((k, 1) for k in self.kids[node].values() if k in self.fuzzy)  # another letter
        points = self._close(out)
        if not points:
            at = -1
        elif (at := self.number.get(points)) is None:
            at = self.number[points] = len(self.states)
            self.states.append(points)
            self.next.append({})
        self.next[state][c] = at
        return at

    def find(self, word: str) -> tuple[str, int] | None:
        """The term that a lower-case word is, opens with or misspells, and the number of edits."""
        state, opened = 0, None
        for c in word:
            to = self.next[state].get(c)
            if to is None:
                to = self._step(state, c)
            if to < 0:
                return (opened, 0) if opened else None
            state = to
            if self.opening and opened is None:
                opened = next((self.opening[n] for n, e in self.states[state] if e == 0 and n in self.opening), None)
        exact = [self.whole[n] for n, e in self.states[state] if e == 0 and n in self.whole]
        if exact:
            return exact[0], 0
        if opened:
            return opened, 0
        near = sorted(self.whole[n] for n, e in self.states[state] if e == 1 and n in self.whole and n in self.fuzzy)
        near = [t for t in near if len(t) >= LEAST_FUZZY]
        return (near[0], 1) if near else None

    def hits(self, text: str) -> tuple[list[tuple[int, int, str, int]], int]:
        """(start, end, term, edits) of every hit, and the number of words."""
        low = lowered(text)
        words = WORD.findall(low)
        fresh = set(words) - self.none
        found = {}
        for w in fresh:
            hit = self.find(w)
            if hit:
                found[w] = hit
            elif len(w) <= 40:
                self.none.add(w)
        if len(self.none) > CACHE_WORDS:
            self.none.clear()
        if not found:
            return [], len(words)
        return [(m.start(), m.end(), *found[m[0]]) for m in WORD.finditer(low) if m[0] in found], len(words)


_REPORTS = re.compile(r"(?<!\w)(?:" + "|".join(REPORTING) + r")(?!\w)")


def lowered(text: str) -> str:
    """``text`` in small letters, each as long as it was ('İ' would grow to two), so that offsets hold."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def is_quoted(text: str, start: int, end: int, window: int = WINDOW) -> bool:
    """Whether a hit stands in quotation marks or next to a word of reporting."""
    low = max(0, start - window, text.rfind("\n", max(0, start - window), start) + 1)
    stop = text.find("\n", end, end + window)
    high = stop if stop >= 0 else min(len(text), end + window)
    opens = sum(low <= m.start() < start for m in QUOTES.finditer(text, low, min(len(text), start + 1)))
    closes = any(m.start() < high for m in QUOTES.finditer(text, end, min(len(text), high + 1)))
    return bool(opens % 2 and closes) or bool(_REPORTS.search(lowered(text[max(0, start - window // 2) : start])))


def features(lexicon: Lexicon, texts: list[str | None]) -> np.ndarray:
    out = np.zeros((len(texts), N_FEATURES))
    for i, text in enumerate(texts):
        text = text or ""
        hits, n = lexicon.hits(text)
        abuse = quote = fuzzy = weight = 0.0
        kinds = set()
        for start, end, term, edits in hits:
            # a misspelt term counts for a share of the term, in its window like any other
            if is_quoted(text, start, end):
                quote += FUZZY_SHARE if edits else 1
            elif edits:
                fuzzy += 1
                weight += FUZZY_SHARE * lexicon.terms[term]
                kinds.add(term)
            else:
                abuse += 1
                weight += lexicon.terms[term]
                kinds.add(term)
        out[i] = min(abuse, 3), math.log1p(weight), math.log1p(len(kinds)), math.log1p(quote), math.log1p(fuzzy), math.sqrt(abuse / (n + 20)), float(abuse > 0)
    return out


def learn_lexicon(sample: DataFrame, terms: int = LEXICON_TERMS) -> dict[str, float]:
    """Terms and their log odds, from a sample with ``text`` and ``label``.

    A term counts once for each pair of words that it stands between, so that copies of
    one text don't make a term of every word in it.
    """

    def tokens():
        def f(texts):
            rows, found, where = [], [], []
            for i, text in enumerate(texts):
                words = WORD.findall((text or "").lower())
                made: dict[str, int] = {}
                for k, w in enumerate(words):
                    if w in made:
                        continue
                    around = zlib.crc32(" ".join(words[max(0, k - 1) : k] + words[k + 1 : k + 2]).encode())
                    for term in [w] * (3 <= len(w) <= 40) + [w[:n] + "*" for n in OPENINGS if len(w) > n]:
                        made.setdefault(term, around)
                rows += [i] * len(made)
                found += made
                where += made.values()
            return [rows, found, where]

        return f

    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    bad, good = n.get(1, 0), n.get(0, 0)
    if not bad or not good:
        return {}
    share = bad / (bad + good)
    t, c = F.col("t"), F.col("c")
    expected = (t + c) * share
    ratio = 2 * (t * F.log(t / expected) + F.when(c > 0, c * F.log(c / ((t + c) - expected))).otherwise(0.0))
    odds = F.log((t + 0.5) / (bad + 1)) - F.log((c + 0.5) / (good + 1))
    tried = stage_table(
        map_texts(sample, tokens, {"term": "string", "around": "long"}, ["label"], explode=True)
        .distinct()
        .groupBy("term")
        .agg(F.sum("label").cast("double").alias("t"), F.sum(1 - F.col("label")).cast("double").alias("c"))
        .where(t >= 3),
        "toxicity-terms",
    )
    least = 2 * math.log(max(tried.count(), 2)) + RATIO_MARGIN
    rows = (
        tried.where((t / bad) / (t / bad + c / good) >= LEAST_SHARE)
        .select("term", odds.alias("odds"), ratio.alias("ratio"))
        .where((F.col("ratio") >= least) & (F.col("odds") > 0))
        .orderBy(F.desc("ratio"), "term")
        .limit(terms)
        .collect()  # LEXICON_TERMS at most
    )
    return {r.term: r.odds for r in rows}


def _scored(
    docs: DataFrame, labels: DataFrame, label: str, parts: int, held_out: int, id_col: str, text_col: str, threshold: float, sample_rows: int, keep: list[str]
) -> DataFrame:
    """``keep`` and, last, the score and the prediction under names that ``keep`` hasn't."""
    spark = docs.sparkSession
    sample, counts = labelled_sample(docs, labels, label, parts, held_out, id_col, text_col, sample_rows)
    sample = stage_table(sample, "toxicity-sample")  # 2 * sample_rows texts at most
    terms = spark.sparkContext.broadcast(learn_lexicon(sample))  # LEXICON_TERMS at most

    def measure():
        lexicon = Lexicon(terms.value)
        return lambda texts: [pa.array(features(lexicon, texts).tolist(), pa.list_(pa.float64()))]

    rows = map_texts(sample, measure, {"f": "array<double>"}, ["label"]).collect()  # 2 * sample_rows at most
    x = np.array([r.f for r in rows], dtype=float).reshape(-1, N_FEATURES)
    model = fit(x, np.array([r.label for r in rows], dtype=float), counts)

    def score():
        lexicon = Lexicon(terms.value)

        def f(texts):
            p = model.score(features(lexicon, texts))
            return [pa.array(p), pa.array((p >= threshold).astype(np.int32))]

        return f

    return map_texts(docs, score, {free_name("_score", keep): "double", free_name("_predicted", keep): "int"}, keep, text_col)


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    parts: int = 3,
    held_out: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.7,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Per document: the id, ``held_out``, ``score`` and ``predicted`` (``score`` at ``threshold`` or more).
    Without labels of both classes every score is the same."""
    made = _scored(docs, labels, label, parts, held_out, id_col, text_col, threshold, sample_rows, [id_col])
    score, predicted = made.columns[-2:]
    return made.select(id_col, (fold(id_col, parts) == held_out).alias("held_out"), F.col(score).alias("score"), F.col(predicted).alias("predicted"))


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    parts: int = 3,
    held_out: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.7,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``docs`` without the documents whose score reaches ``threshold``."""
    made = _scored(docs, labels, label, parts, held_out, id_col, text_col, threshold, sample_rows, docs.columns)
    return made.where(F.col(made.columns[-1]) == 0).select(docs.columns)


__all__ = ["LEXICON_TERMS", "Lexicon", "is_quoted", "learn_lexicon", "toxicity_scores", "drop_toxic"]
