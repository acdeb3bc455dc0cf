"""Secret scans: fixed patterns, and novelty measured by a primed compressor.

Base spans come from three patterns.  The method adds spans of kind ``novel``:
strings of key-like characters with a sensitive word (such as ``key`` or
``bearer``, or its plural) in the window around them, or in themselves, whose
marginal compressed size stays high when zstandard is primed with the code and
prose around them and with a dictionary of common identifiers.  Names, paths and
words repeat what the primer holds and cost few bytes; random strings cost
nearly all of their entropy.

Every candidate is measured.  As a compressor can't tell a long word that the primer
lacks from random letters, nor a number from a random one, what it finds novel has to be
confirmed: by bits a character under letter pairs of the dictionary, where digits
cost what digits hold and a change between small letters, capitals and digits costs
extra (not for a string right after a sensitive word that mixes letters and digits);
for a number by an assignment to a sensitive word right before it, or by LEAST_DIGITS digits.

The work is linear in a text: base spans are looked up by bisection, a run is cut
into pieces that are measured once.  Repeated rows and ids are kept, each row gives
one row, an empty table an empty table.  Columns of the input named like a
result are left out by default.

Offsets are code points, end exclusive.  A null text counts as empty.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from tidewater.llm.common import map_texts, per_process

#: Kinds in the order in which spans at one start are listed.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]+", r"[0-9a-f]{24,}"  # a run of 24 or more is a match of [0-9a-f]+ of that length
LEAST_VALUE, LEAST_ACCESS = 6, 20

#: Words that make what follows them sensitive.
SENSITIVE = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "access_key", "private", "credential", "auth", "bearer", "signature", "session", "cookie", "key")
#: Identifiers that are no secret though they stand in such places.
IDENTIFIERS = (
    "access_token refresh_token client_secret client_id private_key public_key secret_key api_key api_token "
    "authorization bearer username password passphrase credential credentials session_id cookie signature "
    "application configuration environment production development localhost example placeholder changeme "
    "your_api_key_here your_token_here your_secret_here xxxxxxxxxxxxxxxx 0000000000000000 1234567890 "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ https://www. http:// .com .org .json .yaml .html "
    "function return import class const static string integer boolean true false null none undefined default"
)
#: Common words and parts of words, from whose letter pairs the second measure is made.
WORDS = (
    "the and ing tion ation ment ness able ible ally ance ence ious less ful over under inter super trans anti auto micro multi "
    "that with have this from they would there their what about which when make like time just know people into year your good some could "
    "them other than then look only come over think also back after work first well even want because any these give day most "
    "container service manager controller handler factory provider response request message header content length version update create "
    "delete select insert database table column index number value result error exception test assert equal window button image file path name "
    "les des une est que pour dans qui sur pas plus avec sont mais comme tout elle nous vous leur cette être avoir faire "
    "der die und den von das mit sich des auf für ist nicht ein eine als auch werden aus hat dass sie nach bei wird einer schaft heit keit ung lich "
    "los las por con una para como más pero sus este entre cuando todo esta ser son dos también fue había era muy años hasta desde ción mente dad"
)
#: Bits a character from which a string of words, or one that only stands near a sensitive word, is novel; digits that a number needs.
LETTER_BITS, LEAST_DIGITS = 4.9, 24
#: Characters of context on either side; least length of a candidate; bytes a character from which it is novel.
CONTEXT, LEAST_CANDIDATE, NOVELTY = 256, 16, 0.72


def _letter_pairs() -> dict[str, float]:
    """Bits of each letter after each other one, or after none."""
    pairs, firsts = Counter(), Counter()
    for word in re.findall("[a-z]+", f"{IDENTIFIERS} {WORDS}".lower().replace("abcdefghijklmnopqrstuvwxyz", "")):
        for p in zip(" " + word, word):
            pairs["".join(p)] += 1
            firsts[p[0]] += 1
    letters = "abcdefghijklmnopqrstuvwxyz"
    return {x + y: -math.log2((pairs[x + y] + 0.25) / (firsts[x] + 0.25 * len(letters))) for x in " " + letters for y in letters}


def letter_bits(value: str, pairs: dict[str, float]) -> float:
    """Bits a character of a string by letter pairs, digits and changes of kind; separators cost nothing but count."""
    bits, before, kind = 0.0, " ", ""
    for c in value:
        now = "0" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else ""
        if now == "0":
            bits += math.log2(10)
        elif now:
            # a word may start with a capital, after a small letter too
            start = kind == "a" and now == "A"
            bits += pairs[(" " if start or kind == "0" else before) + c.lower()]
        if kind and now and kind != now and (kind, now) != ("A", "a"):
            bits += 2.0
        before, kind = (c.lower() if now in ("a", "A") and now else " "), now
    return bits / len(value)


def _make(novelty: float, least: int, context: int):
    assign = re.compile(ASSIGN, re.I | re.A)
    access, hexes = re.compile(ACCESS), re.compile(HEX)
    words = "|".join(SENSITIVE)
    # a sensitive word, its plural or its longer forms, not the opening of another word
    sensitive = re.compile(rf"(?:(?i:{words})(?i:s|orization|entication)?)(?:(?![A-Za-z])|(?<=[a-z])(?=[A-Z]))", re.A)
    # right before a candidate: at most a few separators after the word
    right_before = re.compile(rf"(?:{words})[^A-Za-z0-9\n]{{1,8}}(?:is\x20|of\x20)?", re.I | re.A)
    candidate = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % least)
    pairs = _letter_pairs()

    def marginal(text: str, start: int, end: int) -> float:
        """Compressed bytes that the candidate adds, per character."""
        import zstandard

        around = (IDENTIFIERS + text[max(0, start - context) : start] + "\n" + text[end : end + context]).encode()
        primer = zstandard.ZstdCompressionDict(around, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        packer = zstandard.ZstdCompressor(level=3, dict_data=primer, write_content_size=False, write_dict_id=False)
        empty = per_process("zstd:empty", lambda: len(packer.compress(b" ")))
        return (len(packer.compress(text[start:end].encode())) - empty) / (end - start)

    def mixed(value: str) -> bool:
        """Has a part with both letters and digits: is no number and not made of words."""
        return any(any(c.isdigit() for c in p) and any(c.isalpha() for c in p) for p in re.split("[-_/+=.]", value))

    def novel(text: str, start: int, end: int, near: bool) -> bool:
        if marginal(text, start, end) < novelty:
            return False
        value = text[start:end]
        if not any(c.isalpha() for c in value):
            # numbers are incompressible too: the second measure is an assignment right before, or their length
            assigned = near and text[max(0, start - 8) : start].rstrip(" \"'").endswith((":", "="))
            return assigned or sum(c.isdigit() for c in value) >= LEAST_DIGITS
        return (near and mixed(value)) or letter_bits(value.rstrip("="), pairs) >= LETTER_BITS

    def spans(text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end), sorted."""
        found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
        found += [(m.start(), 1, m.end()) for m in access.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
        found += [(m.start(), 2, m.end()) for m in hexes.finditer(text)]
        found.sort()
        new, runs = [], list(candidate.finditer(text))
        if not runs:
            return found
        places = [(m.start(), m.end()) for m in sensitive.finditer(text)]
        near = {m.end() for m in right_before.finditer(text)}
        starts = [p[0] for p in places]
        after = sorted(near)
        # the base spans as disjoint stretches, so each candidate looks at one of them
        taken: list[list[int]] = []
        for s, _, e in found:
            if taken and s <= taken[-1][1]:
                taken[-1][1] = max(taken[-1][1], e)
            else:
                taken.append([s, e])
        ends = [e for _, e in taken]

        def free(start: int, end: int) -> bool:
            k = bisect_right(ends, start)
            return k == len(taken) or taken[k][0] >= end

        for m in runs:
            end = m.end() - (len(m[0]) - len(m[0].rstrip(".-")))
            first = m.start() + (len(m[0]) - len(m[0].lstrip(".=-")))
            # the run, then its pieces after a sensitive word or an equals sign inside it, each up to the next one
            inside = {*after[bisect_left(after, first + 1) : bisect_left(after, end)], *(first + e.end() for e in re.finditer("=+", text[first:end]))}
            cuts = [first, *sorted(i for i in inside if first < i < end), end]
            for start, stop in [(first, end), *(list(zip(cuts, cuts[1:])) if len(cuts) > 2 else [])]:
                stop = start + len(text[start:stop].rstrip("=")) if stop < end else stop
                if stop - start < least or not free(start, stop):
                    continue
                k = bisect_left(starts, start - context)
                if start not in near and not (k < len(places) and places[k][1] <= stop + context):
                    continue
                if novel(text, start, stop, start in near):
                    new.append((start, 3, stop))
                    break
        return sorted(found + new)

    return spans


def find_secrets(
    docs: DataFrame,
    text_col: str = "text",
    keep: list[str] | None = None,
    novelty: float = NOVELTY,
    least: int = LEAST_CANDIDATE,
    context: int = CONTEXT,
) -> DataFrame:
    """The columns ``keep`` (default: all but the text and the results) and, per document,
    ``n_assign``, ``n_access``, ``n_hex``, ``n_novel``, ``base_spans`` and ``spans``:
    kind:start:end, comma-joined, by start and then in the order of KINDS."""
    out = {"n_assign": "long", "n_access": "long", "n_hex": "long", "n_novel": "long", "base_spans": "string", "spans": "string"}
    keep = [c for c in docs.columns if c != text_col and c not in out] if keep is None else keep

    def make():
        spans = _make(novelty, least, context)

        def f(texts):
            rows = [spans(t or "") for t in texts]
            counts = [[sum(k == kind for _, k, _ in r) for r in rows] for kind in range(4)]
            write = lambda r: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in r)
            return [*counts, [write([x for x in r if x[1] < 3]) for r in rows], [write(r) for r in rows]]

        return f

    return map_texts(docs, make, out, keep, text_col)


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", **limits) -> DataFrame:
    """``docs`` with every reported span (and what overlaps it) replaced by ``mark``; null texts stay null."""
    novelty, least, context = (limits.get(k, d) for k, d in (("novelty", NOVELTY), ("least", LEAST_CANDIDATE), ("context", CONTEXT)))

    def make():
        spans = _make(novelty, least, context)

        def clean(text):
            if text is None:
                return None
            made, at = [], 0
            for s, _, e in spans(text):
                if s >= at:
                    made += [text[at:s], mark]
                at = max(at, e)
            return "".join([*made, text[at:]])

        return lambda texts: [pa.array([clean(t) for t in texts], pa.string())]

    keep = [c for c in docs.columns if c != text_col]
    return map_texts(docs, make, {text_col: "string"}, keep, text_col).select(docs.columns)


__all__ = ["KINDS", "find_secrets", "redact_secrets"]
