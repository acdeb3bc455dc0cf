"""Personal data: anchors found by Aho-Corasick, grown by small parsers.

One pass of an Aho-Corasick automaton over a text finds the anchors: at-signs,
plus signs, digits, digits before a dot, schemes (``://``), double colons,
bracketed ``[at]`` and identifier cues such as ``IBAN`` or ``account``.  At each
anchor a parser of its kind grows the match to the left and right by fixed
character classes and validates what it has: parts of an address, a check
digit, a number of digits.  No character is visited more than a few times, so
the work is linear in a text, however long it is.

Base kinds follow the stated patterns, leftmost and without overlap in a kind:

* ``email``  ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ``ip``     four runs of digits joined by dots, each at most 255
* ``card``   digits, each after at most one space or hyphen; 16 to 19 that pass Luhn
* ``phone``  ``\\+[0-9][\\x20().0-9-]+[0-9]`` with 8 to 15 digits

Added kinds: ``userinfo`` (name and password of a URL), ``ipv6`` (with a double
colon), ``hidden`` (an email with a bracketed at), and after a cue ``iban``
(country, length and check sum), ``ssn`` and ``account``.

A null or empty text has no spans.  Every row of the input gives one row, so
repeated rows and ids are kept; an empty table gives an empty table.  Offsets
are code points, end exclusive.  Spans of different kinds may overlap.
"""

from __future__ import annotations

import ipaddress

import pyarrow as pa
from pyspark.sql import DataFrame

from tidewater.llm.common import map_texts, per_process

#: Kinds in the order in which spans are listed; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "userinfo", "ipv6", "hidden", "iban", "ssn", "account")
BASE = 4

_DIGITS = frozenset("0123456789")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_UPPER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_WORD = _DIGITS | _LETTERS
_LOCAL = _WORD | frozenset("._%+-")
_LABEL = _WORD | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_HEX = frozenset("0123456789abcdefABCDEF:.")
_USER = _WORD | frozenset("._%+-~!$&'()*,;=:")
#: Words that announce an identifier, with the kind that follows.
CUES = {
    "iban": "iban", "ssn": "ssn", "social security": "ssn", "account": "account", "acct": "account", "a/c": "account",
    "konto": "account", "kontonummer": "account", "cuenta": "account", "compte": "account",
}
#: Characters between a cue and its identifier; least and most digits of an account.
CUE_GAP, ACCOUNT_DIGITS = 24, (6, 17)
#: Words allowed between a cue and its identifier.
CUE_WORDS = frozenset("no nr num number nummer numero is is: the code id".split())
#: The longest text of an IPv6 address.
IPV6_CHARS = 45


def _run(text: str, at: int, chars: frozenset, end: int) -> int:
    """End of the run of ``chars`` that starts at ``at``."""
    while at < end and text[at] in chars:
        at += 1
    return at


def _back(text: str, at: int, chars: frozenset, least: int) -> int:
    """Start of the run of ``chars`` that ends before ``at``, not before ``least``."""
    while at > least and text[at - 1] in chars:
        at -= 1
    return at


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def domain_end(text: str, at: int) -> int:
    """End of two or more labels joined by dots from ``at``, -1 if there are none."""
    n = len(text)
    end = _run(text, at, _LABEL, n)
    dots = 0
    while at < end < n and text[end] == ".":
        last = _run(text, end + 1, _LABEL, n)
        if last == end + 1:
            break
        end, dots = last, dots + 1
    return end if dots else -1


def email_at(text: str, sign: int, least: int) -> tuple[int, int] | None:
    """The address around the at-sign at ``sign``, its local part from ``least`` on."""
    start = _back(text, sign, _LOCAL, least)
    end = domain_end(text, sign + 1) if start < sign else -1
    return (start, end) if end > 0 else None


def ip_at(text: str, digit: int, least: int) -> tuple[int, int, bool] | None:
    """Four numbers joined by dots, the first of which ends at ``digit``; whether they are in range."""
    n, start = len(text), _back(text, digit, _DIGITS, least)
    parts, at = [text[start : digit + 1]], digit + 1
    while len(parts) < 4:
        if at >= n or text[at] != ".":
            return None
        end = _run(text, at + 1, _DIGITS, n)
        if end == at + 1:
            return None
        parts.append(text[at + 1 : end])
        at = end
    return start, at, all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in parts)


def digit_chain(text: str, at: int) -> tuple[int, str]:
    """End and digits of the chain that starts at the digit ``at``: one space or hyphen may stand between two."""
    n, start, end = len(text), at, at + 1
    while end < n:
        if text[end] in _DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in _DIGITS:
            end += 2
        else:
            break
    return end, text[start:end].replace(" ", "").replace("-", "")


def phone_at(text: str, plus: int) -> tuple[int, int] | None:
    n = len(text)
    if plus + 1 >= n or text[plus + 1] not in _DIGITS:
        return None
    last = _run(text, plus + 2, _PHONE, n)
    while last > plus + 3 and text[last - 1] not in _DIGITS:
        last -= 1
    return (plus, last) if last > plus + 3 and text[last - 1] in _DIGITS else None


def userinfo_at(text: str, colon: int) -> tuple[int, int] | None:
    """``name:password`` between a scheme and its host; at most one pass to the next slash or space."""
    start = colon + 3
    end = _run(text, start, _USER, len(text))
    inside = text[start:end]
    ok = end < len(text) and text[end] == "@" and ":" in inside[1:-1] and domain_or_host(text, end + 1)
    return (start, end) if ok and colon and text[colon - 1] in _LETTERS else None


def domain_or_host(text: str, at: int) -> bool:
    return at < len(text) and text[at] in _WORD


def ipv6_at(text: str, colon: int) -> tuple[int, int] | None:
    """An address around a double colon, of two groups at least, that no letter or digit touches."""
    n = len(text)
    start = _back(text, colon, _HEX, max(0, colon - IPV6_CHARS - 1))
    end = _run(text, colon, _HEX, min(n, colon + IPV6_CHARS + 1))
    while end > start and text[end - 1] == "." or text[start:end].endswith(":") and not text[start:end].endswith("::"):
        end -= 1
    if (start and text[start - 1] in _WORD) or (end < n and text[end] in _WORD) or end - start > IPV6_CHARS:
        return None
    value = text[start:end]
    if len([g for g in value.split(":") if g]) < 2 or not any(c in _DIGITS for c in value):
        return None
    try:
        ipaddress.IPv6Address(value)
    except ValueError:
        return None
    return start, end


def hidden_at(text: str, start: int, end: int) -> tuple[int, int] | None:
    """An email whose at-sign is the bracketed word from ``start`` to ``end``."""
    first = _back(text, _back(text, start, frozenset(" "), max(0, start - 1)), _LOCAL, 0)
    at = end + (end < len(text) and text[end] == " ")
    last = domain_end(text, at)
    for dot in (" [dot] ", "[dot]", " (dot) ", "(dot)"):
        label = _run(text, at, _LABEL, len(text))
        if last < 0 and label > at and text[label : label + len(dot)] == dot:
            stop = _run(text, label + len(dot), _LABEL | {"."}, len(text))
            last = stop if stop > label + len(dot) else -1
    has_local = first < start and text[first] in _WORD
    return (first, last) if has_local and last > 0 else None


def after_cue(text: str, at: int) -> int:
    """Where the identifier after a cue starts: small separators and a few fixed words may stand between; -1 if none."""
    n = min(len(text), at + CUE_GAP)
    while at < n:
        if text[at] in " \t:=#.-\"'(":
            at += 1
        elif text[at] in _LETTERS:
            end = _run(text, at, _LETTERS, min(len(text), at + CUE_GAP))
            if text[at:end].lower() not in CUE_WORDS:
                return at
            at = end
        else:
            return at
    return -1


def iban_at(text: str, at: int) -> tuple[int, int] | None:
    """Country, check digits and account with single spaces, 15 to 34 characters of the right check sum."""
    n, end, value, good = len(text), at, "", None
    while end < n and len(value) < 35:
        if text[end] in _DIGITS or text[end] in _UPPER:
            value, end = value + text[end], end + 1
            if len(value) >= 15 and (end == n or text[end] not in _WORD) and len(value) <= 34:
                if value[:2].isalpha() and value[2:4].isdigit() and int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1:
                    good = (at, end)
        elif text[end] == " " and value and text[end - 1] != " ":
            end += 1
        else:
            break
    return good


def ssn_at(text: str, at: int) -> tuple[int, int] | None:
    if at >= len(text) or text[at] not in _DIGITS:
        return None
    end, digits = digit_chain(text, at)
    plain = len(digits) == 9 and digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"
    return (at, end) if plain and len(text[at:end]) in (9, 11) else None


def account_at(text: str, at: int) -> tuple[int, int] | None:
    if at >= len(text) or text[at] not in _DIGITS or (at and text[at - 1] in _WORD):
        return None
    end, digits = digit_chain(text, at)
    low, high = ACCOUNT_DIGITS
    return (at, end) if low <= len(digits) <= high and not (end < len(text) and text[end] in _WORD) else None


def anchors():
    """The automaton: each pattern carries its kind of anchor and its length."""
    import ahocorasick

    found = ahocorasick.Automaton()
    fixed = {"@": "sign", "+": "plus", "://": "scheme", "::": "colons"}
    fixed |= {d: "digit" for d in "0123456789"} | {f"{d}.": "dotted" for d in "0123456789"}
    fixed |= {w: "at" for w in ("[at]", "(at)", "[AT]", "(AT)")}
    fixed |= {form: kind for cue, kind in CUES.items() for form in (cue, cue.title(), cue.upper(), cue.capitalize())}
    for word, kind in fixed.items():
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def spans_of(text: str, automaton) -> list[tuple[int, int, int]]:
    """(kind, start, end), sorted by kind and start."""
    found: set[tuple[int, int, int]] = set()
    ends = dict.fromkeys(("email", "ip", "card", "hidden"), 0)

    def add(kind, span):
        if span:
            found.add((KINDS.index(kind), *span[:2]))

    for last, (kind, length) in automaton.iter(text):
        start, end = last + 1 - length, last + 1
        if kind == "digit":
            if start >= ends["card"]:
                ends["card"], digits = digit_chain(text, start)
                if 16 <= len(digits) <= 19 and luhn(digits):
                    add("card", (start, ends["card"]))
        elif kind == "dotted":
            if start >= ends["ip"] and (ip := ip_at(text, start, ends["ip"])):
                ends["ip"] = ip[1]
                add("ip", ip if ip[2] else None)
        elif kind == "sign":
            if email := email_at(text, start, ends["email"]):
                ends["email"] = email[1]
                add("email", email)
        elif kind == "plus":
            phone = phone_at(text, start)
            if phone and 8 <= sum(c in _DIGITS for c in text[phone[0] : phone[1]]) <= 15:
                add("phone", phone)
        elif kind == "scheme":
            add("userinfo", userinfo_at(text, start))
        elif kind == "colons":
            add("ipv6", ipv6_at(text, start))
        elif kind == "at":
            hidden = hidden_at(text, start, end)
            if hidden and hidden[0] >= ends["hidden"]:
                ends["hidden"] = hidden[1]
                add("hidden", hidden)
        elif (start == 0 or text[start - 1] not in _LETTERS) and (end == len(text) or text[end] not in _LETTERS):
            at = after_cue(text, end)
            if at >= 0:
                add(kind, {"iban": iban_at, "ssn": ssn_at, "account": account_at}[kind](text, at))
    return sorted(found)


def find_personal_data(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all but the text and the results) and, per document, ``n_email``, ``n_ip``,
    ``n_card``, ``n_phone``, ``n_added``, ``base_spans`` and ``spans``: kind:start:end, comma-joined, by kind as
    listed in KINDS and then by start.  A column of the input that is named like a result is left out by default."""
    out = {"n_email": "long", "n_ip": "long", "n_card": "long", "n_phone": "long", "n_added": "long", "base_spans": "string", "spans": "string"}
    keep = [c for c in docs.columns if c != text_col and c not in out] if keep is None else keep

    def make():
        automaton = per_process("personal:anchors", anchors)

        def f(texts):
            rows = [spans_of(t, automaton) if t else [] for t in texts]
            counts = [[sum(k == kind for k, _, _ in r) for r in rows] for kind in range(BASE)]
            added = [sum(k >= BASE for k, _, _ in r) for r in rows]
            write = lambda r: ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in r)
            return [*counts, added, [write([x for x in r if x[0] < BASE]) for r in rows], [write(r) for r in rows]]

        return f

    return map_texts(docs, make, out, keep, text_col)


def mask_personal_data(docs: DataFrame, text_col: str = "text", mark: str = "[{kind}]") -> DataFrame:
    """``docs`` with every span, and what overlaps it, replaced by ``mark``; null texts stay null."""

    def make():
        automaton = per_process("personal:anchors", anchors)

        def clean(text):
            made, at = [], 0
            for s, e, k in sorted((s, e, k) for k, s, e in spans_of(text, automaton)):
                if s >= at:
                    made += [text[at:s], mark.format(kind=KINDS[k].upper())]
                at = max(at, e)
            return "".join([*made, text[at:]])

        return lambda texts: [pa.array([None if t is None else clean(t) for t in texts], pa.string())]

    keep = [c for c in docs.columns if c != text_col]
    return map_texts(docs, make, {text_col: "string"}, keep, text_col).select(docs.columns)


__all__ = ["KINDS", "find_personal_data", "mask_personal_data"]
