"""Repeated byte strings by a difference-cover suffix array, spread by content.

Two equal strings of ``length`` bytes hold the same winnowing fingerprint (the
least hash of the 64-byte strings in them) in the same place.  So the strings
that a fingerprint is the one of, its context, go to the task of that
fingerprint if it comes back, and strings can only be equal to strings in the
same task.  There the suffixes of the contexts are put in order by the difference-cover
algorithm: the triples at two of every three places are sorted and named, the
sequence of names is ordered in the same way, the other suffixes are sorted by
their first byte and the rank behind it and merged in, and neighbours in the
order are compared by ``length`` bytes.  Depths beyond ``length`` don't matter,
so the recursion ends there.

Equal contexts are counted by their names first.  These come back as a whole, and
a fingerprint whose contexts are all equal, or all come back so, sends none to be
sorted; of equal ones a task sends one.  A fingerprint with very many different contexts is not sorted in one task: its
contexts are cut into pieces with a few starts each and dealt anew by the bytes
that all strings of a piece have in common; a piece that nothing shares these
with goes no further.  What is still too many then are strings that agree in
nearly all bytes; each of these is dealt by its own content.

A null text counts as empty.  Results are judged on the input.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import map_texts
from tidewater.llm.tables import is_marked, low_bits, marks, name_place, name_places
from tidewater.session import scratch_path, scratch_scope, stage_table

#: Bytes of a repeated string, and of the strings that fingerprints are hashes of.
LENGTH, GRAM = 200, 64
#: Bits of the table that marks fingerprints which come back (8 MB); others that it marks do no harm.
MARKS = 1 << 26
#: Different contexts of a fingerprint that are sorted in one task, at most.
MANY = 400
#: Bits of the table that marks fingerprints with more (128 kB).
LARGE_MARKS = 1 << 20
#: Starts of strings in a piece of such a fingerprint's contexts.
STEP = 18
#: Bits of the table that marks texts with something to remove (2 MB); others that it marks do no harm.
TEXT_MARKS = 1 << 24
#: Bytes of contexts that are sorted at a time, about, and rows that are looked at for it.
BATCH_BYTES, BATCH_ROWS = 1_000_000, 2_000
#: Names that a task remembers to send an equal context once only.
REMEMBERED = 500_000
#: Grams that are looked at in one go.
SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    made = []
    for base in (_BASE, inverse):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        made.append(np.cumprod(p, dtype=np.uint64))
    return made[0], made[1]


class Fingerprints:
    """Winnowing over the 64-byte strings of a text."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram, self.window = length, gram, length - gram + 1
        self.power, self.back = _powers(4096)

    def find(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the fingerprints of all strings of ``length`` bytes."""
        _, _, place, h, _, _ = self.find_all([raw])
        return place, h

    def find_all(self, raws: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The texts in a row, and for each fingerprint of their strings of ``length`` bytes: whose text,
        its place, its hash, and the first and last start of the strings that it is the one of (all
        in the row of texts)."""
        row = b"".join(raws)
        size = np.array([len(r) for r in raws], np.int64)
        end = np.cumsum(size)
        flat = np.frombuffer(row, np.uint8)
        # starts whose string ends in the same text
        inside = np.repeat(end, size) - np.arange(len(flat)) >= self.length
        none = np.zeros(0, np.int64)
        places, hashes, firsts, lasts = [none], [np.zeros(0, np.uint64)], [none], [none]
        for at in range(0, len(flat) - self.length + 1, SLICE):
            part = flat[at : at + SLICE + self.length - 1]
            starts = np.flatnonzero(inside[at : at + len(part) - self.length + 1])
            if len(starts):
                p, h = self._slice(part)
                p = p[starts]
                new = np.flatnonzero(np.diff(p, prepend=-1))
                places.append(p[new] + at)
                hashes.append(h[p[new]])
                firsts.append(starts[new] + at)
                lasts.append(starts[np.append(new[1:], len(p)) - 1] + at)
        place, h, first, last = (np.concatenate(x) for x in (places, hashes, firsts, lasts))
        # the strings of a fingerprint may start in two slices
        new = np.flatnonzero(np.diff(place, prepend=-1))
        last = last[np.append(new[1:], len(place)) - 1] if len(new) else last
        return row, np.searchsorted(end, place[new], "right"), place[new], h[new], first[new], last

    def _slice(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each start the place of its string's fingerprint, and the hashes at all places."""
        n = len(part)
        if n >= len(self.power):
            self.power, self.back = _powers(2 * n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=total[1:])
        h = (total[self.gram :] - total[: -self.gram]) * self.back[: n - self.gram + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        bits = np.uint64(21)
        least = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)
        wide = 1
        while 2 * wide <= self.window:
            least = np.minimum(least[:-wide], least[wide:])
            wide *= 2
        rest = self.window - wide
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        return (least & np.uint64((1 << 21) - 1)).astype(np.int64), h


def _sorted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of numbers from 0 in their order, and which of these begin a new value."""
    bits = max(len(key) - 1, 1).bit_length()
    if int(key.max(initial=0)) < 1 << (63 - bits):
        # a number and its place in one, so that no indirect sort is needed
        both = np.sort(key << bits | np.arange(len(key)))
        at, value = both & ((1 << bits) - 1), both >> bits
    else:
        at = np.argsort(key, kind="stable")
        value = key[at]
    new = np.ones(len(key), bool)
    new[1:] = value[1:] != value[:-1]
    return at, new


def _named(key: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers from 0 in the order of ``key``, the same where it is, and how many there are."""
    at, new = _sorted(key)
    name = np.empty(len(key), np.int64)
    name[at] = np.cumsum(new) - 1
    return name, int(new.sum())


def _smaller(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each x how many of x and how many of y are smaller, and for each y how many of x."""
    at, new = _sorted(np.concatenate([x, y]))
    of_x = at < len(x)
    group = np.flatnonzero(new)[np.cumsum(new) - 1]
    before = (np.cumsum(of_x) - of_x)[group]
    in_x, out = at[of_x], [np.empty(len(x), np.int64), np.empty(len(x), np.int64), np.empty(len(y), np.int64)]
    out[0][in_x], out[1][in_x], out[2][at[~of_x] - len(x)] = before[of_x], (group - before)[of_x], before[~of_x]
    return out[0], out[1], out[2]


def suffix_ranks(s: np.ndarray, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """Ranks of the suffixes of ``s`` (numbers from 1) by their first ``depth`` symbols at least;
    suffixes that agree in these have ranks next to each other or the same.  With ``wanted``
    (True for some places), only the ranks of these among each other are right."""
    n = len(s)
    if depth <= 1 or n < 3:
        if n < 3 and depth > 1:
            return np.array([sum(s[j:].tolist() < s[i:].tolist() for j in range(n)) for i in range(n)], np.int64)
        return s.astype(np.int64)
    t = np.concatenate([s, np.zeros(3, s.dtype)]).astype(np.int64)
    p1, p2, p0 = np.arange(1, n, 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sample = np.concatenate([p1, p2])
    k = int(t.max()) + 1
    # the triples at the difference cover, named by their order
    triple = t[sample] * k + t[sample + 1]
    if k**3 >= 1 << 40:
        triple = _named(triple)[0]
    name, different = _named(triple * k + t[sample + 2])
    name = name + 1
    if different < len(sample) and depth > 3:
        name = suffix_ranks(np.concatenate([name[: len(p1)], [0], name[len(p1) :]]), -(-depth // 3) + 1) + 1
        name = np.concatenate([name[: len(p1)], name[len(p1) + 1 :]])
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = name
    m = int(name.max(initial=0)) + 2
    if wanted is not None:
        p0, p1, p2 = p0[wanted[p0]], p1[wanted[p1]], p2[wanted[p2]]
        sample = np.concatenate([p1, p2])
    # the others by a symbol and the rank behind it; both kinds are compared where cover meets cover
    pair = t[:-1] * k + t[1:]
    if k * k * m >= 1 << 42:
        pair = _named(pair)[0]
    a0, b0 = t[p0] * m + rank[p0 + 1], pair[p0] * m + rank[p0 + 2]
    a1, b2 = t[p1] * m + rank[p1 + 1], pair[p2] * m + rank[p2 + 2]
    smaller = np.concatenate([[0], np.cumsum(np.bincount(rank[sample], minlength=m))])
    out = np.zeros(n, np.int64)
    out[sample] = smaller[rank[sample]]
    own, first, of_p1 = _smaller(a0, a1)
    _, second, of_p2 = _smaller(b0, b2)
    out[p0] = own + first + second
    out[p1] += of_p1
    out[p2] += of_p2
    return out


def repeated_starts(contexts: list[bytes], group: np.ndarray, shift: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, start) in this order: the starts of the contexts' strings of ``length`` bytes that another
    context of the same group has at the same distance from the fingerprint (``shift`` + start)."""
    size = np.array([len(c) for c in contexts], np.int64)
    begin = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
    # one zero ends each context; the symbols are 1 to 256
    text = np.zeros(int((size + 1).sum()) + 8, np.int64)
    flat = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8)
    text[: len(flat)] = flat.astype(np.int64) + 1
    text[begin + size] = 0
    n = np.maximum(size - length + 1, 0)
    owner = np.repeat(np.arange(len(contexts)), n)
    start = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    place = begin[owner] + start
    wanted = np.zeros(len(flat), bool)
    wanted[place] = True
    order = _sorted(suffix_ranks(text[: len(flat)], length, wanted)[place])[0]
    place, owner, start = place[order], owner[order], start[order]
    # neighbours that agree in all bytes
    word = np.zeros(len(text), np.uint64)
    for i in range(8):
        word[: len(text) - 8] |= (text[i : len(text) - 8 + i] & 0xFF).astype(np.uint64) << np.uint64(8 * i)
    same = np.arange(len(place) - 1)
    for at in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        same = same[word[place[same] + at] == word[place[same + 1] + at]]
    new = np.ones(len(place), np.int64)
    new[same + 1] = 0
    klass = np.cumsum(new)
    key = (klass * (int(group.max(initial=0)) + 1) + group[owner]) * 1024 + shift[owner] + start + 512
    name = _named(key)[0]
    again = np.bincount(name)[name] >= 2
    owner, start = owner[again], start[again]
    by = np.lexsort((start, owner))
    return owner[by], start[by]


#: Columns of contexts on their way to be sorted, and of what comes of it.
_ROWS = "h long, name binary, shift int, context binary, copies long, large boolean, key binary, at long"
_SORTED = _ROWS + ", runs array<int>"


def _order(length: int):
    """For rows of ``_ROWS``, together by ``h`` and in the order of ``h`` and ``name``, those with a
    context first: each context that came once, with the starts that come back as flat half-open
    ``runs``, and each context that is ``large`` as it is, with its copies."""
    runs_type = pa.list_(pa.int32())

    def part(rows: pa.RecordBatch):
        h = rows.column(0).to_numpy()
        names = np.frombuffer(b"".join(rows.column(1).to_pylist()), np.uint32).reshape(len(h), -1)
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (names[1:] != names[:-1]).any(axis=1)
        first = np.flatnonzero(new)
        copies = np.add.reduceat(rows.column(4).to_numpy(), first)
        rows, h = rows.take(pa.array(first)), h[first]
        rows = rows.set_column(4, "copies", pa.array(copies, pa.int64()))
        large = rows.column(5).to_numpy(zero_copy_only=False)
        if large.any():
            some = rows.filter(pa.array(large))
            yield some.append_column("runs", pa.nulls(some.num_rows, runs_type))
        # a context alone with its fingerprint repeats nothing, and one with copies comes back anyway
        group = np.cumsum(np.diff(h, prepend=h[0]) != 0)
        some = ~large & (np.bincount(group[~large], minlength=group[-1] + 1) > 1)[group]
        some &= (np.bincount(group[copies == 1], minlength=group[-1] + 1) > 0)[group]
        if not some.any():
            return
        rows, group, copies = rows.filter(pa.array(some)), group[some], copies[some]
        owner, start = repeated_starts(rows.column(3).to_pylist(), group, rows.column(2).to_numpy().astype(np.int64), length)
        once = copies[owner] == 1
        owner, start = owner[once], start[once]
        if not len(owner):
            return
        begins = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(start, prepend=-2) != 1))
        ends = np.append(begins[1:], len(owner)) - 1
        of = np.flatnonzero(np.diff(owner[begins], prepend=-1))
        runs = pa.ListArray.from_arrays(pa.array(np.append(2 * of, 2 * len(begins)), pa.int32()), pa.array(np.stack([start[begins], start[ends] + 1], axis=1).ravel(), pa.int32()))
        rows = rows.take(pa.array(owner[begins][of]))
        rows = rows.set_column(3, "context", pa.nulls(rows.num_rows, pa.binary()))
        yield rows.append_column("runs", runs)

    def run(batches):
        held, bytes_, most = [], 0, BATCH_BYTES
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                held.append(batch.slice(at, BATCH_ROWS))
                bytes_ += held[-1].nbytes
                if bytes_ > most:
                    rows = pa.concat_batches(held)
                    h = rows.column(0).to_numpy()
                    ends = np.flatnonzero(h[1:] != h[:-1]) + 1
                    if len(ends):
                        yield from part(rows.slice(0, int(ends[-1])))
                        rows = rows.slice(int(ends[-1]))
                    held, bytes_ = [rows], rows.nbytes
                    most = max(BATCH_BYTES, 2 * bytes_)
        if held:
            yield from part(pa.concat_batches(held))

    return run


def _in_order(rows: DataFrame, by, length: int) -> DataFrame:
    """``_SORTED`` of ``rows`` (``_ROWS``), dealt to tasks by ``by``."""
    return rows.repartition(by).sortWithinPartitions("h", "name", F.col("context").isNull()).mapInArrow(_order(length), _SORTED)


def _covered(one: DataFrame, length: int, deal_anew) -> DataFrame:
    """(h, name, runs): for contexts ``one`` (h, name, shift, context), which of their starts come
    back among those of the same ``h``, as flat half-open runs.  ``deal_anew`` does that for the
    contexts of an ``h`` with more than ``MANY`` different ones."""
    spark = one.sparkSession
    contexts = one.groupBy("h", "name").agg(F.count("*").alias("copies"), F.first("shift").alias("shift"), F.first("context").alias("context"))
    # like contexts lie side by side here, so a stronger codec pays
    path = scratch_path(spark, "suffix-contexts")
    contexts.write.option("compression", "zstd").parquet(path)
    contexts = spark.read.parquet(path)
    large = contexts.groupBy("h").agg(F.count("*").alias("kinds")).where(F.col("kinds") > MANY).select("h")
    large_ = spark.sparkContext.broadcast(marks(large, LARGE_MARKS, low_bits(F.col("h"), LARGE_MARKS)))  # LARGE_MARKS bits
    whole = contexts.where("copies > 1").select("h", "name", F.array(F.lit(0), F.greatest(F.octet_length("context") - length + 1, F.lit(0))).alias("runs"))

    def route(to_large: bool):
        def run(batches):
            for batch in batches:
                is_large = is_marked(large_.value, batch.column(0).to_numpy() & (LARGE_MARKS - 1))
                yield batch.filter(pa.array(is_large if to_large else ~is_large))

        return run

    columns = contexts.select("h", "name", "shift", "context", "copies")
    some = columns.mapInArrow(route(False), columns.schema)
    some = some.select("*", F.lit(False).alias("large"), F.lit(None).cast("binary").alias("key"), F.lit(0).cast("long").alias("at"))
    found = _in_order(some, F.col("h"), length).select("h", "name", "runs")
    if not large_.value.any():
        return whole.unionByName(found)
    many = columns.mapInArrow(route(True), columns.schema).where(F.octet_length("context") >= length)
    return whole.unionByName(found).unionByName(deal_anew(many, length))


def _pieces(h: int, shift: int, context: bytes, length: int):
    """(key, begin, piece) of a context's pieces: its starts in steps of their distance from the
    fingerprint; the key is of the bytes that lie in every string that starts within the step."""
    last = shift + len(context) - length
    for step in range((shift + length) // STEP, (last + length) // STEP + 1):
        low = step * STEP - length
        high = min(low + STEP - 1, 0)
        begin, end = max(low, shift) - shift, min(high, last) - shift
        same = context[high - shift : low + length - shift]
        key = hashlib.blake2b(same, digest_size=8, key=h.to_bytes(8, "little", signed=True), salt=step.to_bytes(2, "little")).digest()
        yield int.from_bytes(key, "little", signed=True), begin, context[begin : end + length]


def _by_pieces(many: DataFrame, length: int) -> DataFrame:
    """``_covered`` of contexts (h, name, shift, context, copies), kept in a table, by their pieces."""
    spark = many.sparkSession

    def keys(batches):
        for batch in batches:
            made = [k for h, s, c in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True) for k, _, _ in _pieces(h, s, c, length)]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.int64())], names=["h"])

    again = many.select("h", "shift", "context").mapInArrow(keys, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    bits_ = spark.sparkContext.broadcast(marks(again, MARKS, low_bits(F.col("h"), MARKS)))  # MARKS bits

    def cut(batches):
        bits = bits_.value
        for batch in batches:
            made = []
            for h, name, shift, context, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for key, begin, piece in _pieces(h, shift, context, length):
                    if is_marked(bits, np.array([key & (MARKS - 1)]))[0]:
                        own = hashlib.blake2b(piece, digest_size=12, salt=(-shift - begin).to_bytes(2, "little")).digest()
                        made.append((key, own, shift + begin, piece, h, name, begin, copies))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True)) for row in made], schema)

    schema = pa.schema([
        ("h", pa.int64()), ("name", pa.binary()), ("shift", pa.int32()), ("context", pa.binary()),
        ("whole_h", pa.int64()), ("whole_name", pa.binary()), ("begin", pa.int32()), ("copies", pa.int64()),
    ])
    pieces = many.select("h", "name", "shift", "context", "copies").mapInArrow(
        cut, "h long, name binary, shift int, context binary, whole_h long, whole_name binary, begin int, copies long"
    )
    pieces = stage_table(pieces, "suffix-pieces")
    covered = _covered(pieces.select("h", "name", "shift", "context"), length, _by_strings)
    # contexts with copies come back as a whole anyway
    back = pieces.where("copies = 1").select("h", "name", "whole_h", "whole_name", "begin").join(covered, ["h", "name"])
    return back.select(F.col("whole_h").alias("h"), F.col("whole_name").alias("name"), F.expr("transform(runs, x -> x + begin)").alias("runs"))


def _by_strings(many: DataFrame, length: int) -> DataFrame:
    """``_covered`` of contexts (h, name, shift, context, copies), each string by its own content."""
    strings = many.select("h", "name", "copies", "shift", "context", F.explode(F.sequence(F.lit(0), F.octet_length("context") - length)).alias("start"))
    strings = strings.select(
        "h", "name", "copies", "start", F.unhex(F.md5(F.substring("context", F.col("start") + 1, F.lit(length)))).alias("string"), (F.col("shift") + F.col("start")).alias("place")
    )
    strings = stage_table(strings, "suffix-strings")
    twice = strings.groupBy("h", "place", "string").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    spread = strings.join(twice, ["h", "place", "string"], "left_semi").where("copies = 1").groupBy("h", "name").agg(F.array_sort(F.collect_set("start")).alias("starts"))
    return spread.select("h", "name", F.flatten(F.transform("starts", lambda s: F.array(s, s + 1))).alias("runs"))


def repeated_spans(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(key, spans): for each different text that has any, the byte runs to remove, flat; the key
    is the blake2b digest (16 bytes) of the text."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).cast("string").alias("_t")).where(F.octet_length("_t") >= length)

    def prints():
        find = Fingerprints(length).find_all

        def f(found):
            _, owner, _, h, _, _ = find([t.encode() for t in found])
            return [owner, pa.array(h.astype(np.int64))]

        return f

    again = map_texts(texts, prints, {"h": "long"}, [], "_t", explode=True).groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    again_ = spark.sparkContext.broadcast(marks(again, MARKS, low_bits(F.col("h"), MARKS)))  # MARKS bits

    def contexts(found, find, bits):
        """Whose text, hash, place, first byte, end and name of each context of a marked fingerprint, and the texts."""
        raws = [t.encode() for t in found]
        row, owner, place, h, first, last = find(raws)
        h = h.astype(np.int64)
        some = is_marked(bits, h & (MARKS - 1))
        owner, place, h, first, end = owner[some], place[some], h[some], first[some], last[some] + length
        digest = xxhash.xxh3_128_digest
        names = [digest(row[a:b], p - a)[:12] for a, b, p in zip(first.tolist(), end.tolist(), place.tolist(), strict=True)]
        return raws, row, owner, h, place, first, end, names

    def text_key(raw: bytes) -> bytes:
        return hashlib.blake2b(raw, digest_size=16).digest()

    def where():
        find, bits = Fingerprints(length).find_all, again_.value

        def f(found):
            raws, _, owner, h, _, first, end, names = contexts(found, find, bits)
            keys = [text_key(r) for r in raws]
            before = np.cumsum([0, *(len(r) for r in raws)])[owner]
            return [owner, h, names, [keys[i] for i in owner.tolist()], first - before, end - first]

        return f

    places = map_texts(texts, where, {"h": "long", "name": "binary", "key": "binary", "at": "long", "n": "int"}, [], "_t", explode=True)
    places = stage_table(places, "suffix-places")
    counted = stage_table(places.groupBy("h", "name").agg(F.count("*").alias("copies")), "suffix-names")
    kinds = counted.groupBy("h").agg(F.count("*").alias("kinds"), F.count_if(F.col("copies") == 1).alias("once"))
    kinds = stage_table(kinds.where("kinds > 1 and once > 0"), "suffix-kinds")
    several_ = spark.sparkContext.broadcast(marks(kinds, MARKS, low_bits(F.col("h"), MARKS)))  # MARKS bits
    large_ = spark.sparkContext.broadcast(marks(kinds.where(F.col("kinds") > MANY), LARGE_MARKS, low_bits(F.col("h"), LARGE_MARKS)))  # LARGE_MARKS bits

    def to_sort():
        find, bits, large = Fingerprints(length).find_all, several_.value, large_.value
        times: dict[bytes, int] = {}

        def f(found):
            raws, row, owner, h, place, first, end, names = contexts(found, find, bits)
            keys = [text_key(r) for r in raws]
            before = np.cumsum([0, *(len(r) for r in raws)])
            if len(times) > REMEMBERED:
                times.clear()
            # of equal contexts in a task the first goes with its bytes, the second without, and no other
            rows, context, key = [], [], []
            for i, (name, o, a, b) in enumerate(zip(names, owner.tolist(), first.tolist(), end.tolist(), strict=True)):
                seen = times.get(name, 0)
                if seen < 2:
                    times[name] = seen + 1
                    rows.append(i)
                    context.append(None if seen else row[a:b])
                    key.append(None if seen else keys[o])
            at = np.array(rows, np.int64)
            one = [1] * len(rows)
            is_large = is_marked(large, h[at] & (LARGE_MARKS - 1))
            return [owner[at], h[at], [names[i] for i in rows], (first - place)[at].astype(np.int32), context, one, is_large, key, (first - before[owner])[at]]

        return f

    out = {c: kind for c, kind in (column.split() for column in _ROWS.split(", "))}
    rows = map_texts(texts, to_sort, out, [], "_t", explode=True)
    found = stage_table(_in_order(rows, F.when(F.col("large"), F.xxhash64("name")).otherwise(F.col("h")), length), "suffix-found")
    covered = found.where("runs is not null").select("key", "at", "runs")
    if large_.value.any():
        many = found.where("runs is null")
        by_pieces = _by_pieces(many.select("h", "name", "shift", "context", "copies"), length)
        covered = covered.unionByName(many.where("copies = 1").select("h", "name", "key", "at").join(by_pieces, ["h", "name"]).select("key", "at", "runs"))
    spans = covered.select(
        "key", F.explode(F.expr("transform(sequence(0, size(runs) - 2, 2), i -> struct(at + runs[i] as s, at + runs[i + 1] + %d as e))" % (length - 1))).alias("span")
    )
    whole = places.join(counted.where("copies > 1").select("name"), "name", "left_semi")
    spans = spans.unionByName(whole.select("key", F.struct(F.col("at").alias("s"), (F.col("at") + F.col("n")).alias("e")).alias("span")))
    return spans.groupBy("key").agg(F.collect_set("span").alias("spans"))  # equal texts have a key in common


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per document: the id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the bytes that
    are left.  A byte goes if a string of ``length`` bytes over it also starts elsewhere."""
    spark = docs.sparkSession
    path = scratch_path(spark, "suffix-spans")
    with scratch_scope(spark):  # what the spans are made from goes with them written
        repeated_spans(docs, text_col, length).write.parquet(path)
    spans = spark.read.parquet(path)
    bits_ = spark.sparkContext.broadcast(marks(spans, TEXT_MARKS, name_place(F.col("key"), TEXT_MARKS)))  # TEXT_MARKS bits

    # only texts with something to remove meet their spans, packed
    def some():
        def f(texts):
            raw = [(t or "").encode() for t in texts]
            keys = [hashlib.blake2b(r, digest_size=16).digest() for r in raw]
            rows = np.flatnonzero(is_marked(bits_.value, name_places(keys, TEXT_MARKS))).tolist()
            pack = zstandard.ZstdCompressor().compress
            return [rows, [keys[i] for i in rows], [pack(raw[i]) for i in rows]]

        return f

    def others():
        def f(texts):
            raw = [(t or "").encode() for t in texts]
            rows = np.flatnonzero(~is_marked(bits_.value, name_places([hashlib.blake2b(r, digest_size=16).digest() for r in raw], TEXT_MARKS))).tolist()
            return [rows, [len(raw[i]) for i in rows], [0] * len(rows), [0] * len(rows), [raw[i] for i in rows]]

        return f

    out = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept": "binary"}
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"))
    clean = map_texts(rows, others, out, ["_id"], "_t", explode=True).withColumnRenamed("_id", id_col)
    rows = map_texts(rows, some, {"_key": "binary", "_packed": "binary"}, ["_id"], "_t", explode=True).join(spans.withColumnRenamed("key", "_key"), "_key", "left")
    starts, ends = F.transform("spans", lambda x: x["s"]), F.transform("spans", lambda x: x["e"])
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                size, gone, runs, left = [], [], [], []
                for packed, s, e in zip(*(part.column(c).to_pylist() for c in (1, 2, 3)), strict=True):
                    raw = unpack(packed)
                    change = np.zeros(len(raw) + 1, np.int64)
                    if s:
                        np.add.at(change, np.array(s), 1)
                        np.add.at(change, np.array(e), -1)
                    off = np.cumsum(change[:-1]) > 0
                    size.append(len(raw))
                    gone.append(int(off.sum()))
                    runs.append(int((np.diff(off.astype(np.int8), prepend=0) == 1).sum()))
                    left.append(np.frombuffer(raw, np.uint8)[~off].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(left, pa.binary())],
                    names=[id_col, *out],
                )

    met = rows.select("_id", "_packed", starts.alias("s"), ends.alias("e")).mapInArrow(cut, f"`{id_col}` {kind}, " + ", ".join(f"{n} {k}" for n, k in out.items()))
    return met.unionByName(clean)


__all__ = ["LENGTH", "Fingerprints", "suffix_ranks", "repeated_starts", "repeated_spans", "cut_repeats"]
