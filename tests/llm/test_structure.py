"""Personal data, periodic runs and conversation repair against brute force."""

import hashlib
import random
import re
import zlib

import pytest
from frames import no_documents, odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.llm import conversation_repair as repair
from tidewater.llm.conversation_repair import Repair, cheapest_edits
from tidewater.llm.periodic_runs import find_in_texts, lyndon_lengths, periodic_runs
from tidewater.llm.personal_data import KINDS, anchors, find_personal_data, mask_personal_data, spans_of
from tidewater.llm.queries import damaged, op11_personal_data, op12_periodic_runs, op13_conversation_repair, with_periods

SF = "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# -- personal data ---------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_luhn(digits):
    total = 0
    for k, c in enumerate(digits[::-1]):
        d = int(c) * (2 if k % 2 else 1)
        total += d // 10 + d % 10
    return total % 10 == 0


def brute_personal(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and brute_luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]
    return ",".join(f"{k}:{s}:{e}" for k, s, e in out)


def base_of(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans if k < 4)


@given(st.text(alphabet="ab.@-+1290 ()%:é𝒳[]", max_size=60))
@settings(max_examples=1500, deadline=None)
def test_base_spans_equal_the_patterns(text):
    assert base_of(spans_of(text, anchors())) == brute_personal(text)


def test_base_spans_of_glued_pieces():
    rng, automaton = random.Random(4), anchors()
    pieces = ["a@b.co", "x.y+z@mail-1.example.org", "10.0.0.255", "1.2.3", "300.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 1234-567", "+1", "@", ".", " ", "-", "é", "5", "0", "00001.02.3.4", "6304 0000 0000 0000 000", "::", "://", "account"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 9)))
        assert base_of(spans_of(text, automaton)) == brute_personal(text), text


#: Text, kind and the stretch that the method adds.
ADDED = [
    ("see https://ann:s3cret@host.example/x", "userinfo", "ann:s3cret"),
    ("from 2001:db8::ff00:42:8329, port", "ipv6", "2001:db8::ff00:42:8329"),
    ("write to jo.doe [at] example.org now", "hidden", "jo.doe [at] example.org"),
    ("jo(at)mail [dot] example.com", "hidden", "jo(at)mail [dot] example.com"),
    ("IBAN: DE89 3704 0044 0532 0130 00.", "iban", "DE89 3704 0044 0532 0130 00"),
    ("ssn is 123-45-6789", "ssn", "123-45-6789"),
    ("Account no. 12345678, closed", "account", "12345678"),
]
NOT_ADDED = ["std::vector a::b", "https://example.org/a@b", "IBAN: DE89 3704 0044 0532 0130 01", "ssn 000-45-6789", "on account of 12 people", "accountable 12345678", "x [at] y"]


def test_added_spans():
    automaton = anchors()
    for text, kind, want in ADDED:
        assert want in {text[s:e] for k, s, e in spans_of(text, automaton) if KINDS[k] == kind}, text
    for text in NOT_ADDED:
        assert not [KINDS[k] for k, _, _ in spans_of(text, automaton) if k >= 4], text


def test_personal_data_of_long_and_hostile_texts_is_linear():
    automaton = anchors()
    for piece in ("a@", "1.", "1 ", "+1", "::", "://a:", "[at]", "account 1", "IBAN A", "a"):
        spans_of(piece * (2_000_000 // len(piece)), automaton)  # a pass more than a few times over the text would not end


def test_personal_data_query(spark):
    got = {r.doc_id: r for r in op11_personal_data(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        want, r = brute_personal(d.text or ""), got[d.doc_id]
        kinds = [s.split(":")[0] for s in want.split(",")]
        assert r.base_sha256 == sha(want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(k) for k in KINDS[:4]]
        assert set(want.split(",")) - {""} <= set(r.spans.split(","))


def test_personal_data_of_odd_tables(spark):
    docs = odd_documents(spark)
    assert find_personal_data(docs).count() == docs.count() == mask_personal_data(docs).count()
    assert find_personal_data(no_documents(spark)).collect() == []
    extra = docs.withColumn("n_email", F.lit("mine")).withColumn("_text_", F.lit("kept"))
    assert {r._text_ for r in find_personal_data(extra).collect()} == {"kept"}
    masked = mask_personal_data(spark.createDataFrame([(1, "to a@b.co, +49 30 123456"), (2, None)], "doc_id long, text string"))
    assert {r.doc_id: r.text for r in masked.collect()} == {1: "to [EMAIL], [PHONE]", 2: None}


# -- periodic runs ---------------------------------------------------------


def brute_lyndon(s):
    is_lyndon = lambda w: all(w < w[k:] for k in range(1, len(w)))
    return [max(j - i for j in range(i + 1, len(s) + 1) if is_lyndon(s[i:j])) for i in range(len(s))]


def brute_runs(w):
    n, found = len(w), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if size >= max(6, 4 * q) and not any(all(w[x] == w[x + d] for x in range(i, i + size - d)) for d in range(1, q)):
                found.add((i, size, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda x: (x[0], x[2]))


@given(st.lists(st.integers(0, 2), min_size=1, max_size=16))
@settings(max_examples=600, deadline=None)
def test_lyndon_lengths(s):
    assert lyndon_lengths(s, 3) == brute_lyndon(s)
    assert lyndon_lengths([2 - x for x in s], 3) == brute_lyndon([2 - x for x in s])


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        k, words = rng.randint(1, 4), []
        while len(words) < rng.randint(0, 70):
            unit = [rng.randrange(k) for _ in range(rng.randint(1, 5))]
            words += (unit * 9)[: rng.randint(1, 30)]
        text = " ".join(map(str, words))
        (_, a), (_, b), (_, c) = find_in_texts([text, None, text + "\x0b\t" + text], 6, 4)
        assert a == brute_runs(words) and b == [] and c == brute_runs(words * 2), words


def test_long_periodic_texts_end_soon():
    fib = ["a", "a b"]
    while len(fib[-1]) < 400_000:
        fib.append(f"{fib[-1]} {fib[-2]}")
    assert find_in_texts(["a " * 300_000], 6, 4)[0][1] == [(0, 300_000, 1)]
    assert find_in_texts([" ".join(str(i % 1000) for i in range(200_000))], 6, 4)[0][1] == [(0, 200_000, 1000)]
    assert find_in_texts([fib[-1]], 6, 4)[0][1] == []  # no Fibonacci word holds a fourth power


def brute_periods(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_periodic_runs_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        words, r = brute_periods(d.doc_id, d.text), got[d.doc_id]
        if len(words) > 2500:
            continue  # the quadratic check of long texts is left to the sampled test above
        runs = brute_runs(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert r.n_runs == len(runs) and r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r.collapsed_sha256 == sha(" ".join(w for i, w in enumerate(words) if i not in gone))
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
    assert sum(r.n_runs > 0 for r in got.values()) > 50


def test_with_periods_keeps_odd_rows(spark):
    docs = odd_documents(spark)
    made = with_periods(docs)
    assert sorted((str(r.doc_id), " ".join(brute_periods(r.doc_id, r.text)) if r.doc_id is not None else r.text) for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 10 == 0 and r.text) == sorted(
        (str(r.doc_id), r.text) for r in made.collect() if zlib.crc32(str(r.doc_id).encode()) % 10 == 0 and r.text
    )
    assert made.count() == docs.count()


def test_periodic_runs_of_odd_tables(spark):
    docs = odd_documents(spark).withColumn("_text_", F.lit("kept"))
    got = periodic_runs(docs).collect()
    assert len(got) == docs.count() and {r._text_ for r in got} == {"kept"}
    assert all(r.n_runs == 0 and r.collapsed == "" and r.start is None for r in got if r.doc_id in (2, 3, 4))
    assert periodic_runs(no_documents(spark)).collect() == []
    with pytest.raises(ValueError, match="min_periods"):
        periodic_runs(docs, min_periods=2)


# -- conversation repair ---------------------------------------------------


def brute_edits(classes):
    """Least (cost, audit) by trying all ways, state by state."""

    def inserted(best):
        for _ in range(4):
            for s, (c, w) in list(best.items()):
                t, v = (3 if s == 2 else 2), (c + 3, w + "I")
                best[t] = min(best.get(t, v), v)
        return best

    best = inserted({0: (0, "")})
    for x in classes:
        after = {}
        for s, (c, w) in best.items():
            ways = [("D", 4, s)]
            if x != "x":
                more = 3 if x.isupper() else 0
                ways.append(("R", 3 + more, 3 if s == 2 else 2))
                kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((s, x.lower()))
                ways += [("K", more, kept)] if kept else []
            for e, cost, t in ways:
                v = (c + cost, w + e)
                after[t] = min(after.get(t, v), v)
        best = inserted(after)
    return min(v for s, v in best.items() if s in (0, 3))


@given(st.text(alphabet="xsuaoSUAO", max_size=40))
@settings(max_examples=1500, deadline=None)
def test_edits_equal_brute_force(classes):
    audit, cost = cheapest_edits(classes)
    assert (cost, audit) == brute_edits(classes)


def test_prices_are_dual_and_exact():
    rng = random.Random(3)
    for _ in range(200):
        classes = "".join(rng.choice("xsuaoSUAO") for _ in range(rng.randint(1, 16)))
        ends = tuple(rng.choice((0, 3, 6, repair.INF)) for _ in range(3)) + (0,)
        price = repair.auction(classes, ends)
        for r in range(len(classes)):
            for s in range(4):
                assert all(price[r][s] <= c + price[i][j] for _, c, i, j in repair.arcs(r, s, classes) if price[i][j] < repair.INF)


def brute_conversations(rows):
    """rows: (conv, turn, role, text) of the table as it is given."""
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        said = lambda x: " " if x is None else x
        h = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = said(role), said(text)
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        role = "user" if h == 4 else role
        kept += [(turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    out = {}
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256("\0".join((str(len(c := "-" if conv is None else f"={conv}")), c, str(len(r[1])), r[1], r[2])).encode()).digest()))
        seen, classes, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in kept:
            visible = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            kind = role[:1] if role[:1] in ("s", "u", "a") else "o"
            classes += "x" if fault in ("blank", "duplicate") else kind.upper() if fault else kind
        turns = {t for t, _, _ in kept if t is not None}
        cost, audit = brute_edits(classes)
        lines, at, last = [], 0, ""
        for e in audit:
            role, text = ("", "") if e == "I" else kept[at][1:]
            at += e != "I"
            if e != "D":
                role = role if e == "K" else "assistant" if last == "u" else "user"
                last = role[:1]
                lines.append(f"{role}:{text}")
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha("\n".join(lines)))
    return out


def as_table(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def test_repair_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_table(op13_conversation_repair(spark, SF)) == brute_conversations(rows)


def made_conversations(hot):
    rng = random.Random(5)
    says = ["Yes.", "no", "Why?", "", " \t", "A longer answer, with\na second line.", "...", None, "Ünï!", "Yes. \x0b"]
    roles = ["user", "assistant", "system", "tool", None, "", "user", "assistant"]
    rows = [(c, t, rng.choice(roles), rng.choice(says)) for c in (1, 2, 3, None) for t in rng.sample(range(30), 12)]
    rows += [(4, None, "user", "Hi."), (4, None, "user", "Hi."), (4, 3, "assistant", "Ok."), (5, 1, "user", "Hi."), (6, None, None, None)]
    rows += [(7, t, rng.choice(roles[:2] * 5 + roles), f"{rng.choice(says)}{t % 7}.") for t in range(hot)]
    return rows + rows[-5:] + rows[:3]


@pytest.mark.parametrize("hot", [40, 900])
def test_repair_of_odd_and_hot_conversations(spark, tmp_dir, hot):
    rows = made_conversations(hot)
    extra = ("clash", 1)
    names = "conv_id long, turn long, role string, text string, digest string, part int"
    spark.createDataFrame([(*r, *extra) for r in rows], names).write.parquet(f"{tmp_dir}/t/conversations.parquet")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the hot conversation crosses partitions
    try:
        got = as_table(op13_conversation_repair(spark, f"{tmp_dir}/t"))
        whole = Repair(damaged(spark.read.parquet(f"{tmp_dir}/t/conversations.parquet")), copies_col="copies")
        crossing, kept = whole.split.count(), whole.rows().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == brute_conversations(rows)
    assert crossing > 0
    by = {}
    for r in sorted(kept, key=lambda r: r.position):
        by.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert {c: sha("\n".join(by.get(c, []))) for c in got} == {c: v[-1] for c, v in got.items()}


def test_repair_of_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert Repair(none).digests().collect() == [] == Repair(none).rows().collect()
