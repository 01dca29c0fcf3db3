from __future__ import annotations

import datetime
import hashlib

import pytest
import regex as re
from pyspark.sql import functions as F

from eventide.llm import pii


def luhn(s):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(s))) % 10 == 0


def iban(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def day(s):
    for layout in ("%Y-%m-%d", "%d/%m/%Y", "%d.%m.%Y"):
        try:
            return 1900 <= datetime.datetime.strptime(s, layout).year <= 2099
        except ValueError:
            pass
    return False


CHECK = {
    "card": lambda s: luhn(re.sub("[^0-9]", "", s)) and bool(re.search("[1-9]", s)), "iban": iban, "date": day,
    "ssn": lambda s: bool(re.match(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}$", s)),
    "secret": lambda s: bool(re.search("[0-9]", s) and re.search("[A-Fa-f]", s)),
    "phone": lambda s: True, "ip": lambda s: all(int(x) < 256 for x in s.split(".")), "email": lambda s: True,
}


def found(text):
    """(start, end, kind) of every checked value, by Python's own matching."""
    out = []
    for m in re.finditer(pii.ANY, text or ""):
        kind = next(k for k, p in pii.PATTERNS.items() if re.fullmatch(p, m[0]))
        if CHECK[kind](m[0]):
            out.append((m.start(), m.end(), kind))
    return out


def feistel(symbols, radix, key, kind):
    """The network in plain Python."""
    a, h = list(symbols), len(symbols) // 2
    for r in range(pii.ROUNDS):
        other = a[h:] if r % 2 == 0 else a[:h]
        seen = ",".join([key, kind, str(r), *map(str, other)])
        stream = "".join(hashlib.sha256(f"{seen},{b}".encode()).hexdigest() for b in range(len(a) // 8 + 1))
        for i in range(len(a)):
            if (i < h) == (r % 2 == 0):
                a[i] = (a[i] + int(stream[8 * i:8 * i + 8], 16)) % radix[i]
    return a


TEXTS = [
    "card 4111 1111 1111 1111 and 4111-1111-1111-1111, 4111111111111111; not 4111111111111112 nor 0000000000000000",
    "DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432 not GB82WEST12345698765433",
    "ssn 123-45-6789, 666-45-6789 000-12-3456 899-99-9999 665-01-0001 667-01-0001",
    "born 1984-02-29, 29.02.1984, 29/02/1984; not 1983-02-29 nor 1899-12-31; 1900-01-01 2099-12-31",
    "call +1 (017) 555-7713 or (212) 555-0187, +49 30 1234 5678!! but Version 2.0.",
    "ips 10.0.0.255, 256.1.1.1 1.2.3.4.5 and 233.254.104.120.", "mail und.34@mail7.example.com, A.b+c_9@x.org### leré.90@mail2.example.com " + "x" * 90 + ".1@a.example.net",
    'token = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"!! token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"',
    None, "", "no numbers at all", "é@ 12", "1" * 5000, "a1." * 20_000, "1984-02-29 1984-02-29", "a@" * 500,
]


@pytest.fixture(scope="module")
def out(spark):
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(TEXTS)], "doc_id long, text string, Pseudonyms int")
    frame = pii.pseudonymise(docs, key="k")
    assert frame.columns == ["doc_id", "text", "pseudonyms"]
    return {r.doc_id: r for r in frame.collect()}


def test_values_text_and_formats(out):
    for i, text in enumerate(TEXTS):
        spots, r = found(text), out[i]
        assert [p.kind for p in r.pseudonyms] == [k for *_, k in spots], text
        if not spots:
            assert r.text == text
            continue
        want, at = "", 0
        for (a, b, kind), p in zip(spots, r.pseudonyms, strict=True):
            old, new = text[a:b], p.pseudonym
            assert CHECK[kind](new) and re.fullmatch(pii.PATTERNS[kind], new), (old, new)
            if kind != "ip":
                shape = lambda s: re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", s)))
                assert kind == "secret" or shape(old) == shape(new)
                assert len(old) == len(new)
            assert old != new
            want, at = want + text[at:a] + new, b
        assert r.text == want + text[at:]


def test_links_and_key(spark, out):
    cards = [re.sub("[^0-9]", "", p.pseudonym) for p in out[0].pseudonyms]
    assert len(set(cards)) == 1
    assert len({p.pseudonym for p in out[14].pseudonyms}) == 1
    digits = [int(c) for c in "411111111111111"]
    assert [int(c) for c in cards[0][:-1]] == feistel(digits, [10] * 15, "k", "card")
    assert out[5].pseudonyms[0].pseudonym == ".".join(map(str, feistel([10, 0, 0, 255], [256] * 4, "k", "ip")))
    docs = spark.createDataFrame([(r.doc_id, r.text) for r in out.values()], "doc_id long, text string")
    back = {r.doc_id: r.text for r in pii.pseudonymise(docs, key="k", undo=True).collect()}
    assert back == dict(enumerate(TEXTS))
    other = {r.doc_id: r.text for r in pii.pseudonymise(docs, key="k2", undo=True).collect()}
    assert other[0] != TEXTS[0]


def test_days_and_numbers_are_permuted(spark):
    days = spark.range(73_049).select(pii.replaced("date", F.date_format(F.date_add(F.to_date(F.lit("1900-01-01")), F.col("id").cast("int")), "yyyy-MM-dd"), "k").alias("d"))
    got = days.agg(F.count_distinct("d"), F.min("d"), F.max("d")).first()
    assert tuple(got) == (73_049, "1900-01-01", "2099-12-31")
    small = spark.range(1000).select(pii.replaced("phone", F.concat(F.lit("(12) 345 "), F.lpad(F.col("id").cast("string"), 4, "0")), "k").alias("d"))
    assert small.distinct().count() == 1000


#: Text, and the values in it with their kinds, written down by hand.
BESIDE = [
    ("4111 1111 1111 1111 12/27", [("card", "4111 1111 1111 1111")]),
    ("4111 1111 1111 1111 123", [("card", "4111 1111 1111 1111")]),
    ("no 7 4111111111111111", [("card", "4111111111111111")]),
    ("12/27 4111-1111-1111-1111 123, 5", [("card", "4111-1111-1111-1111")]),
    ("ref 1234567 3782 822463 10005 1234 x", [("card", "3782 822463 10005")]),
    ("1 2 3 4111 1111 1111 1111 5500 0000 0000 0004 9 99", [("card", "4111 1111 1111 1111"), ("card", "5500 0000 0000 0004")]),
    ("41111111 11111111", [("card", "41111111 11111111")]),
    ("5 1984-02-29 4111111111111111 123-45-6789 7", [("date", "1984-02-29"), ("card", "4111111111111111"), ("ssn", "123-45-6789")]),
    ("4111 1111 1111 1112 123", []),
    ("DE89370400440532013000 BIC COBADEFFXXX", [("iban", "DE89370400440532013000")]),
    ("DE89 3704 0044 0532 0130 00 12 AB", [("iban", "DE89 3704 0044 0532 0130 00")]),
    ("AB12 REF GB82 WEST 1234 5698 7654 32 FOR 30", [("iban", "GB82 WEST 1234 5698 7654 32")]),
    ("NO9386011117947 BE68539007547034", [("iban", "NO9386011117947"), ("iban", "BE68539007547034")]),
]


def test_values_beside_others(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(BESIDE)] + [(99, "8 " * 3000 + "x")], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymise(docs, key="k").collect()}
    assert got[99].text == "8 " * 3000 + "x"
    for i, (text, spots) in enumerate(BESIDE):
        new = [(p.kind, p.pseudonym) for p in got[i].pseudonyms]
        assert [k for k, _ in new] == [k for k, _ in spots], text
        want = text
        for (kind, old), (_, pseudonym) in zip(spots, new, strict=True):
            assert old != pseudonym and CHECK[kind](pseudonym)
            want = want.replace(old, pseudonym)
        assert got[i].text == want


LAYOUTS = [
    ("call +14155552671.", [("phone", "+14155552671", "+1")]),
    ("415-555-2671 or 1-415-555-2672", [("phone", "415-555-2671", ""), ("phone", "1-415-555-2672", "1-")]),
    ("415.555.2671, v1.2.3.4.5 at 10.0.0.255", [("phone", "415.555.2671", ""), ("ip", "10.0.0.255", "")]),
    ("+33 1 23 45 67 89 and +1.415.555.2671", [("phone", "+33 1 23 45 67 89", "+33 "), ("phone", "+1.415.555.2671", "+1.")]),
    ("+41 44 668 18 00 1984-02-29", [("phone", "+41 44 668 18 00", "+41 "), ("date", "1984-02-29", "")]),
    ("+1 4155552671 4111 1111 1111 1111", [("phone", "+1 4155552671", "+1 "), ("card", "4111 1111 1111 1111", "")]),
    ("at 1984-02-29T10:00", [("date", "1984-02-29", "")]),
    ("1984-02-29Tx 1+2 555-2671 +12", []),
]


def test_layouts_of_phones_and_dates(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LAYOUTS)], "doc_id long, text string")
    frame = pii.pseudonymise(docs, key="k")
    got = {r.doc_id: r for r in frame.collect()}
    for i, (text, spots) in enumerate(LAYOUTS):
        new = [(p.kind, p.pseudonym) for p in got[i].pseudonyms]
        assert [k for k, _ in new] == [k for k, *_ in spots], text
        for (kind, old, code), (_, pseudonym) in zip(spots, new, strict=True):
            assert old != pseudonym and pseudonym.startswith(code)
            assert re.fullmatch(pii.PATTERNS[kind], pseudonym)
            assert kind == "ip" or re.sub("[0-9]", "9", old) == re.sub("[0-9]", "9", pseudonym)
            text = text.replace(old, pseudonym)
        assert got[i].text == text
    back = pii.pseudonymise(frame.select("doc_id", "text"), key="k", undo=True).collect()
    assert {r.doc_id: r.text for r in back} == {i: t for i, (t, _) in enumerate(LAYOUTS)}


def test_empty_table(spark):
    assert pii.pseudonymise(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in pii.op5_pii(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(rows) and sum(r.n_replaced for r in got.values()) > 5
    for r in rows:
        spots = found(r.text)
        assert got[r.doc_id].n_replaced == len(spots)
        assert (got[r.doc_id].text == r.text) == (not spots)
        for a, b, _ in spots:
            assert r.text[a:b] not in got[r.doc_id].text
