"""Personal data replaced by format-preserving pseudonyms.

Numbers, dates, addresses and secrets are found by pattern, checked (Luhn sum,
IBAN remainder, valid calendar day, octet range, assigned number range), and
put through a keyed Feistel network over their own symbols: an unbalanced
network in which each half is shifted, symbol by symbol and each within its own
radix, by a keyed SHA-256 of the other half. It permutes the values of a format,
so a pseudonym has the format and passes the check of what it replaces, equal
values get equal pseudonyms in every document, and the key undoes it. What fails
its check is left as it is. Everything is a built-in expression.

| kind | symbols | kept |
| --- | --- | --- |
| card | digits but the last, which becomes the Luhn digit | separators |
| iban | letters and digits of the account part; check digits computed | country, blanks |
| ssn | area among 898, group among 99, serial among 9999 | hyphens |
| phone | digits after the country code | country code, layout |
| ip | four octets | dots |
| date | day among the 73,049 = 17 x 4,297 of 1900 to 2099 | layout |
| email | ASCII letters and digits of the local part | domain, case, punctuation, other letters |
| secret | hexadecimal digits | case |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import free_name, table

ROUNDS = 10
#: Key of the registered query; a deployment passes its own.
KEY = "eventide-pseudonyms"

#: Length of an IBAN by country (the registry's); codes that are not listed have 15 to 34 characters.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}
_LISTED = "(?:" + "|".join(
    f"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items()) + ")(?![A-Za-z0-9])"
_CODES = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")
#: Sizes of the digit groups of a written card, besides 13 to 19 digits in one.
CARD_LAYOUTS = ("4-4-4-4-", "4-6-5-", "4-6-4-", "4-3-3-3-", "4-4-4-4-3-")
_DATE = (r"(?<![A-Za-z0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})"
         r"(?!(?!T[0-9]{2}:)[A-Za-z0-9/-])")
#: Country codes of one, two and three digits: where a phone number has no mark after its code.
_COUNTRY = "(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
#: What a group of a phone number does not begin: a date, or a card in groups.
_NO_PHONE = rf"(?!{_DATE}|[0-9]{{4}}(?:[ -][0-9]{{4}}){{3}}|[0-9]{{4}}[ -][0-9]{{6}}[ -])"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: What may be personal data, by kind; the first that matches a stretch counts. Lengths are
#: bounded and starts are anchored by what precedes them, so the search is linear.
PATTERNS = {
    "email": r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]{1,256}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "iban": rf"(?<![A-Za-z0-9])(?:{_LISTED}|(?!{_CODES})[A-Z]{{2}}[0-9]{{2}}(?:(?: (?!{_LISTED}))?[A-Z0-9]){{11,30}}(?![A-Za-z0-9]))",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32}|[0-9A-F]{64}|[0-9A-F]{40}|[0-9A-F]{32})(?![A-Za-z0-9])",
    "phone": r"(?<![A-Za-z0-9+])(?:\+[0-9]{1,3}[ -]?)?\([0-9]{2,4}\)[ -]?[0-9]{3,4}[ -]?[0-9]{3,4}(?![A-Za-z0-9])"
             r"|(?<![A-Za-z0-9+])\+[0-9]{1,3}[ -][0-9]{2,4}[ -][0-9]{3,4}[ -]?[0-9]{3,4}(?![A-Za-z0-9])"
             rf"|(?<![A-Za-z0-9+])(?=\+(?:[ .-]?[0-9]){{8}})\+(?:[0-9]{{8,15}}|[0-9]{{1,3}}[ .-][0-9]{{6,12}}"
             rf"|[0-9]{{1,3}}(?:[ .-]{_NO_PHONE}[0-9]{{1,4}}){{2,5}})(?![A-Za-z0-9])"
             r"|(?<![A-Za-z0-9+.-])(?:(?:1-)?[0-9]{3}-[0-9]{3}-[0-9]{4}|(?:1\.)?[0-9]{3}\.[0-9]{3}\.[0-9]{4})(?![A-Za-z0-9]|[.-][0-9])",
    "ssn": r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])",
    "date": _DATE,
    "ip": rf"(?<![A-Za-z0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[A-Za-z0-9])",
}
#: A run of digit groups, up to where another kind begins: the cards in it are looked for by :func:`cards`.
_OTHER = "|".join(PATTERNS[kind] for kind in ("phone", "ssn", "date", "ip"))
PATTERNS["card"] = (rf"(?<![A-Za-z0-9])(?=[0-9](?:(?:[ -](?!{_OTHER}))?[0-9]){{12}})[0-9]{{1,19}}(?![A-Za-z0-9])"
                    rf"(?:[ -](?!{_OTHER})[0-9]{{1,19}}(?![A-Za-z0-9]))*+")
ANY = "|".join(PATTERNS.values())
PARTS = "array<struct<kind:string,pseudonym:string>>"
DATE_LAYOUTS = {"-": "yyyy-MM-dd", "/": "dd/MM/yyyy", ".": "dd.MM.yyyy"}


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


# --- the permutation -----------------------------------------------------------------------

def feistel(symbols: Column, radix: Column, key: str, kind: str, undo: bool = False) -> Column:
    """``symbols`` (array of long, each below its ``radix``) keyed-permuted, or put back."""
    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if undo else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    half = (F.size(symbols) / 2).cast("int")

    def step(a: Column, r: Column) -> Column:
        first = r % 2 == 0
        other = F.when(first, F.slice(a, half + 1, F.size(a))).otherwise(F.slice(a, F.lit(1), half))
        seen = F.concat_ws(",", F.lit(key), F.lit(kind), r.cast("string"), F.transform(other, lambda x: x.cast("string")))
        stream = let(seen, lambda s: F.array_join(F.transform(
            F.sequence(F.lit(0), (F.size(a) / 8).cast("int")), lambda b: F.sha2(F.concat_ws(",", s, b.cast("string")), 256)), ""))

        def shifted(x: Column, i: Column, s: Column) -> Column:
            by = F.conv(F.substring(s, i * 8 + 1, F.lit(8)), 16, 10).cast("long")
            return F.pmod(x - by if undo else x + by, F.element_at(radix, i + 1))

        return let(stream, lambda s: F.transform(
            a, lambda x, i: F.when((i < half) == first, shifted(x, i, s)).otherwise(x)))

    return F.aggregate(rounds, symbols, step)


def chars(text: Column) -> Column:
    return F.split(text, "")


def refill(text: Column, old: str, new: Column) -> Column:
    """``text`` with its characters of the class ``old`` replaced, in order, by the array ``new``."""
    return let(chars(text), lambda c: F.array_join(F.transform(c, lambda x, i: F.when(
        x.rlike(old), F.element_at(new, 1 + F.size(F.filter(F.slice(c, F.lit(1), i), lambda y: y.rlike(old))))).otherwise(x)), ""))


def digits(text: Column) -> Column:
    return F.transform(chars(F.regexp_replace(text, "[^0-9]", "")), lambda x: x.cast("long"))


def _texts(numbers: Column) -> Column:
    return F.transform(numbers, lambda x: x.cast("string"))


def _same(symbols: Column, radix: int) -> Column:
    return F.transform(symbols, lambda _: F.lit(radix).cast("long"))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


# --- checks and replacements by kind -------------------------------------------------------

def luhn_digit(payload: Column) -> Column:
    """The digit that completes a payload of digits."""
    n = F.size(payload)
    return F.pmod(-_total(F.transform(payload, lambda x, i: F.when(
        (n - i) % 2 == 1, x * 2 - F.when(x > 4, 9).otherwise(0)).otherwise(x))), F.lit(10)).cast("long")


def iban_rest(text: Column) -> Column:
    """Remainder by 97 of an IBAN without blanks, its first four characters moved to its end."""
    moved = F.concat(F.substring(text, 5, 40), F.substring(text, 1, 4))
    return F.aggregate(chars(moved), F.lit(0).cast("long"), lambda a, x: F.when(
        x.rlike("[0-9]"), (a * 10 + F.ascii(x) - 48) % 97).otherwise((a * 100 + F.ascii(x) - 55) % 97))


def _day(m: Column) -> Column:
    """Days since 1900-01-01 of a written date, null if there is no such day in 1900 to 2099."""
    read = F.when(m.contains("-"), F.try_to_date(m, DATE_LAYOUTS["-"])).when(
        m.contains("/"), F.try_to_date(m, DATE_LAYOUTS["/"])).otherwise(F.try_to_date(m, DATE_LAYOUTS["."]))
    day = F.datediff(read, F.to_date(F.lit("1900-01-01")))
    return F.when(day.between(0, 73_048), day)


def valid(kind: str, m: Column) -> Column:
    """Whether a match of the kind's pattern passes the kind's check."""
    if kind == "card":
        return let(digits(m), lambda d: luhn_digit(F.slice(d, F.lit(1), F.size(d) - 1)) == F.element_at(d, -1)) & \
            F.regexp_replace(m, "[^0-9]", "").rlike("[1-9]")
    if kind == "iban":
        return iban_rest(F.replace(m, F.lit(" "), F.lit(""))) == 1
    if kind == "ssn":
        return m.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)")
    if kind == "date":
        return _day(m).isNotNull()
    if kind == "secret":
        return m.rlike("[0-9]") & m.rlike("[A-Fa-f]")
    return F.lit(True)


def _letters_and_digits(text: Column, letter: str, kind: str, key: str, undo: bool) -> Column:
    """Letters (radix 26, or 16 with the digits of a secret) and digits permuted, cases and the rest kept."""
    pick = f"[{letter}0-9]"
    own = F.filter(chars(text), lambda x: x.rlike(pick))
    if kind == "secret":
        value = lambda x: F.conv(x, 16, 10).cast("long")
        upper = text.rlike("[A-F]")
        return let(own, lambda o: let(
            feistel(F.transform(o, value), F.transform(o, lambda _: F.lit(16).cast("long")), key, kind, undo),
            lambda new: F.array_join(F.transform(new, lambda v: F.when(upper, F.conv(v, 10, 16)).otherwise(
                F.lower(F.conv(v, 10, 16)))), "")))
    value = lambda x: F.when(x.rlike("[0-9]"), F.ascii(x) - 48).otherwise(F.ascii(F.lower(x)) - 97).cast("long")
    radix = lambda x: F.when(x.rlike("[0-9]"), 10).otherwise(26).cast("long")
    back = lambda v, x: F.when(x.rlike("[0-9]"), v.cast("string")).when(
        x.rlike("[A-Z]"), F.char(v + 65)).otherwise(F.char(v + 97))
    return let(own, lambda o: let(
        feistel(F.transform(o, value), F.transform(o, radix), key, kind, undo),
        lambda new: refill(text, pick, F.zip_with(new, o, back))))


def replaced(kind: str, m: Column, key: str, undo: bool = False) -> Column:
    """The pseudonym of a valid match."""
    if kind == "card":
        return let(digits(m), lambda d: let(F.slice(d, F.lit(1), F.size(d) - 1), lambda p: let(
            feistel(p, _same(p, 10), key, kind, undo),
            lambda q: refill(m, "[0-9]", _texts(F.array_append(q, luhn_digit(q)))))))
    if kind == "iban":
        plain = F.replace(m, F.lit(" "), F.lit(""))
        account = _letters_and_digits(F.substring(plain, 5, 40), "A-Z", kind, key, undo)
        whole = let(account, lambda a: let(F.concat(F.substring(plain, 1, 2), F.lit("00"), a), lambda z: F.concat(
            F.substring(plain, 1, 2), F.lpad((98 - iban_rest(z)).cast("string"), 2, "0"), a)))
        return let(whole, lambda w: refill(m, "[A-Z0-9]", chars(w)))
    if kind == "ssn":
        area, group, serial = (F.split(m, "-")[k].cast("long") for k in range(3))
        own = F.array(area - F.when(area > 666, 2).otherwise(1), group - 1, serial - 1)
        return let(feistel(own, F.array(*[F.lit(r).cast("long") for r in (898, 99, 9999)]), key, kind, undo), lambda n: F.concat_ws(
            "-", F.lpad((n[0] + F.when(n[0] >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
            F.lpad((n[1] + 1).cast("string"), 2, "0"), F.lpad((n[2] + 1).cast("string"), 4, "0")))
    if kind == "phone":
        code = F.regexp_extract(m, rf"^(\+(?:[0-9]{{1,3}}(?:[ .-]|(?=\())|{_COUNTRY}(?=[0-9]))|1[.-](?=[0-9]{{3}}[.-]))", 1)
        return let(code, lambda c: let(F.substring(m, F.length(c) + 1, F.length(m)), lambda rest: let(digits(rest), lambda d: let(
            feistel(d, _same(d, 10), key, kind, undo), lambda n: F.concat(c, refill(rest, "[0-9]", _texts(n)))))))
    if kind == "ip":
        return let(F.transform(F.split(m, r"\."), lambda x: x.cast("long")), lambda o: F.array_join(
            _texts(feistel(o, _same(o, 256), key, kind, undo)), "."))
    if kind == "date":
        new = let(_day(m).cast("long"), lambda d: let(
            feistel(F.array((d / 4297).cast("long"), d % 4297), F.array(F.lit(17).cast("long"), F.lit(4297).cast("long")), key, kind, undo),
            lambda n: F.date_add(F.to_date(F.lit("1900-01-01")), (n[0] * 4297 + n[1]).cast("int"))))
        return let(new, lambda d: F.when(m.contains("-"), F.date_format(d, DATE_LAYOUTS["-"])).when(
            m.contains("/"), F.date_format(d, DATE_LAYOUTS["/"])).otherwise(F.date_format(d, DATE_LAYOUTS["."])))
    if kind == "email":
        at = F.instr(m, "@")
        return F.concat(_letters_and_digits(F.substring(m, F.lit(1), at - 1), "A-Za-z", kind, key, undo), F.substring(m, at, F.length(m)))
    return _letters_and_digits(m, "A-Fa-f", kind, key, undo)


def cards(m: Column, key: str, undo: bool = False) -> Column:
    """(kind, text) of the parts of a run of digit groups: cards replaced, the rest of null kind.

    A card is one group of 13 to 19 digits or groups of a usual layout, whatever digits stand beside it
    (expiry, code, other numbers); without one, the run as a whole may be a card in groups of any size.
    """
    part = lambda kind, text: F.struct(F.lit(kind).cast("string").alias("kind"), text.alias("pseudonym"))
    text_of = lambda pieces, i, n: F.regexp_replace(F.array_join(F.slice(pieces, i + 1, n), ""), "[ -]$", "")
    width = lambda x: F.length(F.regexp_replace(x, "[^0-9]", ""))

    def groups_at(pieces: Column, i: Column) -> Column:
        """How many groups from ``i`` on are a card; 0 for none."""
        sizes = F.array_join(F.transform(F.slice(pieces, i + 1, 5), lambda x: F.concat(width(x).cast("string"), F.lit("-"))), "")
        fits = lambda n: valid("card", text_of(pieces, i, F.lit(n)))

        def chosen(z: Column) -> Column:
            out = F.when(z.rlike("^1[3-9]-") & fits(1), 1)
            for layout in CARD_LAYOUTS:
                out = out.when(z.startswith(layout) & fits(layout.count("-")), layout.count("-"))
            return out.otherwise(0)

        return let(sizes, chosen)

    def parted(pieces: Column, taken: Column) -> Column:
        """The parts, from the groups and the number of groups of the card that begins at each."""
        def step(state: Column, i: Column) -> Column:
            n, last = F.element_at(taken, i + 1), lambda n: F.element_at(pieces, i + n)
            after = lambda n: F.array(part(None, F.regexp_extract(last(n), "[ -]$", 0)))
            return F.when(i < state["next"], state).when(n > 0, F.struct((i + n).alias("next"), F.concat(
                state["parts"], F.array(part("card", replaced("card", text_of(pieces, i, n), key, undo))), after(n)).alias("parts"))
            ).otherwise(F.struct((i + 1).alias("next"), F.concat(state["parts"], F.array(part(None, last(F.lit(1))))).alias("parts")))

        start = F.struct(F.lit(0).alias("next"), F.array().cast(PARTS).alias("parts"))
        return F.aggregate(F.sequence(F.lit(0), F.size(pieces) - 1), start, step, lambda state: state["parts"])

    whole = F.when(width(m).between(13, 19) & valid("card", m), F.array(part("card", replaced("card", m, key, undo)))
                   ).otherwise(F.array(part(None, m)))
    return let(F.regexp_extract_all(m, F.lit("[0-9]+[ -]?"), F.lit(0)), lambda pieces: let(
        F.transform(pieces, lambda _, i: groups_at(pieces, i)),
        lambda taken: F.when(F.exists(taken, lambda n: n > 0), parted(pieces, taken)).otherwise(whole)))


# --- the operator --------------------------------------------------------------------------

def pseudonymise(docs: DataFrame, key: str = KEY, text: str = "text", undo: bool = False) -> DataFrame:
    """``docs`` with ``text`` rewritten, and ``pseudonyms``: (kind, pseudonym) of each replacement, in order.

    With ``undo`` the pseudonyms of the same key are put back. A null or empty
    text stays as it is and has no replacements; an input column ``pseudonyms``
    (in any case) gives way; an empty table gives no rows. Rows are independent.
    """
    source = F.col(f"`{text}`")
    gaps, found = free_name(docs, "gaps", "found")

    def judged(m: Column) -> Column:
        out = None
        for kind, pattern in PATTERNS.items():
            is_kind = m.rlike(f"^(?:{pattern})$")
            one = cards(m, key, undo) if kind == "card" else F.array(
                F.when(valid(kind, m), F.struct(F.lit(kind).alias("kind"), replaced(kind, m, key, undo).alias("pseudonym"))
                       ).otherwise(F.struct(F.lit(None).cast("string").alias("kind"), m.alias("pseudonym"))))
            out = F.when(is_kind, one) if out is None else out.when(is_kind, one)
        return out

    none = F.array().cast(f"array<{PARTS}>")
    cut = docs.withColumn(found, F.when(source.rlike("[0-9@]"), F.transform(
        F.regexp_extract_all(source, F.lit(ANY), F.lit(0)), judged)).otherwise(none))
    some = F.size(found) > 0
    woven = F.array_join(F.flatten(F.zip_with(
        F.split(source, ANY, -1), F.col(found), lambda gap, m: F.array(gap, F.coalesce(F.array_join(m.pseudonym, ""), F.lit(""))))), "")
    kept = [c for c in docs.columns if c.lower() != "pseudonyms"]
    return cut.select(
        *[F.when(some, woven).otherwise(source).alias(c) if c == text else F.col(f"`{c}`") for c in kept],
        F.coalesce(F.filter(F.flatten(found), lambda m: m.kind.isNotNull()), F.array().cast(PARTS)).alias("pseudonyms"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced, and how many values of each kind were."""
    out = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = out.withColumn("kinds", F.col("pseudonyms.kind"))
    return kinds.select("doc_id", "text", F.size("kinds").cast("long").alias("n_replaced"), *[
        (F.size("kinds") - F.size(F.array_remove("kinds", kind))).cast("long").alias(f"n_{kind}") for kind in PATTERNS])
