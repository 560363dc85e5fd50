"""Personal data: keyed, format-preserving Feistel pseudonyms.

Numbers and dates that pass their kind's check are found in the text and
permuted within their format: digits stay digits, separators stay, a card
number keeps a valid check digit, an address keeps valid octets, a date stays
a date of the same notation. The permutation depends on the key and the kind
alone, so equal values get equal pseudonyms in every document and different
values different ones. Numbers that fail the check are left alone.

Digit strings go through a Feistel network on their two halves. Values of
other domains go through a balanced one over a little more than the domain,
again until they fall into it (cycle-walking). Both are bijections. Letters of
mail names and hex digits of secrets are shifted within their class, place by
place, by what stands before and then after them, which can be undone too.
Round values come from SHA-256 of key, kind, round and half. Built-in column functions only: a text
is split at the matches, the matches are mapped, and the pieces put back, so
nothing is shuffled or gathered.

Kinds: payment cards (13 to 19 digits, Luhn), telephone numbers (with + and a
country code, 8 to 15 digits, plain or with blanks, hyphens, brackets or dots;
North American ones with area codes from 200, by hyphens, dots or brackets;
national ones with a leading 0 and two separators), IBANs (length of the
country, mod 97), IPv4 addresses (octets up to 255), mail addresses (the
local part's characters), social security numbers (valid areas), dates
(yyyy-mm-dd, yyyy/mm/dd, dd/mm/yyyy, dd.mm.yyyy, month first where the day
comes first can't be, days and months of one digit, valid days of 1900 to
2099), and secrets given as name = "hex digits" (32 or more).

Dates of two-digit days and months, day or year first, share one permutation
and stay linked; each other notation has a domain of its own, as its values
must stay in it. So have telephone numbers by what they begin with and their
count of digits.

Defined cases: a null text stays null; an empty or clean text stays as it is;
a value that only touches further digits or letters is no match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "tidelog-pseudonym-key"     # a parameter: real jobs pass their own
ROUNDS = 8

# How each kind is written.
CARD = (r"(?<![\w+-])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})"
        r"(?![\w-])")
PLANTED = r"(?<![\w+])\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4}(?![0-9])"
_MORE = r"(?:(?:[ -]|[ -]?\(|\)[ -]?)?[0-9])"
PLUS = (PLANTED + rf"|(?<![\w+])\+(?:1{_MORE}{{10}}|[2-9]{_MORE}{{7,14}})(?![0-9])"
        r"|(?<![\w+])\+[1-9][0-9]{0,2}\.[0-9]{2,4}\.[0-9]{3,4}\.[0-9]{3,4}(?![0-9])")
# its country code, as the numbering plan has them
COUNTRY = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})"
AREA = (r"(?<![\w+.(/-])(?:1[-. ])?(?:\([2-9][0-9]{2}\) ?[0-9]{3}[-. ][0-9]{4}|[2-9][0-9]{2}-[0-9]{3}-[0-9]{4}"
        r"|[2-9][0-9]{2}\.[0-9]{3}\.[0-9]{4})(?![\w-]|\.[0-9])")
TRUNK = (r"(?<![\w+.(/-])(?<![0-9][ -])(?:\(0[0-9]{2,4}\)|0[0-9]{2,4})[ /-][0-9]{3,4}[ -][0-9]{3,4}"
         r"(?![\w-]|[ .][0-9])")
# length of an IBAN: its countries
IBANS = {
    15: "NO", 16: "BE", 18: "DK|FI|FO|GL|NL", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG",
    25: "AO|LY|PT|ST", 26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HU|LB|NI|PL|SV",
    29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU", 31: "MT|SC", 32: "LC", 33: "RU"}
IBAN = (r"(?<![\w])(?:" + "|".join(f"(?:{c})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in IBANS.items())
        + r")(?![\w])")
PHONE = f"{IBAN}|{PLUS}|{AREA}|{TRUNK}"      # an IBAN's groups are no telephone number
IPV4 = r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])"
MAIL = r"(?<![\p{L}\p{N}_.+%-])[\p{L}\p{N}_.+%-]+@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,}"
SSN = r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"
ISO_DATE = r"(?<![\w-])(?:19|20)[0-9]{2}-[0-9]{1,2}-[0-9]{1,2}(?![\w-])"
YEAR_SLASH_DATE = r"(?<![\w/])(?:19|20)[0-9]{2}/[0-9]{1,2}/[0-9]{1,2}(?![\w/])"
SLASH_DATE = r"(?<![\w/])[0-9]{1,2}/[0-9]{1,2}/(?:19|20)[0-9]{2}(?![\w/])"
DOT_DATE = r"(?<![\w.])[0-9]{1,2}\.[0-9]{1,2}\.(?:19|20)[0-9]{2}(?![\w]|\.[0-9])"
SECRET = r"""(?<=[=:] ?["'])[0-9A-Fa-f]{32,}(?=["'])"""
FIRST_DAY, DAYS = "1900-01-01", 73049      # 1900-01-01 to 2099-12-31
# kind: (pattern, cheap test that any text with a match passes), in the order of replacement
KINDS = {
    "mail": (MAIL, lambda t: t.contains("@")),
    "secret": (SECRET, lambda t: t.rlike("[0-9A-Fa-f]{32}")),
    "iban": (IBAN, lambda t: t.rlike("[A-Z]{2}[0-9]{2} ?[A-Z0-9]")),
    "phone": (PHONE, lambda t: t.rlike(r"\+[0-9]|[0-9]{3}\)?[ ./-]?[0-9]{3}")),
    "ipv4": (IPV4, lambda t: t.rlike(r"[0-9]\.[0-9]")),
    "ssn": (SSN, lambda t: t.rlike("[0-9]-[0-9][0-9]-[0-9]")),
    "iso_date": (ISO_DATE, lambda t: t.rlike("[0-9]-[0-9]{1,2}-[0-9]")),
    "year_slash_date": (YEAR_SLASH_DATE, lambda t: t.rlike("[0-9]/[0-9]{1,2}/[0-9]")),
    "slash_date": (SLASH_DATE, lambda t: t.rlike("[0-9]/[0-9]{1,2}/[0-9]")),
    "dot_date": (DOT_DATE, lambda t: t.rlike(r"[0-9]\.[0-9]{1,2}\.[0-9]")),
    # what is an IBAN or telephone number is no card number
    "card": (f"{CARD}|{IBAN}|{PLUS}", lambda t: t.rlike("[0-9]{4}")),
}


def _round(key: str, kind: str, i: int, tweak: Column, half: Column, size: Column) -> Column:
    """Pseudorandom value in [0, size) of a half."""
    h = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), F.lit(str(i)), tweak, half.cast("string")), 256)
    return F.pmod(F.conv(F.substring(h, 1, 15), 16, 10).cast("long"), size)


def _let(value: Column, f) -> Column:
    """``f`` of a value that is computed once."""
    return F.transform(F.array(value), f)[0]


def _feistel(n: Column, half: Column, key: str, kind: str, tweak: Column) -> Column:
    """Permutation of [0, half * half); ``half`` below 2**31."""
    state = F.struct(F.floor(n / half).cast("long").alias("l"), F.pmod(n, half).cast("long").alias("r"))

    def step(i: int):
        return lambda s: F.struct(
            s["r"].alias("l"), F.pmod(s["l"] + _round(key, kind, i, tweak, s["r"], half), half).alias("r"))

    for i in range(ROUNDS):
        state = _let(state, step(i))
    return _let(state, lambda s: s["l"] * half + s["r"])


def _walked(n: Column, half: int, size: int, key: str, kind: str, steps: int) -> Column:
    """Permutation of [0, size), size <= half * half: the network is applied
    again while the value is outside, up to ``steps`` times. ``half`` is chosen
    so close to the root of ``size`` that no value needs more than a few."""
    once = lambda v: _feistel(v, F.lit(half).cast("long"), key, kind, F.lit(""))
    walk = lambda v, _: F.when(v < size, v).otherwise(once(v))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), once(n), walk)


def _permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """A string of 2 to 18 digits, permuted among those of its length. The
    halves have floor and ceil of half the digits; they swap sizes each round."""
    n = F.length(digits)
    a = F.floor(n / 2).cast("int")
    power = lambda w: F.concat(F.lit("1"), F.repeat(F.lit("0"), w)).cast("long")
    state = F.struct(F.substring(digits, F.lit(1), a).alias("l"), F.substring(digits, a + 1, n - a).alias("r"))

    def step(i: int):
        return lambda s: F.struct(s["r"].alias("l"), F.lpad(F.pmod(
            s["l"].cast("long") + _round(key, kind, i, n.cast("string"), s["r"], power(F.length(s["l"]))),
            power(F.length(s["l"]))).cast("string"), F.length(s["l"]), "0").alias("r"))

    for i in range(ROUNDS):
        state = _let(state, step(i))
    return _let(state, lambda s: F.concat(s["l"], s["r"]))


def _only_digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _refill(shape: Column, digits: Column, kept: str = "0-9") -> Column:
    """``shape`` with its digits, or the characters ``kept``, replaced in order by ``digits``."""
    return F.array_join(F.transform(F.filter(F.split(shape, ""), lambda ch: ch != ""), lambda ch, i: F.when(
        ch.rlike(f"^[{kept}]$"), F.substring(digits, F.length(F.regexp_replace(
            F.substring(shape, F.lit(1), i + 1), f"[^{kept}]", "")), F.lit(1))).otherwise(ch)), "")


def _luhn_sum(digits: Column, from_right: int) -> Column:
    """Luhn sum; the rightmost digit has place ``from_right``."""
    n = F.length(digits)
    place = lambda i: F.pmod(n - i + from_right, F.lit(2))
    one = lambda i: _let(F.substring(digits, i, F.lit(1)).cast("int"),
                         lambda d: F.when(place(i) == 0, d).otherwise(F.pmod(d * 2, F.lit(10)) + F.floor(d * 2 / 10)))
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0).cast("long"), lambda acc, i: acc + one(i))


def _card(m: Column, key: str) -> Column:
    """The digits but the last are permuted, the last is made to fit."""
    digits = _only_digits(m)
    new = lambda d: _let(_permuted_digits(F.substring(d, F.lit(1), F.length(d) - 1), key, "card"),
                         lambda p: F.concat(p, F.pmod(-_luhn_sum(p, 1), F.lit(10)).cast("string")))
    return _let(digits, lambda d: F.when(m.rlike("^[0-9]") & (F.pmod(_luhn_sum(d, 0), F.lit(10)) == 0), _let(
        new(d), lambda p: _refill(m, p))).otherwise(m))


def _phone(m: Column, key: str) -> Column:
    """The digits after the country code, the leading 1 or the leading 0."""
    ten = F.substring(_only_digits(m), -10, 10)
    planted = F.concat(F.regexp_extract(m, r"^\+[0-9]+ \(", 0), _let(_permuted_digits(ten, key, "phone"), lambda d: F.concat(
        F.substring(d, 1, 3), F.lit(") "), F.substring(d, 4, 3), F.lit("-"), F.substring(d, 7, 4))))
    code = F.regexp_extract(F.concat(F.lit("+"), _only_digits(m)), COUNTRY, 0)
    after = lambda n: F.substring(_only_digits(m), n + 1, F.length(m))
    plus = _let(F.length(code) - 1, lambda n: F.when(n > 0, _let(
        F.concat(F.substring(code, F.lit(2), n), _permuted_digits(after(n), key, "phone")), lambda d: _refill(m, d))).otherwise(m))
    # area codes from 200: 8 * 10**9 numbers
    area = _let(_walked(ten.cast("long") - 2_000_000_000, 89443, 8_000_000_000, key, "phone_area", 20), lambda v: _refill(
        m, F.concat(F.when(F.length(_only_digits(m)) == 11, "1").otherwise(""), (v + 2_000_000_000).cast("string"))))
    trunk = _let(_permuted_digits(after(F.lit(1)), key, "phone_trunk"), lambda d: _refill(m, F.concat(F.lit("0"), d)))
    return (F.when(m.rlike(f"^(?:{PLANTED})$"), planted).when(m.startswith("+"), plus).when(m.rlike("^[A-Z]"), m)
            .when(m.rlike(r"^\(?0"), trunk).otherwise(area))


def _mod_97(chars: Column) -> Column:
    """Rest by 97 of the digits, with letters as 10 to 35."""
    return F.aggregate(F.filter(F.split(chars, ""), lambda ch: ch != ""), F.lit(0), lambda acc, ch: F.when(
        ch.between("0", "9"), acc * 10 + F.ascii(ch) - 48).otherwise(acc * 100 + F.ascii(ch) - 55) % 97)


def _iban(m: Column, key: str) -> Column:
    """What follows the check digits is permuted, the check digits are made
    to fit. With letters it is permuted within the classes, place by place."""
    def new(country: Column, own: Column) -> Column:
        permuted = F.when(own.rlike("^[0-9]+$"), _permuted_digits(own, key, "iban")).otherwise(
            _permuted_alphabet(own, key, "iban"))
        return _let(permuted, lambda p: _refill(m, F.concat(country, F.lpad((98 - _mod_97(
            F.concat(p, country, F.lit("00")))).cast("string"), 2, "0"), p), "A-Z0-9"))

    whole = lambda c: (c.substr(1, 2), c.substr(F.lit(5), F.length(c)))
    return _let(F.replace(m, F.lit(" "), F.lit("")), lambda c: F.when(
        (_mod_97(F.concat(c.substr(F.lit(5), F.length(c)), c.substr(1, 4))) == 1)
        & c.substr(3, 2).between("02", "98"), new(*whole(c))).otherwise(m))


def _ipv4(m: Column, key: str) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda p: p.cast("long"))
    valid = F.forall(parts, lambda p: p <= 255)
    n = F.aggregate(parts, F.lit(0).cast("long"), lambda acc, p: acc * 256 + p)
    return F.when(valid, _let(_feistel(n, F.lit(65536).cast("long"), key, "ipv4", F.lit("")), lambda v: F.concat_ws(
        ".", *[F.pmod(F.shiftright(v, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)]))).otherwise(m)


def _ssn(m: Column, key: str) -> Column:
    """Area 001 to 899 without 666, group 01 to 99, serial 0001 to 9999."""
    area, group, serial = (F.substring(m, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area >= 1) & (area <= 899) & (area != 666) & (group >= 1) & (serial >= 1)
    # the domain counts valid values only: 898 areas
    n = ((area - 1 - F.when(area > 666, 1).otherwise(0)) * 99 + (group - 1)) * 9999 + (serial - 1)
    back = lambda v: _let(F.floor(v / (99 * 9999)) + 1, lambda a: F.concat_ws(
        "-", F.lpad((a + F.when(a >= 666, 1).otherwise(0)).cast("string"), 3, "0"),
        F.lpad((F.pmod(F.floor(v / 9999), F.lit(99)) + 1).cast("string"), 2, "0"),
        F.lpad((F.pmod(v, F.lit(9999)) + 1).cast("string"), 4, "0")))
    return F.when(valid, _let(_walked(n, 29816, 898 * 99 * 9999, key, "ssn", 20), back)).otherwise(m)


def _date(m: Column, key: str, form: str) -> Column:
    # one permutation of days for all notations: a date stays linked across them
    day = F.try_to_date(m, form)
    new = _walked(F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long"), 271, DAYS, key, "date", 20)
    valid = day.isNotNull() & (F.date_format(day, form) == m)
    padded = F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), new.cast("int")), form)
    return F.when(valid, padded).otherwise(_other_date(m, key, form.startswith("yyyy")))


def _other_date(m: Column, key: str, year_first: bool) -> Column:
    """A date with days or months of one digit, or with the month first: one
    permutation for each order and number of digits. Where the day comes first
    it does if it can, so month-first days are 13 to 31."""
    parts = F.split(m, "[-/.]")
    y, a, b = (parts[i] for i in ((0, 1, 2) if year_first else (2, 0, 1)))
    number = lambda c: c.cast("long")
    day_last = F.lit(year_first) | (number(b) > 12)
    late = F.lit(not year_first) & day_last      # days from 13 on
    d, mo = F.when(day_last, b).otherwise(a), F.when(day_last, a).otherwise(b)
    first = F.when(late, 13).otherwise(1)
    base = F.struct(
        y.alias("y"), a.alias("a"), b.alias("b"), day_last.alias("day_last"), number(d).alias("d"), number(mo).alias("m"),
        first.cast("long").alias("first"), F.when(F.length(d) == 1, 9).otherwise(32 - first).cast("long").alias("days"),
        F.when(F.length(mo) == 1, 9).otherwise(12).cast("long").alias("months"),
        F.concat_ws(" ", F.lit("year first" if year_first else "year last"), day_last.cast("string"),
                    F.length(a).cast("string"), F.length(b).cast("string")).alias("tweak"))

    def last_day(year: Column, month: Column) -> Column:
        leap = (F.pmod(year, F.lit(4)) == 0) & (year != 1900)
        return F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)

    def permuted(p: Column) -> Column:
        size = p["months"] * p["days"] * 200
        year = lambda v: F.floor(v / (p["months"] * p["days"])) + 1900
        month = lambda v: F.pmod(F.floor(v / p["days"]), p["months"]) + 1
        day = lambda v: F.pmod(v, p["days"]) + p["first"]
        once = lambda v: _feistel(v, F.ceil(F.sqrt(size)).cast("long"), key, "date", p["tweak"])
        inside = lambda v: (v < size) & (day(v) <= last_day(year(v), month(v)))
        n = ((number(p["y"]) - 1900) * p["months"] + p["m"] - 1) * p["days"] + p["d"] - p["first"]
        walked = F.aggregate(F.sequence(F.lit(1), F.lit(30)), once(n),
                             lambda v, _: F.when(inside(v), v).otherwise(once(v)))
        put = lambda v, c: F.lpad(v.cast("string"), F.length(c), "0")
        return _let(walked, lambda v: _refill(m, F.concat(*(
            [put(year(v), p["y"])] if year_first else []),
            F.when(p["day_last"], F.concat(put(month(v), p["a"]), put(day(v), p["b"])))
            .otherwise(F.concat(put(day(v), p["a"]), put(month(v), p["b"]))),
            *([] if year_first else [put(year(v), p["y"])]))))

    return _let(base, lambda p: F.when(
        p["m"].between(1, 12) & (p["d"] >= p["first"]) & (p["d"] <= last_day(number(p["y"]), p["m"])),
        permuted(p)).otherwise(m))


def _permuted_alphabet(part: Column, key: str, kind: str, letters: int = 26) -> Column:
    """Each letter or digit is replaced by one of its own class. The shift of
    a place depends on everything before it, so the map can be undone from the
    left; two passes, the second from the right, make every place depend on
    all others."""
    def one(text: Column, i: int) -> Column:
        step = lambda acc, ch: _let(
            F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), F.lit(str(i)), acc), 256), 1, 8),
                   16, 10).cast("long"),
            lambda h: F.concat(acc, F.when(ch.rlike("^[0-9]$"), _shift(ch, "0", 10, h))
                               .when(ch.rlike("^[a-z]$"), _shift(ch, "a", letters, h))
                               .when(ch.rlike("^[A-Z]$"), _shift(ch, "A", letters, h)).otherwise(ch)))
        return F.aggregate(F.filter(F.split(text, ""), lambda ch: ch != ""), F.lit(""), step)
    return F.reverse(_let(F.reverse(_let(part, lambda p: one(p, 1))), lambda p: one(p, 2)))


def _shift(ch: Column, first: str, size: int, by: Column) -> Column:
    """The character ``by`` places on in the ``size`` characters from ``first``, round the end."""
    return F.char(F.pmod(F.ascii(ch) - ord(first) + by, F.lit(size)) + ord(first))


def pseudonym(match: Column, kind: str, key: str = KEY) -> Column:
    """Pseudonym of a value found as ``kind``; itself if it fails the check."""
    if kind == "card":
        return _card(match, key)
    if kind == "phone":
        return _phone(match, key)
    if kind == "iban":
        return _iban(match, key)
    if kind == "ipv4":
        return _ipv4(match, key)
    if kind == "ssn":
        return _ssn(match, key)
    if kind == "mail":
        return F.concat(_permuted_alphabet(F.substring_index(match, "@", 1), key, kind), F.lit("@"),
                        F.substring_index(match, "@", -1))
    if kind == "secret":
        return _permuted_alphabet(match, key, kind, 6)     # hex digits stay hex digits
    return _date(match, key, {
        "iso_date": "yyyy-MM-dd", "year_slash_date": "yyyy/MM/dd", "slash_date": "dd/MM/yyyy",
        "dot_date": "dd.MM.yyyy"}[kind])


def replaced(text: Column, kind: str, key: str = KEY) -> Column:
    """``text`` with the values of one kind replaced."""
    pattern, may_hold = KINDS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rest = F.split(text, pattern, -1)
    put = lambda m: F.array_join(F.transform(rest, lambda p, i: F.concat(
        p, F.coalesce(pseudonym(F.get(m, i), kind, key), F.lit("")))), "")
    return F.when(may_hold(text), F.when(text.rlike(pattern), _let(found, put)).otherwise(text)).otherwise(text)


def pseudonymise(docs: DataFrame, key: str = KEY, text_col: str = "text", kinds=tuple(KINDS)) -> DataFrame:
    """``docs`` with the personal values of ``text_col`` replaced by pseudonyms."""
    out = docs
    for kind in kinds:
        out = out.select(*[replaced(F.col(f"`{c}`"), kind, key).alias(c) if c == text_col else F.col(f"`{c}`")
                           for c in docs.columns])
    return out


def op5_feistel_pseudonyms(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = pseudonymise(docs.select("doc_id", "text", F.col("text").alias("before")))
    return out.select("doc_id", "text", F.coalesce(F.col("text") != F.col("before"), F.lit(False)).alias("changed"))
