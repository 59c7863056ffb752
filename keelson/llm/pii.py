"""Operator 6: format-preserving Feistel pseudonyms, in DataFrame functions only.

A text is split at everything that looks private; each match is validated and replaced, and the text is put together
again.  Card numbers (Luhn), phone numbers, social security numbers, IPv4 addresses and calendar dates are permuted
within their format by an alternating Feistel network on a mixed radix (a, b): any domain of a * b values is permuted
exactly, without cycle walking.  The round function is HMAC with SHA-256.  The key reaches the rows as a column of a
table of one row, so no plan, log or page of Spark's UI shows it.  The same value gets the same pseudonym in every document, whatever its separators, and the key holder can invert it.  E-mail names and hexadecimal
secrets are no numbers; they get keyed digests of the same shape, which cannot be inverted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Possessive throughout: java.util.regex matches a repeated group by recursion otherwise, and a host of many labels ends the JVM.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
SECRET = r"(?<![A-Za-z0-9])(?=[A-Fa-f]*[0-9])(?=[0-9]*[A-Fa-f])[0-9A-Fa-f]{32,64}(?![A-Za-z0-9])"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9]|\.[0-9])"
PHONE = r"(?<![0-9+])\+[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9]|[./-][0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
KINDS = ("email", "secret", "ipv4", "phone", "date", "ssn", "card")
PATTERNS = dict(zip(KINDS, (EMAIL, SECRET, IPV4, PHONE, DATE, SSN, CARD), strict=True))
PRIVATE = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Days of the 400 years from 1800-01-01, and two factors of their number.
FIRST_DAY, DAY_RADIX = "1800-01-01", (189, 773)
ROUNDS = 10


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def power_of_ten(n: Column) -> Column:
    return F.rpad(F.lit("1"), (n + 1).cast("int"), F.lit("0")).cast("long")


def keyed(df: DataFrame, key: str, name: str) -> DataFrame:
    """`df` with the two padded keys of HMAC in the struct column `name`, from a table of one row."""
    whole = key.encode()
    block = (hashlib.sha256(whole).digest() if len(whole) > 64 else whole).ljust(64, b"\0")
    pads = [bytearray(b ^ pad for b in block) for pad in (0x36, 0x5C)]
    one = df.sparkSession.createDataFrame([(pads,)], f"`{name}` struct<inner: binary, outer: binary>")
    return df.crossJoin(F.broadcast(one))


def hmac(key: Column, *parts: str | Column) -> Column:
    """HMAC-SHA256, in hex, of the parts joined by |."""
    message = F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]).cast("binary")
    return F.sha2(F.concat(key["outer"], F.unhex(F.sha2(F.concat(key["inner"], message), 256))), 256)


def feistel(value: Column, a: Column, b: Column, key: Column, tweak: str | Column, inverse: bool = False) -> Column:
    """A keyed permutation of 0 .. a * b - 1; `key` is a column made by `keyed`."""
    one, two = a.cast("long"), b.cast("long")
    sign = -1 if inverse else 1

    def pseudo_random(i: Column, half: Column) -> Column:
        return F.conv(F.substring(hmac(key, tweak, i, half), 1, 13), 16, 10).cast("long")

    def step(s: Column, i: Column) -> Column:
        left = F.when(i % 2 == 0, F.pmod(s["l"] + sign * F.pmod(pseudo_random(i, s["r"]), one), one)).otherwise(s["l"])
        right = F.when(i % 2 == 1, F.pmod(s["r"] + sign * F.pmod(pseudo_random(i, s["l"]), two), two)).otherwise(s["r"])
        return F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    rounds = F.array(*[F.lit(i) for i in (reversed(range(ROUNDS)) if inverse else range(ROUNDS))])
    start = F.struct(((value - F.pmod(value, two)).cast("decimal(20,0)") / two.cast("decimal(20,0)")).cast("long").alias("l"), F.pmod(value, two).cast("long").alias("r"))
    return F.aggregate(rounds, start, step, lambda s: s["l"] * two + s["r"])


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def refill(shape: Column, digits: Column) -> Column:
    """`shape` with its digits replaced in order by `digits`."""

    def put(s: Column, c: Column) -> Column:
        is_digit = c.rlike("^[0-9]$")
        return F.struct(
            F.concat(s["out"], F.when(is_digit, F.substring(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"),
            F.when(is_digit, s["at"] + 1).otherwise(s["at"]).alias("at"),
        )

    return F.aggregate(F.split(shape, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), put, lambda s: s["out"])


def luhn_sum(digits: Column, doubled: int) -> Column:
    """The Luhn sum; places from the right with i % 2 == doubled count twice (the last place is 1)."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = 2 * d - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == doubled, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def permuted_digits(digits: Column, key: Column, tweak: str, inverse: bool) -> Column:
    """Up to 18 digits as another string of as many digits."""


    def moved(v: Column) -> Column:
        value = feistel(v["d"].cast("long"), v["a"], v["b"], key, F.concat(F.lit(tweak), v["n"].cast("string")), inverse)
        return F.lpad(value.cast("string"), v["n"], F.lit("0"))

    n = F.length(digits)
    half = F.floor(n / 2)
    return let(F.struct(digits.alias("d"), n.alias("n"), power_of_ten(half).alias("a"), power_of_ten(n - half).alias("b")), moved)


def card(value: Column, key: Column, inverse: bool) -> Column:
    """All digits but the last are permuted, and the last is again the check digit; a number that fails Luhn stays."""

    def with_check(body: Column) -> Column:
        return F.concat(body, F.pmod(10 - F.pmod(luhn_sum(body, 1), F.lit(10)), F.lit(10)).cast("string"))

    def moved(digits: Column) -> Column:
        body = permuted_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card", inverse)
        return F.when(luhn_sum(digits, 0) % 10 == 0, let(let(body, with_check), lambda d: refill(value, d))).otherwise(value)

    return let(digits_of(value), moved)


def phone(value: Column, key: Column, inverse: bool) -> Column:
    """The last ten digits are permuted, the country code stays."""

    def moved(digits: Column) -> Column:
        head = F.length(digits) - 10
        return F.concat(F.substring(digits, F.lit(1), head), permuted_digits(F.substring(digits, head + 1, F.lit(10)), key, "phone", inverse))

    return let(let(digits_of(value), moved), lambda d: refill(value, d))


def ssn(value: Column, key: Column, inverse: bool) -> Column:
    """Valid numbers are permuted among themselves: areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999.

    Any other number stays.
    """

    def written(n: Column) -> Column:
        area = F.floor(n / (99 * 9999)) + 1
        parts = (area + F.when(area >= 666, 1).otherwise(0), F.pmod(F.floor(n / 9999), F.lit(99)) + 1, F.pmod(n, F.lit(9999)) + 1)
        return F.concat_ws("-", *[F.lpad(part.cast("long").cast("string"), wide, "0") for part, wide in zip(parts, (3, 2, 4), strict=True)])

    def moved(digits: Column) -> Column:
        area, group, serial = (F.substring(digits, at, n).cast("long") for at, n in ((1, 3), (4, 2), (6, 4)))
        number = ((area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1) * 9999 + serial - 1
        changed = let(feistel(number, F.lit(898 * 99), F.lit(9999), key, "ssn", inverse), written)
        return F.when(digits.rlike("^(000|666|9)|^...00|0000$"), value).otherwise(changed)

    return let(digits_of(value), moved)


def ipv4(value: Column, key: Column, inverse: bool) -> Column:
    number = F.aggregate(F.split(value, r"\."), F.lit(0).cast("long"), lambda s, p: s * 256 + p.cast("long"))
    out = feistel(number, F.lit(65536), F.lit(65536), key, "ipv4", inverse)
    return let(out, lambda n: F.concat_ws(".", *[F.pmod(F.shiftright(n, k), F.lit(256)).cast("string") for k in (24, 16, 8, 0)]))


def date(value: Column, key: Column, inverse: bool) -> Column:
    """A day of 1800 to 2199 becomes another one, written alike; what is no day of the calendar stays."""
    iso = value.rlike("^[0-9]{4}-")
    sep = F.substring(value, 3, 1)
    plain = F.when(iso, value).otherwise(F.concat_ws("-", F.substring(value, 7, 4), F.substring(value, 4, 2), F.substring(value, 1, 2)))
    day = plain.try_cast("date")
    number = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
    a, b = DAY_RADIX
    same_marks = iso | (sep == F.substring(value, 6, 1))
    valid = day.isNotNull() & same_marks & number.between(0, a * b - 1)
    moved = F.date_add(F.lit(FIRST_DAY).cast("date"), feistel(number, F.lit(a), F.lit(b), key, "date", inverse).cast("int"))

    def written(text: Column) -> Column:
        return F.when(iso, text).otherwise(F.concat(F.substring(text, 9, 2), sep, F.substring(text, 6, 2), sep, F.substring(text, 1, 4)))

    return F.when(valid, let(moved.cast("string"), written)).otherwise(value)


def email(value: Column, key: Column) -> Column:
    """The name becomes a keyed digest; the domain stays."""
    name = F.substring(hmac(key, "email", F.lower(value)), 1, 12)
    return F.concat(F.lit("u"), name, F.lit("@"), F.substring_index(value, "@", -1))


def secret(value: Column, key: Column) -> Column:
    """A keyed digest of the same length and case."""
    out = F.substring(hmac(key, "secret", F.lower(value)), F.lit(1), F.length(value))
    return F.when(value == F.upper(value), F.upper(out)).otherwise(out)


def kind_of(value: Column) -> Column:
    out = F.when(value.contains("@"), "email")
    for kind in KINDS[1:]:
        out = out.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), kind)
    return out.otherwise("none")


def replacement(kind: Column, value: Column, key: Column, inverse: bool = False) -> Column:
    out = F.when(kind == "email", value if inverse else email(value, key)).when(kind == "secret", value if inverse else secret(value, key))
    for name, how in (("ipv4", ipv4), ("phone", phone), ("date", date), ("ssn", ssn), ("card", card)):
        out = out.when(kind == name, how(value, key, inverse))
    return out.otherwise(value)


def pseudonymise(docs: DataFrame, key: str, inverse: bool = False, text_col: str = "text") -> DataFrame:
    """`docs` with `text_col` rewritten and the column `private`: array of (kind, pseudonym) of what was replaced.

    A column named `private` in the input is replaced.  Null texts stay null with an empty array; empty texts and texts
    with nothing private stay as they are; numbers and dates that fail validation stay.  Rows, repeated ones too, and
    other columns are kept as they are; an empty table stays empty.  No pattern recurses or backtracks over a repeated
    group, so a text of any length passes.
    """
    name = "_key"
    while name in docs.columns:
        name += "_"
    text, hidden = F.col(text_col), F.col(name)
    may = text.rlike("[0-9@]")
    found = F.when(may, F.regexp_extract_all(text, F.lit(PRIVATE), F.lit(0)))
    rows = keyed(docs, key, name).withColumn("private", F.transform(found, lambda v: F.struct(kind_of(v).alias("kind"), v.alias("value"))))
    rows = rows.withColumn("private", F.transform("private", lambda p: F.struct(p["kind"].alias("kind"), p["value"].alias("value"), replacement(p["kind"], p["value"], hidden, inverse).alias("pseudonym"))))
    gaps = F.split(text, PRIVATE, -1)
    ends = F.concat(F.transform("private", lambda p: p["pseudonym"]), F.array(F.lit("")))
    rebuilt = F.array_join(F.zip_with(gaps, ends, lambda g, p: F.concat(g, p)), "")
    rows = rows.withColumn(text_col, F.when(F.size("private") > 0, rebuilt).otherwise(text))
    changed = F.transform(F.filter("private", lambda p: p["pseudonym"] != p["value"]), lambda p: F.struct(p["kind"].alias("kind"), p["pseudonym"].alias("pseudonym")))
    return rows.drop(name).withColumn("private", F.coalesce(changed, F.array().cast("array<struct<kind:string,pseudonym:string>>")))
