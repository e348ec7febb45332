"""Identifier formats and check digits (H18, H19), as native Column
expressions so a rule pack runs inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quaestor.functions.numeric import col

# Identifier formats.
TIN_PATTERN = r"^\d{9}$"
NIC_OLD_PATTERN = r"^\d{9}V$"
NIC_NEW_PATTERN = r"^\d{12}$"
BRN_PATTERN = r"^PV\d{8}$"
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PHONE_PATTERN = r"^\+94\d{9,10}$"
POSTAL_PATTERN = r"^\d{5}$"
UUID_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
TIN_LENGTHS = (9, 10, 12)


def _day_ok(day: Column) -> Column:
    return day.between(1, 366) | day.between(501, 866)


def valid_tin(c) -> Column:
    """9-digit TIN."""
    return F.coalesce(col(c).rlike(TIN_PATTERN), F.lit(False))


def valid_nic(c, as_of_year) -> Column:
    """(H19) Old ``\\d{9}V`` or new 12-digit national id with a valid day-of-year."""
    x = col(c)
    old = x.rlike(NIC_OLD_PATTERN) & _day_ok(F.substring(x, 3, 3).cast("int"))
    yr = F.substring(x, 1, 4).cast("int")
    ay = F.lit(as_of_year) if isinstance(as_of_year, int) else col(as_of_year)
    new = x.rlike(NIC_NEW_PATTERN) & yr.between(F.lit(1900), ay) & _day_ok(F.substring(x, 5, 3).cast("int"))
    return F.coalesce(old | new, F.lit(False))


def valid_brn(c) -> Column:
    return F.coalesce(col(c).rlike(BRN_PATTERN), F.lit(False))


def valid_email(c) -> Column:
    return F.coalesce(col(c).rlike(EMAIL_PATTERN), F.lit(False))


def valid_phone(c) -> Column:
    return F.coalesce(F.replace(col(c), F.lit(" "), F.lit("")).rlike(PHONE_PATTERN), F.lit(False))


def valid_postal(c) -> Column:
    return F.coalesce(col(c).rlike(POSTAL_PATTERN), F.lit(False))


def valid_uuid(c) -> Column:
    return F.coalesce(F.lower(col(c)).rlike(UUID_PATTERN), F.lit(False))


def _digits(c) -> Column:
    """array<int> of the digits of a string (non-digits removed)."""
    s = F.regexp_replace(col(c).cast("string"), "[^0-9]", "")
    return F.transform(F.split(s, ""), lambda d: d.cast("int"))


def luhn_valid(c) -> Column:
    """mod-10 (Luhn) check over the digits, last digit is the check digit."""
    d = F.reverse(_digits(c))
    weighted = F.transform(
        d, lambda x, i: F.when(i % 2 == 1, F.when(x * 2 > 9, x * 2 - 9).otherwise(x * 2)).otherwise(x))
    total = F.aggregate(weighted, F.lit(0), lambda acc, x: acc + x)
    return (F.size(d) > 1) & (total % 10 == 0)


def mod11_valid(c) -> Column:
    """mod-11 with weights 2,3,4,...(from the right, excluding the check digit);
    check = 11 - (sum % 11), 10 -> 0 and 11 -> 0."""
    d = _digits(c)
    n = F.size(d)
    body = F.reverse(F.slice(d, 1, n - 1))
    weighted = F.transform(body, lambda x, i: x * (i + 2))
    s = F.aggregate(weighted, F.lit(0), lambda acc, x: acc + x)
    chk = (F.lit(11) - s % 11) % 11
    chk = F.when(chk == 10, F.lit(0)).otherwise(chk)
    return (n > 1) & (F.element_at(d, n) == chk)


def mod97_valid(c) -> Column:
    """ISO 7064 MOD 97-10 as used by IBAN: move the first 4 chars to the end,
    letters -> 10..35, the number mod 97 must be 1.  Computed digit by digit
    with ``aggregate`` so no big integers are needed."""
    s = F.upper(F.regexp_replace(col(c).cast("string"), "[^0-9A-Za-z]", ""))
    rotated = F.concat(F.substring(s, 5, 1000000), F.substring(s, 1, 4))
    chars = F.split(rotated, "")
    values = F.transform(chars, lambda ch: F.when(ch.rlike("[0-9]"), ch.cast("int"))
                         .otherwise(F.ascii(ch) - 55))
    rem = F.aggregate(values, F.lit(0),
                      lambda acc, v: F.when(v >= 10, (acc * 100 + v) % 97).otherwise((acc * 10 + v) % 97))
    return (F.length(s) > 4) & (rem == 1)


def checksum_valid(value, algorithm) -> Column:
    """Pick the check by an algorithm code held in a column."""
    a = F.upper(col(algorithm))
    return (F.when(a.isin("MOD10", "LUHN"), luhn_valid(value))
            .when(a == "MOD11", mod11_valid(value))
            .when(a == "MOD97", mod97_valid(value))
            .otherwise(F.lit(None).cast("boolean")))
