"""Whether an identifier found in a text is well formed: checksums, lengths and numbering rules as built-in
expressions over the matched string. They run inside higher-order functions over the matches of a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Country code and length of an account number (ISO 13616 registry).
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 "
    "GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 "
    "MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SD18 SE24 SI19 SK24 SM27 ST25 SV28 "
    "TL23 TN24 TR26 UA29 VA22 VG24 XK20").split()

# What a well-formed address and phone number look like (Java and RE2 compatible).
EMAIL_FORM = r"^[A-Za-z0-9_%+-]+(\.[A-Za-z0-9_%+-]+)*@([A-Za-z0-9]([A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,63}$"
MAX_LOCAL_PART = 64
NATIONAL_PHONE = r"^(222)?[234][0-9]{7}$"
NORTH_AMERICAN_PHONE = r"^1[2-9][0-9]{2}[2-9][0-9]{6}$"


def _codes(c: Column) -> Column:
    """The character codes of a string that is not empty."""
    return F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.ascii(F.substr(c, i, F.lit(1))))


PIECE, PIECES = 15, 5  # digits taken at a time with the remainder so far (a long), and pieces of the longest account number


def mod97(c: Column) -> Column:
    """Remainder modulo 97 of the number that digits and letters (A = 10 ... Z = 35) spell.

    Numbers of up to 75 digits (any account number) go by pieces of 15 digits; what else there may be, sign by sign."""
    spelt = c
    for i in range(26):
        spelt = F.replace(spelt, F.lit(chr(65 + i)), F.lit(str(10 + i)))
    rest = F.lit("")
    for i in range(PIECES):
        rest = (F.concat(F.lit("0"), rest, F.substr(spelt, F.lit(1 + i * PIECE), F.lit(PIECE))).cast("long") % 97).cast("string")
    by_sign = F.aggregate(_codes(c), F.lit(0), lambda acc, code: F.when(code <= 57, (acc * 10 + code - 48) % 97)
                          .otherwise((acc * 100 + code - 55) % 97))
    return F.when(c.rlike("^[0-9A-Z]+$") & (F.length(spelt) <= PIECE * PIECES), rest.cast("int")).otherwise(by_sign)


def iban_valid(hit: Column) -> Column:
    """Length of its country and check digits: the number rearranged with its first four characters last is 1 modulo 97."""
    plain = F.translate(hit, " ", "")
    rearranged = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))
    return F.concat(F.left(plain, F.lit(2)), F.length(plain).cast("string")).isin(IBAN_LENGTHS) & (mod97(rearranged) == 1)


def card_valid(hit: Column) -> Column:
    """Luhn's sum: every second digit from the right doubled, digits of the products added."""
    digits = F.transform(_codes(F.reverse(F.translate(hit, " -", ""))), lambda code, i: F.when(
        i % 2 == 0, code - 48).otherwise((code - 48) * 2 - F.when(code > 52, 9).otherwise(0)))
    return F.aggregate(digits, F.lit(0), lambda acc, d: acc + d) % 10 == 0


def email_valid(hit: Column) -> Column:
    """Labels without empty parts or hyphens at their ends, within their lengths."""
    return hit.rlike(EMAIL_FORM) & (F.instr(hit, F.lit("@")) <= MAX_LOCAL_PART + 1)


def phone_valid(hit: Column) -> Column:
    """The national plan, the North American plan, 8 to 15 digits of any other international number, the internal P form."""
    digits = F.regexp_replace(hit, "[^0-9]", "")
    return (F.when(hit.startswith("P"), F.lit(True))
            .when(hit.startswith("+222") | ~hit.startswith("+"), digits.rlike(NATIONAL_PHONE))
            .when(hit.startswith("+1") & (F.length(digits) == 11), digits.rlike(NORTH_AMERICAN_PHONE))
            .otherwise(F.length(digits).between(8, 15)))


def nni_valid(hit: Column) -> Column:
    """National numbers have no published check digit; one digit ten times over is a filler."""
    return F.length(F.replace(hit, F.left(hit, F.lit(1)), F.lit(""))) > 0


VALID: dict[str, Callable[[Column], Column]] = {
    "EMAIL": email_valid, "PHONE": phone_valid, "NNI": nni_valid, "IBAN": iban_valid, "CARD": card_valid,
}
