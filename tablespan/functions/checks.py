"""Row checks as boolean columns. A NULL value makes a check NULL, which counts as passed."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: text formats
EMAIL_FORMAT = r"^.+@.+\..{2,4}$"
POSTCODE_FORMAT = r"^[0-9]{2}-[0-9]{3}$"
PESEL_FORMAT = r"^[0-9]{11}$"
NIP_FORMAT = r"^[0-9]{10}$"
DATE_FORMAT = r"^[0-9]{4}/[01][0-9]/[0123][0-9]$"
DATE_PATTERN = "yyyy/MM/dd"

# fixed values: weights of the first nine NIP digits; their sum modulo 11 is the tenth digit
NIP_WEIGHTS = (6, 5, 7, 2, 3, 4, 5, 6, 7)


def email_ok(c: Column) -> Column:
    return c.rlike(EMAIL_FORMAT)


def format_ok(c: Column, pattern: str) -> Column:
    return c.rlike(pattern)


def digit_at(c: Column, position: int) -> Column:
    """The digit at a 1-based position as a number (no cast, hence no failure on other text)."""
    return F.ascii(c.substr(position, 1)) - 48


def nip_check_digit(body: Column) -> Column:
    """Weighted sum of nine digits modulo 11; 10 means that no valid number has this body."""
    total = F.lit(0)
    for i, weight in enumerate(NIP_WEIGHTS, start=1):
        total = total + digit_at(body, i) * weight
    return total % 11


def nip_ok(c: Column) -> Column:
    return c.rlike(NIP_FORMAT) & (nip_check_digit(c) == digit_at(c, 10))


def birth_date_ok(c: Column, today: Column) -> Column:
    """A date text of the declared form, a real calendar day, before `today`; NULL is rejected."""
    day = F.try_to_date(c, DATE_PATTERN)
    return F.coalesce(c.rlike(DATE_FORMAT) & day.isNotNull() & (day < today), F.lit(False))


def in_domain(c: Column, values: list) -> Column:
    return c.isin(values)


def length_ok(c: Column, max_len: int | None, min_len: int = 0) -> Column:
    ok = F.length(c) >= min_len
    return ok & (F.length(c) <= max_len) if max_len is not None else ok
