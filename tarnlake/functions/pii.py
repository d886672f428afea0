"""Patterns of personal data, their sensitivity and their masks."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Pattern(NamedTuple):
    regex: str
    sensitivity: int
    mask: str


# Fixed values.
PATTERNS = {
    "email": Pattern(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", 3, "***@***.***"),
    "phone": Pattern(r"\b(?:\+?1[-.\s]?)?\(?[0-9]{3}\)?[-.\s]?[0-9]{3}[-.\s]?[0-9]{4}\b", 3, "***-***-****"),
    "credit_card": Pattern(
        r"\b(?:4[0-9]{12}(?:[0-9]{3})?|5[1-5][0-9]{14}|3[47][0-9]{13}|6(?:011|5[0-9]{2})[0-9]{12})\b", 5, "****-****-****-****"
    ),
    "ssn": Pattern(r"\b(?!000|666|9\d{2})\d{3}-(?!00)\d{2}-(?!0000)\d{4}\b", 5, "***-**-****"),
    "ip_address": Pattern(
        r"\b(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\.){3}(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\b", 2, "***.***.***.***"
    ),
    "uae_phone": Pattern(r"\b(?:\+971|00971|971)?[-\s]?(?:50|52|54|55|56|58)[-\s]?[0-9]{3}[-\s]?[0-9]{4}\b", 3, "+971-**-***-****"),
    "emirates_id": Pattern(r"\b784-[0-9]{4}-[0-9]{7}-[0-9]\b", 5, "784-****-*******-*"),
}
#: Columns with a type this sensitive are masked, and encrypted from the next.
MASK_FROM, ENCRYPT_FROM = 3, 4


def may_hold(c: Column, name: str) -> Column:
    """Cheap condition that every match of the pattern meets: an e-mail address
    has an @, all others have a digit."""
    return F.contains(c, F.lit("@")) if name == "email" else c.rlike("[0-9]")


def holds(c: Column, name: str) -> Column:
    return may_hold(c, name) & c.rlike(PATTERNS[name].regex)


def masked(c: Column, names: list[str]) -> Column:
    """Matches of the named patterns replaced, in pattern order; NULL stays.

    Addresses come first and their mask has no digit, so texts without digits
    skip the patterns that need one.
    """
    if "email" in names:
        c = F.when(may_hold(c, "email"), F.regexp_replace(c, PATTERNS["email"].regex, PATTERNS["email"].mask)).otherwise(c)
    rest = c
    for name, p in PATTERNS.items():
        if name in names and name != "email":
            rest = F.regexp_replace(rest, p.regex, p.mask)
    return F.when(may_hold(c, "digits"), rest).otherwise(c)
