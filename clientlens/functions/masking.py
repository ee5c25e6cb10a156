"""Column functions that hide personal data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MASKED_NAME_PATTERN = "% ****"
MASKED_EMAIL_PATTERN = "%***@%"


def mask_name(name: Column, strict: bool = False) -> Column:
    """First word and ' ****'. ``strict`` also hides a name that is a single word."""
    words = F.split(name, " ")
    masked = F.concat(words[0], F.lit(" ****"))
    if not strict:
        return masked
    return F.when(F.size(words) > 1, masked).otherwise(F.concat(name.substr(1, 1), F.lit(" ****")))


def mask_phone(phone: Column, strict: bool = False) -> Column:
    """First and last three digits. Short numbers pass unless ``strict``."""
    n = F.length(phone)
    masked = F.concat(phone.substr(1, 3), F.lit("****"), F.right(phone, F.lit(3)))
    if not strict:
        return F.when(n < 6, phone).otherwise(masked)
    return F.when(n < 7, F.regexp_replace(phone, ".", "*")).otherwise(masked)


def mask_email(email: Column, strict: bool = False) -> Column:
    """First character and the domain. Text without '@' passes unless ``strict``."""
    at = F.instr(email, "@")
    masked = F.concat(email.substr(1, 1), F.lit("***"), F.substring(email, at, F.length(email)))
    return F.when(at == 0, F.lit("***") if strict else email).otherwise(masked)


def hash_token(value: Column) -> Column:
    """Irreversible token of a value: hexadecimal SHA-256."""
    return F.sha2(value.cast("string"), 256)


def is_raw_name(name: Column) -> Column:
    """True for a name that has not been masked."""
    return name.isNotNull() & ~name.like(MASKED_NAME_PATTERN)


def is_raw_email(email: Column) -> Column:
    """True for an e-mail that has not been masked."""
    return email.isNotNull() & ~email.like(MASKED_EMAIL_PATTERN)
