"""Twelve-digit hierarchical region keys (ARS)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

KEY_LENGTH = 12

# Significant digits per administrative level.
LEVEL_DIGITS = {
    "Land": 2,
    "Kreis": 5,
    "Verwaltungsgemeinschaft": 9,
    "Gemeinde": 12,
}


def level_digits(level: str) -> int:
    """Digits that identify a level; the name is matched without regard to case."""
    for name, digits in LEVEL_DIGITS.items():
        if name.lower() == str(level).lower():
            return digits
    raise ValueError(f"Unknown administrative level {level!r}; known: {list(LEVEL_DIGITS)}")


def pad_left(c: Column, width: int = KEY_LENGTH) -> Column:
    """Zero-fill on the left; longer text is kept whole (``lpad`` alone would cut it)."""
    s = c.cast("string")
    signed = s.rlike(r"^[+-]")
    filled = F.when(signed, F.concat(F.substring(s, 1, 1), F.lpad(s.substr(F.lit(2), F.length(s)), width - 1, "0")))
    return F.when(F.length(s) < width, filled.otherwise(F.lpad(s, width, "0"))).otherwise(s)


def normalize_key(c: Column) -> Column:
    """Shape any code to 12 digits.

    A code that opens with a state number 01-16 lost trailing zeros, so it is filled on the
    right; any other short code lost leading zeros.
    """
    s = F.trim(c.cast("string"))
    state = F.substring(s, 1, 2).try_cast("int")
    return (
        F.when(F.length(s) >= KEY_LENGTH, F.substring(s, 1, KEY_LENGTH))
        .when(F.length(s) == 0, F.lit("0" * KEY_LENGTH))
        .when(state.between(1, 16), F.rpad(s, KEY_LENGTH, "0"))
        .otherwise(pad_left(s))
    )


def level_key(c: Column, digits: int) -> Column:
    """Key of the unit that contains ``c`` at a level: first digits, zero-filled on the right."""
    return F.rpad(F.substring(c.cast("string"), 1, digits), KEY_LENGTH, "0")


def region_prefix(region_key: str) -> str:
    """Prefix that all members of a region share, derived from its trailing zeros."""
    key = str(region_key).zfill(KEY_LENGTH)
    return next(key[:n] for n in (2, 5, 8, len(key)) if not key[n:].strip("0"))


def in_region(c: Column, region_key: str) -> Column:
    """True for keys of a region; the prefix ``00`` stands for the whole country."""
    prefix = region_prefix(region_key)
    return F.lit(True) if prefix == "00" else c.startswith(prefix)
