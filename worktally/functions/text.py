"""Text, number and date normalisation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Zero digits of the decimal digit blocks that occur in typed keys: Devanagari, Bengali, Gurmukhi, Gujarati, Oriya, Tamil, Telugu, Kannada, Malayalam, Arabic-Indic, extended Arabic-Indic, fullwidth.
DIGIT_ZEROS = (0x0966, 0x09E6, 0x0A66, 0x0AE6, 0x0B66, 0x0BE6, 0x0C66, 0x0CE6, 0x0D66, 0x0660, 0x06F0, 0xFF10)
_FOREIGN = "".join(chr(zero + d) for zero in DIGIT_ZEROS for d in range(10))
_ASCII = "0123456789" * len(DIGIT_ZEROS)

BLANKS = r"[\s\p{Z}\x{200B}\x{FEFF}\x1C-\x1F]+"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def collapsed(x: Column) -> Column:
    """White space of any kind collapsed to one blank and trimmed; blank becomes null."""
    squeezed = F.regexp_replace(x.cast("string"), BLANKS, " ")
    return F.nullif(F.trim(squeezed), F.lit(""))


def strip(x: Column) -> Column:
    """Leading and trailing white space of any kind removed."""
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def ascii_digits(x: Column) -> Column:
    """Digits of other scripts as 0-9."""
    return F.translate(x, _FOREIGN, _ASCII)


def whole_number(x: Column) -> Column:
    """The whole number a typed key denotes, as decimal(38,0), or null.

    Accepts blanks of any kind, a sign, leading zeros, grouping commas, a decimal part of zeros,
    exponents and digits of other scripts.
    """
    s = F.regexp_replace(ascii_digits(x.cast("string")), BLANKS, "")
    plain = s.rlike(r"^[+-]?(\d+|\d{1,3}(,\d{2,3})+)(\.0*)?$")
    digits = F.regexp_replace(F.regexp_replace(s, r"\.0*$", ""), r"[,+]", "")
    science = s.rlike(r"^[+-]?\d+(\.\d+)?[eE]\+?\d{1,2}$")
    value = _try_decimal(s, 38, 10)
    whole = F.when(value == F.floor(value), value)
    # Most keys are bare digits: one test, and none of the rewriting below.
    bare = x.cast("string").rlike(r"^[0-9]{1,18}$")
    return F.when(bare, _try_decimal(x.cast("string"), 38, 0)).when(plain, _try_decimal(digits, 38, 0)).when(science, whole.cast("decimal(38,0)"))


def _try_decimal(x: Column, precision: int, scale: int) -> Column:
    return x.try_cast(f"decimal({precision},{scale})")


def number_text(x: Column) -> Column:
    """A number by value as plain text without trailing zeros, or null where the text is no number."""
    s = F.regexp_replace(ascii_digits(x.cast("string")), BLANKS, "")
    bare = F.when(s.rlike(r"^[+-]?\d{1,3}(,\d{2,3})+(\.\d+)?$"), F.regexp_replace(s, ",", "")).otherwise(s)
    value = F.when(bare.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,3})?$"), _try_decimal(bare, 38, 10))
    plain = F.regexp_replace(value.cast("string"), r"\.0+$|(\.\d*?[1-9])0+$", "$1")
    return F.when(value == 0, F.lit("0")).otherwise(plain)


def day(x: Column) -> Column:
    """The day a typed date denotes: yyyy-M-d, d-MMM-yyyy, d-M-yyyy (also with / or .) and 'MMM d, yyyy' with or without a time; else null."""
    s = F.lower(F.trim(F.regexp_replace(ascii_digits(x.cast("string")), BLANKS, " ")))
    iso = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?:[t ].*)?$"
    dmy = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})(?: .*)?$"
    named = r"^(\d{1,2})[- ]([a-z]{3})[a-z]*[- ,]+(\d{4})(?: .*)?$"
    us = r"^([a-z]{3})[a-z]* (\d{1,2}),? (\d{4})(?:,? .*)?$"

    def month(name: Column) -> Column:
        at = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), name)
        return F.when(at > 0, at.cast("string"))

    def made(y: Column, m: Column, d: Column) -> Column:
        return F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(m, 2, "0"), F.lpad(d, 2, "0")).try_cast("date")

    def part(pattern: str, i: int) -> Column:
        return F.regexp_extract(s, pattern, i)

    return (
        F.when(s.rlike(iso), made(part(iso, 1), part(iso, 2), part(iso, 3)))
        .when(s.rlike(named), F.when(month(part(named, 2)).isNotNull(), made(part(named, 3), month(part(named, 2)), part(named, 1))))
        .when(s.rlike(dmy), made(part(dmy, 3), part(dmy, 2), part(dmy, 1)))
        .when(s.rlike(us), F.when(month(part(us, 1)).isNotNull(), made(part(us, 3), month(part(us, 1)), part(us, 2))))
    )
