"""Scalar rules of the analytics: parsing, names, keys, rounding, fiscal years, bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from worktally.functions.text import MONTHS, collapsed, strip

#: Value assigned to a value at or below each of the five percentiles, and above them all.
BAND_VALUES, BAND_ABOVE = (10.0, 25.0, 50.0, 75.0, 90.0), 97.5


def round_to(x: Column, digits: int = 2) -> Column:
    """Half up on the binary value, the same in every engine: floor(x * 10^d + 0.5) / 10^d."""
    return F.floor(x * F.lit(float(10**digits)) + F.lit(0.5)) / F.lit(float(10**digits))


def interpolated(low: Column, high: Column, share: Column) -> Column:
    """low * (1 - share) + high * share, product and sum rounded together as in SQL's quantile_cont, so that a half is rounded alike; null if one is null."""
    fused = F.reflect(F.lit("java.lang.Math"), F.lit("fma"), *[F.coalesce(x, F.lit(0.0)) for x in (low, 1 - share, high * share)])
    return F.when(low.isNotNull() & high.isNotNull() & share.isNotNull(), fused.cast("double"))


def rate(part: Column, whole: Column) -> Column:
    """part / whole in percent with two digits; 0 where whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(round_to(part.cast("double") / whole.cast("double") * 100))


def parse_amount(x: Column) -> Column:
    """A positive amount as decimal(18,2); anything else is null."""
    value = strip(x.cast("string")).try_cast("decimal(18,2)")
    return F.when(value > 0, value)


def parse_date(x: Column) -> Column:
    """A date in one of five notations (2024-06-04, 4-Jun-2024, 04-06-2024, 'Jun 4, 2024', the last also with a time), else null."""
    s = strip(x.cast("string"))
    iso, named, dmy = r"^(\d{4})-(\d{1,2})-(\d{1,2})$", r"^(\d{1,2})-([A-Za-z]{3})-(\d{4})$", r"^(\d{1,2})-(\d{1,2})-(\d{4})$"
    us = r"^([A-Za-z]{3}) (\d{1,2}), (\d{4})( \d{1,2}:\d{2}:\d{2} [AaPp][Mm])?$"

    def part(pattern: str, i: int) -> Column:
        return F.regexp_extract(s, pattern, i)

    def month(name: Column) -> Column:
        at = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(name))
        return F.when(at > 0, at.cast("string"))

    def made(y: Column, m: Column, d: Column) -> Column:
        return F.concat(y, F.lit("-"), F.lpad(m, 2, "0"), F.lit("-"), F.lpad(d, 2, "0")).try_cast("date")

    return (
        F.when(s.rlike(iso), made(part(iso, 1), part(iso, 2), part(iso, 3)))
        .when(s.rlike(named), made(part(named, 3), month(part(named, 2)), part(named, 1)))
        .when(s.rlike(dmy), made(part(dmy, 3), part(dmy, 2), part(dmy, 1)))
        .when(s.rlike(us), made(part(us, 3), month(part(us, 1)), part(us, 2)))
    )


def member_name(x: Column) -> Column:
    """A member's name in upper case without one title in front and a bracket at the end; null gives an empty string."""
    s = F.regexp_replace(strip(F.coalesce(x, F.lit(""))), r"\s*\([^)]*\)\s*$", "")
    s = F.regexp_replace(s, r"(?i)^(shri|smt\.?|dr\.?|mrs\.?|ms\.?|late)\s+", "")
    return F.upper(strip(F.regexp_replace(s, r"\s+", " ")))


def allocation_name(x: Column) -> Column:
    """A name in lower case without titles, for matching allocations; also takes Prof. and Mr."""
    s = F.lower(strip(F.coalesce(x, F.lit(""))))
    s = F.regexp_replace(s, r"\s*\([^)]*\)\s*$", "")
    s = F.regexp_replace(s, r"^(shri|smt|dr|mrs|ms|mr|prof|late)\.?\s+", "")
    return strip(F.regexp_replace(s, r"\s+", " "))


def member_key(name: Column, constituency: Column) -> Column:
    """Normalised name and constituency id, joined by a pipe."""
    return F.concat_ws("|", member_name(name), F.coalesce(constituency.cast("string"), F.lit("")))


def activity_name(x: Column) -> Column:
    """An activity without the scheme number in front."""
    return strip(F.regexp_replace(strip(x), r"(?i)^WS/\s*MP\d+/\d{4}-\d{4}/\d+-", ""))


def category_key(activity: Column, category: Column) -> Column:
    """The activity without a leading NA-, else the category, else UNCLASSIFIED."""
    clean = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(clean(F.regexp_replace(activity, "(?i)^NA-", "")), clean(category), F.lit("UNCLASSIFIED"))


def fiscal_year(d: Column) -> Column:
    """The year in which the fiscal year (April to March) of a day begins."""
    return F.year(F.add_months(d, -3))


def fiscal_label(start: Column) -> Column:
    """A fiscal year as 2024-25."""
    return F.concat(start.cast("string"), F.lit("-"), F.lpad(((start + 1) % 100).cast("string"), 2, "0"))


def band(value: Column, thresholds: list[Column]) -> Column:
    """The band of a value by ascending thresholds; a null threshold holds nothing, a null value has no band."""
    out = None
    for t, v in zip(thresholds, BAND_VALUES):
        hit = t.isNotNull() & (value <= t)
        out = F.when(hit, v) if out is None else out.when(hit, v)
    return F.when(value.isNotNull(), out.otherwise(BAND_ABOVE))


def grade(value: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    """The label of the first step the value reaches; steps are in descending order."""
    out = None
    for least, label in steps:
        out = F.when(value >= least, label) if out is None else out.when(value >= least, label)
    return out.otherwise(otherwise)


def hash_of(*columns: Column) -> Column:
    """SHA-256 of the columns as text joined by a pipe, with a mark for null."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("<NULL>")) for c in columns]), 256)


def identity_of(*columns: Column) -> Column:
    """A compact JSON array of the collapsed columns; null if any is blank."""
    parts = F.array(*[collapsed(c) for c in columns])
    return F.when(F.size(parts) == F.size(F.array_compact(parts)), F.to_json(parts))


def wilson_lower(successes: Column, n: Column, z: float = 1.96) -> Column:
    """Lower bound of the Wilson interval of a share, in percent; 0 without trials."""
    p = successes.cast("double") / n
    centre = p + F.lit(z * z) / (2 * n)
    spread = F.lit(z) * F.sqrt(p * (1 - p) / n + F.lit(z * z) / (4 * n * n))
    return F.when(n > 0, (centre - spread) / (1 + F.lit(z * z) / n) * 100).otherwise(0.0)


def shrunk(score: Column, n: Column, k: float = 5.0, to: float = 50.0) -> Column:
    """A score drawn towards ``to`` with the weight of k observations."""
    return (score * n + F.lit(k * to)) / (n + F.lit(k))
