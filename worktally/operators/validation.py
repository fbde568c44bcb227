"""Checks of JSON texts: keys, list lengths and forbidden words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worktally.functions.jsonline import is_object


def validate_json(df: DataFrame, text: str, required: list[str], allowed: list[str] | None = None, lists: dict[str, tuple[int, int]] | None = None, forbidden: list[str] | None = None) -> DataFrame:
    """``df`` with problems: an array of what is wrong with each text, empty if nothing is.

    A text that isn't a JSON object has the one problem ``not an object``. ``lists`` gives the least
    and the largest length of a list; ``forbidden`` words count in any case.
    """
    keys = F.json_object_keys(F.col(text))
    readable = is_object(F.col(text)) & keys.isNotNull()
    found = [F.when(~F.array_contains(keys, k), F.lit(f"missing {k}")) for k in required]
    if allowed is not None:
        known = F.array(*[F.lit(k) for k in dict.fromkeys([*required, *allowed])])
        found.append(F.when(F.size(F.array_except(keys, known)) > 0, F.lit("unknown key")))
    for k, (least, most) in (lists or {}).items():
        n = F.json_array_length(F.get_json_object(F.col(text), f"$.{k}"))
        found.append(F.when(F.array_contains(keys, k) & (n.isNull() | (n < least) | (n > most)), F.lit(f"length of {k}")))
    for word in forbidden or []:
        found.append(F.when(F.contains(F.lower(F.col(text)), F.lit(word.lower())), F.lit(f"contains {word}")))
    problems = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
    return df.withColumn("problems", F.when(F.coalesce(readable, F.lit(False)), problems).otherwise(F.array(F.lit("not an object"))))
