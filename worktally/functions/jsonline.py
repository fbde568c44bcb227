"""Lines of JSON read with a fixed set of fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def listed_object(raw: Column, fields: list[str]) -> Column:
    """The line read as the only element of an array, so that text after its object is an error; every field as text.

    The result is null or has another size than one where the line isn't one JSON object.
    """
    return _listed(raw, "array<struct<" + ",".join(f"`{f}`:string" for f in fields) + ">>")


def is_object(raw: Column) -> Column:
    """Whether a text is one JSON object and nothing else."""
    listed = _listed(raw, "array<map<string,string>>")
    return F.coalesce((F.size(listed) == 1) & listed[0].isNotNull(), F.lit(False))


def _listed(raw: Column, schema: str) -> Column:
    options = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "mode": "PERMISSIVE"}
    trimmed = F.regexp_replace(raw, r"^[\s\x{FEFF}]+|\s+$", "")
    whole = trimmed.startswith("{") & trimmed.endswith("}")
    return F.when(whole, F.from_json(F.concat(F.lit("["), trimmed, F.lit("]")), schema, options))
