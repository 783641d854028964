"""Judge replies: fences, JSON and lenient integers, on Spark's variant type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brevita.functions.text import strip

FENCE = "```"


def unfenced(raw: Column) -> Column:
    """Drop a leading fence line whole, then the whole last line if it ends in a fence."""
    reply = strip(raw)
    body = F.regexp_replace(reply, r"^[^\n]*(\n|\z)", "")
    body = F.when(F.endswith(body, F.lit(FENCE)), F.regexp_replace(body, r"\n[^\n]*\z", "")).otherwise(body)
    return F.when(F.startswith(reply, F.lit(FENCE)), body).otherwise(reply)


def object_variant(text: Column) -> Column:
    """The text as a JSON object, or null unless it is exactly one object.

    Spark's parser ignores whatever follows a complete value. The text is therefore put into an
    array in front of its own digest: if the text closes early, the digest is not at index 1.
    ``NaN`` and ``Infinity``, which are no JSON, come out as null.
    """
    seal = F.md5(text)
    array = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), seal, F.lit('"]')))
    first = F.try_variant_get(array, "$[0]", "variant")
    whole = (
        F.schema_of_variant(first).startswith("OBJECT")
        & (F.try_variant_get(array, "$[1]", "string") == seal)
        & F.try_variant_get(array, "$[2]", "variant").isNull()
    )
    return F.when(whole, first)


def lenient_int(obj: Column, key: str, missing: int | None = 0) -> Column:
    """Integer value of ``key``: numbers are truncated, numeric strings and booleans accepted.

    A missing key (or no object at all) gives ``missing``. JSON null, other strings, arrays, objects and numbers
    beyond 64 bits give null.
    """
    path = f"$.{key}"
    value = F.try_variant_get(obj, path, "variant")
    kind = F.schema_of_variant(value)
    digits = F.regexp_replace(strip(F.try_variant_get(obj, path, "string")), r"(?<=\d)_(?=\d)", "")
    from_string = F.when(digits.rlike(r"^[+-]?[0-9]+\z"), digits.try_cast("bigint"))
    from_boolean = F.try_variant_get(obj, path, "boolean").cast("bigint")
    return (
        F.when(value.isNull(), F.lit(missing).cast("bigint"))
        .when(kind == "STRING", from_string)
        .when(kind == "BOOLEAN", from_boolean)
        .when(kind == "BIGINT", F.try_variant_get(obj, path, "bigint"))
        .when(
            kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"),
            F.try_variant_get(obj, path, "double").try_cast("bigint"),
        )
    )
