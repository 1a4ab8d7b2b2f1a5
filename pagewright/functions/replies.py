"""Replies of language models: finding the JSON object and validating it strictly."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def outer_braces(c: Column) -> Column:
    """From the first `{` to the last `}`; empty if there is no such pair."""
    return F.regexp_extract(c, r"(?s)\{.*\}", 0)


def json_part(c: Column) -> Column:
    """The content of the first json fence, else the part within the outermost braces."""
    fenced = F.regexp_extract(c, r"(?s)```json\s*(.*?)\s*```", 1)
    return F.when(c.rlike(r"(?s)```json\s*.*?\s*```"), fenced).otherwise(outer_braces(c))


def _kind(c: Column, path: str) -> Column:
    return F.schema_of_variant(F.variant_get(c, path, "variant"))


def integer_field(c: Column, name: str) -> Column:
    """An integer field of a parsed reply: whole numbers, their texts and booleans; null for anything else."""
    path = f"$.{name}"
    kind, number = _kind(c, path), F.try_variant_get(c, path, "double")
    whole = F.when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)") & (number == F.floor(number)), number.cast("int"))
    text = F.trim(F.try_variant_get(c, path, "string"))
    return F.when(kind == "BOOLEAN", F.try_variant_get(c, path, "boolean").cast("int")).when(kind == "STRING", F.when(text.rlike(r"^[+-]?\d+(\.0*)?$"), text.try_cast("double").cast("int"))).otherwise(whole)


def boolean_field(c: Column, name: str) -> Column:
    """A boolean field: true, false, 0, 1 and the usual words for them; null for anything else."""
    path = f"$.{name}"
    kind, number = _kind(c, path), F.try_variant_get(c, path, "double")
    text = F.lower(F.try_variant_get(c, path, "string"))
    words = F.when(text.isin("true", "t", "yes", "y", "on", "1"), True).when(text.isin("false", "f", "no", "n", "off", "0"), False)
    return F.when(kind == "BOOLEAN", F.try_variant_get(c, path, "boolean")).when(kind == "STRING", words).when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.when(number == 1, True).when(number == 0, False))


def identifiers(c: Column) -> Column:
    """The identifiers of a raw reply; null if the reply is rejected.

    contains_pii must be a boolean but its value has no effect.  A missing list is empty; an explicit null and a list
    with anything but texts reject the reply.
    """
    parsed = F.try_parse_json(json_part(c))
    path = "$.extracted_identifiers"
    kind = _kind(parsed, path)
    missing = kind.isNull() & ~F.coalesce(F.is_variant_null(F.variant_get(parsed, path, "variant")), F.lit(False))
    listed = F.try_variant_get(parsed, path, "array<string>")
    value = F.when(missing, F.array().cast("array<string>")).when(kind.isin("ARRAY<STRING>", "ARRAY<VOID>") & ~F.exists(listed, lambda x: x.isNull()), listed)
    return F.when(boolean_field(parsed, "contains_pii").isNotNull(), value)


def rotation_angle(c: Column) -> Column:
    """The angle of a rotation reply, 0 unless it is a quarter turn; a thinking text is required."""
    parsed = F.try_parse_json(F.regexp_replace(outer_braces(c), r"[\x00-\x1F\x7F]", " "))
    angle = F.when(_kind(parsed, "$.thinking") == "STRING", integer_field(parsed, "rotation_angle"))
    return F.when(angle.isin(0, 90, 180, 270), angle).otherwise(0)


def is_spread(c: Column) -> Column:
    """Whether a composition reply says that a page is a spread; false for any reply that is rejected."""
    parsed = F.try_parse_json(F.regexp_replace(outer_braces(c), r"[\x00-\x1F\x7F]", " "))
    return F.coalesce(F.when(_kind(parsed, "$.thinking") == "STRING", boolean_field(parsed, "is_composite_spread")), F.lit(False))


def _object(raw: str | None) -> dict:
    """The JSON object of a reply with a thinking text; empty where there is none."""
    found = re.search(r"(?s)\{.*\}", raw or "")
    try:
        parsed = json.loads(re.sub(r"[\x00-\x1F\x7F]", " ", found[0])) if found else {}
    except ValueError:
        return {}
    return parsed if isinstance(parsed, dict) and isinstance(parsed.get("thinking"), str) else {}


def angle_of_reply(raw: str | None) -> int:
    """`rotation_angle` for one reply in a task."""
    value = _object(raw).get("rotation_angle")
    if isinstance(value, str):
        value = float(value) if re.fullmatch(r"[+-]?\d+(\.0*)?", value.strip()) else None
    return int(value) if isinstance(value, (int, float)) and value in (0, 90, 180, 270) else 0


def spread_of_reply(raw: str | None) -> bool:
    """`is_spread` for one reply in a task."""
    value = _object(raw).get("is_composite_spread")
    if isinstance(value, str):
        return value.lower() in ("true", "t", "yes", "y", "on", "1")
    return isinstance(value, (bool, int, float)) and value == 1
