"""JSON inside text, and nested status objects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_json(c: Column, schema: str) -> Column:
    """The object between the first and the last brace of a text, parsed; null if it does not parse."""
    return F.from_json(F.regexp_extract(c, r"(?s)(\{.*\})", 1), schema, {"mode": "PERMISSIVE"})


def fenced_json(c: Column, schema: str) -> Column:
    """A text that is JSON, or the JSON of its first code fence."""
    inner = F.regexp_extract(c, r"(?s)```(?:json)?\s*(.*?)```", 1)
    return F.from_json(F.when(F.trim(c).startswith("{"), F.trim(c)).otherwise(inner), schema, {"mode": "PERMISSIVE"})


def status_object(fields: dict[str, Column]) -> Column:
    """A JSON object of the fields that are not null."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]), {"ignoreNullFields": "true"})


def serialised_cell(c: Column) -> Column:
    """struct(text, as_json) of a cell of any type: scalars keep their printed form, times are ISO; only nested and
    binary values fall back to JSON, flagged. Null stays null."""
    kind = F.typeof(c)
    nested = kind.rlike("^(array|struct|map|binary|variant)")
    whole = F.to_json(F.struct(c.alias("v")))
    inner = F.substring(whole, F.lit(6), F.length(whole) - 6)  # {"v": ... }
    printed = F.when(kind.startswith("timestamp"), F.replace(c.cast("string"), F.lit(" "), F.lit("T"))).otherwise(c.cast("string"))
    return F.struct(F.when(c.isNull(), None).when(nested, inner).otherwise(printed).alias("text"), (nested & c.isNotNull()).alias("as_json"))


def name_confidence(name: Column, domain: Column, least: int = 5, common: tuple[str, ...] = ("board", "council", "department", "national", "ireland", "authority", "office")) -> Column:
    """`high` if a telling word of the name stands in the domain, else `low`."""
    words = F.filter(F.split(F.lower(name), "[^a-z0-9]+"), lambda w: (F.length(w) >= least) & ~w.isin(*common))
    return F.when(F.exists(words, lambda w: F.contains(F.lower(domain), w)), "high").otherwise("low")


def first_of(*candidates: Column) -> Column:
    """Distinct non-null candidates in their order of preference."""
    return F.array_distinct(F.array_compact(F.array(*candidates)))
