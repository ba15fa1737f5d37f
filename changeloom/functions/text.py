"""Text functions of the workload: reading a model's answer (FN12), flattening (FN13), unix times (FN10), seeded workload values (FN15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def answer(text: Column) -> tuple[Column, Column]:
    """Summary and topics of an answer that holds a JSON object, maybe in fences or prose.

    The summary may be a string or an array of strings (joined by lines); an answer without readable JSON is its own
    summary and has no topics.
    """
    inner = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    body = F.when(inner != "", F.try_parse_json(inner))
    as_text = F.try_variant_get(body, "$.summary", "string")
    parts = F.try_variant_get(body, "$.summary", "array<string>")
    joined = F.when(parts.isNotNull(), F.array_join(F.array_compact(parts), "\n"))
    topics = F.try_variant_get(body, "$.topics", "array<string>")
    return F.when(body.isNull(), text).otherwise(F.coalesce(joined, as_text)), F.when(body.isNotNull(), topics)


def flatten_strings(variant: Column) -> Column:
    """A string, an array of strings, or an array of arrays whose first item counts, as array<string>."""
    one = F.when(F.schema_of_variant(variant) == "STRING", F.array(F.try_variant_get(variant, "$", "string")))
    items = F.try_variant_get(variant, "$", "array<variant>")
    pick = F.transform(items, lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(F.when(F.schema_of_variant(F.try_variant_get(v, "$[0]", "variant")) == "STRING", F.try_variant_get(v, "$[0]", "string"))))
    return F.coalesce(one, F.array_compact(pick))


def _seeded(value: Column, seed: int) -> Column:
    """32 bits that depend on the value and the seed alone, so that a row that is computed again is the same."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), value.cast("string"))), 1, 8), 16, 10).cast("long")


def seeded_uniform(value: Column, low: float, high: float, seed: int) -> Column:
    """FN15: a number between ``low`` and ``high``."""
    return F.lit(low) + F.lit(high - low) * (_seeded(value, seed) / F.lit(4294967296.0))


def seeded_choice(value: Column, options: list[str], seed: int) -> Column:
    """FN15: one of the options."""
    return F.get(F.array(*map(F.lit, options)), (_seeded(value, seed) % len(options)).cast("int"))


def from_unix(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)
