"""JSON text: safe reading, presence of keys, merging."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(text: Column) -> Column:
    """The value, null where the text isn't JSON."""
    return F.try_parse_json(text)


def has_key(text: Column, key: str) -> Column:
    """Whether the object has the key with a value other than null; false for bad JSON."""
    return F.get_json_object(text, f"$.{key}").isNotNull()


def merged(old: Column, new: Column) -> Column:
    """Two JSON objects as one, keys of ``new`` winning unless null; types of values stay. Bad JSON counts as {}.

    Keys that the new object sets are taken out of the old one first, so that no setting about repeated keys matters.
    """
    empty = F.from_json(F.lit("{}"), "map<string,variant>")
    as_map = [F.coalesce(F.from_json(c, "map<string,variant>"), empty) for c in (old, new)]
    news = F.map_filter(as_map[1], lambda _, v: v.isNotNull() & (F.schema_of_variant(v) != "VOID"))
    kept = F.map_filter(as_map[0], lambda k, _: ~F.array_contains(F.map_keys(news), k))
    return F.to_json(F.map_concat(kept, news))


def salvaged(text: Column, opening: str = "[", closing: str = "]") -> Column:
    """The largest part of a text from the first opening to the last closing bracket, as JSON text; null where that isn't JSON."""
    found = F.regexp_extract(text, rf"(?s)(\{opening}.*\{closing})", 1)
    return F.when(F.try_parse_json(found).isNotNull() & (found != ""), found)
