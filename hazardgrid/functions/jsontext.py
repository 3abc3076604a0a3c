"""Strict JSON objects as maps, so that an absent key differs from a null value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardgrid.functions.staging import evaluate_once

_OPTIONS = {"allowSingleQuotes": "false"}


def with_object(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Add ``map<string,string>`` of the JSON object in ``text`` as column ``name``.

    Anything but one whole object is null. Nested values are kept as JSON text
    and numbers as their text; of a repeated key the last value counts.

    On its own the reader stops at the object's brace. The message is therefore
    followed by a closing element that holds the message's own digest, which no
    message can contain: only if that is the second element did nothing else
    stand behind the object. The digest is a value: the reader keeps a table of
    all names it meets, which a name of its own per message would fill.
    """
    digest = F.md5(text)
    wrapped = F.from_json(
        F.concat(F.lit("["), text, F.lit(',{"end":"'), digest, F.lit('"}]')), "array<map<string,string>>", _OPTIONS
    )
    elements = F.col("_elements")
    closed = F.get(elements, F.lit(1))["end"].eqNullSafe(F.col("_digest"))
    only_object = F.when((F.size(elements) == 2) & closed, _last_values(F.get(elements, F.lit(0))))
    marked = df.withColumn("_elements", wrapped).withColumn("_digest", digest)
    return evaluate_once(marked, name, only_object).drop("_elements", "_digest")


def _last_values(obj: Column) -> Column:
    """The map with one entry per key, the last one."""
    keys = F.map_keys(obj)
    entries = F.map_entries(obj)
    later = lambda e, i: F.exists(F.slice(keys, i + 2, F.size(keys)), lambda k: k == e["key"])
    single = F.map_from_entries(F.filter(entries, lambda e, i: ~later(e, i)))
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), single).otherwise(obj)


def lacks(obj: Column, key: str) -> Column:
    """Whether an object does not have a key; a key with a null value is there."""
    return ~F.map_contains_key(obj, F.lit(key))


def bigint(obj: Column, key: str) -> Column:
    """A key's value as a whole number, null when it is not one."""
    text = obj[key]
    written_as_double = F.regexp_extract(text, r"^(-?\d+)\.0$", 1)
    return F.coalesce(text.try_cast("bigint"), written_as_double.try_cast("bigint"))
