"""JSON texts parsed as strictly as a JSON parser would, with the built-in ``from_json``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_STRICT = {"allowSingleQuotes": "false"}
_END = "␞end"
# Values that Python treats as false, as their JSON text (strings without quotes).
_FALSY = ("", "{}", "[]", "0", "0.0", "-0.0", "false")


def strict_value(text: Column) -> Column:
    """The text of the one JSON value in ``text``, compact; null if it is ``null`` or not valid JSON.

    ``from_json`` alone ignores whatever follows the value. Here the value becomes the first element of
    an array that must then end in a known second element, so nothing can follow or escape it.
    """
    wrapped = F.concat(F.lit("["), text, F.lit(f',"{_END}"]'))
    # Read through a one-element array, so that the parse is evaluated once.
    pair = F.transform(
        F.array(F.from_json(wrapped, "array<string>", _STRICT)),
        lambda p: F.when((F.size(p) == 2) & (F.element_at(p, 2) == _END), F.element_at(p, 1)),
    )
    return F.element_at(pair, 1)


def text_array(value: Column) -> Column:
    """Elements of a JSON array as texts; null if it is no array."""
    return F.from_json(value, "array<string>", _STRICT)


def text_map(value: Column) -> Column:
    """Members of a JSON object as texts in their order; null if it is no object.

    ``from_json`` keeps every occurrence of a repeated key; here a key stays at its first place and has
    its last value.
    """

    def last_wins(members: Column) -> Column:
        keys = F.array_distinct(F.map_keys(members))
        last = lambda key: F.element_at(F.filter(F.map_entries(members), lambda e: e["key"] == key), -1)["value"]
        return F.when(F.size(keys) == F.size(members), members).otherwise(
            F.map_from_arrays(keys, F.transform(keys, last))
        )

    return F.element_at(F.transform(F.array(F.from_json(value, "map<string,string>", _STRICT)), last_wins), 1)


def truthy(value: Column) -> Column:
    return value.isNotNull() & ~value.isin(*_FALSY)


def starts_with(text: Column, mark: str) -> Column:
    return F.btrim(text, F.lit(" \t\n\r")).startswith(mark)
