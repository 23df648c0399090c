"""JSON message expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def payload_text(value: Column) -> Column:
    """Payload as text; bytes that are not UTF-8 become NULL."""
    return F.try_validate_utf8(value.cast("string"))


def json_object(text: Column) -> Column:
    """Top-level fields as map<string,string>, or NULL unless the whole text is one JSON object.

    The text is wrapped in an array, because on its own the parser would stop
    after the first object and let trailing garbage pass. A text that itself
    holds a ``]`` could close that array early, so it has to parse as the value
    of an object as well.
    """
    strict = {"allowSingleQuotes": "false"}
    in_array = F.concat(F.lit("["), text, F.lit("]"))
    in_object = F.concat(F.lit('{"v":'), text, F.lit("}"))
    is_one_value = ~F.contains(text, F.lit("]")) | (
        F.size(F.from_json(in_object, "map<string,string>", strict)) == 1
    )
    parsed = F.from_json(in_array, "array<map<string,string>>", strict)
    # Bound to a lambda variable, so that the text is parsed once.
    single = F.transform(
        F.array(parsed), lambda p: F.when((F.size(p) == 1) & is_one_value, F.get(p, F.lit(0)))
    )
    return single[0]


def body(text: Column) -> Column:
    """The message as a VARIANT, with whatever fields it has; NULL if it is no JSON or repeats a key."""
    return F.try_parse_json(text)


def is_json_value(text: Column) -> Column:
    """True when the whole text is one JSON value of any kind."""
    wrapped = F.concat(F.lit("["), text, F.lit("]"))
    return F.coalesce(F.json_array_length(wrapped) == 1, F.lit(False))


def to_message(*columns: Column) -> Column:
    """JSON text of the given columns, keys in the given order, NULLs kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
