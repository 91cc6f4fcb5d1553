"""JSON objects as text: reading known fields, and writing objects that keep the others.

Nested objects are handled as the text they had in the line, which costs one pass
of the parser and keeps what is in them to the letter. Turning parsed values back
into text is several times slower than splicing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

# JSON proper only: what is copied from a line into a fact must stay valid.
JSON_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def with_object(lines: DataFrame, fields: str) -> DataFrame:
    """Add ``row``, the ``fields`` of the object in ``value``, or NULL if it is none.

    The text is parsed as the first element of an array whose second one holds the
    text's hash. So it must be one object and nothing more: the parser stops at the end
    of the first complete array, and no text closes the array before a mark it cannot
    know. The row comes out of a generator, on
    purpose: filters on parsed fields cannot be pushed below it, where they would
    parse every line a second time. The outer form, as the inner one adds such a
    filter itself; and the generator only reads a column, as it does not take part
    in code generation.
    """
    value, parsed = F.col("value"), F.col("_parsed")
    marked = F.concat(
        F.lit("["), value, F.lit(',{"_end":'), F.xxhash64(value).cast("string"), F.lit("}]")
    )
    whole = (F.size(parsed) == 2) & (F.get(parsed, 1)["_end"] == F.xxhash64(value))
    return (
        lines.withColumn(
            "_parsed", F.from_json(marked, f"array<struct<{fields},_end:bigint>>", JSON_OPTIONS)
        )
        .withColumn("_rows", F.when(whole, F.slice("_parsed", 1, 1)))
        .select(*lines.columns, F.explode_outer("_rows").alias("_row"))
        .select(*lines.columns, F.col("_row").dropFields("_end").alias("row"))
    )


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used.

    Inside a conditional branch Spark computes repeated expressions repeatedly.
    """
    return F.get(F.transform(F.array(value), use), 0)


def long_of(text: Column) -> Column:
    """A number given as JSON number or text, without its fraction."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def is_object(text: Column) -> Column:
    """Whether the text of a field is that of an object."""
    return F.coalesce(text.startswith("{"), F.lit(False))


def quoted(text: Column) -> Column:
    """Text as a JSON string."""
    return F.to_json(text.cast("variant"))


def member(name: str, text: Column) -> Column:
    """``"name":text``, or NULL if there is no text; ``text`` is JSON already."""
    return F.concat(F.lit(f'"{name}":'), text)


def object_of(*members: Column) -> Column:
    """An object of the members that are not NULL."""
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def other_members(text: Column, left_out: Column) -> Column:
    """The members of an object except some, as text; NULL if there are none.

    ``left_out`` is an array of names. A repeated key inside a nested value is no
    VARIANT in sessions that do not allow it; then values pass as JSON strings.
    """
    typed = F.from_json(text, "map<string,variant>", JSON_OPTIONS)
    plain = F.transform_values(
        F.from_json(text, "map<string,string>", JSON_OPTIONS), lambda _, v: v.cast("variant")
    )
    others = F.to_json(
        F.map_filter(F.coalesce(typed, plain), lambda key, _: ~F.array_contains(left_out, key))
    )
    return once(
        others,
        lambda text: F.nullif(F.substring(text, F.lit(2), F.length(text) - 2), F.lit("")),
    )
