"""Strict JSON reading and ISO-8601 writing as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark reads some text as JSON that a strict reader refuses; switch that off.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

_ONE_BRACE = r"^[ \t\r\n]*\{[^}]*\}[ \t\r\n]*\z"
_DATE_FIRST = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T]|\s*\z)"


def with_parsed(df: DataFrame, text: Column, schema: T.StructType) -> DataFrame:
    """Add the fields of the JSON object in `text`.

    The parse sits in a generator over a one-element array. As a plain column it
    would be copied into every later filter that uses a parsed field, and each
    copy parses the line again.
    """
    return df.select("*", F.inline(F.array(F.from_json(text, schema, STRICT))))


def once(column: Column, body: Callable[[Column], Column]) -> Column:
    """`body(column)` with a costly column evaluated once, however often it is used."""
    return F.transform(F.array(column), body)[0]


def is_flat(text: Column) -> Column:
    """True if the object in the text holds no other object and no array, and nothing can follow it.

    Its only `}` is the last character, and there is no `[`. `from_json` ignores
    whatever comes after the first value and reads nested values as text, so this
    cheap test is what lets flat records skip `object_keys` and `nested`.
    """
    return text.rlike(_ONE_BRACE) & ~text.contains("[")


def object_keys(text: Column) -> Column:
    """Top-level keys if the text is exactly one valid JSON object, else NULL.

    The text is read as the first element of an array. Text that holds more than
    one value changes the array's length. Text that closes the array itself, as
    in `{..},null],[{}`, fixes the length whatever is put behind it, so two
    different tails cannot both give the expected length.
    """
    head = F.from_json(
        F.concat(F.lit("["), text, F.lit(",null]")), "array<map<string,string>>", STRICT
    )
    longer = F.json_array_length(F.concat(F.lit("["), text, F.lit(",null,null]")))

    def keys(parsed: Column) -> Column:
        alone = (F.size(parsed) == 2) & (~text.contains("]") | (longer == 3))
        return F.when(alone, F.map_keys(parsed[0]))

    return once(head, keys)


def nested(text: Column, schema: T.StructType) -> Column:
    """Whether the object in `text` has an object or an array where `schema` has text.

    Such a value is read as its JSON, which no text column may take. Text that only
    looks like JSON is fine, so the line is read once more as a variant, which knows
    the kinds of its values.
    """
    names = [f.name for f in schema if isinstance(f.dataType, T.StringType)]

    def any_nested(variant: Column) -> Column:
        values = F.array(*[F.try_variant_get(variant, f"$.{name}", "variant") for name in names])
        return F.exists(values, lambda v: F.coalesce(F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)"), F.lit(False)))

    return F.coalesce(once(F.try_parse_json(text), any_nested), F.lit(False))


def instant(text: Column) -> Column:
    """ISO-8601 text as TIMESTAMP, NULL if it is not one.

    The cast alone also takes a bare year, and a bare time that it dates to the
    current day; neither names an instant.
    """
    return F.when(text.rlike(_DATE_FIRST), text).try_cast("timestamp")


def iso_utc(ts: Column) -> Column:
    """TIMESTAMP as ISO-8601 text with offset, without a fraction when it is zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    exact = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(ts == F.date_trunc("SECOND", ts), whole).otherwise(exact)


def json_row(df: DataFrame) -> Column:
    """All columns of `df` as one JSON object: timestamps as ISO text, nulls kept."""
    fields = [
        iso_utc(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.TimestampType)
        else F.col(f.name)
        for f in df.schema
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
