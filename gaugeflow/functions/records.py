"""Records and messages: cast, decode, encode, and lines of text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow import schemas as S
from gaugeflow.functions import sql

JSON_SPACE = " \t\r\n"


def text(column: str) -> Column:
    """Message bytes as text."""
    return F.col(column).cast("string").alias(column)


STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _seal(value: Column) -> Column:
    return F.xxhash64(value).cast("string")


def parsed(value: Column, member: T.DataType) -> Column:
    """Message text read as the only member of an array, followed by a seal.

    Spark's parser stops after the first document of a text. With an array around the
    text and a seal behind it, a second document or trailing text is noticed. A key that is
    repeated counts with its last value.
    """
    around = T.StructType([T.StructField("d", T.ArrayType(member)), T.StructField("e", T.StringType())])
    text = F.concat(F.lit('{"d":['), value, F.lit('],"e":"'), _seal(value), F.lit('"}'))
    return F.from_json(text, around, STRICT)


def is_one(read: Column, value: Column) -> Column:
    """Whether a parsed text is exactly one document."""
    seal = _seal(value)
    # Through an array of one, the parsed text is an operand once and so is parsed once.
    return F.coalesce(
        F.exists(F.array(read), lambda r: (F.size(r["d"]) == 1) & (r["e"] == seal)), F.lit(False)
    )


def only_member(read: Column, value: Column) -> Column:
    """The document of a parsed text; null unless the text is exactly one."""
    return F.when(is_one(read, value), read["d"][0])


def document(value: Column) -> Column:
    """Message text as a document without schema; null if it is not JSON."""
    return F.try_parse_json(value)


def document_field(value: Column, path: str, kind: str) -> Column:
    """One field of a document; null if it is absent or of another kind."""
    return F.try_variant_get(document(value), path, kind)


def is_blank(value: Column) -> Column:
    return value.isNull() | (F.ltrim(value, F.lit(JSON_SPACE)) == "")


def is_object(value: Column) -> Column:
    """Whether JSON text holds an object; only for text that is JSON."""
    return F.ltrim(value, F.lit(JSON_SPACE)).startswith("{")


def time_text(moment: Column) -> Column:
    """A moment as `yyyy-MM-dd HH:mm:ss` in the session time zone."""
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def wall_time_text(moment: Column) -> Column:
    """The same for a timestamp without time zone, whatever the session says."""
    return F.substring(moment.cast("string"), 1, 19)


def group(names: Sequence[str]) -> str:
    """Readings under fixed names, as a struct. SQL text."""
    return f"struct({', '.join(map(sql.name, names))})"


def group_by_name(names: Sequence[str]) -> str:
    """Readings under configured names, as a map without missing readings. SQL text."""
    entries = ", ".join(f"struct({sql.text(n)} AS name, {sql.name(n)} AS reading)" for n in names)
    return f"map_from_entries(filter(array({entries}), e -> e.reading IS NOT NULL))"


def encode(time: Column, topic: Column, categories: str, sensors: str) -> Column:
    """A record as message text; null fields are left out."""
    return F.to_json(
        F.struct(
            time.alias(S.TIME),
            topic.alias(S.TOPIC),
            F.col(S.RESULT),
            F.expr(categories).alias(S.CATEGORY_GROUP),
            F.expr(sensors).alias(S.SENSOR_GROUP),
        )
    )


def key_text(number: Column) -> Column:
    """A sequence number as message key."""
    return number.cast("string")


# The line formats below are fixed values.


def _printed(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit("null"))


def delivery_line() -> Column:
    """Report line of a delivered message."""
    return F.concat(
        F.lit("topic="),
        _printed(F.col("topic")),
        F.lit("  partition="),
        _printed(F.col("partition")),
        F.lit("  offset="),
        _printed(F.col("offset")),
        F.lit(": \n"),
        _printed(F.col("value")),
    )


def consumed_line() -> Column:
    """Console line of a consumed message, with its position."""
    return F.concat(
        F.lit("Consumer: topic = "),
        _printed(F.col("topic")),
        F.lit(", partition = "),
        _printed(F.col("partition")),
        F.lit(", offset = "),
        _printed(F.col("offset")),
        F.lit(", key = "),
        _printed(F.col("key")),
        F.lit(" \n"),
        _printed(F.col("value")),
    )


def archived_line() -> Column:
    """Console line of an archived message: key and value only."""
    return F.concat(
        F.lit("Consumer record: key="),
        _printed(F.col("key")),
        F.lit("\n"),
        _printed(F.col("value")),
    )


def scored_line(features: Column) -> Column:
    """Console line of a scored record; `features` is an array of numbers."""
    return F.concat(
        F.lit("Time: "),
        _printed(F.col(S.TIME)),
        F.lit(", Features: ["),
        F.array_join(features.cast("array<string>"), ","),
        F.lit("], Actual: "),
        _printed(F.col("label")),
        F.lit(", Predicted: "),
        _printed(F.col("prediction")),
        F.lit("  "),
    )
