"""Messages to records: decode once, number the levels, set bad messages aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow import schemas as S
from gaugeflow.functions import levels, records, sql
from gaugeflow.sources.endpoint_config import EndpointConfig

OK, BLANK, MALFORMED, NOT_OBJECT, BAD_FIELD = "ok", "blank", "malformed", "not_object", "bad_field"
POSITION = ["topic", "partition", "offset"]


def cast_envelope(messages: DataFrame) -> DataFrame:
    """Key and value as text; the position stays as it is."""
    return messages.select(records.text("key"), records.text("value"), *POSITION)


def decode_values(
    messages: DataFrame, schema: T.StructType = S.NAMED_RECORD
) -> DataFrame:
    """Add the record as column `data`.

    Catalyst moves a filter on decoded fields below a plain projection, and then
    decodes the text once more for every field the filter reads. It does not
    move filters below a generator, so the record passes through one.
    """
    read = records.parsed(F.col("value"), schema)
    once = messages.select("*", F.explode_outer(F.array(read)).alias("_read"))
    data = records.only_member(F.col("_read"), F.col("value"))
    return once.select(*messages.columns, data.alias("data"))


def extract(decoded: DataFrame) -> DataFrame:
    """The five top fields of the record, two of them groups."""
    fields = [S.TIME, S.TOPIC, S.CATEGORY_GROUP, S.SENSOR_GROUP, S.RESULT]
    return decoded.select(*[F.col(f"data.{name}") for name in fields])


def flatten(rows: DataFrame, *kept: str, record: str | None = None) -> DataFrame:
    """Kept columns, time, label, and every member of both groups as columns.

    The record lies at the top, or in the struct column of the given name.
    """
    at = f"{record}." if record else ""
    return rows.select(
        *kept,
        f"{at}{S.TIME}",
        f"{at}{S.RESULT}",
        f"{at}{S.CATEGORY_GROUP}.*",
        f"{at}{S.SENSOR_GROUP}.*",
    )


def rename_label(flat: DataFrame) -> DataFrame:
    return flat.withColumnRenamed(S.RESULT, "label")


def encode_levels(flat: DataFrame, config: EndpointConfig) -> DataFrame:
    """Level names as numbers; a name that is not configured becomes null."""
    codes = {c.name: levels.level_code(sql.name(c.name), c.levels) for c in config.categories}
    return flat.selectExpr(
        *[
            sql.named(codes[column], column) if column in codes else sql.name(column)
            for column in flat.columns
        ]
    )


def _complete() -> Column:
    """Whether a record can be scored: label 0 or 1, no feature null, every reading finite."""
    present = [f"{name} IS NOT NULL" for name in ("label", *S.FEATURES)]
    # NaN is the largest number to Spark, so one comparison covers it as well.
    finite = [f"abs({name}) < double('Infinity')" for name in S.SENSORS]
    return F.expr(" AND ".join([*present, "label IN (0, 1)", *finite]))


def json_status(value: Column) -> Column:
    """Why text is not one document; null if it is. The same rule as for records."""
    one = records.is_one(records.parsed(value, T.StringType()), value)
    return (
        F.when(records.is_blank(value), BLANK)
        .when(~one, MALFORMED)
        .when(~records.is_object(value), NOT_OBJECT)
    )


def decode_messages(messages: DataFrame, config: EndpointConfig) -> DataFrame:
    """Every message with its position, its record as columns, and a status.

    No message is lost: what cannot be scored has a status other than `ok` and
    keeps its text. Good messages are parsed once; only the others are looked
    at again to say what is wrong.
    """
    decoded = decode_values(cast_envelope(messages))
    flat = flatten(decoded, "key", *POSITION, "value", record="data")
    coded = encode_levels(rename_label(flat), config)
    status = F.when(_complete(), OK).otherwise(
        F.coalesce(json_status(F.col("value")), F.lit(BAD_FIELD))
    )
    return coded.withColumn("status", status)


def accepted(decoded: DataFrame) -> DataFrame:
    """Messages with status `ok`."""
    return decoded.where(_complete()).drop("status", "value")


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.where(~F.coalesce(_complete(), F.lit(False))).select("key", *POSITION, "status", "value")


def archive_rows(messages: DataFrame) -> DataFrame:
    """Messages as archived: identity, key, document text, and a status.

    The identity is the place in the topic. Keys start again with every run of
    a generator and identify nothing.
    """
    text = cast_envelope(messages)
    return text.select(
        F.concat_ws("-", *POSITION).alias("_id"),
        "key",
        *POSITION,
        F.coalesce(json_status(F.col("value")), F.lit(OK)).alias("status"),
        "value",
    )


def archive_schema() -> T.StructType:
    """The columns of archived messages."""
    kinds = {"partition": T.IntegerType(), "offset": T.LongType()}
    names = ["_id", "key", *POSITION, "status", "value"]
    return T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names])


def document_rows(messages: DataFrame) -> DataFrame:
    """Messages as nested documents for a store: identity, place, status, and the record.

    The status is that of archiving. The fields of the record lie at the top, its two groups
    nested, and are null where the text is no document; only then the text is kept as well.
    """
    decoded = decode_values(cast_envelope(messages))
    status = F.when(F.col("data").isNotNull(), OK).otherwise(
        F.coalesce(json_status(F.col("value")), F.lit(OK))
    )
    fields = [F.col(f"data.{name}").alias(name) for name in S.NAMED_RECORD.fieldNames()]
    return decoded.select(
        F.concat_ws("-", *POSITION).alias("_id"),
        "key",
        # In a group of its own: the record has a field `Topic`, too.
        F.struct(*POSITION).alias("source"),
        status.alias("status"),
        "value",
        *fields,
    ).withColumn("value", F.when(F.col("status") != OK, F.col("value")))


def usable_documents(documents: DataFrame, config: EndpointConfig) -> DataFrame:
    """Nested documents as complete rows of numbers, with their identity."""
    flat = rename_label(flatten(documents, "_id"))
    return encode_levels(flat, config).where(_complete())
