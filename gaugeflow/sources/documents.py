"""Document collections as tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.functions import sql

_QUOTED = re.compile(r"(`(?:[^`]|``)*`)")
# What whole numbers of 64 bits and numbers with a point have in common has up to 20 digits.
_DOUBLE_DIGITS = 20


def scan_collection(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """A collection in any format on the classpath: a store connector, JSON, Parquet.

    Without a schema the source infers one, which for JSON reads all the data
    once more; give a schema wherever it is known, or see `scan_documents`.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def _column_type(seen: str) -> str:
    """The type of columns for what was seen in documents.

    Whole numbers of 64 bits are `bigint` and longer ones decimals; numbers that were written with
    a point or an exponent anywhere are `double`, 3.0 too. What was only ever null becomes text,
    and what had several kinds stays a variant.
    """

    def number(found: re.Match) -> str:
        digits, scale = int(found[1]), int(found[2])
        return "DOUBLE" if scale or digits <= _DOUBLE_DIGITS else f"DECIMAL({min(digits, 38)},0)"

    made = []
    for part in _QUOTED.split(seen):
        if not part.startswith("`"):
            part = re.sub(r"\bOBJECT<", "STRUCT<", part)
            part = re.sub(r"\bVOID\b(?!:)", "STRING", part)
            part = re.sub(r"\bDECIMAL\((\d+),(\d+)\)", number, part)
        made.append(part)
    return "".join(made)


def infer_schema(texts: DataFrame, column: str = "value") -> T.StructType:
    """The schema of all documents in a text column, from one aggregation over them.

    Every document tells its own schema, and schemas are merged two by two wherever rows are: a
    field that is missing somewhere is there, numbers widen, and kinds that have nothing in
    common make a variant. Text that is no JSON object takes no part. Field names are those
    of the documents, in the order of their names; none leaves an empty schema.
    """
    read = F.try_parse_json(F.col(column))
    objects = texts.select(read.alias("d")).where(F.schema_of_variant("d").startswith("OBJECT<"))
    seen = objects.agg(F.schema_of_variant_agg("d").alias("s")).first()["s"]
    if seen is None or not seen.startswith("OBJECT<"):
        return T.StructType([])
    return T.DataType.fromDDL(_column_type(seen))


def _type_text(kind: T.DataType) -> str:
    """A type as SQL text, with every name quoted."""
    if isinstance(kind, T.StructType):
        return f"STRUCT<{', '.join(f'{sql.name(f.name)}: {_type_text(f.dataType)}' for f in kind)}>"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{_type_text(kind.elementType)}>"
    return kind.simpleString()


def document_columns(texts: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Documents of a text column as columns of a schema, with variants where it has them.

    A field whose value does not fit its column is null, as is every field of text that is no object.
    """
    if not schema.fields:
        return texts.select([])
    shape = sql.text(_type_text(schema))
    # Through a generator the text is parsed once, however many fields are read from it.
    read = F.expr(f"try_variant_get(try_parse_json({sql.name(column)}), '$', {shape})")
    once = texts.select(F.explode_outer(F.array(read)).alias("d"))
    return once.select("d.*")


def scan_documents(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A collection of one JSON document per line; without a schema it is inferred over all of them.

    Blank lines are no documents.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    return document_columns(lines, infer_schema(lines) if schema is None else schema)
