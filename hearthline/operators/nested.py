"""Child rows out of arrays kept as JSON text, array of structs or array of maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.functions.text import blank_to_null
from hearthline.schema import Record

MAPS = T.ArrayType(T.MapType(T.StringType(), T.StringType()))


def as_array(value: Column, kind: T.DataType) -> tuple[Column, T.DataType] | None:
    """The value as an array of structs or maps with its element type.

    Blank text is an empty array and unreadable JSON is NULL; other types give
    None, which callers turn into an empty result.
    """
    if isinstance(kind, T.StringType):
        parsed = F.from_json(value, MAPS)
        empty = F.array().cast(MAPS)
        return F.when(blank_to_null(value).isNull(), empty).otherwise(parsed), MAPS.elementType
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.MapType)):
        return value, kind.elementType
    return None


def explode_children(
    df: DataFrame, column: str, keep: Sequence[Column], position: str = "position"
) -> tuple[DataFrame, Record] | None:
    """One row per element with its 0-based position, and access to its fields.

    None when the column is missing or is not a list of documents.
    """
    record = Record.of(df)
    found = as_array(record.get(column), record.kind(column)) if record.has(column) else None
    if found is None:
        return None
    array, element = found
    rows = df.select(*keep, F.posexplode(array).alias(position, "_element"))
    return rows.filter("_element is not null"), Record.inside(F.col("_element"), element)


def explode_texts(df: DataFrame, column: str, keep: Sequence[Column], position: str, value: str) -> DataFrame:
    """One row per text of an array column, or of a JSON array kept as text."""
    kind = df.schema[column].dataType
    source = F.col(column)
    if isinstance(kind, T.StringType):
        source = F.from_json(blank_to_null(source), T.ArrayType(T.StringType()))
    rows = df.select(*keep, F.posexplode(source).alias(position, value))
    return rows.filter(F.col(value).isNotNull())
