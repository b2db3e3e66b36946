"""Declared output tables over inputs whose columns may be missing or mistyped.

A ``Record`` is anything with named fields: a DataFrame, a struct column, or a
map column.  A ``Field`` names an input field, how to read it and what to call
it.  ``project`` turns a list of fields into one select.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.functions import dates, domains, numbers, text
from hearthline.functions.names import snake_case


class Record:
    """Uniform access to the fields of a frame, struct or map."""

    def __init__(self, types: dict[str, T.DataType] | None, at: Callable[[str], Column]):
        self._types = types
        self._at = at

    @classmethod
    def of(cls, df: DataFrame) -> Record:
        return cls({f.name: f.dataType for f in df.schema.fields}, lambda n: F.col(f"`{n}`"))

    @classmethod
    def inside(cls, value: Column, kind: T.DataType) -> Record | None:
        """Fields of a struct or string map; None for types without fields."""
        if isinstance(kind, T.StructType):
            return cls({f.name: f.dataType for f in kind.fields}, value.getField)
        if isinstance(kind, T.MapType):
            return cls(None, value.getItem)
        return None

    def has(self, name: str) -> bool:
        return self._types is None or name in self._types

    def kind(self, name: str) -> T.DataType:
        return T.StringType() if self._types is None else self._types[name]

    def get(self, name: str) -> Column:
        return self._at(name)

    def nested(self, name: str) -> Record | None:
        return Record.inside(self.get(name), self.kind(name)) if self.has(name) else None


READERS: dict[str, tuple[Callable[[Column], Column], str]] = {
    "text": (lambda c: c.cast("string"), "string"),
    "clean": (text.clean_string, "string"),
    "int": (numbers.safe_int, "int"),
    "double": (numbers.safe_double, "double"),
    "money": (lambda c: numbers.safe_decimal(c, numbers.MONEY), numbers.MONEY),
    "rate": (lambda c: numbers.safe_decimal(c, numbers.RATE), numbers.RATE),
    "date": (lambda c: c.try_cast("date"), "date"),
    "timestamp": (lambda c: c.try_cast("timestamp"), "timestamp"),
    "date_key": (lambda c: dates.date_key(c.try_cast("date")), "int"),
    "year": (lambda c: F.year(c.try_cast("date")), "int"),
    "month": (lambda c: F.month(c.try_cast("date")), "int"),
    "bool": (domains.safe_bool, "boolean"),
    "settled": (domains.settled_status, "string"),
    "delinquency": (domains.delinquency_bucket, "string"),
    "ssn": (text.mask_ssn, "string"),
}


def safe_col(record: Record, name: str, kind: str = "text") -> Column:
    """The field read as ``kind``, or a typed NULL when the input lacks it."""
    read, sql_type = READERS[kind]
    return read(record.get(name)) if record.has(name) else F.lit(None).cast(sql_type)


def first_existing(record: Record, *names: str, ignore_case: bool = False) -> Column:
    """The first candidate that exists, as text; NULL when none does."""
    known = {}
    if record._types is not None and ignore_case:
        known = {n.lower(): n for n in record._types}
    for name in names:
        actual = known.get(name.lower(), name)
        if record.has(actual):
            return record.get(actual).cast("string")
    return F.lit(None).cast("string")


def coalesce_spellings(record: Record, *names: str) -> Column:
    """First non-NULL value among the spellings that exist."""
    present = [record.get(n).cast("string") for n in names if record.has(n)]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def resolve_fk(record: Record, base: str) -> Column:
    """Key of a reference kept as ``{base}Id``, as a struct with an id, or as a bare value."""
    if record.has(f"{base}Id"):
        direct = record.get(f"{base}Id").cast("string")
        # A map knows its fields only at run time, so both spellings are tried there.
        return F.coalesce(direct, record.get(base).cast("string")) if record._types is None else direct
    if not record.has(base):
        return F.lit(None).cast("string")
    target = record.nested(base)
    for name in ("_id", "id"):
        if target is not None and isinstance(record.kind(base), T.StructType) and target.has(name):
            return target.get(name).cast("string")
    return record.get(base).cast("string")


def first_of_list_fk(record: Record, singular: str, plural: str) -> Column:
    """The single key, else the first of a list kept as array or as JSON-like text."""
    options = [record.get(singular).cast("string")] if record.has(singular) else []
    if record.has(plural):
        options.append(_head(record.get(plural), record.kind(plural)))
    return F.coalesce(*options) if options else F.lit(None).cast("string")


def _head(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text.first_listed(value)
    if not isinstance(kind, T.ArrayType):
        return value.cast("string")
    head = F.get(value, F.lit(0))
    element = Record.inside(head, kind.elementType)
    if element is not None and element.has("_id"):
        return element.get("_id").cast("string")
    return head.cast("string")


@dataclass(frozen=True)
class Field:
    """One output column: where it is read, how, and its name (snake case by default)."""

    source: str
    kind: str = "text"
    name: str | None = None

    @property
    def alias(self) -> str:
        return self.name or snake_case(self.source)

    def read(self, record: Record) -> Column:
        if self.kind == "ref":
            return resolve_fk(record, self.source)
        return safe_col(record, self.source, self.kind)


def fields(kind: str, names: str) -> list[Field]:
    """Fields of one kind; ``raw:alias`` where the name is not the snake-cased one."""
    made = []
    for entry in names.split():
        source, _, alias = entry.partition(":")
        made.append(Field(source, kind, alias or None))
    return made


def columns(record: Record, spec: Iterable[Field]) -> list[Column]:
    return [f.read(record).alias(f.alias) for f in spec]


def project(df: DataFrame, spec: Iterable[Field], *extra: Column) -> DataFrame:
    """One select that yields exactly the declared columns, whatever the input has."""
    return df.select(*columns(Record.of(df), spec), *extra)


def empty_table(spark: SparkSession, spec: Iterable[Field], *extra: Column) -> DataFrame:
    """A table with the declared columns and no rows."""
    return project(spark.range(0), spec, *extra)


def empty_raw(spark: SparkSession, spec: Iterable[Field]) -> DataFrame:
    """The input such a list of fields reads, without rows."""
    nothing = Record({}, F.col)
    return spark.range(0).select(*{f.source: f.read(nothing).alias(f.source) for f in spec}.values())


def drop_ancient_dates(df: DataFrame) -> DataFrame:
    """NULL out dates and timestamps before 1582-10-15 in every such column."""
    old = {
        f.name: dates.safe_day(F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    }
    return df.withColumns(old) if old else df


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column missing on one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
