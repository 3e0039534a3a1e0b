"""Rows that Python code makes, as frames: checked against a declared schema, or with the schema they show."""

from __future__ import annotations

import datetime
import decimal
import re
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows that are handed over together.
BATCH = 4_096

_PLAIN: dict[type, tuple[type, ...]] = {
    T.StringType: (str,), T.BooleanType: (bool,), T.BinaryType: (bytes, bytearray), T.DateType: (datetime.date,),
    T.TimestampType: (datetime.datetime,), T.TimestampNTZType: (datetime.datetime,), T.DecimalType: (decimal.Decimal,),
}
_WHOLE: dict[type, int] = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def violation(value: object, kind: T.DataType, nullable: bool = True, place: str = "row") -> str | None:
    """Where and why a Python value is not of a type; None if it is."""
    if value is None:
        return None if nullable else f"{place}: missing"
    if isinstance(kind, T.StructType):
        if isinstance(value, dict):
            unknown = sorted(set(map(str, value)) - set(kind.names))
            if unknown:
                return f"{place}: no such field {unknown[0]}"
            values = [value.get(name) for name in kind.names]
        elif isinstance(value, (tuple, list)):
            if len(value) != len(kind.fields):
                return f"{place}: {len(value)} values for {len(kind.fields)} fields"
            values = list(value)
        else:
            return f"{place}: {type(value).__name__} for {kind.simpleString()}"
        inner = (violation(v, f.dataType, f.nullable, f"{place}.{f.name}") for v, f in zip(values, kind.fields))
        return next(filter(None, inner), None)
    if isinstance(kind, T.ArrayType) and isinstance(value, (list, tuple)):
        return next(filter(None, (violation(v, kind.elementType, kind.containsNull, f"{place}[{i}]") for i, v in enumerate(value))), None)
    if isinstance(kind, T.MapType) and isinstance(value, dict):
        keys = (violation(k, kind.keyType, False, f"{place} key") for k in value)
        values = (violation(v, kind.valueType, kind.valueContainsNull, f"{place}[{k!r}]") for k, v in value.items())
        return next(filter(None, [*keys, *values]), None)
    wrong = f"{place}: {type(value).__name__} for {kind.simpleString()}"
    if type(kind) in _WHOLE:
        if isinstance(value, bool) or not isinstance(value, int):
            return wrong
        limit = 1 << _WHOLE[type(kind)] - 1
        return None if -limit <= value < limit else f"{place}: {value} is too large for {kind.simpleString()}"
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return wrong if isinstance(value, bool) or not isinstance(value, (int, float)) else None
    if isinstance(kind, T.DateType) and isinstance(value, datetime.datetime):
        return wrong
    if isinstance(kind, T.DecimalType) and isinstance(value, decimal.Decimal):
        sign, digits, power = value.as_tuple()
        fits = isinstance(power, int) and -power <= kind.scale and len(digits) + power <= kind.precision - kind.scale
        return None if fits else f"{place}: {value} does not fit {kind.simpleString()}"
    return None if isinstance(value, _PLAIN.get(type(kind), ())) else wrong


def _as_dict(value: object, kind: T.DataType) -> object:
    """A sound value with its rows as dicts, as Arrow takes them."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        values = [value.get(n) for n in kind.names] if isinstance(value, dict) else value
        return {f.name: _as_dict(v, f.dataType) for f, v in zip(kind.fields, values)}
    if isinstance(kind, T.ArrayType):
        return [_as_dict(v, kind.elementType) for v in value]
    if isinstance(kind, T.MapType):
        return [(k, _as_dict(v, kind.valueType)) for k, v in value.items()]
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return float(value)
    return value


def _checked(make: Callable[[dict], Iterable], schema: T.StructType, out: T.StructType, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    arrow = to_arrow_schema(out)
    held: list[dict] = []
    for batch in batches:
        for source in batch.to_pylist():
            for place, row in enumerate(make(source)):
                reason = violation(row, schema)
                good = _as_dict(row, schema) if reason is None and row is not None else None
                if good is None:
                    held.append({"row": None, "place": place, "reason": reason or "row: missing", "source": str(source), "value": repr(row)})
                else:
                    held.append({"row": good, "place": place, "reason": None, "source": None, "value": None})
            if len(held) >= BATCH:
                yield pa.RecordBatch.from_pylist(held, schema=arrow)
                held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=arrow)


def _nullable(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    return T.MapType(kind.keyType, _nullable(kind.valueType)) if isinstance(kind, T.MapType) else kind


def declared_rows(source: DataFrame, make: Callable[[dict], Iterable], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that ``make`` yields for each row of ``source`` (a dict): those of the declared schema, and the others.

    A row is a tuple or a dict; fields that a dict lacks are NULL. Rejected are rows of another
    length, with unknown fields, with values of another type or too large for it, and with a NULL
    where the schema has none: (place, reason, source, value), the place being the row's number
    among those of its source row. Rows are checked where they are made, batch by batch.
    """
    fields = "place long, reason string, source string, value string"
    out = T.StructType([T.StructField("row", _nullable(schema)), *T.StructType.fromDDL(fields).fields])
    rows = source.mapInArrow(partial(_checked, make, schema, out), out)
    good = rows.where("reason IS NULL").select("row.*")
    return good, rows.where("reason IS NOT NULL").select("place", "reason", "source", "value")


_TYPE = re.compile(r"OBJECT<|VARIANT|VOID")


def merged_schema(rows: DataFrame, column: str) -> str:
    """The type that holds all values of a VARIANT column, found in one pass; where types do not agree it is text."""
    shown = rows.agg(F.schema_of_variant_agg(column).alias("s")).first()["s"]
    return _TYPE.sub(lambda m: "STRUCT<" if m.group().startswith("OBJECT") else "STRING", shown or "VOID")


def loose_rows(rows: DataFrame, column: str) -> DataFrame:
    """Rows of differing keys as a table with the columns that any of them has.

    ``column`` is a VARIANT or JSON text, one object for each row. Keys that a row lacks are
    NULL; a key whose values are of types that have no common one becomes text.
    """
    if rows.schema[column].dataType.simpleString() != "variant":
        rows = rows.select(F.try_parse_json(column).alias(column))
    kind = merged_schema(rows, column)
    if not kind.startswith("STRUCT<"):
        raise ValueError(f"rows are not objects but {kind}")
    return rows.select(F.expr(f"CAST(`{column}` AS {kind})").alias("_row")).select("_row.*")
