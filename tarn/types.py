"""Declared type names, their families, and parameter values."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal
from typing import Any

from pyspark.sql import types as T

#: Declared name -> Spark type; names are trimmed and lower-cased first.
NAMES: dict[str, T.DataType] = {
    **dict.fromkeys(("string", "text", "varchar", "char", "clob", "json", "uuid", "fts5"), T.StringType()),
    **dict.fromkeys(("integer", "int", "bigint"), T.LongType()),
    **dict.fromkeys(("real", "double", "float", "double precision"), T.DoubleType()),
    **dict.fromkeys(("numeric", "decimal"), T.DecimalType(38, 10)),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    **dict.fromkeys(("datetime", "timestamp"), T.TimestampNTZType()),
    **dict.fromkeys(("blob", "binary"), T.BinaryType()),
}
FAMILIES = {
    T.StringType: "string", T.LongType: "integer", T.IntegerType: "integer", T.ShortType: "integer", T.ByteType: "integer",
    T.DoubleType: "float", T.FloatType: "float", T.DecimalType: "decimal", T.BooleanType: "boolean", T.DateType: "date",
    T.TimestampNTZType: "naive_datetime", T.TimestampType: "utc_datetime", T.BinaryType: "binary", T.ArrayType: "array",
    T.MapType: "map", T.StructType: "map",
}
_SIZED = re.compile(r"(numeric|decimal|varchar|char)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)")


def parse_type(name: str | T.DataType) -> T.DataType:
    """The Spark type of a declared name; sized names (``decimal(12,2)``, ``varchar(40)``) are read too."""
    if isinstance(name, T.DataType):
        return name
    key = name.strip().lower()
    if m := _SIZED.fullmatch(key):
        return T.DecimalType(int(m[2]), int(m[3] or 0)) if m[1] in ("numeric", "decimal") else T.StringType()
    if key not in NAMES:
        raise ValueError(f"unknown type {name!r}")
    return NAMES[key]


def type_family(name: str | T.DataType) -> str:
    if isinstance(name, str) and name.strip().lower() in ("json", "fts5"):
        return {"json": "map", "fts5": "text_search_document"}[name.strip().lower()]
    return FAMILIES[type(parse_type(name))]


def bind(value: Any, target: T.DataType | None = None) -> Any:
    """A parameter as the target column takes it.

    Booleans become 1 and 0 against numbers, numbers booleans against boolean columns; decimals keep their
    scale; ISO text is read for dates and timestamps.  Other values pass through.
    """
    if value is None or target is None:
        return value
    numeric = isinstance(target, T.NumericType)
    if isinstance(value, bool) and numeric:
        return int(value)
    if isinstance(target, T.BooleanType) and isinstance(value, int):
        return bool(value)
    if isinstance(target, T.DecimalType) and isinstance(value, (int, float, str)) and not isinstance(value, bool):
        return Decimal(str(value))
    if isinstance(target, T.DateType) and isinstance(value, str):
        return dt.date.fromisoformat(value)
    if isinstance(target, (T.TimestampNTZType, T.TimestampType)) and isinstance(value, str):
        return dt.datetime.fromisoformat(value)
    return value
