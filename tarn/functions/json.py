"""JSON kept as text, read through Spark's variant type.  Invalid JSON is NULL everywhere."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import unsupported

SEGMENT = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
CASTS = {
    "integer": "bigint", "decimal": "decimal(38,10)", "float": "double", "boolean": "int",
    "date": "string", "datetime": "string", "utc_datetime": "string",
}


def parse_path(path: str | list | tuple | None) -> list[str | int]:
    """Segments of ``$.a.b[0]``, ``a.b`` or a list of names and indexes; ``$`` is the root."""
    if path is None:
        return []
    if isinstance(path, str):
        text = path.removeprefix("$")
        path = [int(s) if s.isdigit() else s for s in re.split(r"[.\[\]]", text) if s]
    for s in path:
        if isinstance(s, bool) or isinstance(s, int) and s < 0 or not isinstance(s, int) and not (isinstance(s, str) and SEGMENT.fullmatch(s)):
            raise ValueError(f"invalid JSON path segment {s!r}")
    return list(path)


def render_path(path: str | list | tuple | None) -> str:
    return "$" + "".join(f"[{s}]" if isinstance(s, int) else f".{s}" for s in parse_path(path))


def variant(column: Column) -> Column:
    return F.try_parse_json(column)


def at(column: Column, path) -> Column:
    return F.try_variant_get(variant(column), render_path(path), "variant")


def extract(column: Column, path, cast: str | None = None) -> Column:
    """The value at a path: text, or the type named by ``cast``."""
    if cast is None:
        return extract_text(column, path)
    if cast not in CASTS:
        raise ValueError(f"unsupported JSON cast {cast!r}")
    return F.try_variant_get(variant(column), render_path(path), CASTS[cast])


def extract_text(column: Column, path) -> Column:
    return F.get_json_object(column, render_path(path))


def kind(value: Column) -> Column:
    """The schema of a variant, e.g. BIGINT, DECIMAL(2,1), STRING, VOID, ARRAY<..>, OBJECT<..>."""
    return F.schema_of_variant(value)


def type_of(column: Column, path=None) -> Column:
    """null, true, false, integer, real, text, array or object; NULL where nothing is."""

    def named(pair: Column) -> Column:
        k = pair["k"]
        return (
            F.when(k.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "integer")
            .when(k.startswith("DECIMAL") | k.isin("DOUBLE", "FLOAT"), "real")
            .when(k == "BOOLEAN", pair["t"])
            .when(k == "STRING", "text")
            .when(k == "VOID", "null")
            .when(k.startswith("ARRAY"), "array")
            .when(k.startswith("OBJECT"), "object")
        )

    return _once(_once(at(column, path), lambda v: F.struct(kind(v).alias("k"), F.try_variant_get(v, "$", "string").alias("t"))), named)


def _once(value: Column, then) -> Column:
    """``then`` of a value that is computed once however often ``then`` uses it."""
    return F.transform(F.array(value), then)[0]


def same(value: Column, wanted: Any) -> Column:
    """Whether a variant is a scalar of this type and value (``None`` never matches, as in SQL)."""
    k = kind(value)
    if wanted is None:
        return F.lit(None).cast("boolean")
    if isinstance(wanted, bool):  # true is stored as 1 as well as true
        as_bool = F.when(k == "BOOLEAN", F.try_variant_get(value, "$", "int") == int(wanted))
        return as_bool.when(k.isin("BIGINT", "DOUBLE") | k.startswith("DECIMAL"), F.try_variant_get(value, "$", "double") == float(wanted)).when(k.isNotNull(), False)
    if isinstance(wanted, int):
        number = k.isin("BIGINT", "DOUBLE") | k.startswith("DECIMAL")
        return F.when(k == "BIGINT", F.try_variant_get(value, "$", "bigint") == wanted).when(number, F.try_variant_get(value, "$", "double") == float(wanted)).when(k == "BOOLEAN", F.try_variant_get(value, "$", "int") == wanted).when(k.isNotNull(), False)
    if isinstance(wanted, float):
        number = k.isin("BIGINT", "DOUBLE") | k.startswith("DECIMAL")
        return F.when(number, F.try_variant_get(value, "$", "double") == wanted).when(k.isNotNull(), False)
    text = wanted if isinstance(wanted, str) else json.dumps(wanted, separators=(",", ":"))
    return F.when(k == "STRING", F.try_variant_get(value, "$", "string") == text).when(k.isNotNull(), False)


def _leaves(wanted: Mapping, before: tuple = ()) -> list[tuple[tuple, Any]]:
    out = []
    for key, v in wanted.items():
        path = (*before, str(key))
        if isinstance(v, Mapping):
            out += _leaves(v, path)
        elif isinstance(v, (list, tuple)):
            raise ValueError("containment of nested lists is not supported")
        else:
            out.append((path, v))
    return out


def contains(column: Column, wanted: Any) -> Column:
    """Whether the object holds all these keys and values, nested ones too; an empty object is held by all."""
    if not isinstance(wanted, Mapping):
        raise unsupported("json_contains", "containment takes an object", value=wanted)
    tests = [same(at(column, list(path)), v) for path, v in _leaves(wanted)]
    return reduce(and_, tests) if tests else F.lit(True)


def exists(column: Column, path) -> Column:
    """Whether something is at the path; a JSON null is something."""
    return at(column, path).isNotNull()


def elements(column: Column, path=None) -> Column:
    """The array at a path as an array of variants, NULL if it is none."""
    return F.try_variant_get(variant(column), render_path(path), "array<variant>")


def _is(element: Column, wanted: Any) -> Column:
    return F.coalesce(same(element, wanted), F.lit(False))


def array_contains(column: Column, wanted: Any, path=None) -> Column:
    return array_contains_any(column, [wanted], path)


def array_contains_any(column: Column, wanted: list, path=None) -> Column:
    """One pass over the elements, which are parsed once."""
    if not wanted:
        return F.lit(False)
    return F.coalesce(F.exists(elements(column, path), lambda e: reduce(or_, [_is(e, w) for w in wanted])), F.lit(False))


def array_contains_all(column: Column, wanted: list, path=None) -> Column:
    """One pass over the elements marks which values were met."""
    if not wanted:
        return F.lit(True)
    start = F.array(*(F.lit(False) for _ in wanted))
    met = F.aggregate(elements(column, path), start, lambda seen, e: F.array(*(seen[i] | _is(e, w) for i, w in enumerate(wanted))))
    return F.coalesce(F.forall(met, lambda x: x), F.lit(False))


def array_length(column: Column, path=None) -> Column:
    """Elements of the array at a path: 0 for another JSON value, NULL where nothing is."""
    size = lambda v: F.when(v.isNotNull(), F.coalesce(F.size(F.try_variant_get(v, "$", "array<variant>")).cast("bigint"), F.lit(0).cast("bigint")))
    return _once(at(column, path), size)


def build_object(pairs: Mapping[str, Column]) -> Column:
    """Text of an object; NULL values are kept as null."""
    return F.to_json(F.named_struct(*(x for k, v in pairs.items() for x in (F.lit(k), v))), {"ignoreNullFields": "false"})


def empty_array() -> Column:
    return F.lit("[]")


OPERATIONS = {
    "json_extract": lambda c, path=None, cast=None, **_: extract(c, path, cast),
    "json_extract_text": lambda c, path=None, **_: extract_text(c, path),
    "json_contains": lambda c, value=None, **_: contains(c, value),
    "json_exists": lambda c, path=None, **_: exists(c, path),
    "json_path_exists": lambda c, path=None, **_: exists(c, path),
    "json_typeof": lambda c, path=None, **_: type_of(c, path),
    "json_array_length": lambda c, path=None, **_: array_length(c, path),
    "json_build_object": lambda c, pairs=None, **_: build_object(pairs or {}),
    "json_empty_array": lambda c, **_: empty_array(),
}


def json_operation(name: str, column: Column | None = None, **options: Any) -> Column:
    if name not in OPERATIONS:
        raise unsupported("json_operation", f"{name} is not supported", operation=name)
    return OPERATIONS[name](column, **options)


def json_rows(df, column: str, path=None, name: str = "value"):
    """A row for each element of the array at a path: the other columns, its index and its text."""
    exploded = df.select("*", F.posexplode(elements(F.col(column), path)).alias("index", "_element"))
    return exploded.withColumn(name, F.try_variant_get("_element", "$", "string")).drop("_element")
