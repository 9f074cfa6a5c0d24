"""One predicate and value tree for reads and writes, compiled to Columns.

A predicate is a tuple whose head names the operation: ``("eq", field, value)`` and so on,
``("and", [..])``, ``("or", [..])``, ``("not", p)``, ``("in", field, [..])``, ``("is_null", field)``,
``("not_null", field)``, ``("like", field, pattern)``, ``("not_like", field, pattern)``.
A field is ``("field", name)``; a value is a plain Python value or a tagged one: ``("literal", v)``,
``("literal", ("system", "now"))``, ``("context", key)`` or ``("field", name)``.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_, eq, ge, gt, le, lt, ne, or_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .errors import TarnError
from .types import bind

COMPARISONS = {"eq": eq, "neq": ne, "gt": gt, "gte": ge, "lt": lt, "lte": le}
SYMBOLS = {"=": "eq", "==": "eq", "!=": "neq", "<>": "neq", ">": "gt", ">=": "gte", "<": "lt", "<=": "lte"}
UNSAFE = ("unsafe_sql", "unsafe_fragment")


def valid_name(name: Any) -> bool:
    return isinstance(name, str) and bool(name.strip())


def quote(name: str) -> str:
    """An identifier for Spark SQL, each dotted part in backticks."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def lookup_context(key: Any, context: Mapping[Any, Any] | None) -> Any:
    context = context or {}
    if key in context:
        return context[key]
    for k, v in context.items():  # text and other spellings of one key are the same key
        if str(k) == str(key):
            return v
    raise TarnError("missing_context", "a context value is missing", key=key)


def scalar(value: Any, context: Mapping[Any, Any] | None = None) -> tuple[str, Any]:
    """("literal", v), ("now", None) or ("field", name) for a value of the tree."""
    if isinstance(value, tuple) and value and isinstance(value[0], str):
        tag = value[0]
        if tag in UNSAFE:
            raise TarnError("invalid_command", "raw SQL is not allowed here", value=value)
        if tag == "literal" and len(value) == 2:
            return ("now", None) if value[1] == ("system", "now") else ("literal", value[1])
        if tag == "context" and len(value) == 2:
            return "literal", lookup_context(value[1], context)
        if tag == "field" and len(value) == 2 and valid_name(value[1]):
            return "field", value[1]
        raise TarnError("invalid_command", "unknown tagged value", value=value)
    return "literal", value


def now() -> Column:
    return F.localtimestamp()


def value_column(value: Any, context: Mapping[Any, Any] | None = None, target: T.DataType | None = None, alias: str | None = None) -> Column:
    kind, v = scalar(value, context)
    if kind == "now":
        return now()
    if kind == "field":
        return field_column(v, alias)
    return F.lit(bind(v, target))


def field_column(name: str, alias: str | None = None) -> Column:
    return F.col(f"{quote(alias)}.{quote(name)}" if alias else quote(name))


def _field(node: Any, predicate: Any) -> str:
    if isinstance(node, str) and valid_name(node):
        return node
    if isinstance(node, tuple) and len(node) == 2 and node[0] == "field" and valid_name(node[1]):
        return node[1]
    raise _invalid(predicate)


def _invalid(predicate: Any, why: str = "unsupported predicate") -> TarnError:
    return TarnError("invalid_predicate", why, predicate=predicate)


def compile_predicate(predicate: Any, schema: T.StructType | None = None, context: Mapping[Any, Any] | None = None, alias: str | None = None) -> Column:
    """The Column of a predicate; three-valued logic is Spark's own."""
    if not isinstance(predicate, tuple) or not predicate or not isinstance(predicate[0], str):
        raise _invalid(predicate)
    types = {f.name: f.dataType for f in schema} if schema is not None else {}
    below = lambda p: compile_predicate(p, schema, context, alias)
    op, rest = SYMBOLS.get(predicate[0], predicate[0]), predicate[1:]
    if op in ("and", "or") and len(rest) == 1 and isinstance(rest[0], (list, tuple)):
        if not rest[0]:
            raise _invalid(predicate, "boolean groups must not be empty")
        return reduce(and_ if op == "and" else or_, map(below, rest[0]))
    if op == "not" and len(rest) == 1:
        return ~below(rest[0])
    if op in ("is_null", "not_null") and len(rest) == 1:
        column = field_column(_field(rest[0], predicate), alias)
        return column.isNull() if op == "is_null" else column.isNotNull()
    if len(rest) == 2:
        name = _field(rest[0], predicate)
        column, target = field_column(name, alias), types.get(name)
        if op == "in":
            if not isinstance(rest[1], (list, tuple)) or not rest[1]:
                raise _invalid(predicate, "in takes a list that is not empty")
            return column.isin(*(value_column(v, context, target, alias) for v in rest[1]))
        if op in COMPARISONS:
            return COMPARISONS[op](column, value_column(rest[1], context, target, alias))
        if op in ("like", "not_like"):
            found = insensitive_like(column, value_column(rest[1], context, None, alias))
            return found if op == "like" else ~found
    raise _invalid(predicate)


def insensitive_like(column: Column, pattern: Column) -> Column:
    """LIKE without regard to case.  A backslash is an ordinary character, as there is no escape."""
    return F.call_function("like", F.lower(column), F.replace(F.lower(pattern), F.lit("\\"), F.lit("\\\\")))
