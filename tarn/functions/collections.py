"""Aggregates that gather values: JSON arrays and delimited text."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import unsupported


def json_array(column: Column, distinct: bool = False) -> Column:
    """Text of a JSON array of all values, NULLs included, in sorted order so that it is deterministic."""
    wrapped = F.struct(column.alias("x"))
    gathered = F.sort_array((F.collect_set if distinct else F.collect_list)(wrapped))
    return F.to_json(F.transform(gathered, lambda e: e["x"]), {"ignoreNullFields": "false"})


def joined_text(column: Column, delimiter: str = ",") -> Column:
    """Values joined by a delimiter in sorted order; NULLs are skipped, no values give NULL."""
    gathered = F.sort_array(F.collect_list(column.cast("string")))
    return F.when(F.size(gathered) > 0, F.array_join(gathered, delimiter))


def collection_operation(name: str, column: Column, *, distinct: bool = False, order_by: Any = None, delimiter: str | None = None) -> Column:
    if name == "json_agg" and not order_by:
        return json_array(column)
    if name == "array_agg" and not order_by:
        return json_array(column, distinct)
    if name == "string_agg" and not order_by and not distinct:
        return joined_text(column, "," if delimiter is None else delimiter)
    raise unsupported("collection_operation", f"{name} is not supported in this form", operation=name, distinct=distinct, order_by=order_by)
