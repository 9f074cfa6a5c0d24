"""A fluent query over a session's tables; every step is a DataFrame step, so Catalyst plans the whole."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .errors import unsupported
from .functions.collections import collection_operation
from .operators import relational, textsearch
from .predicates import compile_predicate


class Query:
    def __init__(self, session: Any, df: DataFrame, context: dict | None = None) -> None:
        self.session, self.df, self.context = session, df, context or {}

    def _with(self, df: DataFrame) -> Query:
        return Query(self.session, df, self.context)

    def given(self, **context: Any) -> Query:
        return Query(self.session, self.df, {**self.context, **context})

    def select(self, *columns: str | Column) -> Query:
        return self._with(self.df.select(*columns))

    def filter(self, predicate: Any) -> Query:
        """``("field", value)`` for equality, ``("field", op, value)``, a predicate tree, or a Column."""
        if isinstance(predicate, Column):
            return self._with(self.df.where(predicate))
        if isinstance(predicate, tuple) and len(predicate) == 2 and predicate[0] in self.df.columns:
            predicate = ("eq", *predicate)
        elif isinstance(predicate, tuple) and len(predicate) == 3 and predicate[0] in self.df.columns:
            predicate = (predicate[1], predicate[0], predicate[2])
        return self._with(self.df.where(compile_predicate(predicate, self.df.schema, self.context)))

    def join(self, other: Any, on: Any = None, how: str = "inner") -> Query:
        return self._with(relational.join(self.df, self._frame(other), on, how))

    def right_join(self, other: Any, on: Any) -> Query:
        return self._with(relational.right_join(self.df, self._frame(other), on))

    def full_join(self, other: Any, on: Column) -> Query:
        return self._with(relational.full_join(self.df, self._frame(other), on))

    def aggregate(self, *keys: str | Column, **aggregates: Column) -> Query:
        return self._with(self.df.groupBy(*keys).agg(*(c.alias(n) for n, c in aggregates.items())))

    def collect_values(self, keys: list[str], name: str, operation: str, column: str, **options: Any) -> Query:
        return self._with(self.df.groupBy(*keys).agg(collection_operation(operation, F.col(column), **options).alias(name)))

    def window(self, **columns: Column) -> Query:
        return self._with(self.df.withColumns(columns))

    def match(self, fields: Any, query: str, mode: str | None = None, domain: Any = None) -> Query:
        return self._with(self.df.where(textsearch.match(fields, query, mode, domain)))

    def rollup(self, *_: Any) -> Query:
        raise unsupported("rollup", "rollup is not supported")

    def union(self, other: Any, distinct: bool = True) -> Query:
        return self._with(relational.union(self.df, self._frame(other), distinct=distinct))

    def intersect(self, other: Any) -> Query:
        return self._with(relational.intersect(self.df, self._frame(other)))

    def except_(self, other: Any) -> Query:
        return self._with(relational.except_(self.df, self._frame(other)))

    def order_by(self, *columns: str | int | Column) -> Query:
        """By columns or by ordinals from 1, ascending with NULLs first."""
        return self._with(self.df.orderBy(*(self.df.columns[c - 1] if isinstance(c, int) else c for c in columns)))

    def limit(self, n: int, offset: int = 0) -> Query:
        return self._with((self.df.offset(offset) if offset else self.df).limit(n))

    def execute(self, **options: Any) -> Any:
        return self.session.execute(self.df, **options)

    def explain(self) -> str:
        return self.session.explain(self.df)

    def _frame(self, other: Any) -> DataFrame:
        return other.df if isinstance(other, Query) else self.session.table(other) if isinstance(other, str) else other
