"""SQL statements on a table store: CREATE TABLE, INSERT, REPLACE, UPDATE, DELETE and queries.

Spark's own Parquet tables take no keys, updates or deletes, so these statements are read here and run
as writes of the store; conditions, values and queries are Spark SQL.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..domain import Domain, Reference
from ..errors import TarnError, normalize_error
from ..lexer import mask, plain, table_places
from ..predicates import quote
from ..session import Result, Session
from .writes import Transaction, Writer

_NAME = r'("(?:[^"]|"")+"|`(?:[^`]|``)+`|[A-Za-z_][\w.]*)'
_CREATE = re.compile(rf"\s*CREATE\s+TABLE\s+(IF\s+NOT\s+EXISTS\s+)?{_NAME}\s*\((.*)\)\s*;?\s*", re.I | re.S)
_INSERT = re.compile(rf"\s*(INSERT\s+OR\s+REPLACE|INSERT|REPLACE)\s+INTO\s+{_NAME}\s*\(([^)]*)\)\s*(.*?)\s*;?\s*", re.I | re.S)
_UPDATE = re.compile(rf"\s*UPDATE\s+{_NAME}\s+SET\s+(.*?)\s+WHERE\s+(.*?)\s*;?\s*", re.I | re.S)
_DELETE = re.compile(rf"\s*DELETE\s+FROM\s+{_NAME}\s+WHERE\s+(.*?)\s*;?\s*", re.I | re.S)
_DROP = re.compile(rf"\s*DROP\s+TABLE\s+(IF\s+EXISTS\s+)?{_NAME}\s*;?\s*", re.I)
_ALIASED = re.compile(r"\s+(?:AS\s+)?(?!(?:ON|WHERE|JOIN|LEFT|INNER|CROSS|GROUP|ORDER|LIMIT|OFFSET|UNION|HAVING|EXCEPT|INTERSECT|USING|WINDOW)\b)[A-Za-z_]", re.I)
_CHANGES = re.compile(r"\s*(INSERT|REPLACE|UPDATE|DELETE)\b", re.I)


def _match(pattern: re.Pattern, text: str, nested: bool = False) -> list[str | None] | None:
    """The pattern's groups (from 1) in a statement whose literals and comments, and with ``nested`` whatever
    is in brackets, are not looked at."""
    m = pattern.fullmatch(mask(text, nested))
    return m and [None, *(None if m.start(i) < 0 else text[m.start(i) : m.end(i)] for i in range(1, pattern.groups + 1))]


def _parts(text: str) -> list[str]:
    """Split at commas outside brackets and quotes."""
    out, depth, held, quoted = [], 0, "", ""
    for c in text:
        if quoted:
            quoted = "" if c == quoted else quoted
        elif c in "'\"`":
            quoted = c
        depth += (c == "(") - (c == ")") if not quoted else 0
        if c == "," and not depth and not quoted:
            out.append(held.strip())
            held = ""
        else:
            held += c
    return [*out, held.strip()] if held.strip() else out


def _names(text: str) -> tuple[str, ...]:
    return tuple(plain(p) for p in _parts(text))


def parse_table(text: str) -> Domain:
    """The domain of a CREATE TABLE statement: types, PRIMARY KEY, AUTOINCREMENT, NOT NULL, UNIQUE, REFERENCES."""
    m = _match(_CREATE, text)
    if not m:
        raise TarnError("invalid_command", "not a CREATE TABLE statement", text=text)
    columns, key, unique, required, refs, generated = {}, (), [], set(), [], None
    for part in _parts(m[3]):
        if c := re.fullmatch(r"PRIMARY\s+KEY\s*\((.*)\)", part, re.I | re.S):
            key = _names(c[1])
        elif c := re.fullmatch(r"UNIQUE\s*\((.*)\)", part, re.I | re.S):
            unique.append(_names(c[1]))
        elif c := re.fullmatch(rf"FOREIGN\s+KEY\s*\((.*?)\)\s*REFERENCES\s+{_NAME}\s*\((.*?)\).*", part, re.I | re.S):
            refs.append(Reference(plain(c[1].strip()), plain(c[2]), plain(c[3].strip())))
        elif c := re.fullmatch(rf"{_NAME}\s+([A-Za-z]+(?:\s+PRECISION)?(?:\s*\([^)]*\))?)(.*)", part, re.I | re.S):
            name, rest = plain(c[1]), c[3]
            columns[name] = c[2]
            if re.search(r"PRIMARY\s+KEY", rest, re.I):
                key = (name,)
                generated = name if re.search("AUTOINCREMENT", rest, re.I) or c[2].strip().lower() == "integer" else None
            if re.search(r"NOT\s+NULL", rest, re.I):
                required.add(name)
            if re.search(r"\bUNIQUE\b", rest, re.I):
                unique.append((name,))
            if r := re.search(rf"REFERENCES\s+{_NAME}\s*\((.*?)\)", rest, re.I):
                refs.append(Reference(name, plain(r[1]), plain(r[2].strip())))
        else:
            raise TarnError("invalid_command", "a column can't be read", column=part)
    return Domain(plain(m[2]), columns, key, tuple(unique), frozenset(required), tuple(refs), generated)


class Statements:
    """Runs statement texts on a store; each is a transaction of its own unless one is open."""

    def __init__(self, writer: Writer) -> None:
        self.writer, self.store = writer, writer.store
        self.session = Session(writer.store.spark)

    def execute(self, text: str, params: Sequence[Any] | None = None, *, timeout: int = 60_000) -> Result:
        """Rows of a query, or the number of rows that a change touched."""
        if m := _match(_CREATE, text):
            if not (m[1] and plain(m[2]) in self.store.load()):
                self.store.create(parse_table(text))
            return Result([], [], 0)
        if m := _match(_DROP, text):
            return self._drop(plain(m[2]), bool(m[1]))
        try:
            if not _CHANGES.match(mask(text)):
                return self.session.execute(self.frame(text, params), timeout=timeout)
            return Result([], [], self.writer._guarded(lambda tx: self._change(tx, text, params)))
        except TarnError:
            raise
        except Exception as e:
            raise normalize_error(e) from e

    def frame(self, text: str, params: Sequence[Any] | None = None) -> DataFrame:
        """A query's lazy DataFrame; where it has a table, the store's tables go by their names."""
        current = self.writer.current
        tables = current.tables if current else self.store.load()
        used: dict[str, DataFrame] = {}
        out, at = [], 0
        for start, end, name in table_places(text):
            if name in tables:
                used[name] = self.store.read(tables[name])
                alias = "" if _ALIASED.match(text, end) else f" AS {quote(name)}"
                out += [text[at:start], f"{{{name}}}{alias}"]
                at = end
        return self.session.sql("".join([*out, text[at:]]), params, used)

    def _drop(self, name: str, lenient: bool) -> Result:
        with self.store.lock():
            tables = self.store.load()
            if name not in tables and not lenient:
                raise TarnError("invalid_command", "no such table", table=name)
            tables.pop(name, None)
            self.store.publish(tables)
        return Result([], [], 0)

    def _change(self, tx: Transaction, text: str, params: Sequence[Any] | None) -> int:
        if m := _match(_INSERT, text):
            name, columns = plain(m[2]), _names(m[3])
            rows = self.frame(m[4] if re.match(r"\s*(SELECT|WITH)\b", m[4], re.I) else f"SELECT * FROM ({m[4]})", params).toDF(*columns)
            if m[1].upper() != "INSERT":
                self._replace(tx, name, rows)
            return self.writer.append(name, rows).affected_rows
        if m := _match(_UPDATE, text, nested=True):
            name = plain(m[1])
            state = tx.state(name)
            pairs = [p.partition("=") for p in _parts(m[2])]
            sets = {plain(c.strip()): v.strip() for c, _, v in pairs}
            if unknown := [c for c in sets if c not in state.domain.columns]:
                raise TarnError("execution_failed", "no such column", columns=unknown)
            *values, where = self._expressions([*sets.values(), m[3]], params)
            types = {f.name: f.dataType for f in state.domain.schema}
            changed = {c: F.expr(v).cast(types[c]) for c, v in zip(sets, values, strict=True)}
            matched = F.coalesce(F.expr(where), F.lit(False))
            after, old = self.store.rewritten(state, matched, lambda df: df.withColumns({c: F.when(matched, v).otherwise(F.col(quote(c))) for c, v in changed.items()}))
            touched = old.withColumns(changed)
            n = touched.count()
            if n:
                keys = {c for u in state.domain.uniques for c in u} & set(sets)
                self.writer._constraints(tx, after, touched, among=self.store.read(after) if keys else None)
                tx.put(after)
            return n
        if m := _match(_DELETE, text, nested=True):
            state = tx.state(plain(m[1]))
            (where,) = self._expressions([m[2]], params)
            matched = F.coalesce(F.expr(where), F.lit(False))
            after, old = self.store.rewritten(state, matched, lambda df: df.where(~matched))
            n = old.count()
            if n:
                self.writer._still_referred(tx, state, after, old)
                tx.put(after)
            return n
        raise TarnError("invalid_command", "the statement can't be read (UPDATE and DELETE need WHERE)", text=text)

    def _replace(self, tx: Transaction, name: str, rows: DataFrame) -> None:
        """Delete the rows whose unique keys the new ones take: one rewrite for each unique key of the table."""
        types = {f.name: f.dataType for f in tx.state(name).domain.schema}
        for u in tx.state(name).domain.uniques:
            if set(u) <= set(rows.columns):
                tx.put(self.store.without(tx.state(name), rows.select(*(F.col(quote(c)).cast(types[c]).alias(c) for c in u))))

    @staticmethod
    def _expressions(texts: list[str], params: Sequence[Any] | None) -> list[str]:
        """Expressions with their ``?`` and ``$n`` put in as literals, in order across all of them."""
        from ..session import convert_parameters

        joined, args = convert_parameters("\0".join(texts), params)
        for name in sorted(args, key=len, reverse=True):
            joined = re.sub(rf":{name}\b", lambda m, v=args[name]: _literal(v), joined)
        return joined.split("\0")


def _literal(v: Any) -> str:
    import datetime as dt
    from decimal import Decimal

    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, Decimal):
        return f"CAST('{v}' AS DECIMAL(38,10))"
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP_NTZ '{v.isoformat(sep=' ')}'"
    if isinstance(v, dt.date):
        return f"DATE '{v.isoformat()}'"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


__all__ = ["Statements", "parse_table"]
