"""Portable writes: commands, batches and graphs, checked, previewed and run atomically on a store."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import ExitStack
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import TarnError, normalize_error
from ..predicates import compile_predicate, now, quote, scalar, valid_name
from ..sources.store import Store, TableState
from ..types import bind
from .capabilities import DIALECT

OPERATIONS = ("insert", "upsert", "update", "delete")


@dataclass(frozen=True)
class Command:
    """``assignments`` are (field, value) pairs; ``metadata`` may hold conflict_target,
    upsert_update_fields and foreign_key_guards (field, relation, target_field)."""

    operation: str
    relation: str
    assignments: tuple[tuple[str, Any], ...] = ()
    predicate: Any = None
    returning: Any = "none"
    expected_cardinality: Any = None
    metadata: Mapping[str, Any] = field(default_factory=dict)

    @property
    def cardinality(self) -> tuple:
        if self.expected_cardinality is not None:
            return self.expected_cardinality if isinstance(self.expected_cardinality, tuple) else (self.expected_cardinality,)
        return ("exactly", 1) if self.operation == "insert" else ("many",)


@dataclass(frozen=True)
class Batch:
    commands: tuple[Command, ...]


@dataclass(frozen=True)
class Binding:
    field: str
    from_node: str
    from_row: str
    from_field: str


@dataclass(frozen=True)
class Row:
    id: str
    command: Command
    bindings: tuple[Binding, ...] = ()


@dataclass(frozen=True)
class Node:
    """Rows of one relation; ``delete_missing`` (scope fields) removes rows of the scope not written here."""

    id: str
    relation: str
    rows: tuple[Row, ...]
    delete_missing: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Graph:
    nodes: tuple[Node, ...]
    root: tuple[str, str]


@dataclass
class WriteResult:
    operation: str
    affected_rows: int
    rows: list[dict[str, Any]]
    metadata: dict[str, Any] = field(default_factory=dict)


@dataclass
class Preview:
    statements: list[dict[str, Any]]
    metadata: dict[str, Any]


# ------------------------------------------------------------------------------------- checking


@dataclass
class Checked:
    """A command whose parts passed; errors come in the order in which the parts are checked."""

    command: Command
    assignments: list[tuple[str, str, Any]]
    returning: list[str] | str | None
    guards: list[tuple[str, str, Any]]
    update_fields: list[str] | None = None
    conflict_target: list[str] | None = None
    parameters: list[Any] = field(default_factory=list)


def _assignments(command: Command, context: Mapping | None) -> list[tuple[str, str, Any]]:
    out = []
    for pair in command.assignments:
        name, value = (pair.get("field"), pair.get("value")) if isinstance(pair, Mapping) else pair
        if not valid_name(name):
            raise TarnError("invalid_command", "an assignment needs a field", assignment=pair)
        out.append((name, *scalar(value, context)))
    if not out:
        raise TarnError("invalid_command", f"{command.operation} needs an assignment at least")
    return out


def _returning(value: Any) -> list[str] | str | None:
    if value in (None, "none"):
        return None
    if value in ("all", "*"):
        return "*"
    if isinstance(value, (list, tuple)) and all(valid_name(v) for v in value):
        return list(value)
    raise TarnError("invalid_command", "invalid returning", returning=value)


def _guards(command: Command, assignments: list[tuple[str, str, Any]]) -> list[tuple[str, str, Any]]:
    given = {n: (k, v) for n, k, v in reversed(assignments)}
    out = []
    for guard in command.metadata.get("foreign_key_guards", ()):
        ok = isinstance(guard, Mapping) and valid_name(guard.get("relation")) and valid_name(guard.get("target_field"))
        kind, value = given.get(guard.get("field"), (None, None)) if ok else (None, None)
        if kind != "literal":
            raise TarnError("invalid_foreign_key_guard", "a guard needs an assigned scalar value", guard=guard)
        out.append((guard["relation"], guard["target_field"], value))
    return out


def _conflict_target(command: Command) -> list[str]:
    fields = command.metadata.get("conflict_target")
    if not isinstance(fields, (list, tuple)) or not fields:
        raise TarnError("invalid_command", "upsert needs a conflict target")
    if not all(map(valid_name, fields)):
        raise TarnError("invalid_command", "the conflict target is invalid", fields=fields)
    return list(fields)


def _update_fields(command: Command, assignments: list[tuple[str, str, Any]]) -> list[str]:
    fields = command.metadata.get("upsert_update_fields")
    if not isinstance(fields, (list, tuple)):
        raise TarnError("invalid_command", "upsert needs a list of fields to update")
    assigned = [n for n, _, _ in assignments]
    for why, bad in (("invalid_field", not all(map(valid_name, fields))), ("duplicate_field", len(set(fields)) < len(fields)), ("field_not_assigned", not set(fields) <= set(assigned))):
        if bad:
            raise TarnError("invalid_command", "the fields to update are invalid", fields=fields, reason=why)
    return [n for n in assigned if n in fields]


def check(command: Any, context: Mapping | None = None) -> Checked:
    if not isinstance(command, Command):
        raise TarnError("invalid_command", "expected a write command, batch or graph", actual=command)
    if command.operation not in OPERATIONS or not valid_name(command.relation):
        raise TarnError("invalid_command", "unknown operation or relation", operation=command.operation, relation=command.relation)
    op = command.operation
    if op in ("update", "delete") and command.predicate is None:
        raise TarnError("missing_predicate", f"{op} needs a predicate")
    given = [] if op == "delete" else _assignments(command, context)
    out = Checked(command, given, None, [])
    if op in ("update", "delete"):
        compile_predicate(command.predicate, None, context)
    if op == "upsert":
        out.conflict_target, out.update_fields = _conflict_target(command), _update_fields(command, given)
    if op in ("insert", "upsert"):
        out.returning, out.guards = _returning(command.returning), _guards(command, given)
    elif op == "update":
        out.guards, out.returning = _guards(command, given), _returning(command.returning)
    else:
        out.returning = _returning(command.returning)
    out.parameters = [v for _, k, v in given if k == "literal"] + _literals(command.predicate, context) + [v for _, _, v in out.guards]
    return out


def _literals(node: Any, context: Mapping | None) -> list[Any]:
    """Bound values of a predicate, in order."""
    if not isinstance(node, tuple) or not node:
        return []
    if node[0] in ("and", "or"):
        return [v for p in node[1] for v in _literals(p, context)]
    if node[0] == "not":
        return _literals(node[1], context)
    if node[0] in ("is_null", "not_null"):
        return []
    values = node[2] if node[0] == "in" else [node[2]]
    return [v for k, v in (scalar(x, context) for x in values) if k == "literal"]


def cardinality_holds(count: int, expected: tuple) -> bool:
    match expected:
        case ("exactly", n):
            return count == n
        case ("at_most", n):
            return count <= n
        case ("at_least", n):
            return count >= n
        case ("between", low, high):
            return low <= count <= high
        case ("many",):
            return True
    raise TarnError("invalid_command", "unknown cardinality", expected=expected)


# ---------------------------------------------------------------------------------- transaction


class Transaction:
    """Staged table states over a store; nested ones are savepoints."""

    def __init__(self, store: Store) -> None:
        self.store, self.stack = store, [store.load()]

    @property
    def tables(self) -> dict[str, TableState]:
        return self.stack[-1]

    def state(self, name: str) -> TableState:
        if name not in self.tables:
            raise TarnError("execution_failed", "no such table", table=name)
        return self.tables[name]

    def read(self, name: str) -> DataFrame:
        return self.store.read(self.state(name))

    def put(self, state: TableState) -> None:
        self.tables[state.domain.table] = state


class Writer:
    """Runs writes on a store.  ``transaction`` nests: the outermost publishes, inner ones are savepoints."""

    def __init__(self, store: Store) -> None:
        self.store, self.current = store, None

    def transaction(self, work: Callable[[Transaction], Any]) -> Any:
        """``work``'s value, published; any exception undoes this level and goes on to the caller."""
        if self.current is not None:
            outer = self.current
            outer.stack.append(dict(outer.tables))
            try:
                value = work(outer)
            except BaseException:
                outer.stack.pop()
                raise
            done = outer.stack.pop()
            outer.stack[-1] = done
            return value
        with ExitStack() as stack:
            stack.enter_context(self.store.lock())
            self.current = Transaction(self.store)
            try:
                value = work(self.current)
                self.store.publish(self.current.tables)
                return value
            finally:
                self.current = None

    # ------------------------------------------------------------------------------ writing

    def execute(self, write: Command | Batch | Graph, context: Mapping | None = None) -> Any:
        if isinstance(write, Command):
            check(write, context)
            return self._guarded(lambda tx: self._command(tx, write, context))
        if isinstance(write, Batch):
            for c in write.commands:
                check(c, context)
            return self._guarded(lambda tx: [self._command(tx, c, context) for c in write.commands])
        if isinstance(write, Graph):
            _check_graph(write)
            return self._guarded(lambda tx: self._graph(tx, write, context))
        raise TarnError("invalid_command", "expected a write command, batch or graph", actual=write)

    def _guarded(self, work: Callable[[Transaction], Any]) -> Any:
        try:
            return self.transaction(work)
        except TarnError:
            raise
        except Exception as e:
            raise TarnError("transaction_failed", str(e)) from e

    def _command(self, tx: Transaction, command: Command, context: Mapping | None) -> WriteResult:
        checked = check(command, context)
        state = tx.state(command.relation)
        if unknown := [n for n, _, _ in checked.assignments if n not in state.domain.columns]:
            raise TarnError("execution_failed", "no such column", columns=unknown)
        try:
            run = {"insert": self._insert, "upsert": self._upsert, "update": self._update, "delete": self._delete}[command.operation]
            count, rows = run(tx, state, checked, context)
        except TarnError as e:
            if e.kind == "constraint_violation":
                raise TarnError("execution_failed", e.message, **e.details) from e
            raise
        except Exception as e:
            raise normalize_error(e) from e
        if not cardinality_holds(count, command.cardinality):
            raise TarnError("cardinality_mismatch", "the write touched an unexpected number of rows", expected=command.cardinality, actual=count)
        return WriteResult(command.operation, count, rows, {"dialect": DIALECT})

    def _guards_hold(self, tx: Transaction, checked: Checked) -> bool:
        for relation, name, value in checked.guards:
            rows = tx.read(relation)
            if value is None or rows.where(F.col(quote(name)) == F.lit(bind(value, rows.schema[name].dataType))).isEmpty():
                return False
        return True

    def _proposed(self, state: TableState, checked: Checked) -> dict[str, Column]:
        """The new row's columns, NULL where nothing is assigned."""
        given = {n: (k, v) for n, k, v in checked.assignments}
        out = {}
        for f in state.domain.schema:
            kind, v = given.get(f.name, ("literal", None))
            if kind == "field":
                raise TarnError("execution_failed", "a new row has no field to refer to", field=v)
            out[f.name] = (now() if kind == "now" else F.lit(bind(v, f.dataType))).cast(f.dataType)
        return out

    def _add(self, tx: Transaction, state: TableState, checked: Checked) -> list[dict[str, Any]]:
        columns, next_key, generated = self._proposed(state, checked), state.next_key, state.domain.generated
        given = {n: v for n, _, v in checked.assignments}
        if generated and given.get(generated) is None:
            columns[generated] = F.lit(next_key).cast(state.domain.schema[generated].dataType)
            next_key += 1
        elif generated:
            next_key = max(next_key, int(given[generated]) + 1)
        new = self.store.spark.range(0, 1, 1, 1).select(*(c.alias(n) for n, c in columns.items()))
        self._constraints(tx, state, new)
        fresh = replace(self.store.added(state, new), next_key=next_key)
        tx.put(fresh)
        return self._rows(self.store.read(replace(fresh, files=fresh.files[len(state.files) :])), checked)

    def _insert(self, tx, state, checked, context) -> tuple[int, list]:
        if not self._guards_hold(tx, checked):
            return 0, []
        return 1, self._add(tx, state, checked)

    def _upsert(self, tx, state, checked, context) -> tuple[int, list]:
        if not self._guards_hold(tx, checked):
            return 0, []
        target = checked.conflict_target
        if unknown := [c for c in target if c not in state.domain.columns]:
            raise TarnError("execution_failed", "no such column", columns=unknown)
        if tuple(target) not in {tuple(u) for u in state.domain.uniques} and set(target) not in [set(u) for u in state.domain.uniques]:
            raise TarnError("execution_failed", "the conflict target is not unique", conflict_target=target)
        proposed = self._proposed(state, checked)
        matched = reduce(and_, (F.col(quote(c)) == proposed[c] for c in target))
        if tx.read(state.domain.table).where(matched).isEmpty():
            return 1, self._add(tx, state, checked)
        if not checked.update_fields:
            return 0, []
        return self._change(tx, state, checked, matched, {c: proposed[c] for c in checked.update_fields})

    def _update(self, tx, state, checked, context) -> tuple[int, list]:
        matched = F.coalesce(compile_predicate(checked.command.predicate, state.domain.schema, context), F.lit(False))
        if not self._guards_hold(tx, checked):
            return 0, []
        types = {f.name: f.dataType for f in state.domain.schema}
        sets = {}
        for n, kind, v in checked.assignments:
            value = now() if kind == "now" else F.col(quote(v)) if kind == "field" else F.lit(bind(v, types[n]))
            sets[n] = value.cast(types[n])
        return self._change(tx, state, checked, matched, sets)

    def _change(self, tx, state, checked, matched, sets) -> tuple[int, list]:
        moment = self.store.spark.range(0, 1, 1, 1).select(now()).first()[0]
        frozen = {n: F.lit(moment).cast(state.domain.schema[n].dataType) if _is_now(checked, n) else c for n, c in sets.items()}
        after = lambda df: df.withColumns({n: F.when(matched, c).otherwise(F.col(quote(n))) for n, c in frozen.items()})
        fresh, old = self.store.rewritten(state, matched, after)
        changed = old.withColumns(frozen)
        count = changed.count()
        if count:
            keys = {c for u in state.domain.uniques for c in u}
            unchanged = None if not keys & set(sets) else self.store.read(fresh)
            self._constraints(tx, fresh, changed, among=unchanged)
            tx.put(fresh)
        return count, self._rows(changed, checked)

    def _delete(self, tx, state, checked, context) -> tuple[int, list]:
        matched = F.coalesce(compile_predicate(checked.command.predicate, state.domain.schema, context), F.lit(False))
        fresh, old = self.store.rewritten(state, matched, lambda df: df.where(~matched))
        count = old.count()
        if count:
            self._still_referred(tx, state, fresh, old)
            tx.put(fresh)
        return count, self._rows(old, checked)

    def _rows(self, df: DataFrame, checked: Checked) -> list[dict[str, Any]]:
        if checked.returning is None:
            return []
        columns = df.columns if checked.returning == "*" else checked.returning
        return [r.asDict() for r in df.select(*(quote(c) for c in columns)).collect()]

    def append(self, relation: str, rows: DataFrame) -> WriteResult:
        """INSERT ... SELECT: add the rows of a DataFrame, columns by name, missing ones NULL.

        The rows are written once; constraints are then checked on the written files with distributed
        aggregates and joins.  Generated keys are unique and increasing, but not without gaps.
        """

        def work(tx: Transaction) -> WriteResult:
            state = tx.state(relation)
            d = state.domain
            if unknown := [c for c in rows.columns if c not in d.columns]:
                raise TarnError("execution_failed", "no such column", columns=unknown)
            given = {f.name: (F.col(quote(f.name)) if f.name in rows.columns else F.lit(None)).cast(f.dataType) for f in d.schema}
            if d.generated:
                fresh_key = (F.monotonically_increasing_id() + state.next_key).cast(d.schema[d.generated].dataType)
                given[d.generated] = F.coalesce(given[d.generated], fresh_key)
            after = self.store.added(state, rows.select(*(c.alias(n) for n, c in given.items())))
            new = self.store.read(replace(after, files=after.files[len(state.files) :]))
            try:
                self._bulk_constraints(tx, state, new)
            except TarnError as e:
                raise TarnError("execution_failed", e.message, **e.details) from e
            found = new.agg(F.count("*").alias("n"), *([F.max(quote(d.generated)).alias("top")] if d.generated else [])).first()
            tx.put(replace(after, next_key=max(state.next_key, (found["top"] or 0) + 1)) if d.generated else after)
            return WriteResult("insert", found["n"], [], {"dialect": DIALECT})

        return self._guarded(work)

    # -------------------------------------------------------------------------- constraints

    def _bulk_constraints(self, tx: Transaction, state: TableState, new: DataFrame) -> None:
        d = state.domain
        required = [*d.not_null, *d.key]
        if required and not new.where(reduce(lambda a, b: a | b, (F.col(quote(c)).isNull() for c in required))).isEmpty():
            raise TarnError("constraint_violation", "a required column is NULL", table=d.table, columns=sorted(required))
        for u in d.uniques:
            keys = new.select(*map(quote, u)).dropna()
            twice = keys.groupBy(*map(quote, u)).count().where("count > 1")
            if not twice.isEmpty() or state.files and not self.store.read(state).select(*map(quote, u)).join(keys, list(u), "left_semi").isEmpty():
                raise TarnError("constraint_violation", "a unique key is taken", table=d.table, columns=list(u))
        self._references(tx, d, new, new)

    def _references(self, tx: Transaction, d, rows: DataFrame, own: DataFrame | None = None) -> None:
        """Every reference of ``rows`` has a target; ``own`` are rows of the same table that count too."""
        for r in d.refs if self.store.foreign_keys else ():
            values = rows.select(F.col(quote(r.field)).alias("_v")).dropna().distinct()
            targets = tx.read(r.table)
            if own is not None and r.table == d.table:
                targets = targets.unionByName(own)
            if not values.join(targets.select(F.col(quote(r.target_field)).alias("_v")), "_v", "left_anti").isEmpty():
                raise TarnError("constraint_violation", "a reference has no target", table=d.table, field=r.field)

    def _constraints(self, tx: Transaction, state: TableState, rows: DataFrame, among: DataFrame | None = None) -> None:
        """NOT NULL, UNIQUE and references of new or changed rows.  ``among`` is the whole table after the
        change where a unique column changed; for a new row its key is looked up in the table before."""
        d = state.domain
        required = [*d.not_null, *d.key]
        if required and not rows.where(reduce(lambda a, b: a | b, (F.col(quote(c)).isNull() for c in required))).isEmpty():
            raise TarnError("constraint_violation", "a required column is NULL", table=d.table, columns=sorted(required))
        for u in d.uniques:
            names = [quote(c) for c in u]
            keyed = rows.select(*names).dropna()
            if among is not None:
                twice = among.join(F.broadcast(keyed.distinct()) if keyed.count() <= 10_000 else keyed.distinct(), list(u), "left_semi").groupBy(*names).count().where("count > 1")
                bad = not twice.isEmpty()
            elif state.files and rows.columns and rows.count() == 1:
                first = keyed.first()
                test = first is not None and reduce(and_, (F.col(n) == F.lit(v) for n, v in zip(names, first, strict=True)))
                bad = first is not None and _is_new(rows, state, self.store) and not self.store.read(state).where(test).isEmpty()
            else:
                bad = False
            if bad:
                raise TarnError("constraint_violation", "a unique key is taken", table=d.table, columns=list(u))
        self._references(tx, d, rows)

    def _still_referred(self, tx: Transaction, state: TableState, fresh: TableState, gone: DataFrame) -> None:
        if not self.store.foreign_keys:
            return
        for other in tx.tables.values():
            for r in other.domain.refs:
                if r.table != state.domain.table:
                    continue
                values = gone.select(F.col(quote(r.target_field)).alias("_v")).dropna().distinct()
                rows = self.store.read(fresh) if other.domain.table == r.table else self.store.read(other)
                if not rows.select(F.col(quote(r.field)).alias("_v")).join(values, "_v", "left_semi").isEmpty():
                    raise TarnError("constraint_violation", "rows refer to what is deleted", table=other.domain.table, field=r.field)

    # -------------------------------------------------------------------------------- graphs

    def _graph(self, tx: Transaction, graph: Graph, context: Mapping | None) -> WriteResult:
        results: dict[tuple[str, str], WriteResult] = {}
        affected, strategies = 0, {}
        for node in graph.nodes:
            written = []
            for row in node.rows:
                command = materialize(row, lambda b: _from_result(results, b))
                needed = [b.from_field for n in graph.nodes for r in n.rows for b in r.bindings if (b.from_node, b.from_row) == (node.id, row.id)]
                result = self._command(tx, _also_returning(command, needed), context)
                results[node.id, row.id] = result
                affected += result.affected_rows
                written.append((command, result))
            if node.delete_missing is not None:
                affected += self._delete_missing(tx, node, written, context)
            strategies[node.id] = "ordered_fallback"
        return WriteResult("graph", affected, results[graph.root].rows, {"dialect": DIALECT, "atomic": True, "node_strategies": strategies})

    def _delete_missing(self, tx: Transaction, node: Node, written: Sequence, context: Mapping | None) -> int:
        """Rows of the node's scope (equal scope fields) that this write did not touch go."""
        domain = tx.state(node.relation).domain
        key = domain.key or ((domain.generated,) if domain.generated else ())
        if not written or not key:
            return 0
        scope = [("eq", ("field", f), ("literal", _value_of(written[0], f, context))) for f in node.delete_missing]
        kept = [("and", [("eq", ("field", k), ("literal", r.get(k))) for k in key]) for _, w in written for r in w.rows if all(k in r for k in key)]
        predicate = ("and", [*scope, ("not", ("or", kept))] if kept else scope)
        return self._command(tx, Command("delete", node.relation, predicate=predicate), context).affected_rows

    # ------------------------------------------------------------------------------- preview

    def preview(self, write: Command | Batch | Graph, context: Mapping | None = None) -> Preview:
        """What would be done: no action runs and nothing is staged."""
        if isinstance(write, Command):
            return Preview([_statement(check(write, context))], {"dialect": DIALECT})
        if isinstance(write, Batch):
            return Preview([_statement(check(c, context)) for c in write.commands], {"dialect": DIALECT, "atomic": True})
        if isinstance(write, Graph):
            _check_graph(write)
            out = []
            for node in write.nodes:
                for row in node.rows:
                    symbolic = materialize(row, lambda b: f"<{b.from_node}.{b.from_row}.{b.from_field}>")
                    out.append(_statement(check(symbolic, context)))
                if node.delete_missing is not None:
                    out.append({"text": f"DELETE FROM {quote(node.relation)} WHERE rows of the scope {list(node.delete_missing)} that were not written", "params": []})
            return Preview(out, {"dialect": DIALECT, "atomic": True, "graph": True})
        raise TarnError("invalid_command", "expected a write command, batch or graph", actual=write)


def _is_now(checked: Checked, name: str) -> bool:
    return any(n == name and k == "now" for n, k, _ in checked.assignments)


def _is_new(rows: DataFrame, state: TableState, store: Store) -> bool:
    """Whether the rows are not read from the table's own files (changed rows are)."""
    return not rows.inputFiles()


def _from_result(results: Mapping, b: Binding) -> Any:
    result = results.get((b.from_node, b.from_row))
    if result is None or not result.rows or b.from_field not in result.rows[0]:
        raise TarnError("invalid_command", "a binding has no value", binding=b)
    return result.rows[0][b.from_field]


def materialize(row: Row, value: Callable[[Binding], Any]) -> Command:
    """The row's command with its bindings as literals."""
    bound = tuple((b.field, ("literal", value(b))) for b in row.bindings)
    names = {n for n, _ in bound}
    kept = tuple(a for a in row.command.assignments if (a.get("field") if isinstance(a, Mapping) else a[0]) not in names)
    return replace(row.command, assignments=kept + bound)


def _also_returning(command: Command, names: Sequence[str]) -> Command:
    own = _returning(command.returning)
    return command if own == "*" or not names else replace(command, returning=list(dict.fromkeys([*(own or []), *names])))


def _value_of(written: tuple[Command, WriteResult], name: str, context: Mapping | None) -> Any:
    command, result = written
    for pair in command.assignments:
        n, v = (pair["field"], pair["value"]) if isinstance(pair, Mapping) else pair
        if n == name:
            return scalar(v, context)[1]
    if result.rows and name in result.rows[0]:
        return result.rows[0][name]
    raise TarnError("invalid_command", "the scope of delete_missing has no value", field=name)


def _check_graph(graph: Graph) -> None:
    seen: set[tuple[str, str]] = set()
    for node in graph.nodes:
        for row in node.rows:
            for b in row.bindings:
                if (b.from_node, b.from_row) not in seen:
                    raise TarnError("invalid_command", "a binding refers to a row that is not written before", binding=b)
        seen |= {(node.id, r.id) for r in node.rows}
    if graph.root not in seen:
        raise TarnError("invalid_command", "the graph's root is not one of its rows", root=graph.root)


def _statement(checked: Checked) -> dict[str, Any]:
    c = checked.command
    shown = lambda kind, v: {"literal": "?", "now": "current_timestamp()"}.get(kind) or quote(v)
    names = ", ".join(quote(n) for n, _, _ in checked.assignments)
    values = ", ".join(shown(k, v) for _, k, v in checked.assignments)
    guards = [f"EXISTS (SELECT 1 FROM {quote(r)} WHERE {quote(f)} = ?)" for r, f, _ in checked.guards]
    if c.operation in ("insert", "upsert"):
        text = f"INSERT INTO {quote(c.relation)} ({names}) " + (f"SELECT {values} WHERE {' AND '.join(guards)}" if guards else f"VALUES ({values})")
        if c.operation == "upsert":
            sets = ", ".join(f"{quote(n)} = EXCLUDED.{quote(n)}" for n in checked.update_fields)
            text += f" ON CONFLICT ({', '.join(map(quote, checked.conflict_target))}) " + (f"DO UPDATE SET {sets}" if sets else "DO NOTHING")
    else:
        where = " AND ".join([_shown(c.predicate, shown), *guards])
        sets = ", ".join(f"{quote(n)} = {shown(k, v)}" for n, k, v in checked.assignments)
        text = f"UPDATE {quote(c.relation)} SET {sets} WHERE {where}" if c.operation == "update" else f"DELETE FROM {quote(c.relation)} WHERE {where}"
    if checked.returning:
        text += " RETURNING " + ("*" if checked.returning == "*" else ", ".join(map(quote, checked.returning)))
    return {"text": text, "params": checked.parameters}


def _shown(p: Any, shown: Callable) -> str:
    name = lambda f: quote(f if isinstance(f, str) else f[1])
    value = lambda v: quote(v[1]) if isinstance(v, tuple) and v and v[0] == "field" else "current_timestamp()" if v == ("literal", ("system", "now")) else "?"
    if p[0] in ("and", "or"):
        return "(" + f" {p[0].upper()} ".join(_shown(x, shown) for x in p[1]) + ")"
    if p[0] == "not":
        return f"NOT ({_shown(p[1], shown)})"
    if p[0] in ("is_null", "not_null"):
        return f"{name(p[1])} IS {'NOT ' if p[0] == 'not_null' else ''}NULL"
    if p[0] == "in":
        return f"{name(p[1])} IN ({', '.join(map(value, p[2]))})"
    symbol = {"eq": "=", "neq": "!=", "gt": ">", "gte": ">=", "lt": "<", "lte": "<=", "like": "ILIKE", "not_like": "NOT ILIKE"}.get(p[0], p[0])
    return f"{name(p[1])} {symbol} {value(p[2])}"
