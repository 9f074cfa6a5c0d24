"""A session: tables by name over a folder of Parquet, attached folders, SQL with parameters, time limits."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from .errors import TarnError, normalize_error
from .lexer import QUOTED, braces, fill_braces
from .predicates import quote
from .types import bind

OFF = (False, 0, "off", "false", "0")
TIMEOUT_MS = 5000
_NUMBERED = re.compile(QUOTED + r"|\$(\d+)|\?", re.S)


@dataclass
class Result:
    """What a finished statement returned."""

    columns: list[str]
    rows: list[list[Any]]
    num_rows: int
    metadata: dict[str, Any] = field(default_factory=dict)

    def maps(self) -> list[dict[str, Any]]:
        return [] if self.columns == ["Count"] else [dict(zip(self.columns, r, strict=True)) for r in self.rows]


def convert_parameters(sql: str, params: Sequence[Any] | None) -> tuple[str, dict[str, Any]]:
    """``$n`` and ``?`` as named parameters; quoted text and comments are left alone.

    A number may be used often and in any order; ``?`` takes the values one after another.
    """
    values = list(params or [])
    used: dict[str, Any] = {}
    turn = iter(range(1, len(values) + 1))

    def put(m: re.Match) -> str:
        if m[1] is None and m[0] != "?":
            return m[0]
        n = int(m[1]) if m[1] else next(turn, len(values) + 1)
        if not 1 <= n <= len(values):
            raise TarnError("invalid_parameters", "a placeholder has no value", index=n, given=len(values))
        used[f"p{n}"] = values[n - 1]
        return f":p{n}"

    return _NUMBERED.sub(put, sql), used


class Session:
    """Tables of a folder (or views made in memory), reached by name; ``other.t`` reaches attached ones."""

    def __init__(self, spark: SparkSession, database: str | None = None, *, foreign_keys: Any = True, busy_timeout: int = 0) -> None:
        if isinstance(busy_timeout, bool) or not isinstance(busy_timeout, int) or busy_timeout < 0:
            raise TarnError("invalid_busy_timeout", "busy_timeout is a number of milliseconds", value=busy_timeout)
        self.spark, self.database = spark, None if database in (None, ":memory:") else database.rstrip("/")
        self.foreign_keys = not (foreign_keys.lower() if isinstance(foreign_keys, str) else foreign_keys) in OFF
        self.busy_timeout = busy_timeout
        self.attached: dict[str, str] = {}
        self.frames: dict[str, DataFrame] = {}

    # ------------------------------------------------------------------------------- tables

    def attach(self, path: str, name: str) -> Session:
        self.attached[name] = path.rstrip("/")
        return self

    def register(self, name: str, df: DataFrame) -> Session:
        """A table in memory: a name for a DataFrame."""
        self.frames[name] = df
        return self

    def table(self, name: str) -> DataFrame:
        if name in self.frames:
            return self.frames[name]
        first, _, rest = name.partition(".")
        root = self.attached.get(first) if rest else self.database
        if root is None:
            raise TarnError("invalid_command", "no such table", table=name)
        return self.spark.read.parquet(f"{root}/{rest or first}.parquet")

    def store(self, root: str | None = None) -> Any:
        """A table store with this session's settings, in the session's folder unless told otherwise."""
        from .sources.store import Store

        if root is None and self.database is None:
            raise TarnError("invalid_command", "a store needs a folder")
        return Store(self.spark, root or self.database, foreign_keys=self.foreign_keys, busy_timeout=self.busy_timeout)

    def query(self, source: str | DataFrame) -> Any:
        from .query import Query

        return Query(self, self.table(source) if isinstance(source, str) else source)

    # ---------------------------------------------------------------------------------- SQL

    def sql(self, text: str, params: Sequence[Any] | None = None, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """A lazy DataFrame of a query.  ``{name}`` (or ``{other.name}`` of an attached folder) outside quotes
        stands for a table, ``$n`` or ``?`` for a value."""
        given = tables or {}
        named = {n: given[n] if n in given else self.table(n) for n in braces(text)}
        views = {n: f"tarn_{n.replace('.', '_')}_{uuid.uuid4().hex[:8]}" for n in named}
        for n, df in named.items():
            df.createOrReplaceTempView(views[n])
        try:
            text, args = convert_parameters(fill_braces(text, lambda n: quote(views[n])), [bind(p) for p in params or []])
            return self.spark.sql(text, args=args)
        finally:
            for v in views.values():
                self.spark.catalog.dropTempView(v)

    def execute(self, text: str | DataFrame, params: Sequence[Any] | None = None, *, timeout: int = TIMEOUT_MS) -> Result:
        """Run a query to its end and bring its rows to the driver, within ``timeout`` milliseconds."""
        try:
            df = text if isinstance(text, DataFrame) else self.sql(text, params)
            rows = self.within(timeout, df.collect)
        except TarnError:
            raise
        except Exception as e:
            raise normalize_error(e) from e
        return Result(list(df.columns), [list(r) for r in rows], len(rows))

    def within(self, timeout: int, action: Callable[[], Any]) -> Any:
        """Run an action as a job group that is cancelled again and again once time is up: a cancel that
        comes before the job is submitted would be lost."""
        context, group, done, out = self.spark.sparkContext, f"tarn-{uuid.uuid4().hex}", threading.Event(), {}

        def run() -> None:
            context.setJobGroup(group, "tarn", interruptOnCancel=True)
            try:
                out["value"] = action()
            except BaseException as e:
                out["error"] = e
            finally:
                done.set()

        from pyspark import InheritableThread

        InheritableThread(target=run, daemon=True).start()
        if not done.wait(timeout / 1000):
            while not done.is_set():
                context.cancelJobGroup(group)
                done.wait(0.5)
            if "value" not in out:
                raise TarnError("timeout", "the statement took too long", timeout=timeout)
        if "error" in out:
            raise out["error"]
        return out["value"]

    def explain(self, df: DataFrame) -> str:
        return df._jdf.queryExecution().explainString(self.spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))

    def close(self) -> None:
        """Forget the names; the Spark session may be shared and stays."""
        self.frames.clear()
        self.attached.clear()


def connect(spark: SparkSession, options: Any = None) -> Session:
    """A session from a mapping of options, a folder's path, nothing (in memory), or a session itself."""
    if isinstance(options, Session):
        return options
    if options is None or isinstance(options, str):
        return Session(spark, options)
    if isinstance(options, Mapping):
        known = {"database", "foreign_keys", "busy_timeout"}
        return Session(spark, **{k: v for k, v in options.items() if k in known})
    raise TarnError("invalid_connection_options", "options are a mapping or a path", options=options)


def disconnect(session: Any) -> None:
    if isinstance(session, Session):
        session.close()
