"""A versioned table store on Parquet files: copy-on-write by file, published by one atomic rename.

A manifest lists each table's files, its next generated key and its domain.  A writer adds files under new
names and replaces the manifest; readers of an older manifest keep reading its files.  An insert adds
files only; an update or delete rewrites just the files that hold a matching row.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..domain import Domain, Reference
from ..errors import TarnError


@dataclass(frozen=True)
class TableState:
    domain: Domain
    files: tuple[str, ...] = ()
    next_key: int = 1


def _domain_json(d: Domain) -> dict[str, Any]:
    return {"table": d.table, "schema": d.schema.jsonValue(), "key": d.key, "unique": d.unique, "not_null": sorted(d.not_null), "refs": [[r.field, r.table, r.target_field] for r in d.refs], "generated": d.generated, "text_search": sorted(d.text_search)}


def _domain_from(j: dict[str, Any]) -> Domain:
    schema = T.StructType.fromJson(j["schema"])
    return Domain(j["table"], {f.name: f.dataType for f in schema}, tuple(j["key"]), tuple(map(tuple, j["unique"])), frozenset(j["not_null"]), tuple(Reference(*r) for r in j["refs"]), j["generated"], frozenset(j["text_search"]))


class Store:
    """One folder, reached through Hadoop's file systems, so any store that Spark writes to will do."""

    def __init__(self, spark: SparkSession, root: str, *, foreign_keys: bool = True, busy_timeout: int = 0) -> None:
        self.spark, self.root, self.foreign_keys, self.busy_timeout = spark, root.rstrip("/"), foreign_keys, busy_timeout
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self.fs.mkdirs(self.path(self.root))

    # ----------------------------------------------------------------------------- manifest

    def load(self) -> dict[str, TableState]:
        at = self.path(f"{self.root}/manifest.json")
        if not self.fs.exists(at):
            return {}
        stream = self.fs.open(at)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {n: TableState(_domain_from(t["domain"]), tuple(t["files"]), t["next_key"]) for n, t in json.loads(text).items()}

    def publish(self, tables: dict[str, TableState]) -> None:
        text = json.dumps({n: {"domain": _domain_json(t.domain), "files": t.files, "next_key": t.next_key} for n, t in tables.items()})
        new, old = self.path(f"{self.root}/manifest-{uuid.uuid4().hex}.tmp"), self.path(f"{self.root}/manifest.json")
        stream = self.fs.create(new, True)
        stream.write(text.encode())
        stream.close()
        options = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
        overwrite = self.spark.sparkContext._gateway.new_array(options, 1)
        overwrite[0] = options.OVERWRITE
        context.rename(new, old, overwrite)

    @contextmanager
    def lock(self) -> Iterator[None]:
        """The only writer: a file that is created exclusively, waited for up to ``busy_timeout`` ms."""
        at, until = self.path(f"{self.root}/writer.lock"), time.monotonic() + self.busy_timeout / 1000
        while True:
            try:
                self.fs.create(at, False).close()
                break
            except Exception as e:
                if not self.fs.exists(at) and time.monotonic() >= until:
                    raise
                if time.monotonic() >= until:
                    raise TarnError("store_busy", "another writer holds the store", busy_timeout=self.busy_timeout) from e
                time.sleep(0.02)
        try:
            yield
        finally:
            self.fs.delete(at, False)

    # ------------------------------------------------------------------------------- tables

    def create(self, domain: Domain, df: DataFrame | None = None) -> Store:
        """A new table, empty or with the rows of ``df``."""
        with self.lock():
            tables = self.load()
            if domain.table in tables:
                raise TarnError("invalid_command", "the table exists", table=domain.table)
            state = TableState(domain)
            if df is not None:
                names = list(domain.columns)
                state = self.added(state, df.select(*names))
                if domain.generated:
                    top = self.read(state).agg(F.max(domain.generated)).first()[0]
                    state = replace(state, next_key=(top or 0) + 1)
            self.publish({**tables, domain.table: state})
        return self

    def read(self, state: TableState) -> DataFrame:
        if not state.files:
            return self.spark.createDataFrame([], state.domain.schema)
        return self.spark.read.schema(state.domain.schema).parquet(*state.files)

    def table(self, name: str) -> DataFrame:
        tables = self.load()
        if name not in tables:
            raise TarnError("invalid_command", "no such table", table=name)
        return self.read(tables[name])

    def written(self, df: DataFrame) -> tuple[str, ...]:
        """The files that now hold the rows of ``df``; files without rows are deleted."""
        at = f"{self.root}/data/{uuid.uuid4().hex}"
        df.write.parquet(at)
        found = [s.getPath() for s in self.fs.listStatus(self.path(at)) if s.getPath().getName().startswith("part-")]
        if len(found) > 1:
            full = {r[0].rsplit("/", 1)[1] for r in self.spark.read.schema(df.schema).parquet(at).select(F.col("_metadata.file_path")).distinct().collect()}
            for p in found:
                if p.getName() not in full:
                    self.fs.delete(p, False)
            found = [p for p in found if p.getName() in full]
        return tuple(p.toString() for p in found)

    def added(self, state: TableState, df: DataFrame) -> TableState:
        return replace(state, files=state.files + self.written(df))

    def rewritten(self, state: TableState, matched: Column, change) -> tuple[TableState, DataFrame]:
        """The state after ``change`` (DataFrame to DataFrame) of the files with a matching row; and the
        matching rows.  Other files are kept as they are."""
        rows = self.read(state)
        hits = [r[0] for r in rows.where(matched).select(F.col("_metadata.file_path")).distinct().collect()] if state.files else []
        by_path = {self.path(f).toUri().getPath(): f for f in state.files}
        touched = {by_path[self.path(h).toUri().getPath()] for h in hits}
        if not touched:
            return state, rows.where(F.lit(False))
        old = self.spark.read.schema(state.domain.schema).parquet(*sorted(touched))
        fresh = self.written(change(old))
        return replace(state, files=tuple(f for f in state.files if f not in touched) + fresh), old.where(matched)

    def without(self, state: TableState, keys: DataFrame) -> TableState:
        """The state after one rewrite of the files that hold a row whose values of ``keys``' columns are
        among its rows; other files are kept as they are."""
        names, rows = keys.columns, self.read(state)
        keys = keys.dropna().distinct()
        hits = [r[0] for r in rows.select(*names, F.col("_metadata.file_path").alias("_tarn_file")).join(keys, names, "left_semi").select("_tarn_file").distinct().collect()] if state.files else []
        if not hits:
            return state
        by_path = {self.path(f).toUri().getPath(): f for f in state.files}
        touched = {by_path[self.path(h).toUri().getPath()] for h in hits}
        old = self.spark.read.schema(state.domain.schema).parquet(*sorted(touched))
        fresh = self.written(old.join(keys, names, "left_anti").select(*state.domain.columns))
        return replace(state, files=tuple(f for f in state.files if f not in touched) + fresh)

    def compact(self, name: str, files: int = 1) -> int:
        """Rewrite a table that single-row inserts have left in many files to about ``files``; returns how many went."""
        with self.lock():
            tables = self.load()
            state = tables[name]
            if len(state.files) <= files:
                return 0
            fresh = replace(state, files=self.written(self.read(state).repartition(files)))
            self.publish({**tables, name: fresh})
            return len(state.files) - len(fresh.files)

    def vacuum(self) -> int:
        """Delete files that the manifest doesn't list; returns how many folders went."""
        with self.lock():
            live = {f.rsplit("/", 1)[0].rsplit("/", 1)[1] for t in self.load().values() for f in t.files}
            at, gone = self.path(f"{self.root}/data"), 0
            for s in self.fs.listStatus(at) if self.fs.exists(at) else ():
                if s.getPath().getName() not in live:
                    gone += bool(self.fs.delete(s.getPath(), True))
        return gone
