"""Declared metadata of a table: columns, keys, references and text-search fields."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from .errors import TarnError
from .types import parse_type


@dataclass(frozen=True)
class Reference:
    """``field`` holds values of ``target_field`` in ``table``."""

    field: str
    table: str
    target_field: str


@dataclass(frozen=True)
class Domain:
    """``columns`` maps names to declared types; ``generated`` names the key that the store numbers."""

    table: str
    columns: dict[str, str | T.DataType]
    key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    not_null: frozenset[str] = frozenset()
    refs: tuple[Reference, ...] = ()
    generated: str | None = None
    text_search: frozenset[str] = field(default=frozenset())
    joined: frozenset[str] = frozenset()

    def __post_init__(self) -> None:
        named = {*self.key, *self.not_null, *(c for u in self.unique for c in u), *(r.field for r in self.refs)}
        if unknown := {c for c in named | ({self.generated} if self.generated else set()) if c not in self.columns}:
            raise TarnError("invalid_domain", "constraints name unknown columns", columns=sorted(unknown))

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, parse_type(t)) for c, t in self.columns.items()])

    @property
    def uniques(self) -> tuple[tuple[str, ...], ...]:
        return ((self.key,) if self.key else ()) + self.unique

    def is_text_search(self, column: str) -> bool:
        declared = self.columns.get(column)
        return column in self.text_search or isinstance(declared, str) and declared.strip().lower() == "fts5"
