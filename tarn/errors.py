"""One structured error for the whole engine: a kind from a closed vocabulary, a message and details."""

from __future__ import annotations

from typing import Any

#: Every kind that the engine raises.
KINDS = frozenset(
    {
        "cardinality_mismatch", "invalid_command", "missing_predicate", "invalid_predicate", "missing_context",
        "invalid_foreign_key_guard", "execution_failed", "transaction_failed", "timeout", "unsupported_feature",
        "invalid_connection_options", "invalid_busy_timeout", "constraint_violation", "store_busy", "invalid_domain",
        "invalid_parameters", "missing_dependency",
    }
)


class TarnError(Exception):
    """``kind`` says what went wrong, ``details`` carries its values; ``feature`` names a refused one."""

    def __init__(self, kind: str, message: str, **details: Any) -> None:
        if kind not in KINDS:
            raise ValueError(f"unknown error kind {kind}")
        super().__init__(message)
        self.kind, self.message, self.details = kind, message, details

    @property
    def feature(self) -> str | None:
        return self.details.get("feature")

    def __repr__(self) -> str:
        return f"TarnError({self.kind!r}, {self.message!r}, {self.details!r})"


class MissingDependency(TarnError, ImportError):
    """A library that the engine runs on is not there."""

    def __init__(self, library: str) -> None:
        super().__init__("missing_dependency", f"{library} is needed and can't be imported", library=library)


def unsupported(feature: str, message: str, **details: Any) -> TarnError:
    return TarnError("unsupported_feature", message, feature=feature, **details)


def normalize_error(error: BaseException) -> TarnError:
    """Any exception as a TarnError; Spark's error class is kept in the details."""
    if isinstance(error, TarnError):
        return error
    condition = getattr(error, "getCondition", None) or getattr(error, "getErrorClass", None)
    name = None
    if condition is not None:
        try:
            name = condition()
        except Exception:  # an error that can't describe itself is still an error
            name = None
    text = str(error).split("\n\nJVM stacktrace")[0]
    return TarnError("execution_failed", text, condition=name, exception=type(error).__name__)
