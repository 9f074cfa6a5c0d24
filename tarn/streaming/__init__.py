"""Streams are refused, as the capability map says; use Structured Streaming on the tables directly."""

from __future__ import annotations

from typing import Any

from ..errors import unsupported


def stream(*_: Any, **__: Any) -> Any:
    raise unsupported("stream", "streaming is not supported")
