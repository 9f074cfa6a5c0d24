"""What the engine says it can do."""

from __future__ import annotations

from typing import Any

NAME, DIALECT, PROTOCOL = "tarn", "spark", 1
SUPPORTED = {
    "json_rowset": True, "window_functions": True, "cte": True, "recursive_cte": True, "returning": True,
    "text_search": True, "rollup": False, "stream": False,
}


def supports(feature: str) -> bool:
    return SUPPORTED.get(feature, False)


def capability(feature: str) -> dict[str, Any]:
    out: dict[str, Any] = {"feature": feature, "supported": supports(feature)}
    if feature == "text_search":
        out |= {"modes": ["websearch", "boolean", "phrase"], "default_mode": "websearch", "document_type": "text_search_document", "help": "Token search with web-style, boolean and phrase queries."}
    return out


def write_capabilities(session: Any = None) -> dict[str, Any]:
    """Fails closed: without a live session there is no version, and nothing that needs one is offered."""
    try:
        version = session.spark.version if session is not None and not session.spark.sparkContext._jsc.sc().isStopped() else None
    except Exception:
        version = None
    live = version is not None
    return {
        "protocol_version": PROTOCOL, "insert": True, "update": True, "upsert": True, "delete": True, "returning": live,
        "generated_keys": "returning" if live else False, "transactions": True, "atomic_batch": True, "write_graph": live,
        "merge": False, "dialect": DIALECT, "server_version": version,
    }


def rollup_literal_order(index: int) -> str:
    return f"{index} asc"


def rollup_sort_fix() -> bool:
    return False
