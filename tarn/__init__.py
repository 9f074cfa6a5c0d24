"""A query and data-processing engine on Spark DataFrames."""

import importlib.util

from .errors import MissingDependency, TarnError

if importlib.util.find_spec("pyspark") is None:
    raise MissingDependency("pyspark")

from .domain import Domain, Reference  # noqa: E402
from .plans.capabilities import capability, supports, write_capabilities  # noqa: E402
from .plans.statements import Statements  # noqa: E402
from .plans.writes import Batch, Binding, Command, Graph, Node, Row, Writer  # noqa: E402
from .query import Query  # noqa: E402
from .session import Result, Session, connect, disconnect  # noqa: E402
from .sources.store import Store  # noqa: E402

__all__ = [
    "Batch", "Binding", "Command", "Domain", "Graph", "MissingDependency", "Node", "Query", "Reference", "Result", "Row", "Session", "Statements", "Store",
    "TarnError", "Writer", "capability", "connect", "disconnect", "supports", "write_capabilities",
]
