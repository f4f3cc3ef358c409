"""Every operator as a query over the given tables, with its SQL."""

from millrace.catalog import (  # noqa: F401
    expressions,
    layers,
    reporting,
    storage,
    streams,
)
from millrace.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
