"""All queries of the library by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from .oracles import ORACLES
from .queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
