"""All bound queries."""

from __future__ import annotations

from . import aggregates, folders, incremental, joins, nested, storage, timeline  # noqa: F401
from .registry import QUERIES, TWINS

__all__ = ["QUERIES", "TWINS"]
