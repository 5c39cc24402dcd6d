"""Registered queries, each next to the SQL that must give the same rows."""

from answerloom.registry import answers, corpus, retrieval, storage, training  # noqa: F401
from answerloom.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
