"""Operators for training-data pipelines; nothing else in the library imports this subpackage."""

from tabforge.llm.queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
