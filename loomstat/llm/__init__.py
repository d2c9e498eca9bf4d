"""Operators of a training-data pipeline; nothing else in the library needs them."""

from loomstat.llm.queries import ORACLE, QUERIES  # noqa: F401
