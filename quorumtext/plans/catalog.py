"""The registered queries over the reference tables."""

from __future__ import annotations

from . import ballots, layouts, relations, reports, sequences, texts  # noqa: F401  (they register)
from .registry import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
