"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from ..session import ship

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (spark, sf_dir) under its name, with its SQL if it has one."""

    def keep(f):
        @wraps(f)
        def run(spark, sf_dir):
            ship(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def with_(common: str, body: str) -> str:
    return f"WITH {common}\n{body}"
