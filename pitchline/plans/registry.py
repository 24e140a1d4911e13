"""The named queries of the engine and their SQL."""

from . import stage_queries, state_queries  # noqa: F401  (add their queries)
from .queries import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(SQL)
