"""The queries over the given tables and their SQL twins."""

from suite import (  # noqa: F401  (register their queries)
    marts_queries,
    reach_queries,
    report_queries,
    store_queries,
    stream_queries,
    upkeep_queries,
)
from suite.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
