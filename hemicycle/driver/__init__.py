"""The given tables in the roles of the civic tables, and the queries registered over them."""

from hemicycle.driver import (  # noqa: F401
    json_queries,
    normalise_queries,
    operator_queries,
    page_queries,
    raw_queries,
    relation_queries,
    store_queries,
    stream_queries,
)
from hemicycle.driver.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
