from .queries import queries
from .oracle import oracle_sql

__all__ = ["queries", "oracle_sql"]
