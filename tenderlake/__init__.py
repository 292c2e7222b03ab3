"""tenderlake: public-procurement analytics as Spark DataFrame jobs."""

from .context import Lake  # noqa: F401
from .registry import oracle_sql, queries, run  # noqa: F401
