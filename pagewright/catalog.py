"""Registry of the engine's queries and of the SQL that must give the same rows."""

from .queries import QUERIES
from .sql import ORACLE

__all__ = ["ORACLE", "QUERIES"]
