"""Operators of a training-data pipeline: deduplication, tokens, language, search, packing, sharding.

Nothing outside this package imports it.  ``QUERIES`` and ``ORACLE_SQL`` are
its registered queries and the DuckDB SQL of those that SQL can express.
"""

from logstrata.llm.queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
