"""Column expressions: parsing (Silver), enrichment (Gold) and predicates."""

from logstrata.functions import enrich, parse, predicates

__all__ = ["enrich", "parse", "predicates"]
