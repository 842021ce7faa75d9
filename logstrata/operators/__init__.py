"""Relational operators: the Silver/Gold layers, analyses and the request table."""

from logstrata.operators.layers import bronze_to_gold, bronze_to_silver, silver_to_gold
from logstrata.operators.metrics import (
    client_errors_by_weekday,
    dashboard_summary,
    distinct_days,
    distinct_ips,
    distinct_uris,
    group_count,
    mean_requests_per_day,
    ranked,
    requests_by_date,
    requests_by_method,
    requests_by_protocol,
    requests_by_status,
    response_size,
    row_count,
    top_endpoints,
    top_ips,
    total_requests,
    worst_error_weekday,
)
from logstrata.operators.requests import request_table

__all__ = [
    "bronze_to_gold",
    "bronze_to_silver",
    "silver_to_gold",
    "client_errors_by_weekday",
    "dashboard_summary",
    "distinct_days",
    "distinct_ips",
    "distinct_uris",
    "group_count",
    "mean_requests_per_day",
    "ranked",
    "requests_by_date",
    "requests_by_method",
    "requests_by_protocol",
    "requests_by_status",
    "response_size",
    "row_count",
    "top_endpoints",
    "top_ips",
    "total_requests",
    "worst_error_weekday",
    "request_table",
]
