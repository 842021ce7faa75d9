"""Sources: raw log text, stored Gold data and step logs, events-derived lines."""

from logstrata.sources.events_log import access_log_line, access_log_lines
from logstrata.sources.tables import load_gold, step_rows_frame
from logstrata.sources.text import read_logs

__all__ = [
    "access_log_line",
    "access_log_lines",
    "load_gold",
    "step_rows_frame",
    "read_logs",
]
