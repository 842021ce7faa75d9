"""DuckDB SQL for every registered query, used as the correctness oracle.

Each statement rebuilds the access log from ``events`` with the same rule
(in SQL), parses and enriches it with DuckDB's own regex and date functions,
and computes the expected result.  Column names and types match the Spark
side: ``count(*)`` is BIGINT, ``sum(int)`` is cast to BIGINT, DuckDB's
``dayofweek`` is 0-based (Sunday = 0) so 1 is added.
"""

from __future__ import annotations

from logstrata import constants as C
from logstrata.catalog import REQUEST_FILTER
from logstrata.sources import events_log as R


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _case(expr: str, pairs, default: str | None = None) -> str:
    body = " ".join(f"WHEN {expr} = {k} THEN {v}" for k, v in pairs)
    tail = f" ELSE {default}" if default is not None else ""
    return f"CASE {body}{tail} END"


def _lines_sql() -> str:
    e, u = "event_id", "user_id"
    host = f"'10.0.' || CAST({u} % {R.HOST_MODS[0]} AS VARCHAR) || '.' || CAST({u} % {R.HOST_MODS[1]} AS VARCHAR)"
    ident = f"CASE WHEN {e} % {R.NUMERIC_IDENT_MOD} = 0 THEN ' - 123 ' ELSE ' - - ' END"
    time = f"CASE WHEN {e} % {R.BAD_DATE_MOD} = 0 THEN {_q(R.BAD_DATE)} ELSE strftime(ts, '%d/%b/%Y:%H:%M:%S') END"
    method = _case("event_type", [(_q(k), _q(v)) for k, v in R.METHOD_BY_EVENT_TYPE.items()], _q(R.DEFAULT_METHOD))
    uris = []
    for i, text in enumerate(R.URIS_BY_E_MOD_12):
        value = f"{_q(text)} || CAST({e} % {R.PRODUCT_MOD} AS VARCHAR)" if i == 2 else _q(text)
        uris.append((i, value))
    uri = _case(f"{e} % {len(R.URIS_BY_E_MOD_12)}", uris)
    proto = f"CASE {e} % {R.PROTO_MOD} WHEN 0 THEN ' HTTP/1.0' WHEN 1 THEN '' ELSE ' HTTP/1.1' END"
    err = _case(f"{e} % {len(R.ERROR_STATUSES_BY_E_MOD_5)}", list(enumerate(R.ERROR_STATUSES_BY_E_MOD_5)))
    other = _case(f"{e} % 9", list(R.OTHER_STATUS_BY_E_MOD_9.items()), str(R.DEFAULT_STATUS))
    status = f"CAST(CASE WHEN event_type = 'error' THEN {err} ELSE {other} END AS VARCHAR)"
    size = (
        f"CASE WHEN {e} % {R.DASH_BYTES_MOD} = 0 THEN '-' "
        f"WHEN {e} % {R.HUGE_BYTES_MOD} = 0 THEN {_q(R.HUGE_BYTES)} "
        f"ELSE CAST(({e} * {R.BYTES_FACTOR}) % {R.BYTES_MOD} AS VARCHAR) END"
    )
    tail = f"CASE WHEN {e} % {R.TAIL_MOD} = 0 THEN {_q(R.TAIL)} ELSE '' END"
    regular = (
        f"{host} || {ident} || '[' || {time} || {_q(R.ZONE + '] \"')} || {method} || ' ' || {uri} || {proto}"
        f" || '\" ' || {status} || ' ' || {size} || {tail}"
    )
    return (
        f"SELECT CASE WHEN {e} % {R.EMPTY_LINE_MOD} = 0 THEN '' "
        f"WHEN {e} % {R.GARBAGE_LINE_MOD} = 0 THEN {_q(R.GARBAGE_LINE)} "
        f"ELSE {regular} END AS value FROM events"
    )


def _silver_sql() -> str:
    return (
        "SELECT "
        f"regexp_extract(value, {_q(C.IP_PATTERN)}, 1) AS \"IP\", "
        f"regexp_extract(value, {_q(C.TIMESTAMP_PATTERN)}, 1) AS \"Timestamp\", "
        f"regexp_extract(value, {_q(C.REQUEST_PATTERN)}, 1) AS \"Method\", "
        f"regexp_extract(value, {_q(C.REQUEST_PATTERN)}, 2) AS \"URI\", "
        f"regexp_extract(value, {_q(C.REQUEST_PATTERN)}, 3) AS \"Protocol\", "
        f"regexp_extract(value, {_q(C.STATUS_PATTERN)}, 1) AS \"Status\", "
        f"try_cast(regexp_extract(value, {_q(C.BYTES_PATTERN)}, 1) AS INTEGER) AS \"Bytes\" "
        "FROM lines"
    )


def _gold_sql() -> str:
    names = " ".join(f"WHEN {k} THEN {_q(v)}" for k, v in C.WEEKDAY_NAMES.items())
    cats = " ".join(
        f"WHEN try_cast(\"Status\" AS INTEGER) >= {lo} AND try_cast(\"Status\" AS INTEGER) < {hi} THEN {_q(label)}"
        for lo, hi, label in C.STATUS_CATEGORIES
    )
    endpoint = (
        f"CASE WHEN \"URI\" = {_q(C.HOME_URI)} THEN {_q(C.HOME_ENDPOINT)} "
        f"WHEN regexp_matches(\"URI\", {_q(C.FILE_URI_PATTERN)}) THEN '' "
        f"ELSE regexp_extract(\"URI\", {_q(C.FIRST_SEGMENT_PATTERN)}, 1) END"
    )
    dated = (
        "SELECT *, CAST(try_strptime(regexp_extract(\"Timestamp\", "
        f"{_q(C.DATE_TOKEN_PATTERN)}, 1), '%d/%b/%Y') AS DATE) AS \"Date\" FROM silver"
    )
    with_day = "SELECT *, CAST(dayofweek(\"Date\") + 1 AS INTEGER) AS \"Day_of_Week\" FROM dated"
    return (
        f"WITH dated AS ({dated}), with_day AS ({with_day}) "
        "SELECT \"IP\", \"Timestamp\", \"Method\", \"URI\", \"Protocol\", \"Status\", \"Bytes\", \"Date\", "
        f"\"Day_of_Week\", CASE \"Day_of_Week\" {names} ELSE {_q(C.UNKNOWN_WEEKDAY)} END AS \"Day_of_Week_Name\", "
        f"CASE {cats} ELSE {_q(C.UNKNOWN_CATEGORY)} END AS \"Categoria_Status\", "
        f"{endpoint} AS \"Endpoint\" FROM with_day"
    )


def prelude() -> str:
    return f"WITH lines AS ({_lines_sql()}), silver AS ({_silver_sql()}), gold AS ({_gold_sql()}) "


CLIENT_ERRORS = f"\"Categoria_Status\" = {_q(C.CLIENT_ERROR)}"


def _ranked(key: str, where: str = "", k: int | None = None) -> str:
    flt = f" WHERE {where}" if where else ""
    lim = f" LIMIT {k}" if k is not None else ""
    return (
        f"SELECT \"{key}\", count(*) AS \"count\" FROM gold{flt} GROUP BY \"{key}\" "
        f"ORDER BY \"count\" DESC, \"{key}\" ASC NULLS FIRST{lim}"
    )


def _distinct(column: str, name: str) -> str:
    return f"SELECT count(*) AS {name} FROM (SELECT DISTINCT \"{column}\" FROM gold) d"


def _distinct_with_null(column: str) -> str:
    return (
        f"CAST(count(DISTINCT \"{column}\") + coalesce(max(CASE WHEN \"{column}\" IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT)"
    )


def _request_filter_sql() -> str:
    f = REQUEST_FILTER
    methods = ", ".join(_q(m) for m in f["method"])
    return (
        f"\"Method\" IN ({methods}) AND \"Categoria_Status\" = {_q(f['status_category'])} "
        f"AND \"Date\" >= DATE {_q(f['date_from'])} AND \"Date\" <= DATE {_q(f['date_to'])}"
    )


def _audit_counts() -> str:
    """Expected record counts of the step log, computed from the data."""
    return (
        "SELECT count(*) AS n_lines, "
        "'Without request: ' || count(*) FILTER (\"Method\" = '' AND \"URI\" = '') || ', without size: ' || count(*) FILTER (\"Bytes\" IS NULL) AS silver_message, "
        "'Without date: ' || count(*) FILTER (\"Date\" IS NULL) AS gold_message, "
        f"CAST(least({C.TOP_IPS_K}, count(DISTINCT \"IP\")) AS BIGINT) AS n_top_ips, "
        f"CAST(least({C.TOP_ENDPOINTS_K}, count(DISTINCT CASE WHEN \"Endpoint\" <> '' THEN \"Endpoint\" END)) AS BIGINT) AS n_top_endpoints, "
        f"{_distinct_with_null('IP')} AS n_ips, "
        f"{_distinct_with_null('Date')} AS n_days, "
        f"CAST(count(DISTINCT CASE WHEN {CLIENT_ERRORS} THEN \"Day_of_Week_Name\" END) AS BIGINT) AS n_weekdays, "
        "'Total: ' || CAST(CAST(sum(\"Bytes\") AS BIGINT) AS VARCHAR) || ', Máximo: ' || CAST(max(\"Bytes\") AS VARCHAR) "
        "|| ', Mínimo: ' || CAST(min(\"Bytes\") AS VARCHAR) || ', Médio: ' || printf('%.2f', avg(\"Bytes\")) AS size_message "
        "FROM gold"
    )


# (step, count column of the Sucesso row or None, message column of the Sucesso row or None)
_STEPS = [
    (C.STEP_READ, "n_lines", None),
    (C.STEP_SILVER, "n_lines", "silver_message"),
    (C.STEP_GOLD, "n_lines", "gold_message"),
    (C.STEP_SAVE, None, None),
    (C.STEP_TRIGGER, None, None),
    (C.STEP_TABLE, "n_lines", None),
    (C.STEP_TOP_IPS, "n_top_ips", None),
    (C.STEP_TOP_ENDPOINTS, "n_top_endpoints", None),
    (C.STEP_DISTINCT_IPS, "n_ips", None),
    (C.STEP_DISTINCT_DAYS, "n_days", None),
    (C.STEP_RESPONSE_SIZE, None, "size_message"),
    (C.STEP_ERROR_WEEKDAY, "n_weekdays", None),
]


def _audit_rows(with_start: bool, with_message: bool) -> str:
    selects = []
    for step, count_col, message_col in _STEPS:
        msg_start = ", '' AS \"Message\"" if with_message else ""
        if with_start:
            selects.append(
                f"SELECT {_q(step)} AS \"PipelineStep\", {_q(C.STATUS_START)} AS \"Status\"{msg_start}, "
                "CAST(NULL AS BIGINT) AS \"RecordCount\" FROM counts"
            )
        count = count_col if count_col else "CAST(NULL AS BIGINT)"
        msg = (f", {message_col} AS \"Message\"" if message_col else ", '' AS \"Message\"") if with_message else ""
        selects.append(
            f"SELECT {_q(step)} AS \"PipelineStep\", {_q(C.STATUS_OK)} AS \"Status\"{msg}, "
            f"{count} AS \"RecordCount\" FROM counts"
        )
    return " UNION ALL ".join(selects)


def _audit(with_start: bool, with_message: bool) -> str:
    return f"{prelude()}, counts AS ({_audit_counts()}) {_audit_rows(with_start, with_message)}"


def oracle_sql() -> dict[str, str]:
    p = prelude()
    gold_all = p + "SELECT * FROM gold"
    sql = {
        "text_scan": p + "SELECT value FROM lines",
        "silver_parse": p + "SELECT * FROM silver",
        "gold_enrich": gold_all,
        "gold_from_text": gold_all,
        "endpoint_filter": p + "SELECT * FROM gold WHERE \"Endpoint\" <> ''",
        "client_error_rows": p + f"SELECT * FROM gold WHERE {CLIENT_ERRORS}",
        "top_ips": p + _ranked("IP", k=C.TOP_IPS_K),
        "top_endpoints": p + _ranked("Endpoint", "\"Endpoint\" <> ''", C.TOP_ENDPOINTS_K),
        "distinct_ips": p + _distinct("IP", "distinct_ips"),
        "distinct_days": p + _distinct("Date", "distinct_days"),
        "response_size": p
        + (
            "SELECT CAST(sum(\"Bytes\") AS BIGINT) AS total_bytes, max(\"Bytes\") AS max_bytes, "
            "min(\"Bytes\") AS min_bytes, avg(\"Bytes\") AS avg_bytes FROM gold"
        ),
        "client_errors_by_weekday": p + _ranked("Day_of_Week_Name", CLIENT_ERRORS),
        "total_requests": p + "SELECT count(\"IP\") AS total_requests FROM gold",
        "row_count": p + "SELECT count(*) AS row_count FROM gold",
        "mean_requests_per_day": p
        + "SELECT CAST(count(\"Date\") AS DOUBLE) / NULLIF(count(DISTINCT \"Date\"), 0) AS mean_requests_per_day FROM gold",
        "distinct_uris": p + _distinct("URI", "distinct_uris"),
        "requests_by_method": p + _ranked("Method"),
        "requests_by_status": p + _ranked("Categoria_Status"),
        "requests_by_protocol": p + _ranked("Protocol"),
        "requests_by_date": p
        + "SELECT \"Date\", count(*) AS \"count\" FROM gold GROUP BY \"Date\" ORDER BY \"Date\" ASC NULLS FIRST",
        "worst_error_weekday": p + _ranked("Day_of_Week_Name", CLIENT_ERRORS, 1),
        "dashboard_summary": p
        + (
            "SELECT count(\"IP\") AS total_requests, "
            f"{_distinct_with_null('IP')} AS distinct_ips, "
            "CAST(count(\"Date\") AS DOUBLE) / NULLIF(count(DISTINCT \"Date\"), 0) AS mean_requests_per_day, "
            f"{_distinct_with_null('Date')} AS distinct_days, "
            f"{_distinct_with_null('URI')} AS distinct_uris, "
            "avg(\"Bytes\") AS avg_bytes FROM gold"
        ),
        "dashboard_cube": p
        + (
            "SELECT \"Date\", \"Method\", \"Protocol\", \"Categoria_Status\", count(*) AS requests, count(\"IP\") AS with_ip, "
            "CAST(sum(\"Bytes\") AS BIGINT) AS bytes, count(\"Bytes\") AS sized FROM gold GROUP BY ALL"
        ),
        "dashboard_breakdowns": p + " UNION ALL ".join(
            f"SELECT '{panel}' AS panel, CAST(\"{column}\" AS VARCHAR) AS key, count(*) AS \"count\" FROM gold WHERE {where} GROUP BY 2"
            for panel, column, where in (
                ("method", "Method", "true"), ("status", "Categoria_Status", "true"), ("protocol", "Protocol", "true"),
                ("date", "Date", "true"), ("error_weekday", "Day_of_Week_Name", CLIENT_ERRORS),
            )
        ),
        "dashboard_totals": p
        + (
            f"SELECT count(\"IP\") AS total_requests, {_distinct_with_null('Date')} AS distinct_days, "
            "CAST(count(\"Date\") AS DOUBLE) / NULLIF(count(DISTINCT \"Date\"), 0) AS mean_requests_per_day, "
            "avg(\"Bytes\") AS avg_bytes FROM gold"
        ),
        "request_table_filtered": p + f"SELECT * FROM gold WHERE {_request_filter_sql()}",
        "parquet_publish": gold_all,
        "parquet_publish_by_date": gold_all,
        "parquet_republish_by_date": gold_all,
        "table_publish": gold_all,
        "table_publish_by_date": gold_all,
        "table_republish_by_date": gold_all,
        "csv_export": gold_all,
        "publish_manifest": "SELECT count(*) AS row_count FROM events",
        "audit_steps": _audit(with_start=True, with_message=False),
        "audit_success": _audit(with_start=False, with_message=True),
        "audit_errors": (
            f"SELECT {_q(C.STEP_READ)} AS \"PipelineStep\", {_q(C.STATUS_ERROR)} AS \"Status\", "
            "count(*) AS \"Loaded\" FROM events"
        ),
        "streaming_ingest": gold_all,
        "gold_by_path": gold_all,
    }
    for name in ("summary", "breakdowns"):
        sql[f"rollup_{name}"] = sql[f"dashboard_{name}"]
    for name in ("top_ips", "top_endpoints", "response_size"):
        sql[f"rollup_{name}"] = sql[name]
    return sql


def gold_over_lines_sql() -> str:
    """Gold rows for a caller-provided ``lines(value)`` table (used by tests)."""
    return f"WITH silver AS ({_silver_sql()}), gold AS ({_gold_sql()}) SELECT * FROM gold"
