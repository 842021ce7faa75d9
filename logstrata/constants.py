"""Fixed values of the access-log contract.

Everything in this module must stay exactly as written: the parsed columns,
the labels and the step names are compared value by value with results
produced by the original pipeline, so changing any of them changes results.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: line patterns (Java regex, group 1 unless stated otherwise).
# ---------------------------------------------------------------------------
IP_PATTERN = r"^(\S+)"
TIMESTAMP_PATTERN = r"\[(.*?)\]"
REQUEST_PATTERN = r"\"(\S+)\s(\S+)\s*(\S*)\""  # groups: 1 method, 2 URI, 3 protocol
STATUS_PATTERN = r"\s(\d{3})\s"
BYTES_PATTERN = r"\s(\d+)$"

# Derived forms of the fixed patterns, used by the Silver projection because
# they give the same groups with less work (tests/test_equivalence.py checks
# them against the fixed patterns on adversarial text):
#  * the request is matched once (group 0) and the three parts are read from
#    that short match with the pattern anchored at both ends;
#  * the trailing size is found by backtracking from the end of the line
#    instead of trying every whitespace from the start.  DOTALL lets ``.``
#    cross any line terminator, so the only possible match is the same one.
#  * an ordinary line holds few quotes and brackets.  From each quote the short
#    request pattern reads the line at most twice, from each bracket the fixed
#    timestamp pattern reads it once, so up to FEW_MARKS of them (or a line of
#    at most SHORT_LINE bytes) take time linear in the line;
#  * in longer lines with more, the request and the timestamp are looked for once in
#    each run of non-blank characters and once in each stretch without a line
#    terminator, from its first quote or bracket: if that one cannot match, no
#    later one in the same stretch can.  Possessive quantifiers never give
#    back, so the time is linear in the line, however many marks it holds.
FEW_MARKS = 8
SHORT_LINE = 256
REQUEST_SHORT_PATTERN = r"\"\S++\s(?:\S++\s++\S*\"|\S+\")"
REQUEST_TOKEN_PATTERN = r"(?:^|(?<=\s))[^\s\"]*+(\"\S++\s(?:\S++\s++\S*\"|\S+\"))"
_LINE_ENDS = r"\n\r\u0085\u2028\u2029"
TIMESTAMP_FIRST_PATTERN = rf"(?:^|(?<=[{_LINE_ENDS}]))[^\[{_LINE_ENDS}]*+\[([^\]{_LINE_ENDS}]*+)\]"
REQUEST_PARTS_PATTERN = "^" + REQUEST_PATTERN + "$"
BYTES_FROM_END_PATTERN = r"(?s)^.*\s(\d+)$"
INT_SAFE_DIGITS = 9  # any run of at most 9 ASCII digits fits in a 32-bit int

# FIXED VALUES: Gold derivations.
DATE_TOKEN_PATTERN = r"^(.*?)\:"
DATE_FORMAT = "dd/MMM/yyyy"
FILE_URI_PATTERN = r"\.\w+$"
FIRST_SEGMENT_PATTERN = r"^/([^/]+)(?:/|$)"
HOME_URI = "/"
HOME_ENDPOINT = "home-page"

# FIXED VALUES: weekday names by Spark's dayofweek (1 = Sunday ... 7 = Saturday).
WEEKDAY_NAMES = {
    1: "Domingo",
    2: "Segunda",
    3: "Terça",
    4: "Quarta",
    5: "Quinta",
    6: "Sexta",
    7: "Sábado",
}
UNKNOWN_WEEKDAY = "desconhecido"

# FIXED VALUES: status categories, half-open ranges [low, high).
STATUS_CATEGORIES = [
    (200, 300, "Sucesso"),
    (300, 400, "Redirecionamento"),
    (400, 500, "Erro do Cliente"),
    (500, 600, "Erro do Servidor"),
]
UNKNOWN_CATEGORY = "Desconhecido"
CLIENT_ERROR = "Erro do Cliente"

# FIXED VALUES: pipeline step names and step statuses of the audit log.
STEP_READ = "Read Access Logs"
STEP_SILVER = "Bronze to Silver"
STEP_GOLD = "Silver to Gold"
STEP_SAVE = "Save to Blob"
STEP_TRIGGER = "Trigger"
STEP_TABLE = "Full Load to Delta"
STEP_TOP_IPS = "Top 10 - IP Count"
STEP_TOP_ENDPOINTS = "Top 6 - Endpoints Count"
STEP_DISTINCT_IPS = "Distinct IPs"
STEP_DISTINCT_DAYS = "Distinct Days"
STEP_RESPONSE_SIZE = "Byte das Respostas"
STEP_ERROR_WEEKDAY = "Dia das Semana com Mais Erros"

STATUS_START = "Inicio"
STATUS_OK = "Sucesso"
STATUS_ERROR = "Erro"

# FIXED VALUES: top-k sizes of the two ranking analyses.
TOP_IPS_K = 10
TOP_ENDPOINTS_K = 6

# Name of the view that ad-hoc SQL over a stored table sees.
SQL_VIEW_NAME = "logs_temp"

# Texts of the layer messages (Python format fields), beside the row count.
SILVER_MESSAGE = "Without request: {no_request}, without size: {no_size}"
GOLD_MESSAGE = "Without date: {no_date}"

# FIXED VALUES: text of the response-size step message (Python format fields).
RESPONSE_SIZE_MESSAGE = "Total: {total}, Máximo: {maximum}, Mínimo: {minimum}, Médio: {mean}"
