"""Bronze -> Silver -> Gold: pure, row-wise ``DataFrame -> DataFrame`` steps.

Both steps are narrow projections (no shuffle, row count unchanged, bad lines
kept), so they fuse with the text scan and the Parquet write into a single
whole-stage-codegen stage, and they work unchanged on a streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from logstrata.functions import enrich, parse


def bronze_to_silver(bronze: DataFrame, line_column: str = "value") -> DataFrame:
    """Raw lines -> IP, Timestamp, Method, URI, Protocol, Status, Bytes.

    Two projections: line-wide regexes first (once each), then the request
    parts and the typed size from the short tokens (see ``functions.parse``).
    """
    return bronze.select(*parse.silver_tokens(line_column)).select(*parse.silver_from_tokens())


def silver_to_gold(silver: DataFrame) -> DataFrame:
    """Add Date, Day_of_Week, Day_of_Week_Name, Categoria_Status, Endpoint.

    Three projections so that each derived value is computed once; Catalyst
    keeps them as separate ``Project`` nodes inside one codegen stage instead
    of repeating the regex and date parse in every dependent column.
    """
    with_date = silver.withColumn("Date", enrich.log_date("Timestamp"))
    with_day = with_date.withColumn("Day_of_Week", enrich.day_of_week("Date"))
    return with_day.withColumns(
        {
            "Day_of_Week_Name": enrich.weekday_name("Day_of_Week"),
            "Categoria_Status": enrich.status_category("Status"),
            "Endpoint": enrich.endpoint("URI"),
        }
    )


def bronze_to_gold(bronze: DataFrame, line_column: str = "value") -> DataFrame:
    return silver_to_gold(bronze_to_silver(bronze, line_column))
