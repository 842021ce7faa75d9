"""Schemas of every layer; column order is part of the contract."""

from pyspark.sql import types as T

BRONZE_SCHEMA = T.StructType([T.StructField("value", T.StringType(), True)])

SILVER_SCHEMA = T.StructType(
    [
        T.StructField("IP", T.StringType(), True),
        T.StructField("Timestamp", T.StringType(), True),
        T.StructField("Method", T.StringType(), True),
        T.StructField("URI", T.StringType(), True),
        T.StructField("Protocol", T.StringType(), True),
        T.StructField("Status", T.StringType(), True),
        T.StructField("Bytes", T.IntegerType(), True),
    ]
)

GOLD_SCHEMA = T.StructType(
    SILVER_SCHEMA.fields
    + [
        T.StructField("Date", T.DateType(), True),
        T.StructField("Day_of_Week", T.IntegerType(), True),
        T.StructField("Day_of_Week_Name", T.StringType(), True),
        T.StructField("Categoria_Status", T.StringType(), True),
        T.StructField("Endpoint", T.StringType(), True),
    ]
)

SILVER_COLUMNS = [f.name for f in SILVER_SCHEMA.fields]
GOLD_COLUMNS = [f.name for f in GOLD_SCHEMA.fields]

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("Timestamp", T.StringType(), False),
        T.StructField("PipelineStep", T.StringType(), False),
        T.StructField("Status", T.StringType(), False),
        T.StructField("Message", T.StringType(), True),
        T.StructField("RecordCount", T.LongType(), True),
    ]
)

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("row_count", T.LongType(), False),
        T.StructField("published_at", T.StringType(), False),
        T.StructField("version", T.LongType(), False),
    ]
)
