"""K2: publish a DataFrame as an external catalog table, without a moment in which it is missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from logstrata.schemas import GOLD_SCHEMA
from logstrata.sinks.files import arranged, write_files
from logstrata.sinks.versions import Versions

#: Formats that replace a table's data by a transaction of their own.
TRANSACTIONAL = frozenset({"delta", "iceberg", "hudi"})


def publish_table(
    df: DataFrame,
    table_name: str,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
) -> None:
    """Write ``df`` under ``path`` and (re)point table ``table_name`` to it.

    The result is an EXTERNAL table readable by name, and by path with
    ``load_gold(path=...)``.  A rerun writes a version beside the one being
    read (:mod:`logstrata.sinks.versions`) and then moves the table to it, so
    readers find the old data or the new, never none and no mixture.
    ``fmt="delta"`` works where the package is installed; such formats have
    transactions of their own and are written in place, as is an append.
    """
    spark = df.sparkSession
    if fmt in TRANSACTIONAL or (mode != "overwrite" and not spark.catalog.tableExists(table_name)):
        writer = df.write.format(fmt).mode(mode).option("path", path).option("partitionOverwriteMode", "static")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table_name)
        return
    if mode != "overwrite":
        writer = df.write.format(fmt).mode(mode)
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table_name)
        return
    versions = Versions(spark, path)
    with versions.writing() as version:
        write_files(arranged(df, partition_by=partition_by), version.path, fmt, partition_by=partition_by)
        versions.commit(version)
    point_table(spark, table_name, versions, fmt, partition_by, df.schema)
    versions.prune()


def point_table(
    spark: SparkSession, table_name: str, versions: Versions, fmt: str = "parquet", partition_by: Sequence[str] | None = None, schema: StructType = GOLD_SCHEMA
) -> str:
    """Move the table to the current version; returns its path.

    Publishers that end at the same time all come to the newest version: each
    looks again after it has moved the table.
    """
    path = None
    while path != (latest := versions.latest()["path"]):
        path = latest
        register_table(spark, table_name, path, fmt, partition_by, schema)
    return path


def register_table(
    spark: SparkSession,
    table_name: str,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
    schema: StructType = GOLD_SCHEMA,
) -> None:
    """Point table ``table_name`` at data already written to ``path``.

    Metadata only: no data is read or rewritten, so publishing the Gold
    files as a table costs nothing at any scale.  A table of the same format,
    columns and partition columns gets a new location in one catalog change;
    any other is replaced.  Partitions are found in the folder names of the
    location, not kept in the catalog, so they change with it.  The schema is
    stated: an empty or wholly undated log registers with the same types, and
    no file is sampled to find them.
    """
    location = path.replace("'", "\\'")
    if spark.catalog.tableExists(table_name) and _shape(spark, table_name) == _wanted(fmt, partition_by, schema):
        spark.sql(f"ALTER TABLE {table_name} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table_name)
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    own = spark.newSession()  # for a setting of its own; the catalog is shared
    own.conf.set("spark.sql.hive.manageFilesourcePartitions", "false")
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    own.sql(f"DROP TABLE IF EXISTS {table_name}")
    own.sql(f"CREATE TABLE {table_name} ({columns}) USING {fmt}{by} LOCATION '{location}'")
    spark.catalog.refreshTable(table_name)


def _wanted(fmt: str, partition_by: Sequence[str] | None, schema: StructType) -> tuple:
    return fmt.lower(), {f.name.lower(): f.dataType.simpleString() for f in schema}, [c.lower() for c in partition_by or ()], False


def _shape(spark: SparkSession, table_name: str) -> tuple:
    """Format, columns, partition columns and whether the catalog keeps the partitions."""
    rows = [(r[0], r[1]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table_name}").collect()]  # one row a column
    names = [n for n, _ in rows]
    columns = rows[: next((i for i, n in enumerate(names) if not n or n.startswith("#")), len(rows))]
    facts = dict(rows[names.index("# Detailed Table Information"):] if "# Detailed Table Information" in names else [])
    by = []
    if "# Partition Information" in names:
        for name, _ in rows[names.index("# Partition Information") + 2:]:
            if not name or name.startswith("#"):
                break
            by.append(name.lower())
    return str(facts.get("Provider", "")).lower(), {n.lower(): t for n, t in columns}, by, facts.get("Partition Provider") == "Catalog"
