"""Dashboard state by day, kept beside the Gold table and renewed only for the days a run touches.

Four small tables hold all that the dashboard and the analyses need: counts
and sizes by date, method, protocol and status category; requests by date and
client, by date and URI, by date and endpoint.  Counts add up over days, and
distinct clients and URIs are exact because their keys are kept.  A renewal
reads the touched days of Gold (partitions, if Gold is partitioned by date),
writes their state as a new version and commits a marker that says where the
state of each day lies; the other days keep theirs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logstrata import constants as C
from logstrata.operators import metrics as M
from logstrata.session import list_folder
from logstrata.sinks.versions import Versions

UNDATED = "none"

_KEYS = {"clients": "IP", "uris": "URI", "endpoints": "Endpoint"}
_SCHEMAS = {
    "cube": StructType().add("Date", "date").add("Method", "string").add("Protocol", "string").add("Categoria_Status", "string")
    .add("requests", "long").add("with_ip", "long").add("bytes", "long").add("sized", "long").add("largest", "integer").add("smallest", "integer"),
    **{name: StructType().add("Date", "date").add(key, "string").add("requests", "long") for name, key in _KEYS.items()},
}


def _states(gold: DataFrame) -> dict[str, DataFrame]:
    cube = gold.groupBy("Date", "Method", "Protocol", "Categoria_Status").agg(
        F.count(F.lit(1)).alias("requests"), F.count("IP").alias("with_ip"), F.sum("Bytes").alias("bytes"),
        F.count("Bytes").alias("sized"), F.max("Bytes").alias("largest"), F.min("Bytes").alias("smallest"),
    )
    return {"cube": cube, **{name: gold.groupBy("Date", key).agg(F.count(F.lit(1)).alias("requests")) for name, key in _KEYS.items()}}


def _day(day: dt.date | str | None) -> str:
    return UNDATED if day is None else str(day)


def touched_days(rows: DataFrame) -> list[dt.date | None]:
    """The dates in ``rows`` (None for undated ones): one value a day reaches the driver."""
    return [r[0] for r in rows.select("Date").distinct().collect()]


def update_rollup(spark: SparkSession, gold: DataFrame, root: str, days: Iterable[dt.date | str | None] | None = None) -> list[str]:
    """Renew the state of ``days`` (dates; None for undated rows) from ``gold``; of everything if not given.

    Days without rows lose their state.  Readers keep the previous state until
    the new one is complete.  Two updates may run at a time if they touch
    different days.  Returns the days that now have a state.
    """
    versions = Versions(spark, root)
    renewed = None if days is None else {_day(d) for d in days}
    if renewed is not None:
        dates = sorted(renewed - {UNDATED})
        wanted = F.col("Date").isin([dt.date.fromisoformat(d) for d in dates]) if dates else F.lit(False)
        gold = gold.where(wanted | F.col("Date").isNull() if UNDATED in renewed else wanted)
    with versions.writing() as version:
        for name, state in _states(gold).items():
            by_day = state.withColumn("day", F.coalesce(F.col("Date").cast("string"), F.lit(UNDATED)))
            by_day.hint("rebalance", "day").write.partitionBy("day").parquet(f"{version.path}/{name}")
        found = {n.removeprefix("day=") for n in list_folder(spark, f"{version.path}/cube") if n.startswith("day=")}
        before = (versions.latest() or {}).get("days", {})  # read late: another update may have ended
        now = {d: folder for d, folder in before.items() if renewed is not None and d not in renewed}
        now |= {d: version.name for d in found}
        versions.commit(version, days=now, uses=sorted(set(now.values())), at_the_end=True)
    versions.prune()
    return sorted(now)


@dataclass
class Rollup:
    """The state of all days, and what follows from it (columns as in :mod:`logstrata.operators.metrics`)."""

    cube: DataFrame
    clients: DataFrame
    uris: DataFrame
    endpoints: DataFrame

    @classmethod
    def load(cls, spark: SparkSession, root: str) -> "Rollup":
        versions = Versions(spark, root)
        days = (versions.latest() or {}).get("days", {})

        def read(name: str) -> DataFrame:
            paths = [f"{versions.data(folder)}/{name}/day={day}" for day, folder in sorted(days.items())]
            return spark.read.schema(_SCHEMAS[name]).parquet(*paths) if paths else spark.createDataFrame([], _SCHEMAS[name])

        return cls(*map(read, _SCHEMAS))

    def _by(self, table: DataFrame, key: str) -> DataFrame:
        return table.groupBy(key).agg(F.sum("requests").alias("count"))

    def top_ips(self, k: int = C.TOP_IPS_K) -> DataFrame:
        """A1, D9."""
        return M.ranked(self._by(self.clients, "IP"), "IP", k)

    def top_endpoints(self, k: int = C.TOP_ENDPOINTS_K) -> DataFrame:
        """A2, D10."""
        return M.ranked(self._by(self.endpoints.where("Endpoint <> ''"), "Endpoint"), "Endpoint", k)

    def distinct_ips(self) -> DataFrame:
        """A3, D2."""
        return M.distinct_values(self.clients, "IP", "distinct_ips")

    def distinct_uris(self) -> DataFrame:
        """D5."""
        return M.distinct_values(self.uris, "URI", "distinct_uris")

    def distinct_days(self) -> DataFrame:
        """A4, D4."""
        return M.distinct_values(self.cube, "Date", "distinct_days")

    def response_size(self) -> DataFrame:
        """A5, D6."""
        return self.cube.agg(
            F.sum("bytes").alias("total_bytes"), F.max("largest").alias("max_bytes"), F.min("smallest").alias("min_bytes"),
            F.try_divide(F.sum("bytes").cast("double"), F.sum("sized")).alias("avg_bytes"),
        )

    def breakdowns(self) -> DataFrame:
        """D7, D8, D11, D12, D13."""
        return M.breakdowns_of_cube(self.cube)

    def summary(self) -> DataFrame:
        """D1 to D6 as one row."""
        parts = M.totals_of_cube(self.cube).unionByName(self.distinct_ips(), True).unionByName(self.distinct_uris(), True)
        return parts.agg(*[F.max(c).alias(c) for c in ("total_requests", "distinct_ips", "mean_requests_per_day", "distinct_days", "distinct_uris", "avg_bytes")])
