"""Runs the layers one after the other, writing each table.

    spark-submit run.py --landing s3a://bucket/landing --root s3a://bucket/tables

A table that fails is reported and does not stop the others.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from comptoir.plans.layers import BRONZE, GOLD, ROLLUPS, SILVER, Gold, Silver, StoredTables, Tables
from comptoir.plans.watch import REPORT as CLEANING, Watch
from comptoir.sources.landing import FILES, RAW_FILES, LandingTables, folder_bytes
from comptoir.sources.stores import TableStore, intermediates, written

PARTITIONED = {("silver", "ventes"): "date_vente"}
# These have one row per day, so by date they are one file per row: only on request.
DAILY_BY_DATE = {("gold", "ca_daily"): "date_vente", ("gold", "daily_trend"): "date_vente"}
# Shuffle partitions for an input size. AQE merges partitions that turn out small,
# so too many cost little, while too few spill.
PARTITION_BYTES = 128 * 1024 * 1024
# Stored returns of more bytes have too many ids to be broadcast.
MANY_RETURNS = 64 * 1024 * 1024
REPORT = "layer STRING, table STRING, status STRING, rows BIGINT, error STRING"


def by_client(buckets: int) -> dict[tuple[str, str], tuple[str, int]]:
    """Sales and clients stored by client, so that what is summed or joined by client needs no shuffle of the sales."""
    return {("silver", "ventes"): ("client_id", buckets), ("silver", "clients"): ("client_id", buckets)}


class Runner:
    """``partition_by`` gives the partition column of (layer, table), ``bucket_by`` its bucket column and their number."""

    def __init__(
        self, store: TableStore, partition_by: dict[tuple[str, str], str] = PARTITIONED,
        bucket_by: dict[tuple[str, str], tuple[str, int]] | None = None,
    ):
        self.store = store
        self._partition_by, self._bucket_by = partition_by, bucket_by or {}
        self._lines: list[tuple] = []
        self._cleaned: list[tuple] = []
        self._rejected: list[tuple] = []

    def _attempt(
        self, layer: str, name: str, build: Callable[[], DataFrame], source: str | None = None, watch: Watch | None = None,
    ) -> None:
        try:
            place = layer, name
            rows = self.store.write(build(), layer, name, self._partition_by.get(place), source, self._bucket_by.get(place))
            self._lines.append((layer, name, "OK", rows, None))
            if watch:
                self._cleaned.append(watch.line(rows))
        except Exception as error:  # one table's failure is reported, not raised
            self._lines.append((layer, name, "FAILED", 0, str(error)))

    def bronze(self, source, files: dict[str, str] | None = None) -> None:
        """``source`` has one method per bronze table. What it sets aside becomes a table too."""
        with self._layer():
            for name in BRONZE:
                self._attempt("bronze", name, lambda: getattr(source, name)(), (files or {}).get(name))
                if self._lines[-1][2] == "OK" and hasattr(source, "rejected"):
                    self._rejected += source.rejected(name)
            if getattr(source, "sets_aside", False):
                self._attempt("bronze", "quarantine", source.quarantined)

    def silver(self) -> None:
        watches = {name: Watch(name) for name in SILVER}
        many = self.store.bytes("bronze", "retours") > MANY_RETURNS
        tables = Silver(self.stored("bronze"), watches, many)
        with self._layer():
            for name in SILVER:
                self._attempt("silver", name, lambda: tables[name], watch=watches[name])

    def gold(self) -> None:
        """Fourteen of the tables come from four roll-ups, so the sales are read
        five times instead of fifteen, and mostly in a few columns."""
        silver = self.stored("silver")
        with self._layer():
            try:
                ventes = silver.ventes
                rollups = {name: written(build(ventes), name) for name, build in ROLLUPS.items()}
            except Exception as error:
                self._lines.append(("gold", "rollups", "FAILED", 0, str(error)))
                rollups = {}
            tables = Gold(silver, **rollups)
            for name in GOLD:
                self._attempt("gold", name, lambda: tables[name])

    @contextmanager
    def _layer(self) -> Iterator[None]:
        """The tables of a layer that succeed are published together; what was stored on the way goes."""
        with intermediates(self.store.spark), self.store.publishing():
            yield

    def stored(self, layer: str) -> Tables:
        return StoredTables(lambda name: self.store.read(layer, name))

    def rejects(self) -> DataFrame:
        """table, column, n: cells of the landing files that were not of their type, observed in the bronze jobs."""
        return self.store.spark.createDataFrame(self._rejected, "table STRING, column STRING, n BIGINT")

    def cleaning(self) -> DataFrame:
        """What the rules did to each silver table, observed in the jobs that wrote it."""
        return self.store.spark.createDataFrame(self._cleaned, CLEANING)

    def report(self) -> DataFrame:
        """One line per table written so far."""
        return self.store.spark.createDataFrame(self._lines, REPORT)


def run_pipeline(
    source, store: TableStore, files: dict[str, str] | None = None,
    partition_by: dict[tuple[str, str], str] = PARTITIONED, input_bytes: int | None = None,
    bucket_by: dict[tuple[str, str], tuple[str, int]] | None = None,
) -> Runner:
    """Runs all layers; the runner has the reports. With ``input_bytes`` the shuffles are sized for that input first."""
    if input_bytes is not None:
        size_shuffles(store.spark, input_bytes)
    runner = Runner(store, partition_by, bucket_by)
    runner.bronze(source, files)
    runner.silver()
    runner.gold()
    return runner


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Sets the shuffle partitions for an input, at least one per core."""
    wanted = -(-input_bytes // PARTITION_BYTES)
    partitions = max(spark.sparkContext.defaultParallelism, wanted)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    return partitions


def main() -> None:
    arguments = argparse.ArgumentParser(description=__doc__)
    arguments.add_argument("--landing", required=True, help="folder with the CSV tables")
    arguments.add_argument("--root", help="folder to write Parquet tables to")
    arguments.add_argument("--catalog", help="v2 catalog to write to instead")
    arguments.add_argument("--format", default="iceberg", help="table format of the catalog")
    arguments.add_argument("--by-table", action="store_true", help="landing files lie in raw/{table}/")
    arguments.add_argument("--infer", action="store_true", help="infer column types from the CSV")
    arguments.add_argument("--buckets-by-client", type=int, help="store sales and clients in so many buckets instead of by date")
    arguments.add_argument("--quarantine", action="store_true", help="keep lines that are no records in a table of their own")
    arguments.add_argument("--daily-by-date", action="store_true", help="partition the daily gold tables too")
    given = arguments.parse_args()

    spark = SparkSession.builder.appName("retail layers").getOrCreate()
    store = TableStore(spark, root=given.root, catalog=given.catalog, format=given.format)
    partition_by = PARTITIONED | DAILY_BY_DATE if given.daily_by_date else PARTITIONED
    bucket_by = by_client(given.buckets_by_client) if given.buckets_by_client else {}
    partition_by = {place: column for place, column in partition_by.items() if place not in bucket_by}
    source = LandingTables(spark, given.landing, RAW_FILES if given.by_table else FILES, given.infer, given.quarantine)
    runner = run_pipeline(
        source, store, partition_by=partition_by, input_bytes=folder_bytes(spark, given.landing), bucket_by=bucket_by)
    report = runner.report()
    report.show(100, truncate=False)
    runner.cleaning().show(truncate=False)
    runner.rejects().where("n > 0").show(100, truncate=False)
    for line in report.where("status = 'OK' AND layer = 'bronze'").collect():
        store.read("bronze", line.table, lineage=True).printSchema()
    store.schemas().show(100, truncate=False)
    for layer in ("bronze", "silver", "gold"):
        store.list(layer).show(100, truncate=False)
    if report.where("status <> 'OK'").count():
        raise SystemExit(1)


if __name__ == "__main__":
    main()
