"""Writing and reading tables of a layer."""

from __future__ import annotations

import atexit
import json
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from comptoir.sources.lineage import with_lineage, without_lineage

COMPRESSION = "snappy"
FILE_BYTES = 64 * 1024 * 1024

# -- intermediates --------------------------------------------------------------

_scope: ContextVar[str | None] = ContextVar("intermediates", default=None)
_run_folders: dict[str, str] = {}


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) as Hadoop's objects."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    files, place = _hadoop(spark, path)
    files.delete(place, True)


def run_folder(spark: SparkSession) -> str:
    """The folder of this application's intermediates, which all executors can reach.

    Lies under ``spark.checkpoint.dir``; only a local session may do without.
    It is removed when the driver's process ends in order.
    """
    application = spark.sparkContext.applicationId
    if application not in _run_folders:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.gettempdir()
        folder = f"{base.rstrip('/')}/comptoir-{application}-{uuid.uuid4().hex}"
        _run_folders[application] = folder
        files, place = _hadoop(spark, folder)
        owner = os.getpid()
        atexit.register(lambda: os.getpid() == owner and files.delete(place, True))
    return _run_folders[application]


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[str]:
    """What is stored within this block is removed at its end, also if it fails.

    Frames that read it must have been evaluated by then.
    """
    folder = f"{run_folder(spark)}/scope-{uuid.uuid4().hex}"
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        remove(spark, folder)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name for stored intermediates, in the innermost ``intermediates`` block."""
    return f"{_scope.get() or run_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` read back from Parquet: lineage ends there and survives lost executors."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


# -- tables ---------------------------------------------------------------------

def balanced(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Output files of an even size: AQE merges small and splits large partitions.

    With a partition column, rows of one value meet in few tasks, and a value
    that holds much of the data is split over several.
    """
    return df.hint("rebalance", partition_by) if partition_by else df.hint("rebalance")


class TableStore:
    """Create-or-replace tables named ``{layer}.{layer}_{name}``.

    Without ``catalog``: Parquet under ``root``, one folder per version, registered
    in the session catalog. With ``catalog``: a table of that (v2) catalog in its format, which
    replaces tables atomically.

    Under ``root`` a *manifest* lists the current folder of every table. Versions
    are written beside the old ones, and one new manifest file makes all of a
    ``publishing`` block current at once: that is the commit, and ``snapshot``
    reads by it. Then each catalog table is pointed to its folder; if that is
    cut short, ``recover`` completes it from the manifest. Files stay as long as
    one of the last ``KEPT`` manifests names them, for readers that have begun.
    One writer at a time.
    """

    KEPT = 2

    def __init__(
        self, spark: SparkSession, root: str | None = None, catalog: str | None = None,
        format: str = "parquet", database_prefix: str = "",
    ):
        if (root is None) == (catalog is None):
            raise ValueError("give either root or catalog")
        self.spark, self.root, self.catalog, self.format = spark, root, catalog, format
        self._prefix = database_prefix
        self._staged: dict[str, dict] | None = None

    def database(self, layer: str) -> str:
        own = f"{self._prefix}{layer}"
        return f"{self.catalog}.{own}" if self.catalog else own

    def table(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{layer}_{name}"

    def create_database(self, layer: str) -> None:
        place = "" if self.catalog else f" LOCATION '{self.root}/{layer}'"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)}{place}")

    def write(self, df: DataFrame, layer: str, name: str, partition_by: str | None = None,
              source: str | None = None, bucket_by: tuple[str, int] | None = None, even: bool = True) -> int:
        """Replaces the table and returns its row count, taken during the write.

        ``bucket_by`` (column, number) stores the rows by hash of the column, in
        order of it: joins and aggregates on it then need no shuffle. A key that
        holds much of the table is one task in those. ``even=False`` leaves the files
        as the last shuffle made them, for tables that are soon gone; that is a shuffle
        of the whole table less.
        """
        if bucket_by and (partition_by or self.catalog):
            raise ValueError("buckets are for Parquet tables without partitions")
        if layer == "bronze" and "_source_file" in df.columns:
            stamped = df
        else:
            stamped = with_lineage(df, layer, source)
        seen = Observation()
        # Bronze is written as it was split for reading; other layers come out of shuffles of any size.
        if bucket_by:
            placed = stamped.repartition(bucket_by[1], bucket_by[0])  # a file per bucket
        else:
            as_is = not partition_by and (layer == "bronze" or not even)
            placed = stamped if as_is else balanced(stamped, partition_by)
        rows = placed.observe(seen, F.count(F.lit(1)).alias("rows"))
        self.create_database(layer)
        if self.catalog:
            writer = rows.writeTo(self.table(layer, name)).using(self.format)
            writer = writer.tableProperty("write.parquet.compression-codec", COMPRESSION)
            writer = writer.tableProperty("write.target-file-size-bytes", str(FILE_BYTES))
            writer = writer.tableProperty("write.format.default", "parquet").tableProperty("format-version", "2")
            if partition_by:
                writer = writer.partitionedBy(F.col(partition_by))
            writer.createOrReplace()
        else:
            staged = {f"{layer}.{name}": self._stage(rows, layer, name, partition_by, bucket_by)}
            if self._staged is None:
                self._publish(staged)
            else:
                self._staged.update(staged)
        return seen.get["rows"]

    @contextmanager
    def publishing(self) -> Iterator[None]:
        """Tables written in this block become current together at its end, or, if it fails, not at all."""
        if self.catalog or self._staged is not None:
            yield
            return
        self._staged = {}
        try:
            yield
            staged, self._staged = self._staged, None
        except BaseException:
            staged, self._staged = self._staged, None
            for entry in staged.values():
                remove(self.spark, entry["path"])
            raise
        if staged:
            self._publish(staged)

    def _stage(
        self, rows: DataFrame, layer: str, name: str, partition_by: str | None, bucket_by: tuple[str, int] | None,
    ) -> dict:
        path = f"{self.root}/{layer}/{layer}_{name}/{uuid.uuid4().hex}"
        writer = rows.write.format("parquet").option("compression", COMPRESSION)
        if bucket_by:  # only a table is written in buckets; its files stay when its name goes
            draft = f"{self.database(layer)}.draft_{uuid.uuid4().hex}"
            writer.bucketBy(bucket_by[1], bucket_by[0]).sortBy(bucket_by[0]).option("path", path).saveAsTable(draft)
            self.spark.sql(f"DROP TABLE {draft}")
        else:
            (writer.partitionBy(partition_by) if partition_by else writer).save(path)
        return {"path": path, "partition_by": partition_by, "bucket_by": bucket_by}

    def _publish(self, staged: dict[str, dict]) -> None:
        files, unfinished = _hadoop(self.spark, f"{self.root}/_manifest/unfinished")
        if files.exists(unfinished):  # else the versions that tables still point to would go
            self.recover()
        files.create(unfinished, True).close()
        self._commit(self.manifest() | staged)
        for key, entry in staged.items():
            self._point(*key.split(".", 1), entry)
        files.delete(unfinished, False)
        self._forget_old()

    # The manifests are numbered files; the highest number is current.

    def _manifests(self) -> list[str]:
        files, folder = _hadoop(self.spark, f"{self.root}/_manifest")
        if not files.exists(folder):
            return []
        return sorted(str(f.getPath().toString()) for f in files.listStatus(folder) if f.getPath().getName().endswith(".json"))

    def _load(self, manifest: str) -> dict[str, dict]:
        files, place = _hadoop(self.spark, manifest)
        stream = files.open(place)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def manifest(self) -> dict[str, dict]:
        """path and partition_by of every current table, by ``layer.name``."""
        known = self._manifests()
        return self._load(known[-1]) if known else {}

    def _commit(self, tables: dict[str, dict]) -> None:
        known = self._manifests()
        number = int(known[-1].rsplit("/", 1)[-1].split(".")[0]) + 1 if known else 1
        files, draft = _hadoop(self.spark, f"{self.root}/_manifest/{number:012}.draft")
        stream = files.create(draft, True)
        try:
            stream.write(json.dumps(tables, indent=1).encode())
        finally:
            stream.close()
        _, final = _hadoop(self.spark, f"{self.root}/_manifest/{number:012}.json")
        if not files.rename(draft, final):
            raise OSError(f"manifest {number} was written by someone else")

    def _point(self, layer: str, name: str, entry: dict) -> None:
        """The catalog's table at this folder.

        Only the location changes if the columns are the same and there are no
        partitions to list; otherwise the table is created anew, and as it was
        if that fails.
        """
        table, path = self.table(layer, name), entry["path"]
        before = self._location(table)
        if before and not entry["partition_by"] and not entry["bucket_by"]:
            columns = [(f.name, f.dataType) for f in self.spark.read.parquet(path).schema]
            if columns == [(f.name, f.dataType) for f in self.spark.table(table).schema] and not (self._known(before) or entry)["bucket_by"]:
                self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
                self.spark.catalog.refreshTable(table)
                return
        try:
            self._create(table, entry)
        except Exception:
            if before:
                self._create(table, self._known(before) or {**entry, "path": before})
            raise

    def _known(self, path: str) -> dict | None:
        """The entry of a version that one of the last manifests names."""
        return next((e for m in reversed(self._manifests()) for e in self._load(m).values() if e["path"] == path), None)

    def _create(self, table: str, entry: dict) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        path, columns, buckets = entry["path"], "", ""
        if entry["bucket_by"]:  # Spark asks for the columns of a table in buckets
            by, number = entry["bucket_by"]
            schema = self.spark.read.parquet(path).schema
            columns = f"({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema)})"
            buckets = f"CLUSTERED BY (`{by}`) SORTED BY (`{by}`) INTO {number} BUCKETS"
        self.spark.sql(f"CREATE TABLE {table} {columns} USING parquet {buckets} LOCATION '{path}'")
        if entry["partition_by"]:
            self.spark.catalog.recoverPartitions(table)

    def recover(self) -> None:
        """Points every catalog table to its folder in the manifest."""
        for key, entry in self.manifest().items():
            layer, name = key.split(".", 1)
            self.create_database(layer)
            if self._location(self.table(layer, name)) != entry["path"]:
                self._point(layer, name, entry)

    def _forget_old(self) -> None:
        """Removes manifests but the last, and the versions that none of those names."""
        known = self._manifests()
        kept = {entry["path"] for manifest in known[-self.KEPT:] for entry in self._load(manifest).values()}
        for manifest in known[:-self.KEPT]:
            for entry in self._load(manifest).values():
                if entry["path"] not in kept:
                    remove(self.spark, entry["path"])
            remove(self.spark, manifest)

    def bytes(self, layer: str, name: str) -> int:
        """Size of the current version of a table under ``root``; 0 if there is none."""
        entry = self.manifest().get(f"{layer}.{name}") if self.root else None
        if not entry:
            return 0
        files, folder = _hadoop(self.spark, entry["path"])
        return files.getContentSummary(folder).getLength()

    def snapshot(self, layer: str, name: str) -> DataFrame:
        """The table as the manifest has it: tables that were published together are read together."""
        entry = self.manifest()[f"{layer}.{name}"]
        return without_lineage(self.spark.read.parquet(entry["path"]))

    def _location(self, table: str) -> str | None:
        """Where a table of the catalog lies, in the form in which it was given."""
        if not self.spark.catalog.tableExists(table):
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
        place = rows[0].data_type if rows else None
        if place and place.startswith("file:") and not self.root.startswith("file:"):
            return "/" + place.removeprefix("file:").lstrip("/")
        return place

    def read(self, layer: str, name: str, lineage: bool = False) -> DataFrame:
        stored = self.spark.table(self.table(layer, name))
        return stored if lineage else without_lineage(stored)

    def list(self, layer: str) -> DataFrame:
        return self.spark.sql(f"SHOW TABLES IN {self.database(layer)}").select("namespace", "tableName")

    def schemas(self) -> DataFrame:
        """The databases of the catalog."""
        return self.spark.sql(f"SHOW SCHEMAS IN {self.catalog}" if self.catalog else "SHOW SCHEMAS")
