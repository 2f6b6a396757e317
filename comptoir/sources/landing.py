"""The landing folder: one CSV file, or folder of files, per table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from comptoir.sources.lineage import with_lineage
from comptoir.sources.schemas import SCHEMAS, columns_of, type_of

FILES = {name: f"{name}.csv" for name in SCHEMAS}
#: The same files with a folder per table, as the upload lays them out.
RAW_FILES = {name: f"raw/{name}/{name}.csv" for name in SCHEMAS}
WHOLE = ("BIGINT", "INT")


#: Separates nothing in a CSV file, so a line read with it is one cell.
_NO_SEPARATOR = "\x01"
#: A quoted cell. What is left of a line without them tells its form.
_QUOTED = r'(^|,)"(?:[^"\\]|\\.)*+"'
SHORT, LONG, BROKEN_QUOTE = "fewer cells than the header", "more cells than the header", "broken quote"


def _text(spark: SparkSession, path: str, *kept: Column) -> DataFrame:
    """All columns of the header, as text. Files whose header differs are an error."""
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    text = reader.option("inferSchema", False).option("enforceSchema", False).csv(path)
    return text.select("*", *kept) if kept else text


def _fault(line: Column, columns: int) -> Column:
    """Why a line is no record of so many cells; null if it is one."""
    bare = F.regexp_replace(line, _QUOTED, "$1")
    cells = F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1
    return (
        F.when(bare.rlike('(?:^|,)"'), BROKEN_QUOTE)
        .when(cells < columns, SHORT).when(cells > columns, LONG))


def checked_lines(spark: SparkSession, path: str) -> DataFrame:
    """The columns of the header, as text, with ``_line`` and ``_fault``: one row per line that is not blank.

    A line is read whole first, so that a bad one can be shown as it is. Files
    whose header differs are an error. A faulty line has its cells as far as
    they can be read. Line breaks within quotes are not supported.
    """
    whole = spark.read.options(header=True, encoding="UTF-8", sep=_NO_SEPARATOR, quote="", enforceSchema=False)
    header = whole.csv(path).columns[0]
    lines = whole.schema(StructType([StructField(header, StringType())])).csv(path)
    columns = _text(spark, path).columns
    quoted = ", ".join(f"`{c.replace('`', '``')}` STRING" for c in columns)
    line = F.col(f"`{header.replace('`', '``')}`")
    source = F.col("_metadata.file_name")
    shown = lines.select(line.alias("_line"), _fault(line, len(columns)).alias("_fault"), source.alias("_read_from"))
    cells = F.from_csv("_line", quoted, {"mode": "PERMISSIVE"}).alias("_cells")
    return shown.select(cells, "_line", "_fault", "_read_from").select("_cells.*", "_line", "_fault", "_read_from")


def _as_declared(name: str, kind: str) -> Column:
    """The text column as its declared type, null if it is not of that type.

    Whole numbers may be written with a decimal point, as some writers do for
    columns with gaps; they must have no fraction.
    """
    cell = F.trim(F.col(f"`{name}`"))
    if kind == "STRING":
        return F.col(f"`{name}`")
    if kind in WHOLE:
        number = cell.try_cast("decimal(38,6)")
        return F.when(number == F.floor(number), number.try_cast(kind))
    return cell.try_cast(kind)


def read_csv(spark: SparkSession, path: str, table: str, infer: bool = False) -> DataFrame:
    """A landing table with its declared columns and types, or with inferred types.

    Columns are found by the header's names, in any order; other columns are
    left out and a missing one is an error. Inference reads the whole input
    once more, and the types then depend on it. Lines with too few or too many
    cells are kept as far as they go; ``split_csv`` sets them aside.
    """
    if infer:
        return spark.read.option("header", True).option("encoding", "UTF-8").option("inferSchema", True).csv(path)
    return declared(_text(spark, path), table)


def split_csv(spark: SparkSession, path: str, table: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) of a landing table: every line that is not blank is in one of them.

    Accepted rows have the declared columns. Quarantined ones are
    ``table, file, reason, line``, the line as it stands in the file.
    """
    lines = checked_lines(spark, path)
    bad = lines.where("_fault IS NOT NULL").select(
        F.lit(table).alias("table"), F.col("_read_from").alias("file"), F.col("_fault").alias("reason"), F.col("_line").alias("line"))
    return declared(lines.where("_fault IS NULL"), table), bad


def _check_header(text: DataFrame, table: str) -> None:
    missing = [c for c in columns_of(table) if c not in text.columns]
    if missing:
        raise ValueError(f"{table}: the header lacks {', '.join(missing)}; it has {', '.join(text.columns)}")


def declared(text: DataFrame, table: str, *kept: str) -> DataFrame:
    """The declared columns of a table of text columns, and those to keep as they are."""
    _check_header(text, table)
    return text.select(*(_as_declared(c, type_of(table, c)).alias(c) for c in columns_of(table)), *kept)


def _typed(table: str) -> list[str]:
    return [c for c in columns_of(table) if type_of(table, c) != "STRING"]


def _bad_cells(table: str) -> list[Column]:
    """Per typed column, the number of cells that hold something else."""
    bad = lambda c: (F.trim(F.col(f"`{c}`")) != "") & _as_declared(c, type_of(table, c)).isNull()
    return [F.count_if(bad(c)).alias(c) for c in _typed(table)]


def rejects(spark: SparkSession, path: str, table: str) -> DataFrame:
    """column, n: cells that hold something which is not of the declared type, by column."""
    text = _text(spark, path)
    _check_header(text, table)
    columns = _typed(table)
    counted = text.agg(*_bad_cells(table))
    return counted.select(F.explode(F.array(*(
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n")) for c in columns))).alias("found")).select("found.*")


class LandingTables:
    """Bronze frames over ``{folder}/{file}``, with the file each row came from.

    With ``quarantine`` lines that are no records are left out of the frames;
    ``quarantined`` has them.
    """

    def __init__(
        self, spark: SparkSession, folder: str, files: Mapping[str, str] = FILES, infer: bool = False, quarantine: bool = False,
    ):
        if infer and quarantine:
            raise ValueError("types are inferred from all lines; quarantine needs declared types")
        self._spark, self._folder, self._files = spark, folder, files
        self._infer, self._quarantine = infer, quarantine
        self._seen: dict[str, Observation] = {}

    def __getattr__(self, table: str) -> Callable[[], DataFrame]:
        if table.startswith("_") or table not in self._files:
            raise AttributeError(table)

        def load() -> DataFrame:
            path = f"{self._folder}/{self._files[table]}"
            if self._infer:
                raw = read_csv(self._spark, path, table, infer=True)
                return with_lineage(raw, "bronze", F.col("_metadata.file_name"))
            if self._quarantine:
                text = checked_lines(self._spark, path).where("_fault IS NULL")
            else:
                text = _text(self._spark, path, F.col("_metadata.file_name").alias("_read_from"))
            _check_header(text, table)
            self._seen[table] = Observation()
            typed = declared(text.observe(self._seen[table], *_bad_cells(table)), table, "_read_from")
            return with_lineage(typed, "bronze", F.col("_read_from")).drop("_read_from")

        return load

    @property
    def sets_aside(self) -> bool:
        return self._quarantine

    def quarantined(self) -> DataFrame:
        """table, file, reason, line of every line of the landing files that is no record."""
        return reduce(DataFrame.unionAll, (
            split_csv(self._spark, f"{self._folder}/{file}", table)[1] for table, file in self._files.items()))

    def rejected(self, table: str) -> list[tuple[str, str, int]]:
        """(table, column, n) of a table whose frame has been evaluated, without reading it again."""
        return [(table, c, n) for c, n in self._seen[table].get.items()] if table in self._seen else []

    def rejects(self) -> DataFrame:
        """table, column, n over all landing files: what the types cost. Reads them."""
        each = [
            rejects(self._spark, f"{self._folder}/{file}", table).select(F.lit(table).alias("table"), "column", "n")
            for table, file in self._files.items()
        ]
        return reduce(DataFrame.unionAll, each)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """The files below a folder. Listed as binary files, whose content is not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)


def folder_bytes(spark: SparkSession, folder: str) -> int:
    return _files(spark, folder).agg(F.sum("length")).first()[0] or 0


def manifest(spark: SparkSession, folder: str, expected: Mapping[str, str], format: str = "csv") -> DataFrame:
    """file, destination, found, n (rows) for each expected landing file.

    A missing file is a row of its own, not an error. A file of the same name in
    another folder below is not the expected one.
    """
    # Paths are listed in full, with a scheme; the folder may be given without.
    root = F.regexp_replace(F.lit(folder.rstrip("/")), "^[a-zA-Z0-9+.-]+:/+", "/")
    below = F.substring(F.regexp_replace("path", "^[a-zA-Z0-9+.-]+:/+", "/"), F.length(root) + 2, F.length("path"))
    is_there = {
        file: F.max((below == file) | below.startswith(f"{file}/")).alias(file) for file in expected.values()
    }
    there = _files(spark, folder).agg(*is_there.values()).first()

    def line(table: str, file: str) -> DataFrame:
        found = bool(there[file])
        if found:
            counted = spark.read.format(format).option("header", True).load(f"{folder}/{file}").agg(F.count("*").alias("n"))
        else:
            counted = spark.range(1).select(F.lit(0).cast("long").alias("n"))
        return counted.select(
            F.lit(file).alias("file"), F.lit(f"raw/{table}/{file}").alias("destination"),
            F.lit(found).alias("found"), "n")

    return reduce(DataFrame.unionAll, (line(*item) for item in expected.items()))
