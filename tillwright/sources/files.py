"""Reading raw files and folders of files."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.operators.clean import clean_names
from tillwright.operators.sets import union_relaxed
from tillwright.schemas import text_schema


def read_csv_text(
    spark: SparkSession, paths: str | list[str], columns: list[str] | None = None
) -> DataFrame:
    """CSV with a header, every column as text, names cleaned.

    With ``columns`` the file is not opened before the job runs. A folder is
    read with everything below it; a list of files reads exactly those, and the
    input splits keep each task small.
    """
    reader = (
        spark.read.option("header", True)
        .option("recursiveFileLookup", True)
        .option("enforceSchema", False)
    )
    if columns:
        reader = reader.schema(text_schema(columns))
    return clean_names(reader.csv(paths))


#: The columns that a checked read adds: the text of a line that does not fit, its file.
LINE, FILE = "_bad_line", "_file"


def read_csv_checked(
    spark: SparkSession, paths: str | list[str], columns: list[str] | None = None, header: bool = True
) -> DataFrame:
    """CSV as text, with the lines that do not fit marked: ``_bad_line`` and ``_file``.

    A line fits if it has as many fields as the header (or ``columns``, where there is no
    header). Of one that does not, the text is kept in ``_bad_line`` and its fields count for
    nothing; for all others ``_bad_line`` is null. Line breaks inside quotes are not read.
    """
    reader = spark.read.option("header", header).option("recursiveFileLookup", True)
    if columns is None:
        if not header:
            raise ValueError("a file without a header needs the names of its columns")
        columns = reader.option("enforceSchema", False).csv(paths).columns
    schema = text_schema([*columns, LINE])
    rows = (
        reader.schema(schema)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", LINE)
        .csv(paths)
    )
    # A line is judged by all of its fields, so whoever asks for it reads them all.
    every = F.coalesce(*[F.col(f"`{n}`") for n in columns], F.lit(""))
    line = F.concat(F.col(LINE), F.substring(every, 1, 0))
    return clean_names(rows.withColumns({FILE: F.col("_metadata.file_path"), LINE: line}))


def split_lines(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of lines that fit, and (file, line) of those that do not."""
    good = checked.filter(F.col(LINE).isNull()).drop(LINE, FILE)
    bad = checked.filter(F.col(LINE).isNotNull())
    return good, bad.select(F.col(FILE).alias("file"), F.col(LINE).alias("line"))


def line_counts(checked: DataFrame) -> DataFrame:
    """Per file: lines that fit and lines that do not."""
    return checked.groupBy(F.col(FILE).alias("file")).agg(
        F.count_if(F.col(LINE).isNull()).alias("good_lines"),
        F.count_if(F.col(LINE).isNotNull()).alias("bad_lines"),
    )


def read_source(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Parquet, or CSV with a header and inferred types."""
    if file_format == "csv":
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    if file_format == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unknown format {file_format}")


def read_parquet_tree(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files below a folder, whatever their columns and types; empty files don't count.

    Files whose schemas Spark can merge are one scan; the groups are widened and
    united. Only file names come to the driver.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )
    files = sorted(r["path"] for r in listed.filter("length > 0").collect())
    if not files:
        raise LookupError(f"no Parquet file below {path}")
    groups: dict[str, list[str]] = {}
    for own in _mergeable(spark, files):
        groups.setdefault(_scan(spark, own).schema.json(), []).extend(own)
    return union_relaxed(*[_scan(spark, own) for own in groups.values()])


def _scan(spark: SparkSession, files: list[str]) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(*files)


def _mergeable(spark: SparkSession, files: list[str]) -> list[list[str]]:
    """Runs of files whose schemas merge, found by halving; loads of one kind lie together."""
    try:
        _scan(spark, files)
        return [files]
    except (PySparkException, Py4JJavaError):
        if len(files) == 1:
            raise
    half = len(files) // 2
    return _mergeable(spark, files[:half]) + _mergeable(spark, files[half:])


def read_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only these columns; the Parquet scan reads nothing else."""
    return df.select(*names)


def path_columns(path: Column, root: str = "raw") -> dict[str, Column]:
    """Dataset, day folder and file name from an object path, null if it is not one of ours.

    Valid are ``raw/<dataset>/<file>.csv`` and ``raw/<dataset>/<day>/<file>.csv``.
    """
    parts = F.split(F.url_decode(path), "/")
    n = F.size(parts)
    last = F.element_at(parts, -1)
    valid = (
        n.isin(3, 4)
        & (F.lower(F.get(parts, F.lit(0))) == root)
        & (F.get(parts, F.lit(1)) != "")
        & F.lower(last).endswith(".csv")
    )
    return {
        "dataset": F.when(valid, F.get(parts, F.lit(1))),
        "partition_date": F.when(valid & (n == 4), F.get(parts, F.lit(2))),
        "file_name": F.when(valid, last),
    }


def parse_paths(df: DataFrame, path: str = "path") -> DataFrame:
    """Rows with a valid path, with its parts as columns."""
    return df.withColumns(path_columns(F.col(path))).filter(F.col("dataset").isNotNull())


def with_file_path(df: DataFrame, base: str) -> DataFrame:
    """The row's file below ``base``, as ``path``."""
    full = F.col("_metadata.file_path")
    return df.withColumn("path", F.substring_index(full, f"{base.rstrip('/')}/", -1))
