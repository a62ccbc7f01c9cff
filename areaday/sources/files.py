"""Delimited text, and which landed files to read."""

from __future__ import annotations

from functools import reduce
from pathlib import PurePosixPath
from urllib.parse import unquote, urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from areaday import schemas
from areaday.fixed import FILES_READ, YEAR_IN_FILE_NAME
from areaday.functions.text import first_match
from areaday.sources.boundaries import quoted_records

#: Quotes within quotes are doubled. Rows with too many or too few fields raise an error; they can only be told when all
#: columns are parsed.
CSV_DIALECT = {"header": True, "quote": '"', "escape": '"', "mode": "FAILFAST", "columnPruning": False}


def read_strings(spark: SparkSession, path: str | list[str], sep: str = ";", multi_line: bool = False) -> DataFrame:
    """A delimited file with a header, every column a string.

    With ``multi_line`` fields may hold line breaks; several tasks read a large file even then, see ``read_records``.
    """
    if multi_line:
        return read_records(spark, path, None, sep)
    return spark.read.options(**CSV_DIALECT, sep=sep).csv(path)


def read_typed(
    spark: SparkSession, path: str | list[str], schema: StructType | str, sep: str = ",", multi_line: bool = False
) -> DataFrame:
    """A delimited file with a header that must match ``schema``; malformed rows raise an error."""
    if multi_line:
        return read_records(spark, path, StructType.fromDDL(schema) if isinstance(schema, str) else schema, sep)
    return spark.read.schema(schema).options(**CSV_DIALECT, sep=sep, enforceSchema=False).csv(path)


def read_records(spark: SparkSession, path: str | list[str], schema: StructType | None, sep: str) -> DataFrame:
    """Delimited files whose fields may hold line breaks, read in splits; without a schema all columns are strings.

    Counting the quotes of all splits happens here, the rest when the result is used. All files must have the header of
    the first one, and that must match the schema, or an error is raised.
    """
    dialect = {**CSV_DIALECT, "sep": sep, "multiLine": True}
    first = spark.read.options(**{**dialect, "header": False}).csv(path).first()
    whole = spark.read.options(**dialect)
    frame = whole.csv(path) if schema is None else whole.schema(schema).csv(path)
    if first is None:
        return frame
    titles = [f"c{i} STRING" for i in range(len(first))]
    if schema is not None and [str(title).lower() for title in first] != [name.lower() for name in schema.names]:
        raise ValueError(f"columns {list(first)} where the schema has {schema.names}")
    options = {key: str(value).lower() if isinstance(value, bool) else value for key, value in dialect.items()}
    parsed = lambda ddl: F.from_csv("record", ddl, options)
    of_first = F.struct(*[F.lit(title).cast("string").alias(f"c{i}") for i, title in enumerate(first)])
    header = parsed(", ".join(titles))
    other = F.raise_error(F.concat(F.lit("a file with another header: "), "record")).cast("boolean")
    is_row = F.when(~F.col("header"), True).when(header.eqNullSafe(of_first), False).otherwise(other)
    records = quoted_records(spark, path).filter(is_row)
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in frame.schema)
    return records.select(parsed(ddl).alias("r")).select("r.*")


def read_weather_hourly(spark: SparkSession, path: str) -> DataFrame:
    return read_typed(spark, path, schemas.WEATHER_HOURLY)


def read_predictions(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return read_typed(spark, path, schema)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path``, ``name`` of the files below ``folder``; an error if there are none.

    A dataset that Spark wrote is a folder of part files and counts as one file, under its folder's
    name. Only names are read, not contents.
    """
    root = urlparse(folder).path.rstrip("/") + "/"
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no folder {folder}") from error
    inside = F.substring_index("path", root, -1)
    names = files.select(F.split_part(inside, F.lit("/"), F.lit(1)).alias("name")).distinct()
    listed = names.filter(~F.col("name").rlike(r"^[_.]")).withColumn(
        "path", F.concat(F.lit(folder.rstrip("/") + "/"), "name")
    )
    if listed.isEmpty():
        raise FileNotFoundError(f"no files below {folder}")
    return listed.select("path", "name")


def with_year(files: DataFrame, name: str = "name") -> DataFrame:
    """The files whose name carries a year, with that year."""
    year = first_match(F.col(name), YEAR_IN_FILE_NAME).cast("int")
    return files.withColumn("year", year).filter(F.col("year").isNotNull())


def recent_files(files: DataFrame, n: int = FILES_READ, name: str = "name") -> DataFrame:
    """The ``n`` latest files by the year in their name; ties go by name."""
    return with_year(files, name).orderBy(F.desc("year"), name).limit(n)


def files_by_year(files: DataFrame, name: str = "name") -> DataFrame:
    """The files of each year, one row per file, with how many the year has.

    Rows rather than one list per year, so that a year with very many files is no single value. Years
    have four digits, which bounds the broadcast side.
    """
    named = with_year(files, name).select("year", name).distinct()
    per_year = named.groupBy("year").agg(F.count(F.lit(1)).alias("files_in_year"))
    return named.join(F.broadcast(per_year), "year").orderBy("year", name)


def first_lines(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The first line of each file below ``paths``, in the order of ``paths`` and then of names, by one job.

    Every file starts a task of its own, which stops after the first rows, so only the beginnings of files are read.
    """
    setting = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))

        def first(frames):
            for frame in frames:
                if frame.num_rows:
                    if frame.column("start")[0].as_py() == 0:
                        yield frame.slice(0, 1).select(["value", "file"])
                    return

        found = lines.mapInArrow(first, "value string, file string").collect()
    finally:
        spark.conf.set(setting, before)
    place = {urlparse(path).path.rstrip("/"): i for i, path in enumerate(reversed(paths))}

    def order(file: str) -> tuple[int, str]:
        above = [file, *map(str, PurePosixPath(file).parents)]
        return -max((place[p] for p in above if p in place), default=0), file

    named = {unquote(row.file): row.value for row in found}
    return {file: named[file] for file in sorted(named, key=lambda f: order(urlparse(f).path))}


def read_union(spark: SparkSession, paths: list[str], sep: str = ";") -> DataFrame:
    """Files with headers of their own, aligned by column name; what a file lacks is null.

    One job reads all headers; files with the same one are one scan. Columns come in the order of the paths.
    """
    alike: dict[str, list[str]] = {}
    for file, header in first_lines(spark, paths).items():
        alike.setdefault(header, []).append(file)
    frames = [read_strings(spark, same, sep) for same in alike.values()] or [read_strings(spark, paths, sep)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_same_columns(spark: SparkSession, paths: list[str], renames: dict[str, str], sep: str = ";") -> DataFrame:
    """Files that must have the same columns in the same order once renamed."""
    frames = [read_strings(spark, path, sep).withColumnsRenamed(renames) for path in paths]
    for frame in frames[1:]:
        if frame.columns != frames[0].columns:
            raise ValueError(f"columns differ: {frames[0].columns} and {frame.columns}")
    return reduce(DataFrame.union, frames)


def read_accidents(spark: SparkSession, folder: str, n: int = FILES_READ) -> DataFrame:
    """The rows of the ``n`` latest accident files of a folder, with one ``id`` column."""
    latest = recent_files(list_files(spark, folder), n).select("path").collect()
    if not latest:
        raise FileNotFoundError(f"no accident files below {folder}")
    return with_accident_id(read_union(spark, [row.path for row in latest]))


def with_accident_id(raw: DataFrame) -> DataFrame:
    """``id`` from ``Accident_Id``, or else ``Num_Acc``; either column may be missing."""
    present = [F.col(c) for c in ("Accident_Id", "Num_Acc") if c in raw.columns]
    if not present:
        raise ValueError("neither Accident_Id nor Num_Acc among the columns")
    return raw.withColumn("id", F.coalesce(*present)).drop("Accident_Id", "Num_Acc")
