"""CSV snapshots: one file or directory per period, read in a single scan."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennia.sources import inference

CENTURY = 2000
#: The name of a file or, for a directory of part files, of the directory; a key=value directory counts as its value.
SNAPSHOT = r"([^/=]+)(?:/part-[^/]*)?$"
#: First lines that are read side by side.
HEADERS_AT_ONCE = 32


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None, **options: object
) -> DataFrame:
    """CSV with a header from any Hadoop path, directory or glob.

    With a schema there is no inference pass, and headers are checked against it by
    name instead of being ignored.  Without one, types are inferred from the data.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if schema is None:
        return spark.read.csv(paths, header=True, inferSchema=True, **options)
    return spark.read.csv(paths, schema=schema, header=True, enforceSchema=False, **options)


def snapshot_name() -> Column:
    """Name of the snapshot a row was read from.

    The file's own name or, for a directory of part files, the directory's name; a
    ``key=value`` directory counts as its value.
    """
    return F.regexp_extract(F.col("_metadata.file_path"), SNAPSHOT, 1)


def snapshot_year(name: Column) -> Column:
    """First two characters after the last underscore, as a year of the 2000s."""
    return F.regexp_extract(name, r"_(\d{2})[^_]*$", 1).try_cast("int") + F.lit(CENTURY)


def snapshot_gender(name: Column) -> Column:
    """``F`` for names whose first underscore token is ``female``, else ``M``."""
    return F.when(F.split_part(name, F.lit("_"), F.lit(1)) == "female", "F").otherwise("M")


def _by_header(spark: SparkSession, path: str | Sequence[str], separator: str) -> dict[tuple[str, ...], list[str]]:
    """The ``.csv`` files under a folder or glob, by the names in their first lines."""
    paths = [path] if isinstance(path, str) else list(path)
    named = spark.read.format("binaryFile").options(pathGlobFilter="*.csv", recursiveFileLookup=True).load(paths)
    found = [row["path"] for row in named.select("path").collect()]  # the names of the files
    by_header: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        for header, file in zip(pool.map(lambda file: _header(spark, file, separator), found), found, strict=True):
            by_header.setdefault(header, []).append(file)
    return by_header


def snapshot_types(
    spark: SparkSession, path: str | Sequence[str], missing: Sequence[str] = (), **options: object
) -> DataFrame:
    """snapshot, column_name, bits, type: the type of each column in each snapshot, in one pass over the files of a header."""
    groups = _by_header(spark, path, str(options.get("sep", ",")))
    if not groups:
        return spark.createDataFrame([], "snapshot string, column_name string, bits int, type string")
    found = []
    for header, files in sorted(groups.items()):
        rows = inference.text_files(spark, files, header, **options)
        name = F.regexp_extract("_file", SNAPSHOT, 1)
        found.append(inference.column_types(rows.withColumn("_file", name), header, ["_file"], missing))
    return union_all(found).withColumnRenamed("_file", "snapshot")


def infer_schema(
    spark: SparkSession, path: str | Sequence[str], missing: Sequence[str] = (), **options: object
) -> T.StructType:
    """One schema for all snapshots: a column has the narrowest type that holds its values in every file.

    Columns come in the order of the headers, those of the first header first; texts in ``missing`` stand for no value.
    """
    names = dict.fromkeys(c for header in sorted(_by_header(spark, path, str(options.get("sep", ",")))) for c in header)
    return inference.inferred_schema(snapshot_types(spark, path, missing, **options), list(names))


def read_snapshots(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None, **options: object
) -> DataFrame:
    """All snapshots under a folder or glob, with ``year`` and ``gender`` from their names.

    Only ``.csv`` files are read.  Columns are found by the names in each file's header: files
    of one header are one scan, and a column that a file does not have is null in its rows;
    a column that the schema does not name is left out.  Only the headers are read ahead.
    Without a schema one is inferred that holds the values of all files.
    """
    wanted = infer_schema(spark, path, **options) if schema is None else schema
    wanted = T.StructType.fromDDL(wanted) if isinstance(wanted, str) else wanted
    by_header = _by_header(spark, path, str(options.get("sep", ",")))
    if not by_header:
        by_header = {tuple(wanted.names): []}
    types = {f.name: f.dataType for f in wanted}
    name = snapshot_name()
    scans = []
    for header, files in sorted(by_header.items()):
        own = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
        rows = read_csv(spark, files, own, **options) if files else spark.createDataFrame([], own)
        file = name if files else F.lit("")
        columns = [
            (F.col(f"`{c}`") if c in header else F.lit(None).cast(types[c])).alias(c) for c in wanted.names
        ]
        scans.append(rows.select(*columns, snapshot_year(file).alias("year"), snapshot_gender(file).alias("gender")))
    return union_all(scans)


def _header(spark: SparkSession, path: str, separator: str) -> tuple[str, ...]:
    """Names in the first line of a file, through Spark's own file systems."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(place)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return tuple(next(csv.reader([(line or "").removeprefix("\ufeff")], delimiter=separator), []))


def union_all(frames: Sequence[DataFrame], by_name: bool = True) -> DataFrame:
    """All rows of all frames; by name, columns missing from one frame are null there."""
    if not frames:
        raise ValueError("union_all needs at least one frame")
    if by_name:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return reduce(DataFrame.union, frames)

