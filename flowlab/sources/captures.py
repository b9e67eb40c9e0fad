"""CSV captures: listing, header checks and a merge by column name."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from flowlab.errors import MissingInput
from flowlab.functions.names import quoted
from flowlab.operators.kinds import column_kinds, fitting_types

# Larger than any file, small enough that the sizes of millions of files still add up in 64 bits.
WHOLE_FILE_BYTES = 1 << 40


def list_files(spark: SparkSession, directory: str, extension: str = "csv") -> list[str]:
    """Paths of the files with this extension right inside ``directory``, on any file system."""
    try:
        # Only file names are wanted: the content column is pruned and no file is opened.
        files = (
            spark.read.format("binaryFile").option("pathGlobFilter", f"*.{extension}")
            .load(directory).select("path")
        )
        return sorted(r["path"] for r in files.collect())
    except AnalysisException as problem:
        raise MissingInput(f"cannot list {directory}: {problem.getCondition()}") from problem


def require_files(spark: SparkSession, directory: str, extension: str = "csv") -> list[str]:
    paths = list_files(spark, directory, extension)
    if not paths:
        raise MissingInput(f"no .{extension} file in {directory}")
    return paths


@contextmanager
def whole_files(spark: SparkSession) -> Iterator[None]:
    """Scans planned inside give every file a task of its own."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name in names:
            spark.conf.set(name, str(WHOLE_FILE_BYTES))
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def plain_path(uri: str) -> str:
    """The path behind an encoded address; local files are named with one slash or three."""
    return re.sub("^file:/+", "file:/", unquote(uri))


def first_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, str | None]:
    """The first line with text of each file, None for files without one. One job; a task reads no further than that line."""
    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                if batch.column(1)[row].as_py().strip():
                    yield batch.slice(row, 1)
                    return

    with whole_files(spark):
        lines = spark.read.text(list(paths))
        files = [plain_path(f) for f in lines.inputFiles()]
        # A part of a file other than its first is no place for a header.
        starts = lines.filter("_metadata.file_block_start = 0").select(F.col("_metadata.file_path").alias("file"), "value")
        found = {plain_path(r["file"]): r["value"] for r in starts.mapInArrow(head, "file string, value string").collect()}
    return {f: found.get(f) for f in files}


def headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """Column names of each CSV file, by its full path. Only one file of each distinct first line is parsed."""
    lines = first_lines(spark, paths)
    one_of = {line: path for path, line in lines.items() if line is not None}
    names = {line: tuple(spark.read.csv(path, header=True).columns) for line, path in one_of.items()}
    return {path: names.get(line, ()) for path, line in lines.items()}


def header_groups(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in headers(spark, paths).items():
        groups.setdefault(header, []).append(path)
    return groups


def check_headers(spark: SparkSession, directory: str, extension: str = "csv") -> DataFrame:
    """``(header, files)``: the distinct header lines of a directory. One row means they agree."""
    groups = header_groups(spark, require_files(spark, directory, extension))
    rows = [(list(header), len(paths)) for header, paths in groups.items()]
    return spark.createDataFrame(rows, "header array<string>, files long")


# Widening order of the numeric types that inference produces.
_NUMERIC = [T.IntegerType(), T.LongType(), T.DoubleType()]


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both: the larger number, else text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _NUMERIC and b in _NUMERIC:
        return max(a, b, key=_NUMERIC.index)
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def merge_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables, columns matched by name.

    The tables must have the same columns, in any order; types that differ are widened first.
    """
    if not dfs:
        raise MissingInput("nothing to merge")
    types: dict[str, T.DataType] = {}
    for df in dfs:
        if set(df.columns) != set(dfs[0].columns):
            odd = sorted(set(df.columns) ^ set(dfs[0].columns))
            raise ValueError(f"tables differ in columns {odd}")
        for field in df.schema.fields:
            types[field.name] = wider(types.get(field.name, field.dataType), field.dataType)
    aligned = [
        df.select(*[quoted(c) if df.schema[c].dataType == t else quoted(c).cast(t).alias(c) for c, t in types.items()])
        for df in dfs
    ]
    return reduce(DataFrame.unionByName, aligned)


def read_groups(spark: SparkSession, groups: Mapping[tuple[str, ...], Sequence[str]], schema: T.StructType) -> DataFrame:
    """The files of every header in the types and the column order of ``schema``."""
    return reduce(DataFrame.unionByName, [
        spark.read.schema(T.StructType([schema[c] for c in header]))
        .csv(list(group), header=True, mode="FAILFAST").select(*[quoted(c) for c in schema.fieldNames()])
        for header, group in groups.items()
    ])


def capture_kinds(spark: SparkSession, groups: Mapping[tuple[str, ...], Sequence[str]]) -> DataFrame:
    """The kinds of values in all files, see ``column_kinds``: one job that keeps counts, not rows."""
    names = next(iter(groups))
    text = T.StructType([T.StructField(c, T.StringType()) for c in names])
    return column_kinds(read_groups(spark, groups, text))


def inferred_schema(spark: SparkSession, groups: Mapping[tuple[str, ...], Sequence[str]]) -> T.StructType:
    """Types that fit every row of every file; columns of files without rows are text."""
    types = fitting_types(capture_kinds(spark, groups))
    return T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in next(iter(groups))])


def merge_csv_files(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """All rows of the files, columns matched by name, one scan per distinct header.

    Spark matches the columns of a multi-file CSV read by position, so files are grouped by
    header. With ``schema`` the types are those given and an unreadable value fails the job
    instead of turning into NULL. Without it they are inferred from every row: a sample could
    miss the one value that does not fit. The widened types are then used to read the text
    itself, so no value passes through a narrower type. Headers take one job for all files, types another.
    """
    if not paths:
        raise MissingInput("no files to merge")
    groups = header_groups(spark, paths)
    names = next(iter(groups))
    for header in groups:
        if set(header) != set(names):
            raise ValueError(f"files differ in columns {sorted(set(header) ^ set(names))}")
    if schema is None:
        schema = inferred_schema(spark, groups)
    elif set(schema.fieldNames()) != set(names):
        raise ValueError(f"schema and files differ in columns {sorted(set(schema.fieldNames()) ^ set(names))}")
    return read_groups(spark, groups, schema)


def read_flows(
    spark: SparkSession, directory: str, schema: T.StructType | None = None, extension: str = "csv"
) -> DataFrame:
    """Every capture of a directory as one table."""
    return merge_csv_files(spark, require_files(spark, directory, extension), schema)
