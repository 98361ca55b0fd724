"""CSV dumps: folders of files with differing headers, newest file, per-file profile."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom import session
from trendloom.functions import text as tx
from trendloom.operators import skew
from trendloom.sources import quoted

CORRUPT = "_corrupt"
FILE, ROW = "file_name", "row_no"
_BOM = "﻿"


def list_files(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """(path, modificationTime, length) of the files; contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    return reader.load(path).select("path", "modificationTime", "length")


def header_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of one file; reads its first line only."""
    names = spark.read.option("header", True).csv(path).columns
    return tuple(n.lstrip(_BOM).strip() for n in names)


def read_dump(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    header: Sequence[str] | None = None,
    na_values: Sequence[str] = (),
    glob: str | None = None,
) -> DataFrame:
    """Read dumps as the declared schema plus file, size, row and corrupt text.

    Values may hold quoted line breaks; files are split all the same (see ``quoted``). Each file's
    own header names its columns, unless ``header`` does; headers are read within the job and only
    different ones reach the driver. Columns of the schema that a file lacks are null. Rows that do
    not fit their header are kept and marked. ``row_no`` is the order within a file.
    """
    records, headers = quoted.read_records(spark, paths, glob)
    kinds = sorted(r[0] for r in headers.select("header").distinct().collect()) if header is None else []
    # A row per file; beyond the bound the join is salted.
    records = skew.lookup(records, headers, ["path"], ["row_no"], "inner", max_rows=100_000)
    # Two signs that end the lines of a file are one within its values too.
    text = F.when(F.col("crlf"), F.replace("record", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))
    if header is None:
        parsed = [(F.col("header") == kind, _parsed(text, _split_header(kind), schema, na_values)) for kind in kinds]
    else:
        parsed = [(F.lit(True), _parsed(text, list(header), schema, na_values))]
    if not parsed:
        return _empty(spark, schema)
    row = F.when(*parsed[0])
    for test, value in parsed[1:]:
        row = row.when(test, value)
    return tx.with_once(records, "_row", row).select(
        *[F.col("_row")[f.name].alias(f.name) for f in schema.fields],
        F.col("name").alias(FILE),
        F.col("size").alias("file_size"),
        F.col("row_no").alias(ROW),
        F.col("_row")[CORRUPT].alias(CORRUPT),
    )


def _split_header(text: str) -> list[str]:
    """Names of a header; repeated and empty ones are told apart by place, as no schema names them."""
    names = [n.strip() for n in next(csv.reader([text]))]
    return [n if n and n != CORRUPT and names.index(n) == i else f"_c{i}" for i, n in enumerate(names)]


def _parsed(record, names: Sequence[str], schema: T.StructType, na_values: Sequence[str]):
    """A record as a struct of the schema's columns and its text where it does not fit the header."""
    raw = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}

    def struct(row):
        columns = []
        for field in schema.fields:
            if field.name in names:
                value = row[field.name]
                if na_values:
                    value = F.when(~value.isin(list(na_values)), value)
                columns.append(_typed(value, field.dataType).alias(field.name))
            else:
                columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        return F.struct(*columns, row[CORRUPT].alias(CORRUPT))

    return tx.let(F.from_csv(record, raw.toDDL(), options), struct)


def _typed(value, data_type: T.DataType):
    if isinstance(data_type, T.IntegralType):  # writers turn whole numbers into '12.0'
        return F.coalesce(value.try_cast(data_type), value.try_cast("double").try_cast(data_type))
    return value.try_cast(data_type)


def read_dumps(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    glob: str = "*.csv",
    na_values: Sequence[str] = (),
) -> DataFrame:
    """All dumps of a folder as one frame; a column that a file lacks is null for its rows."""
    return read_dump(spark, path, schema, na_values=na_values, glob=glob)


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    extra = [
        T.StructField(FILE, T.StringType()),
        T.StructField("file_size", T.LongType()),
        T.StructField(ROW, T.LongType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
    return spark.createDataFrame([], T.StructType([*schema.fields, *extra]))


def good_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def input_profile(df: DataFrame) -> DataFrame:
    """(file_name, file_size, rows, bad_rows) of what read_dumps returned."""
    return df.groupBy(FILE).agg(
        F.first("file_size").alias("file_size"),
        F.count("*").alias("rows"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("bad_rows"),
    )


def latest_file(spark: SparkSession, path: str, globs: Sequence[str]) -> str | None:
    """The newest file of the first pattern that matches anything."""
    for glob in globs:
        try:
            newest = (
                list_files(spark, path, glob)
                .orderBy(F.desc("modificationTime"), F.desc("path"))
                .limit(1)
                .collect()
            )
        except AnalysisException as error:
            if not session.is_missing(error):
                raise
            continue
        if newest:
            return newest[0]["path"]
    return None


def latest_snapshot(
    spark: SparkSession, path: str, schema: T.StructType, globs: Sequence[str]
) -> DataFrame:
    """Only the newest dump; no other file is opened."""
    file = latest_file(spark, path, globs)
    return _empty(spark, schema) if file is None else read_dump(spark, file, schema)


def keyword_column(columns: Sequence[str], part: str = "keyword") -> str:
    """The first column whose name holds ``part``, whatever its case."""
    for name in columns:
        if part in name.lower():
            return name
    raise ValueError(f"no column with '{part}' in its name")


def read_keywords(spark: SparkSession, path: str) -> DataFrame:
    """(keyword) from a keyword file with or without a byte order mark."""
    name = keyword_column(header_of(spark, path))
    schema = T.StructType([T.StructField(name, T.StringType())])
    return good_rows(read_dump(spark, path, schema)).select(F.col(f"`{name}`").alias("keyword"))
