"""File readers: Parquet, CSV, versioned tables, object listings."""

from __future__ import annotations

import json
from collections import defaultdict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farelane.functions.text import month_file_parts
from farelane.schemas import ZONE_LOOKUP

# Reader format by file extension.
FORMATS = {".csv": "csv", ".parquet": "parquet"}


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """A table in any installed format: ``parquet`` here, ``delta`` where its package is present."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, infer: bool = False) -> DataFrame:
    """CSV with a header: typed by the schema, by inference, or all text."""
    if schema is not None:
        return spark.read.schema(schema).csv(path, header=True, enforceSchema=False)
    return spark.read.csv(path, header=True, inferSchema=infer)


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The zone lookup with pinned types; columns may come in any order or be missing."""
    header = read_csv(spark, path)
    return header.select(
        *[
            F.col(field.name).try_cast(field.dataType).alias(field.name)
            for field in ZONE_LOOKUP.fields
            if field.name in header.columns
        ]
    )


def list_files(spark: SparkSession, root: str, suffix: str = ".parquet", prefix: str = "") -> DataFrame:
    """Path, time and length of all files below ``root`` whose path there starts with ``prefix``; no content is read."""
    base = f"{root.rstrip('/')}/{prefix}*" if prefix else root
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
        .load(base)
    )
    return files.select("path", "modificationTime", "length")


def read_objects(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Whole files as binary rows."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
    )


def read_recursive(spark: SparkSession, root: str, suffix: str = ".parquet") -> DataFrame:
    """The rows of all files below ``root`` that end in ``suffix``, each with its file's ``path``."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}")
    return reader.parquet(root).withColumn("path", F.col("_metadata.file_path"))


def latest_file(spark: SparkSession, root: str, suffix: str = ".csv") -> DataFrame:
    """The newest file, ties to the first path; looked up again at every call."""
    return list_files(spark, root, suffix).orderBy(F.desc("modificationTime"), "path").limit(1)


def read_latest(spark: SparkSession, root: str, suffix: str = ".csv") -> DataFrame:
    """The content of the newest file."""
    if suffix not in FORMATS:
        raise ValueError(f"unsupported file type: {suffix}")
    newest = latest_file(spark, root, suffix).first()
    if newest is None:
        raise FileNotFoundError(f"no {suffix} file in {root}")
    if FORMATS[suffix] == "csv":
        return read_csv(spark, newest["path"], infer=True)
    return spark.read.parquet(newest["path"])


def schemas_alike(spark: SparkSession, paths: list[str]) -> list[tuple[StructType, list[str]]]:
    """Runs of neighbouring files whose schemas go together, each with the schema of all of them.

    One Spark job reads the footers in its tasks and merges the schemas. If types differ the
    halves are tried, so there are about as many jobs as changes of type times the depth.
    """
    try:
        merged = spark.read.option("mergeSchema", "true").parquet(*paths).schema
        return [(merged, paths)]
    except Exception as problem:
        if len(paths) == 1 or "CANNOT_MERGE" not in str(problem):
            raise
    half = len(paths) // 2
    return schemas_alike(spark, paths[:half]) + schemas_alike(spark, paths[half:])


def read_month_files(spark: SparkSession, root: str, service: str) -> DataFrame:
    """All monthly files of a service below ``root``, with service, year and month from their names.

    A month is a file or a folder of files. Months may differ in columns and types: footers are
    read by Spark jobs, files whose schemas go together are one scan, and the scans are joined by
    name. Types widen to one that holds both, and a column that a month lacks is null there.
    """
    month = F.regexp_extract("path", rf"({service}_tripdata_\d{{4}}-\d{{2}})\.parquet(/|$)", 1)
    listed = list_files(spark, root).select("path", month.alias("month")).where("month <> ''").orderBy("month", "path")
    paths = [row["path"] for row in listed.collect()]
    if not paths:
        raise FileNotFoundError(f"no monthly file of {service} in {root}")
    alike = defaultdict(list)
    for schema, group in schemas_alike(spark, paths):
        alike[schema.json()] += group
    scans = [
        spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(*group).withColumns(month_file_parts(F.col("_metadata.file_path")))
        for schema, group in alike.items()
    ]
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), scans)


def run_query(spark: SparkSession, table: str, query: str | None = None) -> DataFrame:
    """A warehouse table, or the result of a query."""
    return spark.sql(query) if query else spark.table(table)
