"""Warehouse tables."""

from __future__ import annotations

import json
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.sinks.store import part_folder, shaped

#: Between a table's folder and those of its staged parts.
PARTS = "-parts/"

# Warehouse type by column type.
WAREHOUSE_TYPES = {
    T.TimestampNTZType: "DATETIME",
    T.StringType: "STRING",
    T.IntegerType: "INT64",
    T.LongType: "INT64",
    T.FloatType: "FLOAT64",
    T.DoubleType: "FLOAT64",
    T.BooleanType: "BOOL",
    T.TimestampType: "TIMESTAMP",
    T.DateType: "DATE",
}

# Relational type by column type.
RELATIONAL_TYPES = {
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.DoubleType: "DOUBLE PRECISION",
    T.StringType: "TEXT",
    T.TimestampType: "TIMESTAMP",
    T.TimestampNTZType: "TIMESTAMP",
}

INSERT_ROWS = 10_000


def _type_name(types: dict[type, str], field: T.StructField) -> str:
    try:
        return types[type(field.dataType)]
    except KeyError:
        raise TypeError(f"column {field.name}: no type for {field.dataType.simpleString()}") from None


def warehouse_schema(schema: T.StructType) -> list[dict[str, str]]:
    """Name, type and mode of each column; an unsupported type is an error."""
    return [
        {
            "name": field.name,
            "field_type": _type_name(WAREHOUSE_TYPES, field),
            "mode": "NULLABLE" if field.nullable else "REQUIRED",
        }
        for field in schema.fields
    ]


def daily_table_names(service: str, day: str) -> dict[str, str]:
    """Names of the two tables of a service: one per month, one per day."""
    year, month, date = day.split("-")
    service = service.upper()
    return {
        "daily": f"{service}_DAILY_MONTH_TABLE_{year}_{month}",
        "zones": f"{service}_DAILY_TABLE_{year}_{month}_{date}",
    }


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    replace_by: tuple[str, ...] = (),
    folder: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Creates the table unless it exists; ``folder`` puts its files there."""
    warehouse_schema(schema)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(replace_by)})" if replace_by else ""
    place = f" LOCATION '{folder}'" if folder else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt}{parts}{place}")


def table_folder(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.where("col_name = 'Location'").first()["data_type"]


def _check_columns(table: str, offered: T.StructType, stored: T.StructType) -> None:
    """A report must have the table's columns with the table's types, in any order."""
    kinds = [{f.name.lower(): f.dataType.simpleString() for f in schema.fields} for schema in (offered, stored)]
    if kinds[0] != kinds[1]:
        odd = sorted(set(kinds[0].items()) ^ set(kinds[1].items()))
        raise ValueError(f"the report does not fit {table}: {', '.join(f'{n} {kind}' for n, kind in odd)}")


#: Table property with the folders that the last publishing put out of use.
SUPERSEDED = "farelane.superseded"


@dataclass(frozen=True)
class Staged:
    """A report written beside its table: which parts it replaces and where their files lie."""

    table: str
    folder: str
    replace_by: tuple[str, ...]
    parts: tuple[tuple[str | None, ...], ...]

    def place(self, values: tuple[str | None, ...]) -> str:
        return "/".join([self.folder, *map(part_folder, self.replace_by, values)])


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stage_report(
    df: DataFrame,
    table: str,
    replace_by: tuple[str, ...] = ("date",),
    folder: str | None = None,
    fmt: str = "parquet",
    part: str | None = None,
) -> Staged:
    """Writes a report beside its table, which still shows the old parts; ``switch_parts`` shows the new ones.

    Creates the table if it is missing. Columns that the table lacks, or of other types than
    its own, are an error.
    """
    spark = df.sparkSession
    create_table(spark, table, df.schema, replace_by, folder, fmt)
    _check_columns(table, df.schema, spark.table(table).schema)
    home = table_folder(spark, table).split(PARTS, 1)[0]
    target, columns = f"{home}{PARTS}{uuid4().hex}", df.select(*spark.table(table).columns)
    if part is not None:
        (key,) = replace_by
        staged = Staged(table, target, replace_by, ((part,),))
        columns.drop(key).write.format(fmt).save(staged.place((part,)))
        return staged
    if not replace_by:
        columns.write.format(fmt).save(target)
        return Staged(table, target, (), ())
    shaped(columns, replace_by).write.format(fmt).partitionBy(*replace_by).save(target)
    keys = [F.col(key).cast("string").alias(key) for key in replace_by]
    written = columns.select(*keys).limit(0) if _is_empty(spark, target, fmt) else spark.read.schema(columns.schema).format(fmt).load(target).select(*keys)
    return Staged(table, target, replace_by, tuple(sorted((tuple(r) for r in written.distinct().collect()), key=repr)))


def _is_empty(spark: SparkSession, folder: str, fmt: str) -> bool:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{fmt}").load(folder)
    return files.select("path").isEmpty()


def switch_parts(spark: SparkSession, staged: Staged) -> None:
    """Lets the table show the parts of a staged report in place of its own; other parts are not looked at.

    Files of the parts replaced stay until the next switch, so whoever reads them now finds
    them whole. Staging and switching again puts the same parts in place again.
    """
    table, old = staged.table, []
    if not staged.replace_by:
        old.append(table_folder(spark, table))
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(staged.folder)}")
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()} if staged.replace_by else set()
    fresh = []
    for values in staged.parts:
        spec = ", ".join(f"`{k}` = {'NULL' if v is None else _quoted(v)}" for k, v in zip(staged.replace_by, values))
        place = _quoted(staged.place(values))
        if "/".join(map(part_folder, staged.replace_by, values)) in known:
            described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({spec})").where("col_name = 'Location'").first()
            old.append(described["data_type"])
            spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION {place}")
        else:
            fresh.append(f"PARTITION ({spec}) LOCATION {place}")
    if fresh:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(fresh)}")
    _clear_superseded(spark, table)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{SUPERSEDED}' = {_quoted(json.dumps(old))})")
    spark.catalog.refreshTable(table)


def _clear_superseded(spark: SparkSession, table: str) -> None:
    """Empties the folders that the switch before put out of use."""
    for row in spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == SUPERSEDED).collect():
        for folder in json.loads(row["value"]):
            spark.createDataFrame([], "cleared string").write.mode("overwrite").parquet(folder)


def publish(
    df: DataFrame,
    table: str,
    replace_by: tuple[str, ...] = ("date",),
    limit: int | None = None,
    order: list[Column | str] | None = None,
    folder: str | None = None,
    fmt: str = "parquet",
    part: str | None = None,
) -> dict[str, int] | None:
    """Writes a report into a table, replacing the parts it covers.

    ``part`` is the value of the only ``replace_by`` column for a report on one
    part: that part is replaced even if the report has become empty.

    Running it again leaves the table as it is. The report is staged beside the table and
    then switched in part by part, so readers find old or new parts, whole. Columns that the
    table lacks, or of other types than its own, are an error. ``limit`` writes the first rows
    in ``order`` only and gives back how many were offered and written; without it the report
    goes in whole.
    """
    counts = None
    if limit is not None:
        if not order:
            raise ValueError("a limited table needs an order")
        offered = df.count()
        counts = {"offered": offered, "written": min(limit, offered)}
        df = df.orderBy(*order).limit(limit)
    switch_parts(df.sparkSession, stage_report(df, table, replace_by, folder, fmt, part))
    return counts


def relational_statement(table: str, schema: T.StructType) -> str:
    """``CREATE TABLE`` for a relational database."""
    columns = ", ".join(f"{f.name} {_type_name(RELATIONAL_TYPES, f)}" for f in schema.fields)
    return f"CREATE TABLE {table} ({columns})"


def relational_options(url: str, table: str, connections: int = 8, rows: int = INSERT_ROWS) -> dict[str, str]:
    """Writer options: few connections, many rows per round trip."""
    return {"url": url, "dbtable": table, "numPartitions": str(connections), "batchsize": str(rows)}


def insert_relational(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    """Typed bulk insert: nulls stay nulls. A retried task inserts its rows again, so use a staging table."""
    df.write.format("jdbc").options(**relational_options(url, table), **options).mode(mode).save()
