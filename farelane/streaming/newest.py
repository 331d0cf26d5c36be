"""A table of the newest row per key, kept by a stream that writes changed keys only.

``changes`` holds one folder per batch, ``base`` the newest rows up to some batch. After every
``every`` batches the changes are folded into a new base; a marker then names the base that
counts. Folders are written again after the turns below, so readers of the base before a fold
find all its files until the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

#: Batches between two folds.
FOLD_AFTER = 16
#: Turns of the folders: changes of so many folds, and so many bases, lie side by side.
CHANGE_SLOTS, BASE_SLOTS = 3, 2
MARKERS = "fold long, first_batch long, every long"


def _prepare(spark: SparkSession, path: str, every: int) -> None:
    """The marker of a table without a base, unless there is one; folds of a table keep their length."""
    marker = spark.range(1).select(*(F.lit(v).cast("long").alias(n) for n, v in (("fold", -1), ("first_batch", 0), ("every", every))))
    marker.write.mode("ignore").parquet(f"{path}/markers")
    kept = {r["every"] for r in spark.read.schema(MARKERS).parquet(f"{path}/markers").select("every").distinct().collect()}
    if kept != {every}:
        raise ValueError(f"{path} folds after {sorted(kept)} batches, not after {every}")


def _marker(spark: SparkSession, path: str) -> tuple[int, int]:
    newest = spark.read.schema(MARKERS).parquet(f"{path}/markers").agg(F.max(F.struct("fold", "first_batch")).alias("m")).first()["m"]
    return newest["fold"], newest["first_batch"]


def newest_rows(rows: DataFrame, keys: list[str], by: str) -> DataFrame:
    """The row of the highest ``by`` for every key; sums up before the shuffle."""
    values = [c for c in rows.columns if c not in (*keys, by)]
    best = rows.groupBy(*keys).agg(F.max(F.struct(by, *values)).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in values])


def _gathered(spark: SparkSession, path: str, schema: StructType, keys: list[str], fmt: str, slots: list[int], before: int | None = None) -> DataFrame:
    """The newest rows of the base that counts and of all changes since, up to a batch."""
    fold, first_batch = _marker(spark, path)
    written = StructType([*schema.fields, StructField("slot", IntegerType()), StructField("batch", LongType())])
    changes = spark.read.schema(written).format(fmt).load(f"{path}/changes")
    changes = changes.where(F.col("slot").isin(slots) & (F.col("batch") >= first_batch))
    changes = changes.drop("slot") if before is None else changes.where(F.col("batch") < before).drop("slot")
    if fold >= 0:
        base = spark.read.schema(schema).format(fmt).load(f"{path}/base/slot={fold % BASE_SLOTS}")
        changes = changes.unionByName(base.withColumn("batch", F.lit(-1).cast("long")))
    return newest_rows(changes, keys, "batch")


def start_newest(
    table: DataFrame,
    keys: list[str],
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    every: int = FOLD_AFTER,
    once: bool = False,
) -> StreamingQuery:
    """Writes the rows that a trigger changed, one folder per batch; a repeated batch replaces its own.

    ``table`` is an aggregation by ``keys``. A trigger costs as much as it changes; the whole
    table is written once in ``every`` batches.
    """
    spark, schema = table.sparkSession, table.schema
    _prepare(spark, path, every)

    def write(changed: DataFrame, batch: int) -> None:
        fold, place = divmod(batch, every)
        slot = fold % CHANGE_SLOTS
        folder = f"{path}/changes/slot={slot}"
        if place == 0:  # the slot still holds the changes of an earlier turn
            rows = changed.withColumn("batch", F.lit(batch).cast("long")).write.format(fmt).mode("overwrite")
            rows.option("partitionOverwriteMode", "static").partitionBy("batch").save(folder)
        else:
            changed.write.format(fmt).mode("overwrite").save(f"{folder}/batch={batch}")
        if place == every - 1:
            session = changed.sparkSession
            whole = _gathered(session, path, schema, keys, fmt, [slot], batch + 1)
            if _marker(session, path)[0] < fold:
                whole.write.format(fmt).mode("overwrite").save(f"{path}/base/slot={fold % BASE_SLOTS}")
                told = (("fold", fold), ("first_batch", batch + 1), ("every", every))
                marker = session.range(1).select(*(F.lit(v).cast("long").alias(n) for n, v in told))
                marker.write.mode("append").parquet(f"{path}/markers")

    writer = table.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_newest(spark: SparkSession, path: str, schema: StructType, keys: list[str], fmt: str = "parquet") -> DataFrame:
    """The table as of the last batch written, one row per key."""
    return _gathered(spark, path, schema, keys, fmt, list(range(CHANGE_SLOTS)))


def stored_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Keys and values of the only stateful operator of a checkpoint, as its last batch left them."""
    return spark.read.format("statestore").load(checkpoint).select("key.*", "value.*")


def state_metadata(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Operator, store, partitions and batches of the state in a checkpoint."""
    return spark.read.format("state-metadata").load(checkpoint)
