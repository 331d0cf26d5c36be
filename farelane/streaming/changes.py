"""Row changes of the trip table: JSON envelopes in, append log and running counts out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from farelane.functions.calendar import time_from_micros
from farelane.operators.columns import select_if
from farelane.schemas import CORRUPT, CUSTOMER_COUNT, GREEN_AFTER, GREEN_TIMES, change_envelope
from farelane.streaming.newest import FOLD_AFTER, read_newest, start_newest, stored_state


def encode_changes(
    trips: DataFrame, op: Column | None = None, at_ms: Column | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Change messages from rows that have the columns of the after-image.

    A delete has no after-image. ``keep`` passes columns on beside the message.
    """
    op = F.lit("c") if op is None else op
    after = F.struct(
        *[
            (F.unix_micros(F.col(name).cast("timestamp")) if name in GREEN_TIMES else F.col(name)).alias(name)
            for name in GREEN_AFTER.names
        ]
    )
    payload = F.struct(
        F.when(op != "d", after).alias("after"),
        op.alias("op"),
        (F.lit(None).cast("long") if at_ms is None else at_ms).alias("ts_ms"),
    )
    return trips.select(*keep, F.to_json(F.struct(payload.alias("payload"))).alias("value"))


def decode_changes(messages: DataFrame) -> DataFrame:
    """The message text and the parsed envelope; text that is not JSON has no payload."""
    text = F.col("value").cast("string")
    envelope = F.from_json(
        text, change_envelope(), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    return messages.select(text.alias("value"), envelope.alias("data"))


def parse_changes(messages: DataFrame) -> DataFrame:
    """After-images as trip rows. Messages without one give no row; updates are further rows."""
    after = F.col("data.payload.after")
    images = select_if(decode_changes(messages), after.isNotNull(), "data.payload.after.*")
    return images.withColumns({name: time_from_micros(name) for name in GREEN_TIMES})


def rejected_changes(messages: DataFrame) -> DataFrame:
    """Messages that give no row, with the reason."""
    reason = (
        F.when(F.col("value").isNull(), "empty")
        .when(F.col(f"data.{CORRUPT}").isNotNull(), "malformed")
        .when(F.col("data.payload.op") == "d", "delete")
        .otherwise("no_after")
    )
    without = F.col("data.payload.after").isNull()
    return select_if(decode_changes(messages), without, "value", reason.alias("reason"))


def running_counts(trips: DataFrame) -> DataFrame:
    """Changes per customer. On a stream the state holds one number per customer and is never dropped."""
    return trips.groupBy("id_customer").agg(F.count("*").alias("customer_count"))


def start_append(rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", once: bool = False) -> StreamingQuery:
    """Appends every row exactly once; the file sink's log hides files of failed attempts."""
    writer = (
        rows.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


# Copies of the count table: the one being written and the one before it.
SLOTS = 2


def start_counts(counts: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", once: bool = False) -> StreamingQuery:
    """Writes the whole count table at each trigger, for tables that are small.

    Batches take turns in two folders, so readers find a whole table while the
    next one is written, and a repeated batch replaces its own rows.
    """

    def write(table: DataFrame, batch: int) -> None:
        (
            table.withColumns({"batch": F.lit(batch), "slot": F.lit(batch % SLOTS)})
            .write.format(fmt)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("slot")
            .save(path)
        )

    writer = counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_counts(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The newest whole count table."""
    table = spark.read.format(fmt).load(path)
    newest = table.agg(F.max("batch").alias("batch"))
    return table.where(F.col("batch") == newest.scalar()).drop("batch", "slot")


def start_changed_counts(
    counts: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", once: bool = False, every: int = FOLD_AFTER
) -> StreamingQuery:
    """Writes the counts that a trigger changed; read them with ``read_changed_counts``."""
    return start_newest(counts, ["id_customer"], path, checkpoint, fmt, every, once)


def read_changed_counts(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_newest(spark, path, CUSTOMER_COUNT, ["id_customer"], fmt)


def counts_in_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """id_customer, customer_count as the checkpoint of the running count holds them."""
    key, value = stored_state(spark, checkpoint).columns
    return stored_state(spark, checkpoint).select(F.col(key).alias("id_customer"), F.col(value).alias("customer_count"))


def recovery_gaps(spark: SparkSession, folder: str, fmt: str = "parquet") -> DataFrame:
    """Customers for whom the state, the count table and the append log of an ingest job differ.

    Empty when all three went equally far: after a run that took all messages, and after any
    stop once the job has gone on to the end.
    """
    logged = spark.read.format(fmt).load(f"{folder}/data").groupBy("id_customer").agg(F.count("*").alias("logged"))
    counted = read_changed_counts(spark, f"{folder}/count_customer", fmt).withColumnRenamed("customer_count", "counted")
    state = counts_in_state(spark, f"{folder}/count_checkpoint").withColumnRenamed("customer_count", "in_state")
    every = None
    for part in (logged, counted, state):
        named = part.withColumnRenamed("id_customer", "_id")
        every = named if every is None else (
            every.join(named.withColumnRenamed("_id", "_other"), F.col("_id").eqNullSafe(F.col("_other")), "full")
            .withColumn("_id", F.coalesce("_id", "_other")).drop("_other")
        )
    same = F.col("logged").eqNullSafe(F.col("counted")) & F.col("counted").eqNullSafe(F.col("in_state"))
    return every.where(~same).withColumnRenamed("_id", "id_customer")


def start_ingest(
    messages: DataFrame, folder: str, fmt: str = "parquet", once: bool = False, every: int = FOLD_AFTER
) -> tuple[StreamingQuery, StreamingQuery, StreamingQuery]:
    """The queries of the job, each with its own checkpoint below ``folder``: rows, counts, rejects.

    Messages that give no row go to ``rejects`` with the reason. The counts are written by
    changed keys and folded after ``every`` batches. Wait with
    ``spark.streams.awaitAnyTermination()``, which also ends when one of them
    fails. Started again on the same folder, all go on where they stopped.
    """
    trips = parse_changes(messages)
    return (
        start_append(trips, f"{folder}/data", f"{folder}/checkpoint", fmt, once),
        start_changed_counts(running_counts(trips), f"{folder}/count_customer", f"{folder}/count_checkpoint", fmt, once, every),
        start_append(rejected_changes(messages), f"{folder}/rejects", f"{folder}/rejects_checkpoint", fmt, once),
    )
