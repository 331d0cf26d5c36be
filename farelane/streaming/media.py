"""Images and sound as base64 messages: encoding, size gate, decoding, storing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from farelane.functions.text import base64_bytes, base64_length, base64_line, object_path
from farelane.operators.columns import select_if
from farelane.schemas import MEDIA_METADATA
from farelane.sinks.objects import Put, write_objects

# Message field, object prefix, file extension and content type of each kind.
KINDS = {
    "image": ("image_data", "image", "jpg", "image/jpeg"),
    "speech": ("speech_data", "speech", "mp3", "audio/mpeg"),
}
# Fixed value: longest message in bytes, 5 MiB.
MAX_MESSAGE_BYTES = 5 * 1024 * 1024


def encode_media(files: DataFrame, kind: str) -> DataFrame:
    """Messages from rows with ``id``, ``year``, ``month``, ``day`` and binary ``content``.

    ``n_bytes`` is the length of the message, found without encoding the
    content, so that refused messages are never built.
    """
    field = KINDS[kind][0]
    metadata = F.struct(*[F.col(name).cast("string").alias(name) for name in MEDIA_METADATA.names]).alias("metadata")
    empty = F.to_json(F.struct(F.lit("").alias(field), metadata))
    return files.select(
        "id",
        (F.octet_length(empty) + base64_length("content")).alias("n_bytes"),
        F.to_json(F.struct(base64_line("content").alias(field), metadata)).alias("value"),
    )


def refusal(max_bytes: int = MAX_MESSAGE_BYTES) -> Column:
    """Why a message may not be sent, null if it may."""
    return F.when(F.coalesce(F.length("id"), F.lit(0)) == 0, "no_id").when(
        F.col("n_bytes") > max_bytes, "too_long"
    )


def sendable(messages: DataFrame, max_bytes: int = MAX_MESSAGE_BYTES) -> DataFrame:
    return messages.where(refusal(max_bytes).isNull())


def refused(messages: DataFrame, max_bytes: int = MAX_MESSAGE_BYTES) -> DataFrame:
    """Refused messages: id, length in bytes and reason."""
    return gate(messages, max_bytes).where("reason IS NOT NULL")


def gate(messages: DataFrame, max_bytes: int = MAX_MESSAGE_BYTES) -> DataFrame:
    """Every message: id, length in bytes and why it is refused, null if it is sent."""
    return messages.select("id", "n_bytes", refusal(max_bytes).alias("reason"))


def decode_media(messages: DataFrame, kind: str, *keep: str) -> DataFrame:
    """Objects from messages; ``content`` is null for a broken message. ``keep`` passes columns on."""
    field, prefix, ext, content_type = KINDS[kind]
    shape = StructType([StructField(field, StringType(), True), StructField("metadata", MEDIA_METADATA, True)])
    data = messages.select(*keep, F.from_json(F.col("value").cast("string"), shape).alias("data"))
    meta = {name: F.col(f"data.metadata.{name}") for name in MEDIA_METADATA.names}
    objects = data.select(
        *keep,
        object_path(prefix, meta["year"], meta["month"], meta["day"], meta["id"], ext).alias("path"),
        F.lit(content_type).alias("content_type"),
        base64_bytes(F.col(f"data.{field}")).alias("content"),
    )
    return objects.select(*keep, "path", "content_type", F.octet_length("content").cast("long").alias("n_bytes"), "content")


def whole(objects: DataFrame) -> DataFrame:
    """Objects that can be stored."""
    return select_if(objects, F.col("path").isNotNull() & F.col("content").isNotNull(), *objects.columns)


def rejection() -> Column:
    """Why a decoded message gives no object, null if it gives one."""
    return F.when(F.col("path").isNull(), "no_path").when(F.col("content").isNull(), "no_content")


def latest_per_path(objects: DataFrame, *order: str) -> DataFrame:
    """The last object of each path under ``order``, ties to the larger digest; copies are given once.

    The last one is found without its content, and only the objects that have won
    are grouped by path, so the contents of a hot path never meet in one task.
    """
    digest = F.xxhash64("content", "content_type")
    place = F.struct(*order, digest.alias("_digest"))
    newest = objects.groupBy("path").agg(F.max(place).alias("_newest")).select(F.col("path").alias("_path"), "_newest")
    won = objects.join(newest, (objects["path"] == newest["_path"]) & place.eqNullSafe(newest["_newest"]), "left_semi")
    columns = [c for c in objects.columns if c != "path"]
    once = won.groupBy("path").agg(F.first(F.struct(*columns)).alias("last"))
    return once.select("path", *[f"last.{c}" for c in columns])


def start_media(
    messages: DataFrame,
    kind: str,
    folder: str,
    order: str,
    make_put: Callable[[], Put] | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Decodes and stores each batch below ``folder``.

    The last object of each path goes to ``objects`` with its ``order``, one folder
    per batch, which a repeated batch replaces; ``read_latest_objects`` finds the
    last one over all batches. With ``make_put`` the content goes to single files
    instead, where a later batch overwrites, and ``objects`` holds the report on
    them. Messages that give no object go to ``rejects`` with the reason.
    """
    rows = decode_media(messages, kind, order, "value")

    def store(batch: DataFrame, number: int) -> None:
        def write(df: DataFrame, name: str) -> None:
            df.withColumn("batch", F.lit(number)).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("batch").parquet(f"{folder}/{name}")

        decoded = batch.withColumn("reason", rejection()).persist(StorageLevel.DISK_ONLY)
        try:
            last = latest_per_path(decoded.where("reason IS NULL").drop("reason", "value"), order)
            write(write_objects(last, make_put) if make_put else last, "objects")
            write(decoded.where("reason IS NOT NULL").select(F.col("value").cast("string").alias("value"), "reason"), "rejects")
        finally:
            decoded.unpersist()

    writer = rows.writeStream.option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(store)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_latest_objects(spark: SparkSession, folder: str, order: str) -> DataFrame:
    """The last object of each path over all batches of ``start_media``, however messages fell into them."""
    return latest_per_path(spark.read.parquet(f"{folder}/objects").drop("batch"), order)


def read_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of all batches that gave no object, with the reason."""
    rejects = spark.read.schema("value string, reason string, batch long").parquet(f"{folder}/rejects")
    return rejects.select("value", "reason")
