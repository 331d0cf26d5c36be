import base64
import json

import pytest
from pyspark.sql import functions as F

from farelane.functions.text import base64_length, base64_line
from farelane.sinks.objects import get_objects, put_object, write_objects
from farelane.sources.files import read_objects
from farelane.sources.streams import text_messages
from farelane.streaming import media
from workload.queries import QUERIES
from workload.tables import given_stream

META = {"year": "2024", "month": "01", "day": "02"}
FILES = "id string, year string, month string, day string, content binary"


def message(name, content, kind="image_data"):
    return json.dumps({kind: base64.b64encode(content).decode(), "metadata": {"id": name, **META}})


def files(spark, rows):
    return spark.createDataFrame([(name, "2024", "01", "02", content) for name, content in rows], FILES)


@pytest.mark.parametrize("size", [0, 1, 2, 3, 56, 57, 58, 1000])
def test_base64_is_one_line_of_the_length_foretold(spark, size):
    row = spark.createDataFrame([(bytes(range(256)) * 4,)], "b binary").select(F.substring("b", 1, size).alias("b"))
    text, length = row.select(base64_line("b"), base64_length("b")).first()
    assert text == base64.b64encode((bytes(range(256)) * 4)[:size]).decode()
    assert length == len(text)


def test_message_length_is_exact(spark):
    rows = files(spark, [('a"ä\\', b"x" * 500), ("", b"y"), ("b", b"")])
    for kind in media.KINDS:
        for row in media.encode_media(rows, kind).collect():
            assert row["n_bytes"] == len(row["value"].encode())
            assert set(json.loads(row["value"])) == {media.KINDS[kind][0], "metadata"}


def test_gate(spark):
    messages = media.encode_media(files(spark, [("a", b"x" * 30), ("b", b"x" * 300), ("", b"x"), (None, b"x")]), "speech")
    limit = messages.where("id = 'a'").first()["n_bytes"]
    assert [r["id"] for r in media.sendable(messages, limit).collect()] == ["a"]
    assert media.sendable(messages, limit - 1).count() == 0
    refused = media.refused(messages, limit).collect()
    assert sorted((r["id"] or "", r["reason"]) for r in refused) == [("", "no_id"), ("", "no_id"), ("b", "too_long")]


def test_decoding(spark):
    texts = [message("a", b"\xff\xd8data"), '{"image_data": "%%%", "metadata": {"id": "b"}}', "{broken", message("c", b"", "speech_data")]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    objects = media.whole(media.decode_media(df, "image")).collect()
    assert [tuple(r) for r in objects] == [("image/2024/01/02/a.jpg", "image/jpeg", 6, bytearray(b"\xff\xd8data"))]
    sound = media.whole(media.decode_media(df, "speech")).collect()
    assert [(r["path"], r["content_type"], r["n_bytes"]) for r in sound] == [("speech/2024/01/02/c.mp3", "audio/mpeg", 0)]


def test_last_message_of_a_path_wins(spark):
    df = spark.createDataFrame([(message("a", b"old"), 1), (message("a", b"new"), 2), (message("b", b"one"), None)], "value string, at int")
    last = media.latest_per_path(media.decode_media(df, "image", "at"), "at")
    assert {(r["path"][-5:], bytes(r["content"])) for r in last.collect()} == {("a.jpg", b"new"), ("b.jpg", b"one")}


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 1, 0], [1, 2, 0]])
def test_batches_do_not_change_the_last_object(spark, tmp_path, order):
    feed, folder = tmp_path / "feed", str(tmp_path / "out")
    feed.mkdir()
    texts = [message("a", b"1"), message("a", b"4444"), message("a", b"999999999")]
    for n in order:
        (feed / f"{order.index(n)}.txt").write_text("\n".join([texts[n]] * 3))
        source = text_messages(spark, str(feed)).withColumn("at", F.length("value"))
        assert media.start_media(source, "image", folder, "at", once=True).awaitTermination(120)
    assert [bytes(r["content"]) for r in media.read_latest_objects(spark, folder, "at").collect()] == [b"999999999"]
    assert media.read_rejects(spark, folder).count() == 0


def test_failed_object_does_not_stop_the_others(spark, tmp_path):
    root = tmp_path.as_uri()

    def make_put():
        put = put_object(root)

        def picky(path, content, kind):
            if "bad" in path:
                raise OSError("no space")
            put(path, content, kind)

        return picky

    df = spark.createDataFrame([(message(n, n.encode()),) for n in ("a", "bad", "c")], "value string")
    report = write_objects(media.decode_media(df, "image"), make_put).collect()
    assert {r["path"][17:]: r["error"] for r in report} == {"a.jpg": None, "bad.jpg": "OSError: no space", "c.jpg": None}
    stored = read_objects(spark, str(tmp_path), "*.jpg").collect()
    assert sorted(bytes(r["content"]) for r in stored) == [b"a", b"c"]


@pytest.mark.parametrize("single_files", [False, True])
def test_stream_stores_and_goes_on_after_a_restart(spark, tmp_path, single_files):
    feed, folder = tmp_path / "feed", str(tmp_path / "out")
    feed.mkdir()
    root = (tmp_path / "store").as_uri()
    make_put = (lambda: put_object(root)) if single_files else None
    for n, texts in enumerate([[message("a", b"1"), "{broken"], [message("a", b"22"), message("b", b"3")]]):
        (feed / f"{n}.txt").write_text("\n".join(texts))
        source = text_messages(spark, str(feed)).withColumn("at", F.length("value"))
        assert media.start_media(source, "image", folder, "at", make_put, once=True).awaitTermination(120)
    rows = spark.read.parquet(f"{folder}/objects")
    assert rows.groupBy("batch").count().count() == 2 and rows.count() == 3
    assert [tuple(r) for r in media.read_rejects(spark, folder).collect()] == [("{broken", "no_path")]
    if single_files:
        stored = read_objects(spark, str(tmp_path / "store"), "*.jpg").collect()
        assert sorted(bytes(r["content"]) for r in stored) == [b"22", b"3"]


def test_producer_from_files(spark, tmp_path):
    (tmp_path / "x.jpg").write_bytes(b"\x00\x01\x02")
    scanned = read_objects(spark, str(tmp_path), "*.jpg").selectExpr(
        "'x' AS id", "'2024' AS year", "'01' AS month", "'02' AS day", "content"
    )
    sent = media.sendable(media.encode_media(scanned, "image")).first()
    assert sent["value"] == message("x", b"\x00\x01\x02").replace(": ", ":").replace(", ", ",")


@pytest.mark.parametrize("files", [0, 1, 3])
def test_streams_read_a_table_that_is_a_file_or_a_folder(spark, tmp_path, files):
    rows = spark.createDataFrame([(i, f"text {i} " * (1 + i % 5)) for i in range(1, 40)], "doc_id long, text string")
    table, checkpoint = tmp_path / "documents.parquet", tmp_path / "checkpoint"
    if files:
        rows.repartition(files).write.parquet(str(table))
    else:
        rows.toPandas().to_parquet(table)
    rows.limit(1).write.parquet(str(tmp_path / "documents.parquet.old"))
    stream = given_stream(spark, str(tmp_path), "documents").writeStream.format("parquet").option("checkpointLocation", str(checkpoint))
    assert stream.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination(120)
    assert sorted(spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(rows.collect())
    for name in ("media_stream_objects", "media_stream_speech", "media_stream_files"):
        assert QUERIES[name](spark, str(tmp_path)).count() == 38


def test_stored_files_are_listed_and_read_by_tasks(spark, tmp_path):
    names = ["a.jpg", "x/b.jpg", "x/y/z/c d%20ü.jpg", "x/y/empty.jpg", "x/_hidden.jpg", ".hidden/e.jpg", "x/_k=1/f.gz", *(f"many/{n}.jpg" for n in range(5000))]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"" if "empty" in name else name.encode())
    (tmp_path / "x" / "nothing").mkdir()
    got = get_objects(spark, tmp_path.as_uri())
    rows = sorted((r["path"], r["length"], bytes(r["content"])) for r in got.collect())
    assert rows == sorted((n, len(n.encode()), n.encode()) for n in names if "empty" not in n and "hidden" not in n)
    whole = read_objects(spark, str(tmp_path)).selectExpr("path", "length", "content").collect()
    assert rows == sorted((r["path"].split(f"{tmp_path}/", 1)[1], r["length"], bytes(r["content"])) for r in whole)
    assert got.rdd.getNumPartitions() == 1 and not any(f.endswith("jpg") for f in got.inputFiles())


def test_the_driver_does_not_list_the_files_of_a_media_stream(spark, tmp_path):
    rows = [(i, f"text {i}") for i in range(1, 300)]
    spark.createDataFrame(rows, "doc_id long, text string").toPandas().to_parquet(tmp_path / "documents.parquet")
    stored = QUERIES["media_stream_files"](spark, str(tmp_path))
    assert not any("/store/" in f for f in stored.inputFiles())
    assert stored.count() == sum(i % 50 != 7 for i, _ in rows)
