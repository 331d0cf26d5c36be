import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from farelane.schemas import GREEN_AFTER
from farelane.sources.streams import kafka_options, text_messages
from farelane.streaming import changes, newest

AFTER = {
    "vendorid": 2,
    "lpep_pickup_datetime": 1704158700123456,
    "lpep_dropoff_datetime": 1704159300000000,
    "store_and_fwd_flag": "N",
    "total_amount": 12.5,
    "id": "20240100000001",
    "id_customer": 5,
}


def message(op="c", **after):
    return json.dumps({"schema": {"type": "struct"}, "payload": {"before": None, "after": AFTER | after, "op": op}})


BROKEN = '{"payload": {"af'
DELETE = json.dumps({"payload": {"before": {}, "after": None, "op": "d"}})
TEXTS = [message(), message("u", total_amount=13.0), message(id_customer=6), DELETE, BROKEN, None, "{}"]


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_after_images(spark):
    rows = changes.parse_changes(frame(spark, TEXTS))
    assert rows.columns == GREEN_AFTER.names
    got = rows.withColumn("at", F.col("lpep_pickup_datetime").cast("string")).orderBy("id_customer", "total_amount").collect()
    assert [(r["id_customer"], r["total_amount"]) for r in got] == [(5, 12.5), (5, 13.0), (6, 12.5)]
    assert got[0]["at"] == "2024-01-02 01:25:00.123456"
    assert got[0]["trip_type"] is None


def test_bytes_as_from_a_topic(spark):
    rows = frame(spark, TEXTS).select(F.encode("value", "UTF-8").alias("value"))
    assert changes.parse_changes(rows).count() == 3


def test_a_field_of_the_wrong_type_becomes_null(spark):
    row = changes.parse_changes(frame(spark, [message(vendorid="many")])).first()
    assert row["vendorid"] is None and row["id_customer"] == 5


def test_reasons(spark):
    rows = changes.rejected_changes(frame(spark, TEXTS)).collect()
    assert {(r["value"], r["reason"]) for r in rows} == {
        (DELETE, "delete"),
        (BROKEN, "malformed"),
        (None, "empty"),
        ("{}", "no_after"),
    }


def test_encoding_comes_back(spark):
    first = changes.parse_changes(frame(spark, TEXTS[:3]))
    again = changes.parse_changes(changes.encode_changes(first))
    assert sorted(map(repr, first.collect())) == sorted(map(repr, again.collect()))
    deletes = changes.encode_changes(first, op=F.lit("d"))
    assert changes.parse_changes(deletes).count() == 0


def wait(*running):
    for query in running:
        assert query.awaitTermination(120)


def test_restart_loses_and_repeats_nothing(spark, tmp_path):
    feed, folder = tmp_path / "feed", str(tmp_path / "out")
    feed.mkdir()
    for round_no, texts in enumerate([TEXTS, [message(id_customer=6), BROKEN], []]):
        (feed / f"{round_no}.txt").write_text("\n".join(t or "" for t in texts))
        wait(*changes.start_ingest(text_messages(spark, str(feed)), folder, once=True))
    rows = spark.read.parquet(f"{folder}/data")
    assert rows.count() == 4
    counts = changes.read_changed_counts(spark, f"{folder}/count_customer")
    assert changes.recovery_gaps(spark, folder).count() == 0
    assert counts.columns == ["id_customer", "customer_count"]
    assert {tuple(r) for r in counts.collect()} == {(5, 2), (6, 2)}
    rejected = spark.read.parquet(f"{folder}/rejects")
    assert sorted(r["reason"] for r in rejected.collect()) == sorted(
        r["reason"] for r in changes.rejected_changes(frame(spark, [t or "" for t in TEXTS] + [BROKEN])).collect()
    )


def test_count_table_keeps_two_copies(spark, tmp_path):
    feed, path = tmp_path / "feed", str(tmp_path / "counts")
    feed.mkdir()
    for n in range(5):
        (feed / f"{n}.txt").write_text(message(id_customer=n))
    source = text_messages(spark, str(feed), files_per_trigger=1)
    wait(changes.start_counts(changes.running_counts(changes.parse_changes(source)), path, str(tmp_path / "c"), once=True))
    assert spark.read.parquet(path).select("slot").distinct().count() == 2
    assert {tuple(r) for r in changes.read_counts(spark, path).collect()} == {(n, 1) for n in range(5)}


def _feed_counts(spark, feed, path, checkpoint, batches, every=2):
    """One trigger per list of customers, each with new files only; the rows that every trigger wrote."""
    for n, customers in batches:
        (feed / f"{n}.txt").write_text("\n".join(message(id_customer=c) for c in customers))
        source = text_messages(spark, str(feed), files_per_trigger=1)
        wait(changes.start_changed_counts(changes.running_counts(changes.parse_changes(source)), path, checkpoint, once=True, every=every))


def test_a_trigger_writes_changed_keys_only(spark, tmp_path):
    feed, path, checkpoint = tmp_path / "feed", str(tmp_path / "counts"), str(tmp_path / "c")
    feed.mkdir()
    _feed_counts(spark, feed, path, checkpoint, [(0, range(50)), (1, [3]), (2, [3, 60])], every=100)
    written = spark.read.parquet(f"{path}/changes").groupBy("batch").count().collect()
    assert {r["batch"]: r["count"] for r in written} == {0: 50, 1: 1, 2: 2}
    counts = {r[0]: r[1] for r in changes.read_changed_counts(spark, path).collect()}
    assert counts == {c: 1 for c in [*range(50), 60]} | {3: 3}


def test_folds_keep_counts_and_bound_files(spark, tmp_path):
    feed, path, checkpoint = tmp_path / "feed", str(tmp_path / "counts"), str(tmp_path / "c")
    feed.mkdir()
    expected: dict[int, int] = {}
    for n in range(9):
        customers = [n % 4, 10 + n, 7]
        _feed_counts(spark, feed, path, checkpoint, [(n, customers)])
        for c in customers:
            expected[c] = expected.get(c, 0) + 1
        assert {r[0]: r[1] for r in changes.read_changed_counts(spark, path).collect()} == expected, n
    # Three turns of changes and two bases stay, whatever the number of batches.
    assert spark.read.parquet(f"{path}/changes").select("batch").distinct().count() <= 3 * 2
    assert spark.read.parquet(f"{path}/base").select("slot").distinct().count() == 2
    assert {r[0]: r[1] for r in changes.counts_in_state(spark, checkpoint).collect()} == expected


def test_folds_of_a_table_keep_their_length(spark, tmp_path):
    feed, path, checkpoint = tmp_path / "feed", str(tmp_path / "counts"), str(tmp_path / "c")
    feed.mkdir()
    _feed_counts(spark, feed, path, checkpoint, [(0, [1, 2])], every=3)
    with pytest.raises(ValueError, match="folds after"):
        _feed_counts(spark, feed, path, checkpoint, [(1, [2])], every=2)


def test_a_repeated_batch_counts_once(spark, tmp_path):
    """The batch is taken off the commit log, as if the job had died before it ended."""
    feed, path, checkpoint = tmp_path / "feed", str(tmp_path / "counts"), str(tmp_path / "c")
    feed.mkdir()
    _feed_counts(spark, feed, path, checkpoint, [(0, [1, 2]), (1, [2])])
    for name in ("1", ".1.crc"):
        (tmp_path / "c" / "commits" / name).unlink()
    _feed_counts(spark, feed, path, checkpoint, [(2, [5])])
    assert {tuple(r) for r in changes.read_changed_counts(spark, path).collect()} == {(1, 1), (2, 2), (5, 1)}


def test_state_of_a_stopped_job(spark, tmp_path):
    """RocksDB with changelog checkpoints: what the state reader finds is what was counted."""
    settings = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        feed, folder = tmp_path / "feed", str(tmp_path / "out")
        feed.mkdir()
        for n, customers in enumerate([[1, 2], [2, 3], [2]]):
            (feed / f"{n}.txt").write_text("\n".join(message(id_customer=c) for c in customers))
            wait(*changes.start_ingest(text_messages(spark, str(feed), files_per_trigger=1), folder, once=True))
            assert changes.recovery_gaps(spark, folder).count() == 0
        assert {tuple(r) for r in changes.counts_in_state(spark, f"{folder}/count_checkpoint").collect()} == {(1, 1), (2, 3), (3, 1)}
        (operator,) = newest.state_metadata(spark, f"{folder}/count_checkpoint").select("operatorName").distinct().collect()
        assert operator[0] == "stateStoreSave"
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_gaps_are_found(spark, tmp_path):
    feed, folder = tmp_path / "feed", str(tmp_path / "out")
    feed.mkdir()
    (feed / "0.txt").write_text("\n".join(message(id_customer=c) for c in (1, 2, 2)))
    wait(*changes.start_ingest(text_messages(spark, str(feed)), folder, once=True))
    log = spark.read.parquet(f"{folder}/data").where("id_customer = 1")
    log.write.parquet(f"{folder}/other/data")
    (tmp_path / "out" / "count_customer").rename(tmp_path / "out" / "other" / "count_customer")
    (tmp_path / "out" / "count_checkpoint").rename(tmp_path / "out" / "other" / "count_checkpoint")
    gaps = changes.recovery_gaps(spark, f"{folder}/other").collect()
    assert [(r["id_customer"], r["logged"], r["counted"], r["in_state"]) for r in gaps] == [(2, None, 2, 2)]


def test_kafka_options():
    options = kafka_options("trips.public.green", ["a:1", "b:2"], max_offsets=10)
    assert options["kafka.bootstrap.servers"] == "a:1,b:2"
    assert (options["startingOffsets"], options["failOnDataLoss"]) == ("earliest", "false")
    assert options["maxOffsetsPerTrigger"] == "10"
    assert "maxOffsetsPerTrigger" not in kafka_options("t", ["a:1"])


@pytest.mark.parametrize("micros, text", [(0, "1970-01-01 00:00:00"), (-1, "1969-12-31 23:59:59.999999")])
def test_times_are_exact(spark, micros, text):
    row = changes.parse_changes(frame(spark, [message(lpep_pickup_datetime=micros)]))
    assert row.select(F.col("lpep_pickup_datetime").cast("string")).first()[0] == text


def test_naive_times_survive_the_round_trip(spark):
    at = datetime(2024, 3, 4, 5, 6, 7, 8)
    trips = changes.parse_changes(frame(spark, [message()])).withColumn("lpep_pickup_datetime", F.lit(at).cast("timestamp_ntz"))
    back = changes.parse_changes(changes.encode_changes(trips))
    assert back.select(F.col("lpep_pickup_datetime").cast("timestamp_ntz")).first()[0] == at
