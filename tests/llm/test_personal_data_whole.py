"""Learned contexts on large corpora and by a join, long identifiers: nothing is lost."""

from pyspark.sql import functions as F

from farelane.llm import pii

CALLS = [(i, f"text {'abc'[i % 3]} then call me: +1 (743) 555-{1000 + i} bye") for i in range(20)]
ASKED = [(100, "please call me: 743-555-2222 now"), (101, "invoice 743-555-2222 paid"), (102, None), (None, "call me: 743-555-2222"), (100, "please call me: 743-555-2222 now")]


def test_a_context_stays_reliable_beside_a_hot_source(spark):
    calls = spark.createDataFrame(CALLS + ASKED, "doc_id long, text string")
    address = F.concat_ws(".", F.lit("host 10"), (F.col("id") / 65536).cast("int"), (F.col("id") / 256).cast("int") % 256, F.col("id") % 256)
    hot = spark.range(1_500_000).groupBy((F.col("id") / 3000).cast("long").alias("doc_id")).agg(F.concat_ws(" ", F.collect_list(address)).alias("text"))
    assert pii.reliable_patterns(calls.unionByName(hot)).get("call me:") == "phone"


def test_joined_patterns_equal_shipped_ones(spark, monkeypatch):
    table = spark.createDataFrame(CALLS + ASKED, "doc_id long, text string").withColumn("source", F.lit("s"))
    shipped = [pii.find_personal_data(table), pii.mask_personal_data(table)]
    shipped = [sorted(map(repr, t.collect())) for t in shipped]
    monkeypatch.setattr(pii, "FEW_PATTERNS", 0)
    joined = [pii.find_personal_data(table), pii.mask_personal_data(table)]
    assert joined[1].columns == table.columns
    assert [sorted(map(repr, t.collect())) for t in joined] == shipped
    assert sum("call me: [PHONE]" in row for row in shipped[1]) == 23


def test_a_long_identifier_is_masked_whole():
    for digits in (24, 25, 28, 60):
        text = f"call me: {'7' * digits} bye"
        assert pii.masked(text, pii.all_spans(text, {"call me:": "phone"})[1]) == "call me: [PHONE] bye"
    text = "call me: 743-555-2222 10.0.0.1 " + "5" * 30
    spans = pii.all_spans(text, {"call me:": "phone"})[1]
    assert [text[a:b] for a, b, _ in spans] == ["743-555-2222", "10.0.0.1", "5" * 30]
