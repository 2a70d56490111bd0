from __future__ import annotations

from collections import Counter
from datetime import date, timedelta

from revaudit.operators.generate import generate_reviews
from revaudit.streaming.live import append_clean_rows, clean_rows, drop_repeated_ids


def test_stream_equals_batch_and_continues(spark, tmp_path):
    source, out, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))
    first, second = generate_reviews(spark, 400), generate_reviews(spark, 300, seed=9)
    first.write.parquet(source)
    live = spark.readStream.schema(first.schema).parquet(source)
    append_clean_rows(live, out, progress).awaitTermination()
    assert spark.read.parquet(out).count() == 396
    second.write.mode("append").parquet(source)
    append_clean_rows(live, out, progress).awaitTermination()
    found = spark.read.parquet(out)
    expected = clean_rows(spark.read.parquet(source))
    assert found.columns == expected.columns and found.count() == 396 + 297
    assert found.exceptAll(expected).count() == 0


def test_default_progress_loses_and_repeats_nothing(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    first, second = generate_reviews(spark, 100), generate_reviews(spark, 300, seed=9)
    first.write.parquet(source)
    live = spark.readStream.schema(first.schema).parquet(source)
    append_clean_rows(live, out).awaitTermination()
    second.write.mode("append").parquet(source)
    for _ in range(2):  # the second time there is nothing new
        append_clean_rows(live, out).awaitTermination()
        expected = clean_rows(spark.read.parquet(source))
        found = spark.read.parquet(out)
        assert found.count() == expected.count() > 390
        assert found.exceptAll(expected).count() == 0


def test_repeated_ids_go_within_the_delay(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    kinds = "review_id string, date date, text string"

    def arrive(*rows):
        dated = [(i, None if d is None else date(2024, 1, 1) + timedelta(days=d), t) for i, d, t in rows]
        spark.createDataFrame(dated, kinds).coalesce(1).write.mode("append").parquet(source)
        live = drop_repeated_ids(spark.readStream.schema(kinds).parquet(source), "5 days")
        started = live.writeStream.option("checkpointLocation", str(tmp_path / "notes")).trigger(availableNow=True)
        started.start(out, format="parquet", outputMode="append").awaitTermination()
        return Counter(r["text"] for r in spark.read.parquet(out).collect())

    seen = arrive(("a", 10, "a1"), ("b", 11, "b1"), (None, 10, "none"), ("a", None, "undated"), ("b", 11, "b1"))
    assert seen == Counter(["a1", "b1", "none", "undated"])
    # restarted: a and b are still held, rows without an id or a date pass
    seen = arrive(("a", 12, "a2"), ("c", 30, "c1"), (None, 10, "none"), ("a", None, "undated"))
    assert seen == Counter(["a1", "b1", "none", "none", "undated", "undated", "c1"])
    # the mark is at day 25: older rows are late, and a is no longer held
    seen = arrive(("d", 12, "late"), ("a", 31, "a3"), ("c", 29, "c2"))
    assert seen["late"] == 0 and seen["a3"] == 1 and seen["c2"] == 0
