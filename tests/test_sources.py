from __future__ import annotations

import json

import pytest

from revaudit.sources.readers import load_reviews, read_reviews_csv
from revaudit.sources.writers import write_csv, write_json, write_text


def test_missing_tokens_and_quoted_cells(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(
        "review_id,text,rating,useful_votes,has_owner_response,note\n"
        'R1,nan,4.0,3.0,True,x\n'
        'R2,null,,,False,NA\n'
        'R3,None,5,1,,y\n'
        'R4,"",1,0,True,z\n'
        'R5,NA,2,0,True,z\n'
        'R6,none,2.5,0,True,z\n'
        'R7,"say ""hi""\nagain, ok",3,0,True,z\n'
        'R8, leading blank ,3,0,True,z\n'
    )
    rows = {r["review_id"]: r for r in read_reviews_csv(spark, str(path)).collect()}
    assert [rows[f"R{i}"]["text"] for i in range(1, 6)] == [None] * 5
    assert rows["R6"]["text"] == "none" and rows["R6"]["rating"] == 2.5
    assert rows["R7"]["text"] == 'say "hi"\nagain, ok'
    assert rows["R8"]["text"] == " leading blank "
    assert rows["R1"]["useful_votes"] == 3 and rows["R2"]["useful_votes"] is None
    assert rows["R1"]["has_owner_response"] is True and rows["R3"]["has_owner_response"] is None
    assert rows["R2"]["note"] is None


def test_malformed_number_raises(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text("review_id,useful_votes\nR1,4.5\n")
    with pytest.raises(Exception, match="4.5"):
        read_reviews_csv(spark, str(path)).collect()


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("R1", ' a "b"\n, c\r\nd ', 4.5, 3), ("R2", None, None, None)],
        "review_id string, text string, rating double, useful_votes long",
    )
    write_csv(df, str(tmp_path / "out"))
    assert sorted(read_reviews_csv(spark, str(tmp_path / "out")).collect()) == sorted(df.collect())


def test_local_source_generates_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    first = load_reviews(spark, "local", path)
    assert first.count() == 5000 and first.filter("text IS NULL").count() == 50
    again = load_reviews(spark, "local", path, n=7)
    assert again.count() == 5000


def test_half_written_folders_are_not_read(spark, tmp_path):
    path = tmp_path / "raw"
    write_csv(load_reviews(spark, "synthetic", n=50).repartition(4), str(path))
    (path / "_SUCCESS").unlink()
    next(path.glob("part-*")).unlink()
    with pytest.raises(ValueError, match="half-written"):
        load_reviews(spark, "csv", str(path))
    assert load_reviews(spark, "local", str(path), n=60).count() == 60
    assert load_reviews(spark, "csv", str(path)).count() == 60
    with pytest.raises(ValueError, match="missing"):
        load_reviews(spark, "csv", str(tmp_path / "absent"))
    single = tmp_path / "one.csv"
    single.write_text("review_id,text\nR1,fine\n")
    assert load_reviews(spark, "csv", str(single)).count() == 1
    assert load_reviews(spark, "local", str(single)).count() == 1


def test_other_sources(spark, tmp_path):
    df = load_reviews(spark, "synthetic", n=20)
    df.write.parquet(str(tmp_path / "p"))
    assert load_reviews(spark, "parquet", str(tmp_path / "p")).count() == 20
    write_csv(df, str(tmp_path / "c"))
    assert load_reviews(spark, "csv", str(tmp_path / "c"), multi_line=False).count() == 20
    df.createOrReplaceTempView("some_reviews")
    assert load_reviews(spark, "table", "some_reviews").count() == 20
    with pytest.raises(ValueError, match="Unknown source: api"):
        load_reviews(spark, "api")


def test_report_files(spark, tmp_path):
    report = spark.sql("SELECT 1 AS n, true AS ok, named_struct('x', CAST(NULL AS INT)) AS inner")
    write_json(report, str(tmp_path / "j"))
    (part,) = (tmp_path / "j").glob("part-*")
    assert json.loads(part.read_text()) == {"n": 1, "ok": True, "inner": {"x": None}}
    write_text(spark, ["# T", "", "- a"], str(tmp_path / "t"))
    (part,) = (tmp_path / "t").glob("part-*")
    assert part.read_text() == "# T\n\n- a\n"
