"""Training, grid search, metrics and file discovery."""

import pytest
from pyspark.sql import functions as F

from corvane.operators import training
from corvane.sources import files, posts


def test_classifier_learns_and_follows_the_rule(spark):
    rows = spark.createDataFrame([(k, "good fine nice" if k % 4 == 0 else "bad poor awful", int(k % 4 == 0)) for k in range(80)], "id long, text string, label int")
    model = training.fit_classifier(rows)
    out = training.classify(model, rows, "race")
    assert out.columns == ["id", "text", "label", "predicted", "p"] and out.where("predicted <> label").count() == 0


def test_grid_search_resumes(spark, tmp_path, monkeypatch):
    users = [(f"u{k}", "g" if k % 2 else "h") for k in range(20)]
    own = spark.createDataFrame([(u, f"w:{g}{i}", 3) for u, g in users for i in range(3)] + [(u, "w:all", 5) for u, _ in users], "author string, feature string, cnt long")
    train = spark.createDataFrame(users[:14], "author string, location string")
    valid = spark.createDataFrame(users[14:], "author string, label string")
    grid = (training.Config(vocab_size=5), training.Config(vocab_size=1, selector="freq"))
    best = training.grid_search(spark, own, train, valid, str(tmp_path / "grid"), grid)
    assert best == grid[0] and len({c.key for c in training.GRID}) == 6
    monkeypatch.setattr(training, "fit_location", None)  # a restart trains nothing again
    assert training.grid_search(spark, own, train, valid, str(tmp_path / "grid"), grid) == best


def test_metrics_and_quarantine(spark, tmp_path):
    rows, seen = training.with_metrics(spark.range(10), "stage", F.col("id") > 6)
    rows.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"total": 10, "passed": 3}
    training.log_metrics(spark, str(tmp_path / "metrics"), "stage", seen.get)
    assert spark.read.parquet(str(tmp_path / "metrics")).count() == 2
    lines = spark.createDataFrame([('{"id": "a"}', "f"), ("{oops", "f"), ("", "g")], "value string, file string")
    good, bad = posts.quarantined(lines, "id STRING")
    assert [r.id for r in good.collect()] == ["a"] and bad.count() == 2


def test_month_files(spark, tmp_path):
    for name in ("RC_2010-01.zst", "RC_2010-01.part2.zst", "RC_2010-03.zst", "RS_2010-02.zst", "RC_2011-01.zst", "notes.txt"):
        (tmp_path / name).write_bytes(b"x")
    listing = files.listed(spark, str(tmp_path))
    found = files.month_files(listing, "comments", [2010])
    assert {k: len(v) for k, v in found.items()} == {(2010, 1): 2, (2010, 3): 1} and len(files.missing_files(found, [2010])) == 10
    assert list(files.to_do(found, {"RC_2010-03"})) == [(2010, 1)]
    with pytest.raises(FileNotFoundError):
        files.month_files(listing, "submissions", [2011])
    assert files.job_slice([1, 2, 3], 2, 1) == [3]
    with pytest.raises(IndexError):
        files.job_slice([1, 2, 3], 2, 2)
    assert files.job_tag("Label X", "skin_tone", [2010, 2011]) == "label-x_skin-tone_2010-2011"
