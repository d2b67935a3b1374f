"""The jobs from the command line, one after another over the same messages."""

from __future__ import annotations

import pytest

from gaugeflow.__main__ import main


@pytest.fixture(scope="module")
def place(tmp_path_factory):
    return tmp_path_factory.mktemp("command")


def _run(place, *arguments):
    source = ["--format", "parquet", "--path", f"{place}/messages", "--topic", "epd01"]
    main([*source, *map(str, arguments)])


def test_all_jobs(spark, place, capsys):
    _run(place, "publish", "--records", 2000)
    out = ["--checkpoint", place / "c-archive", "--out", place / "archive"]
    _run(place, "archive", *out)
    assert spark.read.parquet(f"{place}/archive").count() == 2000

    _run(place, "train", "--archive", place / "archive", "--model", place / "model")
    printed = dict(line.split(": ") for line in capsys.readouterr().out.splitlines() if ": " in line)
    assert float(printed["auc_of_predictions"]) > 0.9
    assert float(printed["auc_of_scores"]) > 0.9

    scored = ["--checkpoint", place / "c-score", "--out", place / "scored"]
    _run(place, "score", "--model", place / "model", *scored)
    rows = spark.read.parquet(f"{place}/scored")
    right = rows.where("prediction = label").count()
    assert rows.count() == 2000 and right > 1800

    consumed = ["--checkpoint", place / "c-consume", "--out", place / "consumed"]
    _run(place, "consume", *consumed, "--seconds", 8)
    assert spark.read.parquet(f"{place}/consumed/documents").count() == 2000


def test_jobs_over_a_topic_table(spark, place, capsys):
    source = ["--format", "topic_table", "--path", f"{place}/topics", "--topic", "epd01"]
    for _ in range(2):
        main([*source, "publish", "--records", "500"])
    out = f"{place}/t-archive"
    main([*source, "archive", "--checkpoint", f"{place}/c-t-archive", "--out", out])
    rows = spark.read.parquet(out)
    assert rows.count() == rows.select("_id").distinct().count() == 1000
    main([*source, "train", "--model", f"{place}/t-model"])
    assert "auc_of_scores" in capsys.readouterr().out
