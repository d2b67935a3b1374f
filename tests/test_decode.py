from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from sample import CODES, messages, record, text

from gaugeflow import schemas as S
from gaugeflow.operators import decode, features
from gaugeflow.plans import event_records as er
from gaugeflow.plans import jobs
from gaugeflow.plans.fixed_model import FIXED

WITHOUT_SENSORS = '{"CurrentTime":"t","Topic":"x","Result":1,"Categories":{"cat0":"sound"}}'


def _only(spark, config, value):
    return decode.decode_messages(messages(spark, [value]), config).first()


@pytest.mark.parametrize(
    "value, status",
    [
        (text(), "ok"),
        (text(extra=[1, {"a": 2}]), "ok"),
        (text(cat1=2), "ok"),
        (text(CurrentTime=None), "ok"),
        ("\n\t " + text(), "ok"),
        (None, "blank"),
        ("", "blank"),
        (" \t\r\n", "blank"),
        ("no JSON", "malformed"),
        (text()[:-5], "malformed"),
        ("12", "not_object"),
        ("[1]", "not_object"),
        ("null", "not_object"),
        ('"{}"', "not_object"),
        ("[" + text() + "]", "not_object"),
        ("{}", "bad_field"),
        (WITHOUT_SENSORS, "bad_field"),
        (text(cat1="unheard of"), "bad_field"),
        (text(cat1=9), "bad_field"),
        (text(cat1=None), "bad_field"),
        (text(sensor3="hot"), "bad_field"),
        (text(sensor3=None), "bad_field"),
        (text(sensor3=float("nan")), "bad_field"),
        (text(Result="yes"), "bad_field"),
        (text(Result=None), "bad_field"),
        (text(Categories=[1]), "bad_field"),
        (text() + text(), "malformed"),
        (text() + " garbage", "malformed"),
        (text() + "] garbage", "malformed"),
        (text() + "," + text(), "malformed"),
        (text().replace('"', "'"), "malformed"),
        ('{"Result":0,' + text()[1:], "ok"),
        (text(sensor0="Infinity"), "bad_field"),
        (text().replace('"sensor0": 0.0', '"sensor0": 1e999'), "bad_field"),
        (text(Result=7), "bad_field"),
        (text(Result=-1), "bad_field"),
    ],
)
def test_status(spark, config, value, status):
    row = _only(spark, config, value)
    # A NaN is no JSON to the strict parser, but it is not blank or another kind.
    allowed = {status, "malformed"} if value and "NaN" in value else {status}
    assert row.status in allowed
    assert row.value == value


def test_values_of_a_good_record(spark, config):
    row = _only(spark, config, text())
    assert [row[name] for name in S.CATEGORIES] == CODES
    assert [row[name] for name in S.SENSORS] == [float(i) for i in range(10)]
    assert (row.key, row.topic, row.partition, row.offset, row.label) == ("0", "epd01", 0, 0, 1)


def test_one_bad_field_leaves_the_others(spark, config):
    row = _only(spark, config, text(cat1="unheard of", sensor3="hot"))
    assert row.cat1 is None and row.sensor3 is None
    assert (row.cat0, row.cat2, row.sensor2, row.sensor4) == (0, 0, 2.0, 4.0)


def test_level_names_do_not_fit_the_coded_schema(spark):
    decoded = decode.decode_values(
        decode.cast_envelope(messages(spark, [text(cat1=3)])), S.CODED_RECORD
    ).first()
    assert decoded.data.Categories.cat1 == 3
    assert decoded.data.Categories.cat0 is None
    assert decoded.data.Sensors.sensor9 == 9.0


def test_no_message_is_lost(spark, config):
    values = [text(), None, "", "x", "12", text(cat0="?"), text(Result=0)]
    decoded = decode.decode_messages(messages(spark, values), config)
    good, bad = decode.accepted(decoded), decode.rejected(decoded)
    assert sorted(r.offset for r in good.collect()) == [0, 6]
    assert {r.offset: r.status for r in bad.collect()} == {
        1: "blank", 2: "blank", 3: "malformed", 4: "not_object", 5: "bad_field",
    }
    assert "value" not in good.columns and "status" not in good.columns


def test_archive_keeps_every_text(spark):
    values = [text(), "{}", None, "x", "[1]"]
    rows = decode.archive_rows(messages(spark, values, first_offset=5)).collect()
    assert [r.value for r in rows] == values
    assert [r.status for r in rows] == ["ok", "ok", "blank", "malformed", "not_object"]
    assert rows[0]._id == "epd01-0-5" and len({r._id for r in rows}) == 5


def test_encode_and_decode_are_inverse(spark, sf_dir, config):
    events = er.events(spark, sf_dir)
    records = er.event_records(events, config).select(S.RESULT, *S.CATEGORIES, *S.SENSORS)
    text_rows = decode.cast_envelope(er.event_messages(events, config))
    flat = decode.flatten(decode.decode_values(text_rows), record="data").drop(S.TIME)
    assert flat.exceptAll(records).count() == 0
    assert records.exceptAll(flat).count() == 0


def test_assembled_features_keep_their_order(spark, config):
    decoded = decode.decode_messages(messages(spark, [text(), text(cat0="?")]), config)
    rows = features.assemble(decode.accepted(decoded)).collect()
    assert len(rows) == 1
    assert list(rows[0].features) == [float(c) for c in CODES] + [float(i) for i in range(10)]


def _stored(spark, config, sf_dir, tmp_path):
    path = str(tmp_path / "messages")
    er.event_messages(er.events(spark, sf_dir), config).write.parquet(path)
    return spark.read.schema(S.ENVELOPE).parquet(path)


def test_scoring_plan(spark, config, sf_dir, tmp_path, plan_of):
    stored = _stored(spark, config, sf_dir, tmp_path)
    plan = plan_of(jobs.scored_messages(stored, FIXED, config))
    details = plan.split("\n\n\n", 1)[-1]
    # Once for the record; the other is looked at only for messages that failed.
    assert details.count("from_json(") == 2
    for operator in ("Exchange", "Python", "Sort", "UDF"):
        assert operator not in plan
    assert "timestampType" not in plan


def test_a_filter_does_not_decode_again(spark, config, sf_dir, tmp_path, plan_of):
    stored = _stored(spark, config, sf_dir, tmp_path)
    decoded = decode.decode_messages(stored, config)
    hot = decode.accepted(decoded).where((F.col("sensor1") > 10) & (F.col("cat0") == 1))
    details = plan_of(hot).split("\n\n\n", 1)[-1]
    assert details.count("from_json(") == 1


def test_record_helper_is_a_good_record():
    assert set(record()) == {"CurrentTime", "Topic", "Result", "Categories", "Sensors"}


def test_score_and_archive_agree_on_what_a_document_is(spark, config):
    values = [text(), text() + text(), text() + " x", text().replace('"', "'"), "12", "null", "", None, "{}"]
    rows = messages(spark, values)
    shapes = ("blank", "malformed", "not_object")
    scored = {r.offset: r.status for r in decode.decode_messages(rows, config).collect()}
    archived = {r.offset: r.status for r in decode.archive_rows(rows).collect()}
    for offset, status in archived.items():
        assert status == "ok" or status == scored[offset]
        assert (scored[offset] in shapes) == (status in shapes)
