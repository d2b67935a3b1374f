from __future__ import annotations

import json

import pytest

from gaugeflow.sources import endpoint_config as ec


def test_tables(spark):
    table = ec.config_from_text(spark, ec.packaged_text())
    levels, sensors = ec.level_table(table), ec.sensor_table(table)
    written = json.loads(ec.packaged_text())
    assert levels.count() == sum(len(c["levels"]) for c in written["categories"])
    assert sensors.count() == 10
    cat1 = levels.where("category = 'cat1'").orderBy("level_no").collect()
    wanted = written["categories"][1]
    assert [r.level for r in cat1] == wanted["levels"]
    assert [r.one_threshold for r in cat1] == wanted["oneThresholds"]
    assert [r.zero_threshold for r in cat1] == wanted["zeroThresholds"]
    assert [r.scale for r in sensors.orderBy("sensor_no").collect()] == [
        s["scale"] for s in written["sensors"]
    ]


def test_file_and_text_give_the_same(spark, tmp_path):
    path = tmp_path / "endpoint.json"
    path.write_text(ec.packaged_text())
    assert ec.read_config(spark, str(path)) == ec.packaged_config()
    scanned = ec.scan_config(spark, str(path))
    assert scanned.schema["sensors"].dataType.elementType["scale"].dataType.simpleString() == "double"


def _broken(change) -> list[str]:
    document = json.loads(ec.packaged_text())
    change(document)
    with pytest.raises(ec.ConfigError) as caught:
        ec.bind(document)
    return str(caught.value).split("; ")


def test_broken_configurations():
    assert _broken(lambda d: d["categories"][0]["oneThresholds"].__setitem__(1, 0.99)) == [
        "cat0.oneThresholds: the last threshold must be 1"
    ]
    assert _broken(lambda d: d["categories"][1]["levels"].pop()) == [
        "cat1.oneThresholds: one threshold per level is needed",
        "cat1.zeroThresholds: one threshold per level is needed",
    ]
    assert _broken(lambda d: d["categories"][0]["zeroThresholds"].__setitem__(0, 1.5)) == [
        "cat0.zeroThresholds: thresholds must not fall"
    ]
    assert _broken(lambda d: d.__setitem__("errorRate", 2)) == ["errorRate is outside 0..1"]
    assert _broken(lambda d: d["sensors"][0].__setitem__("name", "cat0")) == [
        "a name is used twice"
    ]
