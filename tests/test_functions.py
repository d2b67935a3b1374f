from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeflow.functions import levels, readings, records
from gaugeflow.functions.draws import HashedDraws
from gaugeflow.sources.endpoint_config import Sensor

NAMES = ["low", "mid", "high"]


def _column(spark, values, kind, expression, name="x"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} {kind}")
    column = F.expr(expression) if isinstance(expression, str) else expression
    return [r.y for r in rows.select("i", column.alias("y")).orderBy("i").collect()]


def test_a_draw_on_a_threshold_takes_the_next_level(spark):
    picked = levels.level_at("x", NAMES, [0.2, 0.5, 1.0])
    drawn = [0.0, 0.19, 0.2, 0.49, 0.5, 0.999, 1.0, None]
    assert _column(spark, drawn, "double", picked) == [
        "low", "low", "mid", "mid", "high", "high", None, None,
    ]


def test_level_codes(spark):
    code = levels.level_code("x", NAMES)
    texts = ["low", "mid", "high", "0", "2", "3", "lo", "", None]
    assert _column(spark, texts, "string", code) == [0, 1, 2, 0, 2, None, None, None, None]


def test_a_number_that_is_a_level_name_counts_as_name(spark):
    code = levels.level_code("x", ["1", "0", "7"])
    assert _column(spark, ["1", "0", "7", "2"], "string", code) == [0, 1, 2, 2]


def test_codes_and_names_are_inverse(spark):
    back = levels.level_name(levels.level_code("x", NAMES), NAMES)
    assert _column(spark, NAMES, "string", back) == NAMES
    name = levels.level_name("x", NAMES)
    assert _column(spark, [0, 2, 3, None], "int", name) == ["low", "high", None, None]


def test_names_with_quotes(spark):
    names = ["it's", 'a "b"', "back\\slash", "`tick`"]
    back = levels.level_name(levels.level_code("x", names), names)
    assert _column(spark, names, "string", back) == names


def test_noise_replaces_at_the_error_rate(spark):
    rows = [(0.0, 0.0), (0.09, 0.34), (0.09, 0.999), (0.1, 0.0), (0.9, 0.5)]
    table = spark.createDataFrame(rows, "chance double, pick double").coalesce(1)
    replaced = levels.replacement("chance", "pick", 0.1, 3)
    noisy = levels.noisy_level("'high'", replaced, NAMES)
    assert [r[0] for r in table.selectExpr(noisy).collect()] == ["low", "mid", "high", "high", "high"]


def _quantised(value: float, scale: float) -> float:
    return float(math.trunc(math.floor(1000.0 * scale * value + 0.5) / 1000)) + 0.0


def test_quantise_known_values(spark):
    values = [1.9994, 1.9995, -1.9995, -1.9996, -0.9994, 0.0, 7.0, -7.25]
    assert _column(spark, values, "double", readings.quantise("x", 1.0)) == [
        1.0, 2.0, -1.0, -2.0, 0.0, 0.0, 7.0, -7.0,
    ]
    halves = readings.thousandths("x", 1.0)
    assert _column(spark, [-0.0025, 0.0025, -2.5, 2.5], "double", halves) == [-2, 3, -2500, 2500]


@settings(max_examples=5, deadline=None)
@given(
    st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=200),
    st.sampled_from([0.5, 1.0, 25.0, 250.0]),
)
def test_quantise_equals_brute_force(spark, values, scale):
    got = _column(spark, values, "double", readings.quantise("x", scale))
    assert got == [_quantised(v, scale) for v in values]


@pytest.mark.parametrize(
    "kind, one, zero",
    [(0, 3.0, 14.0), (1, 14.0, 3.0), (2, 3.0, 3.0), (3, 0.5, 0.5), (9, None, None)],
)
def test_sensor_families(spark, kind, one, zero):
    sensor = Sensor("s", kind, 1.0, one_mean=1.0, one_std=1.0, zero_mean=10.0, zero_std=2.0)
    raw = readings.raw_reading(sensor, "x", normal="2D", uniform="0.5D")
    assert _column(spark, [1, 0], "int", raw) == [one, zero]


def test_draws_do_not_depend_on_the_layout(spark):
    draws = HashedDraws("id", seed=7)
    columns = ["id", f"{draws.uniform(3)} AS u", f"{draws.normal(4)} AS z"]
    few = spark.range(0, 5000, 1, 2).selectExpr(*columns).orderBy("id").collect()
    many = spark.range(0, 5000, 1, 7).selectExpr(*columns).orderBy("id").collect()
    assert few == many


def test_draws_have_the_right_distribution(spark):
    draws = HashedDraws("id", seed=7)
    rows = spark.range(200_000).selectExpr(
        f"{draws.uniform(0)} AS u", f"{draws.uniform(1)} AS w", f"{draws.normal(0)} AS z"
    )
    seen = rows.agg(
        F.min("u").alias("low"),
        F.max("u").alias("high"),
        F.avg("u").alias("u"),
        F.var_samp("u").alias("uv"),
        F.corr("u", "w").alias("uw"),
        F.avg("z").alias("z"),
        F.stddev_samp("z").alias("zs"),
        F.corr("u", "z").alias("uz"),
        F.avg((F.abs("z") < 1.96).cast("int")).alias("inside"),
    ).first()
    assert 0 <= seen.low < 1e-3 and 1 - 1e-3 < seen.high < 1
    assert abs(seen.u - 0.5) < 0.005 and abs(seen.uv - 1 / 12) < 0.002
    assert abs(seen.uw) < 0.01 and abs(seen.uz) < 0.01
    assert abs(seen.z) < 0.01 and abs(seen.zs - 1) < 0.01
    assert abs(seen.inside - 0.95) < 0.003


def test_time_texts(spark):
    row = spark.sql(
        "SELECT timestamp'2024-03-01 07:08:09.987' AS t, timestamp_ntz'2024-03-01 07:08:09.987' AS n"
    ).select(records.time_text(F.col("t")), records.wall_time_text(F.col("n"))).first()
    assert list(row) == ["2024-03-01 07:08:09"] * 2


def test_lines_print_missing_parts(spark):
    rows = spark.createDataFrame(
        [("t", 1, 5, None, "{}")],
        "topic string, partition int, offset bigint, key string, value string",
    )
    lines = rows.select(
        records.delivery_line(), records.consumed_line(), records.archived_line()
    ).first()
    assert list(lines) == [
        "topic=t  partition=1  offset=5: \n{}",
        "Consumer: topic = t, partition = 1, offset = 5, key = null \n{}",
        "Consumer record: key=null\n{}",
    ]


def test_a_missing_reading_is_left_out_of_its_group(spark):
    rows = spark.createDataFrame([("a", None)], "cat0 string, cat1 string")
    assert rows.selectExpr(records.group_by_name(["cat0", "cat1"])).first()[0] == {"cat0": "a"}


def test_document_fields_of_another_kind_are_null(spark):
    texts = ['{"k": 3}', '{"k": "x"}', "{}", "nonsense", None]
    field = records.document_field(F.col("x"), "$.k", "int")
    assert _column(spark, texts, "string", field) == [3, None, None, None, None]
