"""Labels and sensor readings from random draws. SQL text."""

from __future__ import annotations

from gaugeflow.functions import sql
from gaugeflow.sources.endpoint_config import Sensor

# Numbers of the sensor families.
FOLLOWS_LABEL, OPPOSES_LABEL, IGNORES_LABEL, UNIFORM = range(4)


def drawn_label(draw: str, success_rate: float) -> str:
    """1 if the draw lies below the success rate, else 0."""
    return f"if({draw} < {sql.double(success_rate)}, 1, 0)"


def raw_reading(sensor: Sensor, label: str, normal: str, uniform: str) -> str:
    """Reading before scaling; null for a family that does not exist.

    A family that follows the label takes its mean and deviation from the side
    of the label, one that opposes it from the other side.
    """
    one_side = (sensor.one_std, sensor.one_mean)
    zero_side = (sensor.zero_std, sensor.zero_mean)
    if sensor.kind == FOLLOWS_LABEL:
        return _by_label(normal, label, one_side, zero_side)
    if sensor.kind == OPPOSES_LABEL:
        return _by_label(normal, label, zero_side, one_side)
    if sensor.kind == IGNORES_LABEL:
        return f"({normal} * {sql.double(sensor.one_std)} + {sql.double(sensor.one_mean)})"
    if sensor.kind == UNIFORM:
        return uniform
    return "CAST(NULL AS DOUBLE)"


def _by_label(
    normal: str, label: str, if_one: tuple[float, float], if_zero: tuple[float, float]
) -> str:
    # The draw stands once in the expression, so it is computed once per row.
    std, mean = (
        f"if({label} = 1, {sql.double(a)}, {sql.double(b)})"
        for a, b in zip(if_one, if_zero, strict=True)
    )
    return f"({normal} * {std} + {mean})"


def thousandths(value: str, scale: float) -> str:
    """Scaled value as a whole number of thousandths, half rounded up."""
    return f"floor({sql.double(1000.0 * scale)} * {value} + 0.5D)"


def whole_units(thousandths: str) -> str:
    """Thousandths cut to whole units; the cut goes toward zero."""
    return f"(({thousandths} - {thousandths} % 1000) / 1000D)"


def quantise(value: str, scale: float) -> str:
    """Scale, round to thousandths, then cut: -1.9996 gives -2, but -1.9995 gives -1."""
    return whole_units(thousandths(value, scale))
