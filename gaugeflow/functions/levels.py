"""Category levels: number them, pick them by threshold, disturb them. SQL text."""

from __future__ import annotations

from collections.abc import Sequence

from gaugeflow.functions import sql
from gaugeflow.sources.endpoint_config import Category


def level_code(level: str, levels: Sequence[str]) -> str:
    """Position of a level name, from 0; null for a name that is not listed.

    Text that is already a level number keeps that number, so named and coded
    records can share one path.
    """
    codes = {str(number): number for number in range(len(levels))}
    codes |= {name: number for number, name in enumerate(levels)}
    pairs = ", ".join(f"{sql.text(name)}, {number}" for name, number in codes.items())
    return f"try_element_at(map({pairs}), {level})"


def level_name(code: str, levels: Sequence[str]) -> str:
    """Level name at a position; null outside the list."""
    listed = ", ".join(sql.text(name) for name in levels)
    return f"get(array({listed}), {code})"


def level_at(draw: str, levels: Sequence[str], thresholds: Sequence[float]) -> str:
    """First level whose threshold lies above the draw; null if none does."""
    steps = " ".join(
        f"WHEN {draw} < {sql.double(threshold)} THEN {sql.text(level)}"
        for level, threshold in zip(levels, thresholds, strict=True)
    )
    return f"CASE {steps} END"


def labelled_level(draw: str, label: str, category: Category) -> str:
    """`level_at` with the threshold list that belongs to the label."""
    one = level_at(draw, category.levels, category.one_thresholds)
    if category.one_thresholds == category.zero_thresholds:
        return one
    zero = level_at(draw, category.levels, category.zero_thresholds)
    return f"if({label} = 1, {one}, {zero})"


def replacement(chance: str, pick: str, error_rate: float, n_levels: int) -> str:
    """Number of an evenly picked level at the error rate, else null."""
    picked = f"CAST(floor({pick} * {n_levels}) AS INT)"
    return f"CASE WHEN {chance} < {sql.double(error_rate)} THEN {picked} END"


def noisy_level(level: str, replaced_by: str, levels: Sequence[str]) -> str:
    """The replacement level where there is one; it may be the same level again."""
    return f"coalesce({level_name(replaced_by, levels)}, {level})"
