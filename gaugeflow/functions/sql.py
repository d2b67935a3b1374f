"""Literals and names as SQL text."""

from __future__ import annotations


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double(value: float) -> str:
    return f"({float(value)!r}D)"


def named(expression: str, column: str) -> str:
    return f"{expression} AS {name(column)}"
