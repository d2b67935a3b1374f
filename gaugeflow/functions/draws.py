"""Random draws that depend on the row only, never on the layout. SQL text.

`rand(seed)` follows the partition number, so the same table in another layout,
or a partition that is computed again after a lost executor, may differ. These
draws hash a row identity, a stream number and a seed instead.
"""

from __future__ import annotations

import math
from typing import Protocol

from gaugeflow.functions import sql


class Draws(Protocol):
    """Independent draws, told apart by stream number."""

    def uniform(self, stream: int) -> str: ...

    def normal(self, stream: int) -> str: ...


class HashedDraws:
    """Draws for generated tables: uniform on [0, 1) and standard normal."""

    def __init__(self, *identity: str, seed: int = 42):
        self.identity = ", ".join(sql.name(column) for column in identity)
        self.seed = seed

    def _unit(self, stream: int, part: int) -> str:
        salt = (self.seed << 24) + (stream << 8) + part
        bits = f"xxhash64({salt}L, {self.identity})"
        # The upper 53 bits fill the mantissa of a double.
        return f"(shiftrightunsigned({bits}, 11) * {sql.double(2.0**-53)})"

    def uniform(self, stream: int) -> str:
        return self._unit(stream, 0)

    def normal(self, stream: int) -> str:
        radius = f"sqrt(-2D * ln(1D - {self._unit(stream, 1)}))"
        return f"({radius} * cos({sql.double(2 * math.pi)} * {self._unit(stream, 2)}))"
