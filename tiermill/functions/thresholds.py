"""Colour of a value on a threshold scale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Steps = Sequence[tuple[float | None, str]]

# The dashboard scales. A step holds from its bound upwards; None is the base colour.
ROW_COUNT_STEPS: Steps = ((None, "green"), (80, "red"))
RATE_STEPS: Steps = ((None, "green"), (50, "yellow"), (80, "red"))
QUALITY_STEPS: Steps = ((None, "red"), (80, "yellow"), (95, "green"))
FRESHNESS_STEPS: Steps = ((None, "green"), (300, "red"))


def classify(value: str | Column, steps: Steps) -> Column:
    """Colour of the highest step not above the value; null for a null value."""
    value = F.col(value) if isinstance(value, str) else value
    (base_bound, base), *rest = steps
    if base_bound is not None:
        raise ValueError("the first step is the base colour and has no bound")
    chosen = F.when(value.isNull(), F.lit(None))
    for bound, colour in sorted(rest, reverse=True):
        chosen = chosen.when(value >= F.lit(bound), F.lit(colour))
    return chosen.otherwise(F.lit(base))
