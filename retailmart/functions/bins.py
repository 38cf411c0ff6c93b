"""Ordered bins with a label for everything else."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bin:
    """``low <= x <= high``, or ``x < high`` when ``low`` is None."""

    label: str
    low: Any = None
    high: Any = None

    def matches(self, c: Column) -> Column:
        if self.low is None:
            return c < self.high
        return c.between(self.low, self.high)


def bin_label(c: Column, bins: Sequence[Bin], otherwise: str) -> Column:
    """Label of the first bin that matches; NULLs and the rest get ``otherwise``."""
    first, *rest = bins
    label = F.when(first.matches(c), first.label)
    for b in rest:
        label = label.when(b.matches(c), b.label)
    return label.otherwise(otherwise)
