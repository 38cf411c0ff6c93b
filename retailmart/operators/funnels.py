"""Event funnels: counts per step and rates between steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmart.functions import percent


def funnel(
    df: DataFrame,
    event: str,
    steps: Sequence[tuple[str, str]],
    rates: Sequence[str],
    by: Sequence[str] = (),
    digits: int = 2,
    case_insensitive: bool = False,
) -> DataFrame:
    """Events per step and the percentage going on to the next step.

    ``steps`` are (value, output column), ``rates`` the names of the rates
    between neighbours. Counts events, not distinct users or ordered paths.
    ``case_insensitive`` ignores letter case and trailing blanks in ``event``.
    """
    if len(rates) != len(steps) - 1:
        raise ValueError("a funnel has one rate less than steps")
    kind = F.col(event)
    if case_insensitive:
        kind = F.lower(F.rtrim(kind))
        steps = [(value.lower().rstrip(), out) for value, out in steps]
    counted = df.groupBy(*by).agg(
        *[F.count(F.when(kind == value, 1)).alias(out) for value, out in steps]
    )
    outs = [out for _, out in steps]
    return counted.select(
        *by,
        *outs,
        *[
            percent(F.col(b), F.col(a), digits).alias(r)
            for r, a, b in zip(rates, outs, outs[1:], strict=False)
        ],
    )
