"""Exact interpolated quantiles without a shuffle of the values.

Each wanted rank lies in an open interval of values, at first the whole line. A pass proposes one or
two values around the rank with a sketch of fixed size and counts what is below and equal to
them. The rank is then either one of these values, or its interval has lost them, so every pass
shrinks it and every column ends, whatever its ties. A pass is two aggregates over the table, each with one
row per task to shuffle. Tables of up to the sketch's size usually take one pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH = 10_000
# Ranks that one aggregate works on.
AT_ONCE = 40


@dataclass
class _Rank:
    """The value at a place of the sorted column, known to lie strictly between ``low`` and ``high``."""

    column: str
    position: int
    inside: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    value: float | None = None

    def members(self) -> Column:
        c = F.col(self.column)
        within = c.isNotNull()
        if self.low is not None:
            within &= c > F.lit(self.low)
        if self.high is not None:
            within &= c < F.lit(self.high)
        return F.when(within, c)

    def around(self, sketch: int) -> list[float]:
        share = (self.position - self.below) / max(1, self.inside - 1)
        reach = 2 / sketch if self.inside > sketch else 0.0
        return [max(0.0, share - reach), min(1.0, share + reach)]

    def narrow(self, at: float, below: int, upto: int) -> None:
        """Learn that ``below`` values are under ``at`` and ``upto`` are not above it."""
        if self.value is not None:
            return
        if below <= self.position < upto:
            self.value = at
        elif self.position < below and below < self.below + self.inside:
            self.high, self.inside = at, below - self.below
        elif self.position >= upto and upto > self.below:
            self.low, self.inside, self.below = at, self.inside - (upto - self.below), upto


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], sketch: int = SKETCH) -> DataFrame:
    """One row; per column an array with the quantile of each probability (null without values)."""
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    counts = values.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    sizes = {c: counts[f"n{i}"] for i, c in enumerate(columns)}
    ranks: dict[tuple[str, int], _Rank] = {}
    for c, n in sizes.items():
        for p in probs if n else ():
            for position in (math.floor(p * (n - 1)), math.ceil(p * (n - 1))):
                ranks.setdefault((c, position), _Rank(c, position, n))
    while unknown := [r for r in ranks.values() if r.value is None]:
        for first in range(0, len(unknown), AT_ONCE):
            _pass(values, unknown[first : first + AT_ONCE], sketch)

    def interpolated(c: str, p: float) -> Column:
        place = p * (sizes[c] - 1)
        low, high = ranks[c, math.floor(place)].value, ranks[c, math.ceil(place)].value
        return F.lit(low if low == high else low + (high - low) * (place - math.floor(place)))

    answers = [
        F.array(*[interpolated(c, p) for p in probs]) if n else F.lit(None).cast("array<double>") for c, n in sizes.items()
    ]
    return values.sparkSession.range(1).select(*[a.alias(c) for a, c in zip(answers, columns, strict=True)])


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = SKETCH
) -> DataFrame:
    return df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(c) for c in columns]
    )


def median(df: DataFrame, column: str) -> DataFrame:
    """One row, one column: the median."""
    return exact_quantiles(df, [column], [0.5]).select(F.col(column)[0].alias(column))


def _pass(values: DataFrame, ranks: list[_Rank], sketch: int) -> None:
    """One sketch to propose values, one count to learn where they stand."""
    # Ranks in one interval share its sketch.
    together: dict[tuple, list[_Rank]] = {}
    for r in ranks:
        together.setdefault((r.column, r.low, r.high), []).append(r)
    proposals = [
        F.percentile_approx(same[0].members(), [p for r in same for p in r.around(sketch)], sketch).alias(f"q{i}")
        for i, same in enumerate(together.values())
    ]
    proposed = values.agg(*proposals).first()
    wanted = sorted({(c, x) for i, (c, _, _) in enumerate(together) for x in proposed[f"q{i}"]})
    counts = []
    for i, (c, x) in enumerate(wanted):
        counts += [F.count_if(F.col(c) < F.lit(x)).alias(f"below{i}"), F.count_if(F.col(c) <= F.lit(x)).alias(f"upto{i}")]
    seen = values.agg(*counts).first()
    for i, (c, x) in enumerate(wanted):
        for r in ranks:
            if r.column == c:
                r.narrow(x, seen[f"below{i}"], seen[f"upto{i}"])
