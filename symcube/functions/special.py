"""Special values of the data model as plain doubles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Sentinels:
    """The codes an origin uses for special values; a code left at None does not occur."""

    plus_inf: float | None = None
    minus_inf: float | None = None
    undef: float | None = None
    na: float | None = None
    eps: float | None = None


def map_special(value: Column, codes: Sentinels) -> Column:
    """+Inf and -Inf become infinities, Undef and NA become NaN, EPS becomes 0; all else stays."""
    meanings = [(codes.plus_inf, "inf"), (codes.minus_inf, "-inf"), (codes.undef, "nan"), (codes.na, "nan"), (codes.eps, "0")]
    out: Column | None = None
    for code, meaning in meanings:
        if code is not None:
            target = F.lit(float(meaning))
            out = F.when(value == code, target) if out is None else out.when(value == code, target)
    return value if out is None else out.otherwise(value)
