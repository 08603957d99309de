"""Expected length after a time at large (von Bertalanffy growth)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def expected_length(
    start_length: Column, days: Column, linf: Column, k: Column, t0: Column
) -> Column:
    """Age from the start length, plus the days, back to a length.

    A fish at the asymptote stays there; beyond it age is not defined and there is no value.
    """
    ratio = 1 - start_length / linf
    age = F.when(ratio > 0, F.log(ratio)) / -k + t0
    grown = linf * (1 - F.exp(-k * (age + days / 365.0 - t0)))
    return F.when((ratio == 0) & days.isNotNull(), linf).otherwise(grown)
