"""Join conditions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

RULE_NO = "rule_no"


def splittable_on(big: Sequence[Column], grouped: Sequence[Column]) -> Column:
    """Null-safe equality of the keys of a big side with those of a side that has one row per key.

    Adaptive execution splits a hot key only where both inputs are shuffled for the join.  A side that
    was just grouped or joined by the same keys would be joined in place, unsplittable.  Keys compared
    as a struct have a partitioning of their own, so the small side is shuffled again.
    """
    left, right = (F.struct(*[c.alias(f"key{i}") for i, c in enumerate(side)]) for side in (big, grouped))
    return left == right
