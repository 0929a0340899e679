"""Exact order statistics of a column of any size.

Values are narrowed down range by range: a quantile sketch (a mergeable aggregate of
bounded size) proposes two cut values around the wanted place, one pass counts the values
below, at, between and above them, and the search goes on in the range that holds the
place.  Cuts that miss only cost another pass.  What is left in the end, ``COLLECTED``
values at most, is sorted by the driver.  No task and no driver holds more than a sketch
or that many values, however many distinct values there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLLECTED = 10_000
SKETCH = 2000               # accuracy of the sketch: places are off by n / SKETCH at most, nearly always
MARGIN = 2 / SKETCH


def kth(values: DataFrame, place: int, n: int) -> float:
    """The value at 0-based ``place`` of the ``n`` values of a one-column table without nulls."""
    name = values.columns[0]
    x = F.col(f"`{name}`")
    while n > COLLECTED:
        share = (place + 0.5) / n
        lo, hi = values.agg(F.percentile_approx(x, [max(0.0, share - MARGIN), min(1.0, share + MARGIN)], SKETCH)).first()[0]
        ranges = [x < lo, x == lo, (x > lo) & (x < hi), (x == hi) & F.lit(hi > lo), x > hi]
        counts = list(values.agg(*[F.count_if(r) for r in ranges]).first())
        k = 0
        while place >= counts[k]:
            place, k = place - counts[k], k + 1
        if k in (1, 3):
            return (lo, hi)[k // 2]
        values, n = values.where(ranges[k]), counts[k]
    return sorted(r[0] for r in values.collect())[place]


def exact_median(df: DataFrame, column: str) -> float | None:
    """The median of a numeric column, the mean of the middle two; nulls and NaN do not count.

    ``df`` is read about twice per factor of ``SKETCH / 4`` in rows over ``COLLECTED``: cut
    its lineage before if it is dear to compute.
    """
    values = df.select(F.col(column).cast("double").alias("x")).where("x is not null and not isnan(x)")
    n = values.count()
    if not n:
        return None
    low = kth(values, (n - 1) // 2, n)
    return low if n % 2 else (low + kth(values, n // 2, n)) / 2.0
