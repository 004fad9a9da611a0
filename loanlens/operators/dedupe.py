"""Deterministic one-row-per-group selection.

The source reports rely on a lenient GROUP BY that returns columns from an
arbitrary row of each group.  Here the row is chosen by an explicit total
order (NULLs last), so results are reproducible, identical across engines and
unchanged when a lost task is recomputed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, per ``keys`` group, the first row by ``order`` (each ascending, NULLs last; further columns break ties).

    One aggregation takes the least of a struct that holds, for each column in turn, whether it is NULL and
    its value; structs compare field by field.  The input is read and shuffled once, and the aggregation is
    partial before the exchange, so a group with a large share of all rows is one row per task by then.
    """
    order, keys = list(order), list(keys)
    ranked = [*order, *[c for c in df.columns if c not in keys and c not in order]]
    least = F.min(F.struct(*[f for k, c in enumerate(ranked) for f in (F.col(c).isNull().alias(f"n{k}"), F.col(c).alias(f"v{k}"))]))
    first = df.groupBy(*keys).agg(least.alias("__first"))
    return first.select(*keys, *[F.col(f"__first.v{k}").alias(c) for k, c in enumerate(ranked)])
