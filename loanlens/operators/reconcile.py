"""Row differences between two versions of a report.

Rows that both versions hold equally often cancel, NULLs being equal.  Of what is left, by key:

* one row on either side: ``changed``, with the names of the columns that differ;
* otherwise the rows before are ``dropped`` and those after ``added``, with their number.

Two aggregations, the first by all columns and the second by key; both are partial before their
exchange, and a key with many equal rows is one row per task by then.  A version that comes out of a
join on one column of the key is partitioned by it already: named as ``by``, neither aggregation has
an exchange and only the other version is shuffled, once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
              by: str | None = None) -> DataFrame:
    """``keys``, ``status`` (added, dropped, changed), ``changed`` (names of columns, joined by commas) and ``n_rows``.

    ``columns`` are compared (by default all that both have beside the keys).  ``by`` names a column of the
    key by which ``before`` is partitioned already (by a join, say); ``after`` is dealt likewise, so the rows of
    one value pass through one task there.  The result does not depend on it: where ``before`` is partitioned
    otherwise, or Spark split a value with very many rows, there is an exchange more.
    """
    keys = list(keys)
    columns = [c for c in before.columns if c in after.columns and c not in keys] if columns is None else list(columns)
    value = [F.col(c).alias(f"v{k}") for k, c in enumerate(columns)]
    new = after.select(*keys, *value, F.lit(-1).alias("__side"))
    both = before.select(*keys, *value, F.lit(1).alias("__side")).unionByName(new.repartition(by) if by else new)
    left = both.groupBy(*keys, *(f"v{k}" for k in range(len(columns)))).agg(F.sum("__side").alias("__left")).filter("__left <> 0")
    row = F.struct(*(F.col(f"v{k}") for k in range(len(columns))), F.lit(0).alias("end"))
    old, new = F.col("__left") > 0, F.col("__left") < 0
    by_key = left.groupBy(*keys).agg(
        F.sum(F.when(old, F.col("__left")).otherwise(0)).alias("n_old"), F.sum(F.when(new, -F.col("__left")).otherwise(0)).alias("n_new"),
        F.min(F.when(old, row)).alias("old"), F.min(F.when(new, row)).alias("new"),
    )
    differ = F.array_compact(F.array(
        F.lit(None).cast("string"),
        *[F.when(~F.col(f"old.v{k}").eqNullSafe(F.col(f"new.v{k}")), F.lit(c)) for k, c in enumerate(columns)],
    ))
    one = (F.col("n_old") == 1) & (F.col("n_new") == 1)
    fate = lambda status, names, n: F.struct(F.lit(status).alias("status"), names.alias("changed"), n.alias("n_rows"))
    nothing = F.lit(None).cast("string")
    fates = F.when(one, F.array(fate("changed", F.array_join(differ, ","), F.col("n_old")))).otherwise(F.filter(
        F.array(fate("dropped", nothing, F.col("n_old")), fate("added", nothing, F.col("n_new"))), lambda f: f["n_rows"] > 0))
    return by_key.select(*keys, F.explode(fates).alias("__fate")).select(*keys, "__fate.*")
