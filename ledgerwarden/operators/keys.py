"""Key-set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keys_absent(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None,
                null_aware: bool = False) -> DataFrame:
    """Rows of ``left`` whose ``key`` is not among ``right``'s keys.

    Default: ``left_anti`` (a NULL never matches, so a NULL key on the left is
    kept and NULLs on the right are ignored). ``null_aware=True`` gives SQL
    ``NOT IN``: nothing at all once the right side holds a NULL, and NULL left
    keys are dropped unless the right side is empty -- the trap of the
    reference's delete step (Q4). The right side's NULLs and rows are counted
    in one aggregate (a scalar subquery); the keys meet in an ordinary anti
    join, so no side has to be broadcast.
    """
    rk = right_key or key
    r = right.select(F.col(rk).alias("_rk"))
    known = r.where(F.col("_rk").isNotNull())
    out = left.join(known, left[key] == known["_rk"], "left_anti")
    if not null_aware:
        return out
    state = r.agg(F.when(F.count(F.lit(1)) == 0, F.lit("empty"))
                  .when(F.count("_rk") < F.count(F.lit(1)), F.lit("null")).otherwise(F.lit("keys")).alias("_s")).scalar()
    return out.where((state == "empty") | ((state == "keys") & F.col(key).isNotNull()))
