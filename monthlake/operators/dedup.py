"""First row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(o) -> Column:
    # Plain names sort ascending with NULLs last (the SQL engine's default, not Spark's).
    return F.col(o).asc_nulls_last() if isinstance(o, str) else o


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Keep the first row of every key under ``order`` (``row_number() = 1``).

    Planned as WindowGroupLimit: a partial top-1 per key runs inside each map task
    before the shuffle, so a hot key sends at most one row per input partition.
    ``order`` must make the winner unique (add tie-breakers) for deterministic output.
    """
    w = Window.partitionBy(*keys).orderBy(*[_order(o) for o in order])
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)

