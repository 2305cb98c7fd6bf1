"""Stable surrogate keys and the monthly period key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _part(c) -> Column:
    v = (F.col(c) if isinstance(c, str) else c).cast("string")
    # "<length>:<value>" makes the concatenation injective; "N" marks NULL by position.
    return F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("N"))


def surrogate_key(*cols) -> Column:
    """md5 hex of the length-prefixed parts: deterministic across engines, NULL- and
    position-aware (``(NULL,'a') != ('a',NULL)``), never NULL. Unlike ``xxhash64`` it does
    not skip NULL inputs."""
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    return F.md5(F.concat(*[_part(c) for c in cols]))


def period_key(year, month) -> Column:
    """``year * 100 + month`` as int (e.g. 202403)."""
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    return (y * 100 + m).cast("int")
