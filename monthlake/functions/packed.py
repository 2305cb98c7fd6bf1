"""Several texts as one, for a shuffle: beside each other they cost a length, an offset and padding
each, and compress worse.

The texts are joined by ``END``; ``END`` and ``MARK`` inside a text are written as ``MARK`` and a letter,
and NULL as ``MARK`` and another one, so equal packs are equal texts in equal places (NULL like NULL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

END, MARK = "\x01", "\x02"
NULL = f"{MARK}n"


def pack(*texts: str | Column) -> Column:
    """One text of all, never NULL. Packs are joined by ``join_packs``."""
    def one(t: str | Column) -> Column:
        marked = F.replace(F.col(t) if isinstance(t, str) else t, F.lit(MARK), F.lit(f"{MARK}m"))
        return F.coalesce(F.replace(marked, F.lit(END), F.lit(f"{MARK}e")), F.lit(NULL))

    return F.concat_ws(END, *[one(t) for t in texts])


def join_packs(*packs: str | Column) -> Column:
    """The pack of the texts of all ``packs``."""
    return F.concat_ws(END, *packs)


def unpack(packed: str | Column, count: int) -> list[Column]:
    """The ``count`` texts of a pack."""
    parts = F.split(packed, END, -1)

    def one(n: int) -> Column:
        t = F.get(parts, F.lit(n))
        return F.when(t != NULL, F.replace(F.replace(t, F.lit(f"{MARK}e"), F.lit(END)), F.lit(f"{MARK}m"), F.lit(MARK)))

    return [one(n) for n in range(count)]
