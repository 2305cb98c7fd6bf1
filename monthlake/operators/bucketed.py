"""SCD-1 upsert of a table kept in buckets of its key.

A version of the table is one directory of Parquet files bucketed and sorted by the key; its name
holds the number of buckets, which the first load fixes. The catalog knows the directory as a
bucketed table while a load runs, so a merge joins the target bucket by bucket where it lies: only the
source, one load's keys, is shuffled, and the result is written in the same buckets. Versions
become visible through the commit entries of ``operators.upsert``; readers need no catalog.

A join by buckets needs equal keys, and NULL equals nothing, so the null key's row is merged on its
own (the scan of the target for it skips row groups without nulls). The key must not be a floating number.
"""

from __future__ import annotations

import contextlib
import hashlib
import re
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake.operators.dedup import latest_per_key
from monthlake.operators.upsert import (
    CODEC,
    LOAD_COL,
    VERSION_COL,
    _commit,
    _new_version,
    current,
    read_commit,
    read_current,
    try_read,
    write_version,
)


def _name(path: str) -> str:
    return f"bucketed_{hashlib.md5(path.encode()).hexdigest()[:20]}"


@contextlib.contextmanager
def bucket_table(df: DataFrame, path: str, key: str, buckets: int) -> Iterator[DataFrame]:
    """A written directory as a bucketed table of the catalog, with the columns of ``df``, for the length of a load."""
    spark, name = df.sparkSession, _name(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the directory stays


def merged_keys(target: DataFrame, source: DataFrame, key: str, rank: str | None) -> DataFrame:
    """Rows of both with a key that is not NULL: a source row (one per key) replaces the target's, with
    ``rank`` only if it ranks at least as high (NULL lowest)."""
    t = target.where(F.col(key).isNotNull()).select(F.col(key).alias("__tk"), F.struct(*target.columns).alias("__t"))
    s = source.where(F.col(key).isNotNull()).select(F.col(key).alias("__sk"), F.struct(*target.columns).alias("__s"))
    wins = F.lit(True)
    if rank:
        wins = F.col("__t")[rank].isNull() | F.coalesce(F.col("__s")[rank] >= F.col("__t")[rank], F.lit(False))
    row = F.when(F.col("__sk").isNull(), F.col("__t")).when(F.col("__tk").isNull() | wins, F.col("__s")).otherwise(F.col("__t"))
    return t.join(s, F.col("__tk") == F.col("__sk"), "full_outer").select(row.alias("__r")).select("__r.*")


def merged_null(target: DataFrame, source: DataFrame, key: str, rank: str | None) -> DataFrame:
    """The row of the NULL key, if either side has one."""
    both = source.select(*target.columns, F.lit(1).alias(LOAD_COL)).unionByName(target.withColumn(LOAD_COL, F.lit(0)))
    order = [F.col(rank).desc_nulls_last()] if rank else []
    return latest_per_key(both.where(F.col(key).isNull()), [key], [*order, F.col(LOAD_COL).desc()]).drop(LOAD_COL)


def buckets_of(folder: str) -> int | None:
    found = re.search(r"-b(\d+)$", folder)
    return int(found[1]) if found else None


def upsert_bucketed(spark: SparkSession, path: str, source: DataFrame, key: str, columns: Sequence[str],
                    rank: str | None = None, buckets: int | None = None) -> DataFrame:
    """Upsert ``source`` (one row per key) into the table at ``path`` and return the table as read back.

    ``buckets`` counts for the first load only (default: the session's shuffle partitions). A table that
    was written without buckets is shuffled once."""
    last = current(spark, path)
    folder = None if last is None else last.parts[0][1]
    held = buckets_of(folder) if folder else None
    n = held or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    version = _new_version(last)
    new = f"{VERSION_COL}={version}-b{n}"
    src = source.select(*columns)

    def write(rows: DataFrame) -> None:
        said = [F.col(c).alias(c, metadata=src.schema[c].metadata) for c in columns]  # column descriptions
        out, name = f"{path}/data/{new}", _name(f"{path}/data/{new}")
        rows.select(*said).write.format("parquet").mode("errorifexists").bucketBy(n, key).sortBy(key).options(path=out, compression=CODEC).saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")

    if last is None:
        write(src.repartition(n, key))
    else:
        plain = read_commit(spark, path, last).select(*columns)
        with bucket_table(plain, f"{path}/data/{folder}", key, held) if held else contextlib.nullcontext(plain.repartition(n, key)) as target:
            write(merged_keys(target, src, key, rank).unionByName(merged_null(target, src, key, rank)))
    back = try_read(spark, f"{path}/data/{new}")
    if back is None:  # no row, so no file that could tell the columns
        write_version(src.limit(0), path)
        return read_current(spark, path)
    _commit(spark, path, version, [(None, new)])
    return back
