"""Tables on plain Parquet with one commit mechanism, and the SCD-1 upsert on them.

A table is ``<path>/data`` with immutable directories and ``<path>/_commits/version=<n>`` with
one entry per version: the directories that make up the table then, and for a partitioned table
the partition value of each. A write puts new directories in place first and becomes visible
when its entry is written; readers open exactly the directories of the newest entry. A job or
driver that dies half-way, in the first load as in any other, leaves directories that no entry
names, and the next run starts from the last committed state. One writer per table at a time.

Parquet has no MERGE, so a merge is ``target anti-join source-keys UNION source``. For a table
partitioned by month the source is written once into new month directories; of the target only
the months that the source touches are read, and their remaining rows go into directories
beside it. Which months a table holds is known from its entry, without opening a data file.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake.operators.dedup import latest_per_key

VERSION_COL = "version"
LOAD_COL = "__load"
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
CODEC = "zstd"  # of table files: written once, so smaller files are worth a little more work


@dataclass(frozen=True)
class Commit:
    """One version: its number, its directories under ``data`` and their partition values."""

    version: int
    parts: tuple[tuple[str | None, str], ...]

    @property
    def values(self) -> list[str]:
        return sorted({p for p, _ in self.parts if p is not None})


def try_read(spark: SparkSession, path: str, **options) -> DataFrame | None:
    """A Parquet directory, or None when there is no such directory or it holds no file; any
    other error is an error."""
    try:
        return spark.read.options(**options).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ABSENT:
            return None
        raise


def current(spark: SparkSession, path: str) -> Commit | None:
    """The newest committed version. The entries' directories are named by the file listing
    alone (no job); the newest entry is a few rows."""
    log = try_read(spark, f"{path}/_commits")
    if log is None:
        return None
    marker = f"/{VERSION_COL}="
    newest = max(int(f.rsplit(marker, 1)[1].split("/", 1)[0]) for f in log.inputFiles() if marker in f)
    rows = spark.read.parquet(f"{path}/_commits{marker}{newest}").collect()
    return Commit(newest, tuple(sorted(((r.part, r.dir) for r in rows), key=str)))


def current_version(spark: SparkSession, path: str) -> int | None:
    c = current(spark, path)
    return None if c is None else c.version


def _commit(spark: SparkSession, path: str, version: int, parts) -> Commit:
    c = Commit(version, tuple(parts))
    (spark.createDataFrame(list(c.parts), "part string, dir string").coalesce(1)
          .write.mode("errorifexists").parquet(f"{path}/_commits/{VERSION_COL}={version}"))
    return c


def directories(path: str, commit: Commit, values: Sequence[str] | None = None) -> list[str]:
    return [f"{path}/data/{d}" for p, d in commit.parts if values is None or p in values]


def read_commit(spark: SparkSession, path: str, commit: Commit, values: Sequence[str] | None = None) -> DataFrame | None:
    """The rows of a version, or of some of its partitions; None when it has no such directory."""
    dirs = directories(path, commit, values)
    if not dirs:
        return None
    df = spark.read.option("basePath", f"{path}/data").parquet(*dirs)
    return df.drop(VERSION_COL)


def read_current(spark: SparkSession, path: str, values: Sequence[str] | None = None) -> DataFrame | None:
    """The newest committed version (None before the first commit)."""
    c = current(spark, path)
    return None if c is None else read_commit(spark, path, c, values)


def _new_version(last: Commit | None) -> int:
    return max(time.time_ns() // 1000, (last.version if last else 0) + 1)


def write_version(df: DataFrame, path: str) -> int:
    """Replace an unpartitioned table: write the data, then its entry."""
    spark = df.sparkSession
    version = _new_version(current(spark, path))
    df.write.mode("errorifexists").option("compression", CODEC).parquet(f"{path}/data/{VERSION_COL}={version}")
    _commit(spark, path, version, [(None, f"{VERSION_COL}={version}")])
    return version


def merge_frames(target: DataFrame | None, source: DataFrame, keys: Sequence[str], order: Sequence | None,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Pure upsert: one row per key from ``source`` (first under ``order``; None: it has one row
    per key already) replaces the target row with the same key (NULL-safe match); other target
    rows stay."""
    src = source if order is None else latest_per_key(source, keys, order)
    cols = list(columns or (target.columns if target is not None else src.columns))
    src = src.select(*cols)
    if target is None:
        return src
    return kept_rows(target, src, keys, cols).unionByName(src)


def kept_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in ``source`` (one row per key)."""
    k = source.select(*[F.col(c).alias(f"__{c}") for c in keys])
    cond = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys]
    return target.join(k, cond, "left_anti").select(*columns)


def clustered_for_partitions(df: DataFrame, partition: str, keys: Sequence[str]) -> DataFrame:
    """Range-partition on (partition column, keys) before a ``partitionBy`` write.

    After a hash shuffle every task holds rows of every month and would write one file
    per month; range partitioning gives each task a contiguous run of months (a large
    month spans several tasks), so a backfill writes about size/partition-size files
    instead of tasks x months. AQE sizes the ranges."""
    return df.repartitionByRange(F.col(partition), *[F.col(k) for k in keys])


def upsert_table(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                 order: Sequence | None, columns: Sequence[str] | None = None, partition: str | None = None,
                 rank: Sequence | None = None, clustered: bool = False) -> DataFrame:
    """Upsert ``source`` into the table at ``path`` and return the table as read back.

    ``clustered``: the source comes in ranges of the partition column and is written as it is.
    With the partition column among ``keys``, only months that the target holds are compared.

    ``order`` picks one source row per key (None: it has one already). A matched target row is replaced; with ``rank``
    (descending columns that the table stores) only by a source row that ranks at least as high,
    so that loads may come in any order."""
    last = current(spark, path)
    if partition is None:
        target = None if last is None else read_commit(spark, path, last)
        if target is None or rank is None:
            merged = merge_frames(target, source, keys, order, columns)
        else:
            cols = list(columns or target.columns)
            best = (source if order is None else latest_per_key(source, keys, order)).select(*cols).withColumn(LOAD_COL, F.lit(1))
            both = best.unionByName(target.select(*cols).withColumn(LOAD_COL, F.lit(0)))
            merged = latest_per_key(both, keys, [*rank, F.col(LOAD_COL).desc()]).drop(LOAD_COL)
        write_version(merged, path)
        return read_current(spark, path)

    version = _new_version(last)
    src = source if order is None else latest_per_key(source, keys, order)
    cols = list(columns or src.columns)
    rows = src.select(*cols)
    written = _write_parts(rows if clustered else clustered_for_partitions(rows, partition, keys), path, partition, version)
    if not written and last is not None:
        return read_commit(spark, path, last)
    touched = sorted({p for p, _ in written})
    kept: list = []
    target = None if last is None else read_commit(spark, path, last, touched)
    if target is not None:
        held = set(last.values)
        fresh = _read_dirs(spark, path, [d for p, d in written if partition not in keys or p in held])
        rest = kept_rows(target, fresh, keys, cols)
        kept = _write_parts(clustered_for_partitions(rest, partition, keys), path, partition, version, "kept")
    others = [(p, d) for p, d in last.parts if p not in touched] if last else []
    c = _commit(spark, path, version, [*others, *kept, *written])
    out = read_commit(spark, path, c)
    return src.select(*cols).limit(0) if out is None else out


def _read_dirs(spark: SparkSession, path: str, dirs: Sequence[str]) -> DataFrame:
    return spark.read.option("basePath", f"{path}/data").parquet(*[f"{path}/data/{d}" for d in dirs]).drop(VERSION_COL)


def _write_parts(df: DataFrame, path: str, partition: str, version: int, kind: str = "new") -> list[tuple[str, str]]:
    """Write one load's rows under ``data/version=<n>-<kind>/<partition>=<value>`` and return its
    (value, directory) pairs, from the listing of what was written."""
    spark = df.sparkSession
    folder = f"{VERSION_COL}={version}-{kind}"
    df.write.mode("errorifexists").option("compression", CODEC).partitionBy(partition).parquet(f"{path}/data/{folder}")
    back = try_read(spark, f"{path}/data/{folder}")
    marker = f"/{partition}="
    files = [] if back is None else back.inputFiles()
    values = {f.rsplit(marker, 1)[1].split("/", 1)[0] for f in files if marker in f}
    return [(v, f"{folder}/{partition}={v}") for v in sorted(values)]
