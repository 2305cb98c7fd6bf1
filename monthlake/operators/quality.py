"""Declarative data-quality checks: not_null, unique, unique combination, relationship.

Each check returns the failing rows/keys as a DataFrame; the suite returns one row per
check ``(table_name, check_name, columns, failures)`` and can raise when any fail.
All not_null checks of a table are computed in a single scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, StringType

from monthlake.session import scratch_path

MOST_HASHES = 1_000_000  # repeated key hashes that are broadcast: 8 MB


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL counts per column, one pass: ``(column_name, failures)``."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column_name", "failures")


def observe_not_null(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, Observation]:
    """``df`` with the NULLs of ``cols`` counted by whatever job writes it: no scan of its own.

    Watch the frame that is written, after its last shuffle, so that each partition counts once
    however often a stage before it runs."""
    seen = Observation()
    return df.observe(seen, *[F.count_if(F.col(c).isNull()).alias(f"n{k}") for k, c in enumerate(cols)]), seen


def observed_not_null(spark: SparkSession, seen: Observation, cols: Sequence[str]) -> DataFrame:
    """``check_not_null`` of a frame that has been written; waits for the write."""
    found = seen.get
    return spark.createDataFrame([(c, found.get(f"n{k}", 0)) for k, c in enumerate(cols)], "column_name string, failures bigint")


def _repeat_suspects(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The key columns of the rows whose key may occur more than once: for a key with texts, of those
    whose 64-bit hash does.

    The hashes, a fraction of the texts' bytes, are shuffled and the repeated ones written to the
    shared folder; the rows found by them are still to be compared whole. Where too many repeat to
    be broadcast, and for keys of numbers, which are as narrow as a hash, it is every row."""
    kinds = [df.schema[c].dataType for c in cols]
    keys = df.select(*cols)
    if StringType() not in kinds or not all(k == StringType() or isinstance(k, (IntegralType, DateType)) for k in kinds):
        return keys
    spark = df.sparkSession
    hashed = keys.withColumn("__h", F.xxhash64(*cols))
    path = scratch_path(spark, "repeated-hashes")
    hashed.groupBy("__h").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("__h").write.parquet(path)
    repeated = spark.read.parquet(path)
    if repeated.count() > MOST_HASHES:
        return keys
    return hashed.join(F.broadcast(repeated), "__h", "left_semi").drop("__h")


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Values (NULLs ignored) occurring more than once: ``(col, n_records)``."""
    return (_repeat_suspects(df.where(F.col(col).isNotNull()), [col]).groupBy(col).agg(F.count("*").alias("n_records"))
              .where(F.col("n_records") > 1))


def check_unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Column combinations occurring more than once (NULL counts as a value)."""
    return _repeat_suspects(df, cols).groupBy(*cols).agg(F.count("*").alias("n_records")).where(F.col("n_records") > 1)


def check_relationship(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (anti-join).

    The planner picks the join by the parent's size in bytes; in a shuffle join AQE splits the
    partition of a key that holds much of the child table."""
    keys = parent.select(F.col(parent_col).alias("__k"))
    return child.where(F.col(child_col).isNotNull()).join(keys, F.col(child_col) == F.col("__k"), "left_anti")


@dataclass(frozen=True)
class Check:
    table: str
    kind: str  # not_null | unique | unique_combination | relationships
    columns: tuple[str, ...]
    to_table: str | None = None
    to_column: str | None = None


def _failures(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").cast("bigint").alias("failures"))


def run_suite(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """All checks as one DataFrame ``(table_name, check_name, columns, failures)``."""
    return reduce(DataFrame.unionByName, _check_frames(tables, checks))


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check], threads: int = 8) -> list:
    """Execute the suite as independent jobs submitted side by side (a test runner's
    threads); returns the summary rows (one per check, at most a few dozen)."""
    frames = _check_frames(tables, checks)
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        results = list(pool.map(lambda f: f.collect(), frames))
    return [r for rows in results for r in rows]


def _check_frames(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> list[DataFrame]:
    parts: list[DataFrame] = []
    nn: dict[str, list[str]] = {}
    for ck in checks:
        if ck.kind == "not_null":
            nn.setdefault(ck.table, []).extend(ck.columns)
    for table, cols in nn.items():
        parts.append(check_not_null(tables[table], cols).select(
            F.lit(table).alias("table_name"), F.lit("not_null").alias("check_name"),
            F.col("column_name").alias("columns"), F.col("failures").cast("bigint").alias("failures")))
    for ck in checks:
        if ck.kind == "not_null":
            continue
        df = tables[ck.table]
        if ck.kind == "unique":
            bad = check_unique(df, ck.columns[0])
        elif ck.kind == "unique_combination":
            bad = check_unique_combination(df, ck.columns)
        elif ck.kind == "relationships":
            bad = check_relationship(df, tables[ck.to_table], ck.columns[0], ck.to_column)
        else:
            raise ValueError(f"unknown check kind {ck.kind!r}")
        parts.append(_failures(bad).select(
            F.lit(ck.table).alias("table_name"), F.lit(ck.kind).alias("check_name"),
            F.lit(",".join(ck.columns)).alias("columns"), "failures"))
    return parts


def assert_suite(result) -> object:
    """Raise ``AssertionError`` listing every failing check; return the result otherwise.
    Accepts the suite DataFrame or the rows from ``run_checks``."""
    rows = result.where(F.col("failures") > 0).collect() if isinstance(result, DataFrame) else result
    bad = [r for r in rows if r.failures > 0]
    if bad:
        lines = [f"{r.table_name}.{r.check_name}({r.columns}): {r.failures}" for r in bad]
        raise AssertionError("data-quality checks failed:\n" + "\n".join(lines))
    return result
