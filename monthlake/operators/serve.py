"""Serving: ordered pages, id lookups and the page envelope.

``b_start``/``limit`` follow the list endpoint: default 20 rows, at most 200;
``b_start < 0`` and ``limit < 0`` are errors, ``limit = 0`` is an empty page. Lookups
also reject ``limit <= 0`` and raise ``LookupError`` when the id has no rows. Rows are
ordered by the key, NULLs last, then by the remaining columns so pages never overlap.

A serving table is written once in that order (range-partitioned and sorted) together with an
index of its files: rows, first and last key, and the position of the first row. A page at any
depth opens the files that hold its positions and takes its rows by their number in the file:
nothing is sorted, and the driver gets the page only. The row count is taken while the table is written, so the envelope
of a list page opens no data file. A lookup picks files by their first and last key before it opens
any: those inside an id's run are counted by the index, the ones at its ends (at most three) are
opened, and there the key's Bloom filters skip row groups that cannot hold the id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F

from monthlake.functions.packed import pack, unpack
from monthlake.operators.upsert import CODEC, VERSION_COL, _commit, _new_version, current

DEFAULT_LIMIT = 20
MAX_LIMIT = 200
TEXTS = "__texts"


def clamp(b_start, limit, max_limit: int = MAX_LIMIT, allow_zero: bool = True) -> tuple[int, int]:
    try:
        b, n = int(b_start), int(limit)
    except (TypeError, ValueError) as e:
        raise ValueError("invalid paging parameters") from e
    if b < 0:
        raise ValueError("b_start must be >= 0")
    if n < 0 or (n == 0 and not allow_zero):
        raise ValueError("limit must be > 0" if not allow_zero else "limit must be >= 0")
    return b, min(n, max_limit)


def page_order(columns: list[str], key: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in (key, *[c for c in columns if c != key])]


def _in_ranges(df: DataFrame, key: str) -> DataFrame:
    """``df`` in ranges of the page order; the columns of text travel as one."""
    texts = [name for name, kind in df.dtypes if kind == "string" and name != key]
    if len(texts) < 2:
        return df.repartitionByRange(*page_order(df.columns, key))
    rows = df.select(*[c for c in df.columns if c not in texts], pack(*texts).alias(TEXTS))
    column = dict(zip(texts, unpack(TEXTS, len(texts)), strict=True))
    at = [column.get(c, F.col(c)) for c in (key, *[c for c in df.columns if c != key])]
    return rows.repartitionByRange(*[c.asc_nulls_last() for c in at]).select(
        *[column[c].alias(c, metadata=df.schema[c].metadata) if c in column else F.col(c) for c in df.columns])


def write_serving(df: DataFrame, path: str, key: str) -> int:
    """Write a table version in page order, its file index and row count, and then its commit entry."""
    spark, order = df.sparkSession, page_order(df.columns, key)
    version = _new_version(current(spark, path))
    folder = f"{VERSION_COL}={version}"
    written = Observation()
    pages = _in_ranges(df, key).sortWithinPartitions(*order).observe(written, F.count(F.lit(1)).alias("rows"))
    (pages.write.mode("errorifexists").option("compression", CODEC).option(f"parquet.bloom.filter.enabled#{key}", "true")
          .option("parquet.bloom.filter.adaptive.enabled", "true").parquet(f"{path}/data/{folder}"))
    total = written.get.get("rows", 0)
    rows = spark.read.schema(df.schema).parquet(f"{path}/data/{folder}")
    name = F.col("_metadata.file_name")
    files = rows.select(name.alias("file"), F.col(key).alias("k")).groupBy("file").agg(
        F.count("*").alias("rows"), F.min("k").alias("first_key"), F.max("k").alias("last_key"),
        F.count_if(F.col("k").isNull()).alias("null_keys"))
    # Tasks are numbered in range order; one row per file of the table.
    part = F.regexp_extract("file", r"^part-(\d+)", 1).cast("long")
    upto = F.sum("rows").over(Window.orderBy(part, "file"))
    files.withColumn("start", upto - F.col("rows")).write.parquet(f"{path}/_index/{folder}")
    spark.range(1).select(F.lit(total).cast("long").alias("total")).write.parquet(f"{path}/_totals/{folder}")
    _commit(spark, path, version, [(None, folder)])
    return version


def _open(spark: SparkSession, path: str) -> tuple[str, DataFrame]:
    """The newest version's directory and its file index."""
    c = current(spark, path)
    if c is None:
        raise LookupError(f"no table at {path}")
    folder = f"{VERSION_COL}={c.version}"
    return f"{path}/data/{folder}", spark.read.parquet(f"{path}/_index/{folder}")


def totals(spark: SparkSession, path: str) -> DataFrame:
    """One row ``total`` of the newest version, as counted by the job that wrote it."""
    c = current(spark, path)
    if c is None:
        raise LookupError(f"no table at {path}")
    return spark.read.schema("total bigint").parquet(f"{path}/_totals/{VERSION_COL}={c.version}")


def total_rows(spark: SparkSession, path: str) -> int:
    return totals(spark, path).first()[0]


def _positions(spark: SparkSession, path: str, key: str, lo: int, hi: int) -> DataFrame:
    """Rows at positions ``[lo, hi)`` in page order."""
    data, index = _open(spark, path)
    # A file holds a row at least, so at most hi - lo files hold a page.
    files = index.where((F.col("start") < hi) & (F.col("start") + F.col("rows") > lo)).collect() if hi > lo else []
    if not files:
        return spark.read.parquet(data).limit(0)
    df = spark.read.parquet(*[f"{data}/{f.file}" for f in files])
    name, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    wanted = reduce(lambda a, b: a | b, [
        (name == f.file) & (row >= lo - f.start) & (row < hi - f.start) for f in files])
    return df.where(wanted).orderBy(*page_order(df.columns, key)).limit(hi - lo)


def page(spark: SparkSession, path: str, key: str, b_start=0, limit=DEFAULT_LIMIT,
         max_limit: int = MAX_LIMIT) -> DataFrame:
    """Rows ``b_start .. b_start+limit-1`` of a serving table."""
    b, n = clamp(b_start, limit, max_limit)
    return _positions(spark, path, key, b, b + n)


def envelope(df: DataFrame, b_start=0, limit=DEFAULT_LIMIT, max_limit: int = MAX_LIMIT) -> DataFrame:
    """One row ``(b_start, limit, total, next)``; ``next`` is NULL on the last page."""
    b, n = clamp(b_start, limit, max_limit)
    total = F.count("*")
    return df.agg(
        F.lit(b).alias("b_start"), F.lit(n).alias("limit"), total.alias("total"),
        F.when(F.lit(b + n) < total, F.lit(b + n)).alias("next"))


def serving_envelope(spark: SparkSession, path: str, b_start=0, limit=DEFAULT_LIMIT, max_limit: int = MAX_LIMIT) -> DataFrame:
    """``envelope`` of a serving table, from its written row count: no data file is opened."""
    b, n = clamp(b_start, limit, max_limit)
    return _envelope_row(totals(spark, path), b, n)


def _envelope_row(total: DataFrame, b: int, n: int) -> DataFrame:
    return total.select(F.lit(b).alias("b_start"), F.lit(n).alias("limit"), "total",
                        F.when(F.lit(b + n) < F.col("total"), F.lit(b + n)).alias("next"))


def key_files(spark: SparkSession, path: str, value) -> tuple[list[Row], int, int | None]:
    """Where rows of key ``value`` can be, by the index alone: the files at the ends of its run, which
    may hold other keys too (at most three), and the rows and first position of those between."""
    _, index = _open(spark, path)
    v = F.lit(value)
    can = index.where((F.col("first_key") <= v) & (F.col("last_key") >= v))
    end = (F.col("first_key") < v) | (F.col("last_key") > v) | (F.col("null_keys") > 0)
    inner = can.where(~end).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.min("start").alias("start")).first()
    return can.where(end).orderBy("start").collect(), inner.rows, inner.start


def lookup(spark: SparkSession, path: str, key: str, value, b_start=0, limit=DEFAULT_LIMIT,
           max_limit: int = MAX_LIMIT) -> tuple[DataFrame, DataFrame]:
    """(page of rows with ``key == value``, envelope with the key) of a serving table.
    ``LookupError`` when nothing matches; no file is opened where the index knows that."""
    b, n = clamp(b_start, limit, max_limit, allow_zero=False)
    data, _ = _open(spark, path)
    ends, total, start = key_files(spark, path, value)
    is_key, smaller = F.col(key) == F.lit(value), F.col(key) < F.lit(value)
    for f in ends:
        one = spark.read.parquet(f"{data}/{f.file}")
        hits = one.where(is_key).count()
        if hits and (start is None or f.start < start):
            start = f.start + (one.where(smaller).count() if f.first_key < value else 0)
        total += hits
    if total == 0:
        raise LookupError(f"no rows for {key} = {value!r}")
    env = _envelope_row(spark.range(1).select(F.lit(total).cast("long").alias("total")), b, n).select(F.lit(value).alias(key), "*")
    return _positions(spark, path, key, start + b, min(start + b + n, start + total)), env


def row_json(df: DataFrame, col: str = "json") -> DataFrame:
    """Each row as one JSON object (column names as fields; NULL values kept as ``null``)."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(col))
