"""Helpers shared by the operators: words, shared tables, fixed-size bit filters."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake.session import remove_scratch, scratch_path

# A word is a run of characters outside [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text as array<string>; null and blank texts have none."""
    t = F.trim(text, F.lit(SPACES))
    return F.when(F.coalesce(t, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.split(t, SPACE_RUN))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def bounded_sample(df: DataFrame, key: Column, at_most: int) -> DataFrame:
    """At most ``at_most`` rows of ``df``: all, or those whose hash of ``key`` falls below the
    share that gives so many. Each task keeps its share only; nothing is sorted or gathered
    beyond the result, and the limit proves the bound."""
    n = df.count()
    if n > at_most:
        share = max(1.0, at_most - 4 * at_most**0.5) / n  # four standard deviations below the bound
        df = df.where(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < int(share * (1 << 40)))
    return df.limit(at_most)


def quoted(names: Iterable[str]) -> list[Column]:
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that helper columns beside it cannot clash."""
    return F.struct(*quoted(df.columns))


_SHARED: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def write_shared(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage (a lost
    executor recomputes nothing above it) and gives the planner real sizes for its joins."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", codec).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _SHARED[out] = path
    return out


def drop_shared(*tables: DataFrame) -> None:
    """Remove tables of ``write_shared`` that no later step reads: what was made of them is written."""
    for t in tables:
        remove_scratch(t.sparkSession, _SHARED.pop(t))


def plain_scan(docs: DataFrame) -> DataFrame:
    """``docs`` if its rows have a place in a file; else a written copy, whose rows do."""
    try:
        docs.select("_metadata.file_path")
        return docs
    except AnalysisException:
        return write_shared(docs, "content")


_SHIPPED: set[str] = set()


def driver_file(name: str) -> str:
    """A path on the driver, kept until it exits: Spark's file server serves added files from
    there whenever an executor asks, also one that joins late."""
    d = tempfile.mkdtemp(prefix="monthlake-")
    atexit.register(shutil.rmtree, d, ignore_errors=True)
    return os.path.join(d, name)


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    out = driver_file(f"{package.name}-{uuid.uuid4().hex[:12]}.zip")
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def ship_file(spark: SparkSession, path: str) -> str:
    """Send a copy of a driver's file to every executor; returns its name for ``SparkFiles.get``."""
    out = driver_file(f"{uuid.uuid4().hex[:12]}-{os.path.basename(path)}")
    shutil.copyfile(path, out)
    spark.sparkContext.addFile(out)
    return os.path.basename(out)


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder in Hadoop's notation, and its path there. ``s3a`` and ``s3n`` are
    Hadoop's names of ``s3``; a local folder may come without a scheme or with one slash."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), uri
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"s3:{rest}" if scheme in ("s3a", "s3n") else uri)


# --- one-hash bit filter of fixed size ---------------------------------------------------

FILTER_BITS = 1 << 25  # 4 MB in all, in rows of 4 KB: the broadcast below never grows past it


def bit_filter(keys: DataFrame, key: Column) -> DataFrame:
    """A bitmap of the hashes of ``key``: at most ``FILTER_BITS / 32768`` rows of 4 KB."""
    b = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    return (keys.select(b.alias("b"))
                .groupBy(F.bitmap_bucket_number("b").alias("__bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("__bits")))


def with_maybe(df: DataFrame, bits: DataFrame, key: Column, name: str) -> DataFrame:
    """Add boolean ``name``: false only where ``key`` is surely not among the filter's keys.

    The filter's size is fixed, so broadcasting it is safe at any input; false positives
    grow as it fills and are resolved by the exact join that follows."""
    b = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    cols = df.columns
    pos = F.col("__pos")
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.floor(pos / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    hit = F.getbit(byte.cast("int"), (pos % 8).cast("int")) == 1
    probe = df.select("*", F.bitmap_bucket_number(b).alias("__bucket"), F.bitmap_bit_position(b).alias("__pos"))
    return (probe.join(F.broadcast(bits), "__bucket", "left")
                 .select(*quoted(cols), F.coalesce(hit, F.lit(False)).alias(name)))
