"""Delimited text with line breaks inside quotes, read by many tasks.

Quotes are doubled inside quotes, so a byte is inside quotes if and only if the quotes before it are
odd in number. Spark splits files in ranges of whole lines (``RANGE_BYTES``); three steps cut records:

1. every range counts its quotes, and the first one of a file also gives the file's header;
2. a prefix sum over the ranges of a file tells which of them start inside quotes;
3. every range cuts its own records, starting from its parity. A range's first lines, if they
   belong to a record that began before it, and its last record, if it goes on after it, are
   pieces; pieces of one record are put together in the order of their ranges.

A piece is seldom more than a line. Complete records never leave their task: they are written
under their file's header, so that files of one header are one scan with one set of columns.
Brought to the driver: the distinct headers, one number a file, and the ranges that start inside quotes.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthlake.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of the package

RANGE_BYTES = 128 << 20
# A complete record; one that goes on after its range; lines that end an earlier one; a header that goes on.
WHOLE, OPEN, TAIL, HEAD = range(4)


def _lines(spark: SparkSession, paths: Sequence[str], range_bytes: int) -> DataFrame:
    """``file, at, line`` of every line: its file, its range's first byte, its bytes. The ranges depend on
    ``range_bytes`` alone (not on the cluster's size of the moment), so both readings see the same:
    the scan keeps the settings of the session that made it."""
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    own.conf.set("spark.sql.files.openCostInBytes", str(min(range_bytes, 4 << 20)))
    return own.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.col("value").cast("binary").alias("line"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """The lines of one range after the other, as far as a batch holds them."""
    files, at = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
    file = files.indices.to_numpy()
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (at[1:] != at[:-1])) + 1
    for a, b in zip([0, *cuts], [*cuts, len(at)], strict=True):
        if b > a:
            yield files.dictionary[int(file[a])].as_py(), int(at[a]), batch.column(2).slice(a, b - a)


def _quotes(lines: pa.Array) -> np.ndarray:
    return pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64)


def _without_return(line: bytes) -> bytes:
    return line[:-1] if line.endswith(b"\r") else line


def field_names(record: bytes, sep: str, encoding: str, header: bool) -> list[str]:
    """Column names from a file's first record; without a header they are numbered."""
    fields = next(csv.reader([record.decode(encoding).removeprefix("\ufeff")], delimiter=sep, quotechar='"', doublequote=True))
    return fields if header else [f"_c{n}" for n in range(len(fields))]


def measure_ranges(sep: str, encoding: str, header: bool):
    """The function that gives ``file, at, quotes, names`` of a task's ranges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes: dict[tuple[str, int], int] = {}
        first: dict[str, list[bytes]] = {}  # lines of a file's first record
        names: dict[str, list[str]] = {}
        for b in batches:
            for file, at, lines in _runs(b):
                counts = _quotes(lines)
                so_far = quotes.setdefault((file, at), 0)
                quotes[file, at] += int(counts.sum())
                if at or file in names:
                    continue
                record = first.setdefault(file, [])
                for line, n in zip(lines, counts.tolist(), strict=True):
                    so_far += n
                    record.append(_without_return(line.as_py()))
                    if so_far % 2 == 0 and any(record):
                        names[file] = field_names(b"\n".join(record), sep, encoding, header)
                        break
                    if so_far % 2 == 0:
                        record.clear()
        keys = list(quotes)
        yield pa.RecordBatch.from_arrays(
            [pa.array([f for f, _ in keys], pa.string()), pa.array([a for _, a in keys], pa.int64()),
             pa.array(list(quotes.values()), pa.int64()),
             pa.array([names.get(f) if a == 0 else None for f, a in keys], pa.list_(pa.string()))],
            ["file", "at", "quotes", "names"])

    return run


def one_record(record: bytes, sep: str, encoding: str) -> bytes:
    """A record of several lines, if a reader that knows only quoted fields finds one in it too."""
    csv.field_size_limit(sys.maxsize)
    if sum(1 for _ in csv.reader(io.StringIO(record.decode(encoding), newline=""), delimiter=sep)) != 1:
        raise ValueError(f"a quote in a field without quotes: {record[:200]!r}")
    return record


def cut_records(inside: set[tuple[str, int]], groups: dict[str, int], header: bool, sep: str, encoding: str):
    """The function that cuts a task's lines into ``kind, file, at, line, group``."""
    names = ["kind", "file", "at", "line", "group"]

    def rows(kind: int, file: str, at: int, lines: list | pa.Array) -> pa.RecordBatch:
        n = len(lines)
        whole = kind == WHOLE
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * n, pa.int32()), pa.array([None if whole else file] * n, pa.string()),
             pa.array([None if whole else at] * n, pa.int64()),
             lines if isinstance(lines, pa.Array) else pa.array(lines, pa.binary()),
             pa.array([groups[file]] * n, pa.int32())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        held: list[bytes] = []  # lines of the record that is open
        begun = skip = False  # whether the open record began in this range; whether the header is still to come
        parity = 0
        for b in batches:
            for file, at, lines in _runs(b):
                if (file, at) != now:
                    if held:
                        yield rows(HEAD if skip else OPEN if begun else TAIL, *now, [b"\n".join(held)])
                    now, held, parity = (file, at), [], int((file, at) in inside)
                    begun, skip = not parity, header and at == 0
                after = (parity + np.cumsum(_quotes(lines))) % 2
                before = np.concatenate([[parity], after[:-1]])
                parity = int(after[-1])
                single = (before == 0) & (after == 0)
                keep = single.copy()
                if skip and not held:  # the header is the first record that is not blank
                    k = next((k for k, line in enumerate(lines) if not single[k] or line.as_py() not in (b"", b"\r")), None)
                    if k is not None and single[k]:
                        keep[k] = skip = False
                out: list[bytes] = []
                for k in np.flatnonzero(~single).tolist():
                    held.append(lines[k].as_py())
                    if after[k]:
                        begun = begun if before[k] else True
                        continue
                    record = b"\n".join(held)
                    held = []
                    if not begun:
                        yield rows(TAIL, file, at, [record])
                        begun = True
                    elif skip:
                        skip = False
                    else:
                        out.append(one_record(_without_return(record), sep, encoding))
                plain = lines.filter(pa.array(keep))
                if pc.any(pc.ends_with(plain, "\r")).as_py():
                    plain = pa.array([_without_return(x.as_py()) for x in plain], pa.binary())
                plain = plain.filter(pc.greater(pc.binary_length(plain), 0))
                if len(plain):
                    yield rows(WHOLE, file, at, plain)
                if out:
                    yield rows(WHOLE, file, at, out)
        if held:
            yield rows(HEAD if skip else OPEN if begun else TAIL, *now, [b"\n".join(held)])

    return run


def read_quoted(spark: SparkSession, paths: Sequence[str], sep: str, encoding: str, header: bool, null_value: str,
                range_bytes: int = RANGE_BYTES, scratch: str | None = None) -> list[DataFrame]:
    """One frame of text columns per distinct header of the files under ``paths``, read from the records that
    are written under ``scratch`` (the caller may remove it when it is through; default: a folder that stays).

    Blank lines are skipped; line breaks inside quotes stay as they are. A quote that is never closed, one inside a field without quotes that
    joins lines, or a record with more or fewer fields than its header is an error. ``encoding``
    must keep quotes, separators and line breaks as single bytes (not UTF-16 or UTF-32)."""
    if encoding.upper().startswith(("UTF-16", "UTF16", "UTF-32", "UTF32")):
        raise ValueError(f"{encoding} text cannot be read in ranges of bytes")
    lines = _lines(spark, paths, range_bytes)
    base = scratch or scratch_path(spark, "text")
    lines.mapInArrow(measure_ranges(sep, encoding, header), "file string, at bigint, quotes bigint, names array<string>").write.parquet(
        f"{base}/ranges")
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ranges = spark.read.parquet(f"{base}/ranges").withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    odd = ranges.groupBy("file").agg(F.sum("quotes").alias("n")).where("n % 2 = 1").select("file").limit(3).collect()
    if odd:
        raise ValueError(f"a quote is not closed in {', '.join(r.file for r in odd)}")
    inside = {(r.file, r.at) for r in ranges.where("inside").select("file", "at").collect()}
    first = ranges.where("at = 0 AND names IS NOT NULL").select("file", "names")
    headers = [r.names for r in first.groupBy("names").agg(F.min("file").alias("f")).orderBy("f").collect()]
    number = {tuple(names): k for k, names in enumerate(headers)}
    groups = {r.file: number[tuple(r.names)] for r in first.collect()}
    for names in headers:
        if len(set(names)) < len(names):
            raise ValueError(f"a column stands twice in the header {names}")
    records = lines.mapInArrow(cut_records(inside, groups, header, sep, encoding), RECORDS + ", group int")
    records.write.option("compression", "zstd").partitionBy("group").parquet(f"{base}/records")
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST", "nullValue": null_value}
    frames = []
    for k, names in enumerate(headers):
        mine = spark.read.schema(f"{RECORDS}, group int").parquet(f"{base}/records").where(F.col("group") == k)  # a directory
        records = _joined(mine, encoding)
        row = F.from_csv("record", ", ".join(f"c{n} string" for n in range(len(names))), options)
        frames.append(records.select(row.alias("r")).select(*[F.col(f"r.c{n}").alias(name) for n, name in enumerate(names)]))
    return frames


RECORDS = "kind int, file string, at bigint, line binary"


def _joined(rows: DataFrame, encoding: str) -> DataFrame:
    """``record`` of every whole record, and of those put together from their pieces: one left open at
    the end of a range, then the first lines of the ranges after it."""
    rows = rows.select("kind", "file", "at", F.decode("line", encoding).alias("line"))
    nth = Window.partitionBy("file").orderBy("at", F.when(F.col("kind") == TAIL, 0).otherwise(1))
    pieces = rows.where(F.col("kind") != WHOLE).withColumn("opened", F.sum((F.col("kind") != TAIL).cast("int")).over(nth))
    joined = pieces.groupBy("file", "opened").agg(F.array_sort(F.collect_list(F.struct("at", "line"))).alias("p"),
                                                  F.max("kind").alias("kind")).where(F.col("kind") != HEAD)
    joined = joined.select(F.regexp_replace(F.array_join(F.transform("p", lambda x: x["line"]), "\n"), "\r\\z", "").alias("record"))
    return rows.where(F.col("kind") == WHOLE).select(F.col("line").alias("record")).unionByName(joined)
