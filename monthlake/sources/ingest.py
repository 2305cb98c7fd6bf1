"""Raw ingest: delimited text / parquet -> all-string frames, period layout, exports.

S1-S12: text scan with separator and encoding, every column as text, missing-value
tokens -> NULL, format dispatch, snappy parquet sink, ``periodo=YYYY-MM`` partitions,
pruned period reads, multi-file union, skip of periods already present, table export
and catalog registration.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthlake.functions.casts import NULL_TOKENS, nullify_tokens
from monthlake.operators.upsert import ABSENT, CODEC, Commit, current, directories, read_commit, try_read
from monthlake.schemas import COMMENTS, RAW_COLUMNS
from monthlake.session import remove_scratch, scratch_path
from monthlake.sources.quoted import read_quoted

PERIOD_COL = "periodo"
NO_TEXT = "\x00"  # stands for an absent field while parsing, so that a quoted empty text stays a text


def all_string(df: DataFrame) -> DataFrame:
    """Every column cast to text, names and order kept."""
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS, columns: Iterable[str] | None = None) -> DataFrame:
    """Missing-value tokens -> NULL on the given (default: all string) columns, one pass."""
    str_cols = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    targets = set(columns) if columns is not None else str_cols
    return df.select([nullify_tokens(c, tokens).alias(c) if c in targets else F.col(c) for c in df.columns])


def detect_format(path: str) -> str:
    ext = path.rstrip("/").rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""
    return ext


def read_raw(spark: SparkSession, path: str | list[str], fmt: str | None = None, sep: str = ";",
             encoding: str = "ISO-8859-1", tokens: Sequence[str] | None = NULL_TOKENS,
             header: bool = True, scratch: str | None = None) -> DataFrame:
    """Read one raw period file (or many) as all-text columns with missing tokens nulled.

    ``fmt`` defaults to the file extension: ``csv`` (semicolon / latin-1 by default,
    header row, no type inference; quotes doubled inside quotes, a line break inside quotes is
    text) or ``parquet``. A text file is read by as many tasks as it has ranges of
    ``quoted.RANGE_BYTES``; files of one header, or of one Parquet schema, are one scan. All are
    united by column name. Spreadsheets have no Spark source and must be exported to CSV first;
    any other format is a ``ValueError``. ``scratch`` takes the records of text files, which the frame reads.
    """
    paths = [path] if isinstance(path, str) else list(path)
    text, tables = [], []
    for one in paths:
        kind = (fmt or detect_format(one)).lower()
        if "csv" in kind or kind in ("txt", "text"):
            text.append(one)
        elif "parquet" in kind:
            tables.append(one)
        elif "xlsx" in kind:
            raise ValueError("xlsx has no Spark source: export the sheet to CSV and read that")
        else:
            raise ValueError(f"unsupported raw file type: {kind!r}")
    frames = read_quoted(spark, text, sep, encoding, header, NO_TEXT, scratch=scratch) if text else []
    schemas: dict[str, list[str]] = {}
    for one in tables:
        schemas.setdefault(spark.read.parquet(one).schema.json(), []).append(one)
    for schema, those in schemas.items():
        frames.append(all_string(spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*those)))
    df = union_files(frames)
    return null_tokens(df, tokens) if tokens else df


def write_csv(df: DataFrame, path: str, sep: str = ";", encoding: str = "ISO-8859-1", compression: str = "none",
              rows_per_file: int = 0) -> None:
    """Delimited text that ``read_raw`` reads back as it was: quotes doubled, blanks kept, the
    empty text quoted and NULL not. A compressed file is read by one task, so ``rows_per_file`` (0: any)
    bounds it."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).options(
        compression=compression, header=True, sep=sep, encoding=encoding, quote='"', escape='"', escapeQuotes=True, nullValue="", emptyValue='""',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Snappy parquet sink (full refresh of the path)."""
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_if_absent(df: DataFrame, path: str) -> None:
    """Write the whole table only when nothing exists at ``path`` yet (``mode("ignore")``):
    a present target is left untouched, like a create-if-absent cache."""
    df.write.mode("ignore").option("compression", "snappy").parquet(path)


def write_period(df: DataFrame, path: str, period_col: str = PERIOD_COL, cluster: bool = False) -> None:
    """Write rows under ``<path>/periodo=YYYY-MM``; only the periods present in ``df``
    are replaced (dynamic partition overwrite), other periods stay.

    ``cluster`` range-partitions on (period, hash of the whole row) first, for writes
    spanning many months: each task then writes a contiguous run of months instead of
    one file per month per task, and a large month (or one dominated by a single
    value) is spread evenly over several tasks."""
    if cluster:
        df = df.repartitionByRange(F.col(period_col), F.xxhash64(*[F.col(c) for c in df.columns]))
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("compression", CODEC).partitionBy(period_col).parquet(path))


def read_periods(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 period: str | Sequence[str] | None = None, period_col: str = PERIOD_COL) -> DataFrame:
    """Scan one period (``'YYYY-MM'``), several, or all (``None`` / ``'*'``) of a period layout.

    Named periods are opened by their directories alone; one that has not landed raises
    ``FileNotFoundError``. With ``schema``, a column that the files lack raises ``ValueError``."""
    names = None if period in (None, "*") else [period] if isinstance(period, str) else list(period)
    dirs = [path] if names is None else [f"{path}/{period_col}={p}" for p in names]
    reader = spark.read.option("basePath", path)
    try:
        found = reader.parquet(*dirs)
    except AnalysisException as e:
        if names is not None and e.getCondition() in ABSENT:
            raise FileNotFoundError(f"a period of {names} has not landed under {path}") from e
        raise
    if schema is not None:
        have = {c.lower() for c in found.columns}
        if missing := [c for c in schema.fieldNames() if c.lower() not in have]:
            raise ValueError(f"the files under {path} have no column {', '.join(missing)}")
        if period_col not in schema.fieldNames():
            schema = T.StructType(schema.fields + [T.StructField(period_col, T.StringType())])
        found = reader.schema(schema).parquet(*dirs)
    return found.withColumn(period_col, F.col(period_col).cast("string"))


def ingest_period(spark: SparkSession, files: str | Sequence[str], path: str, period: str,
                  required: Sequence[str] = RAW_COLUMNS, fmt: str | None = None, **read) -> bool:
    """One period's raw files -> all text -> missing tokens to NULL -> ``periodo=<period>``.

    A period that has landed is left alone (returns False, no file is read). A file without a
    required column (any case) is an error. The records cut out of text go once they have landed."""
    if try_read(spark, f"{path}/{PERIOD_COL}={period}") is not None:
        return False
    scratch = scratch_path(spark, "text")
    try:
        df = all_string(read_raw(spark, files, fmt=fmt, scratch=scratch, **read))
        if missing := [c for c in required if c.lower() not in {x.lower() for x in df.columns}]:
            raise ValueError(f"{files}: no column {', '.join(missing)}")
        write_period(df.withColumn(PERIOD_COL, F.lit(period)), path)
    finally:
        remove_scratch(spark, scratch)
    return True


def union_files(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns missing in some files become NULL."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def skip_existing(incoming: DataFrame, existing: DataFrame, key: str | Sequence[str] = PERIOD_COL) -> DataFrame:
    """Rows of ``incoming`` whose period (key) is not loaded yet (left anti-join).

    The loaded periods are distinct (one per month), so the planner broadcasts them; past its
    own size limit AQE splits a month that holds most of the incoming rows."""
    keys = [key] if isinstance(key, str) else list(key)
    return incoming.join(existing.select(*keys).distinct(), keys, "left_anti")


def register_table(spark: SparkSession, path: str, name: str, database: str = "gold",
                   db_location: str | None = None, comment: str | None = None) -> DataFrame:
    """Expose a written Parquet table as ``database.name`` (create-if-absent, no copy).

    A versioned table is exposed as its newest committed version; registering it again after a
    commit moves the name on to that version. A partitioned one becomes a view over a table whose
    catalog partitions are the commit's directories, so a query opens the partitions it names."""
    loc = f" LOCATION '{db_location}'" if db_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    commit = current(spark, path)
    if commit is not None and commit.values:
        return _register_parts(spark, path, commit, name, database, comment)
    if commit is not None:
        path = directories(path, commit)[0]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} USING parquet LOCATION '{path}'{_comment(comment)}")
    spark.sql(f"ALTER TABLE {database}.{name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(f"{database}.{name}")
    return spark.table(f"{database}.{name}")


PARTS_AT_ONCE = 200  # partitions in one statement
LOAD_DIR = "load_dir"


def _comment(text: str | None) -> str:
    return "" if not text else " COMMENT '" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _register_parts(spark: SparkSession, path: str, commit: Commit, name: str, database: str, comment: str | None) -> DataFrame:
    """One partition of a value may lie in several directories (a load's new rows and the rows it
    kept), so the table behind the view is partitioned by value and directory. The view is replaced
    when all partitions of the new version are in, then the table of the version before goes."""
    column = commit.parts[0][1].rsplit("/", 1)[1].split("=", 1)[0]
    fields = read_commit(spark, path, commit).schema.fields
    said = {f.name: _comment(f.metadata.get("comment") or COMMENTS.get(f.name)) for f in fields}  # a directory's name has none
    ddl = {f.name: f"`{f.name}` {f.dataType.simpleString()}{said[f.name]}" for f in fields}
    table = f"{name}__v{commit.version}"
    if not spark.catalog.tableExists(f"{database}.{table}"):
        rows = ", ".join(d for n, d in ddl.items() if n != column)
        spark.sql(f"CREATE TABLE {database}.{table} ({rows}, {ddl[column]}, {LOAD_DIR} string) USING parquet "
                  f"PARTITIONED BY ({column}, {LOAD_DIR}) LOCATION '{path}/data'")
        parts = [f"PARTITION ({column}='{v}', {LOAD_DIR}='{d.split('/', 1)[0]}') LOCATION '{path}/data/{d}'" for v, d in commit.parts]
        for at in range(0, len(parts), PARTS_AT_ONCE):
            spark.sql(f"ALTER TABLE {database}.{table} ADD IF NOT EXISTS {' '.join(parts[at:at + PARTS_AT_ONCE])}")
    columns = ", ".join(f"`{n}`{c}" for n, c in said.items())
    names = ", ".join(f"`{n}`" for n in said)
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} ({columns}){_comment(comment)} AS SELECT {names} FROM {database}.{table}")
    for r in spark.sql(f"SHOW TABLES IN {database} LIKE '{name}__v*'").collect():
        if r.tableName != table:
            spark.sql(f"DROP TABLE {database}.{r.tableName}")  # external: its directories stay
    return spark.table(f"{database}.{name}")
