"""Incremental load as a file-source stream.

The monthly "is this period already loaded?" check and the schedule become one
Structured Streaming query over the raw period directory: the checkpoint remembers
which files were processed, ``trigger(availableNow=True)`` processes whatever arrived
since the last run and stops, and ``foreachBatch`` runs the layer upserts for each
micro-batch. A batch names the periods that got files; these are loaded whole from the raw
directory, so the tables are those of one batch run whatever the order of the files, also when
a month comes in parts, and a batch replayed after a failure gives the same tables.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from monthlake import schemas
from monthlake.operators.upsert import read_current, write_version
from monthlake.plans.pipeline import load_silver_gold, paths
from monthlake.plans.staging import run_timestamp, stage
from monthlake.sources.ingest import read_periods


def load_periods(spark: SparkSession, base: str, periods: Sequence[str], run_ts: _dt.datetime | None = None,
                 backfill: bool = True) -> None:
    """Load whole periods from the raw directory through every layer; none: nothing happens."""
    if not periods:
        return
    p = paths(base)
    raw = read_periods(spark, p["raw"], schema=schemas.RAW, period=periods)
    write_version(schemas.describe(stage(raw, run_ts or run_timestamp())), p["bronze"])
    load_silver_gold(spark, base, read_current(spark, p["bronze"]), backfill=backfill)


def start_incremental(spark: SparkSession, base: str, checkpoint: str, backfill: bool = True,
                      max_files_per_trigger: int | None = None, available_now: bool = True,
                      run_ts: _dt.datetime | None = None) -> StreamingQuery:
    """Start the stream over ``<base>/raw``; returns the running query.

    ``backfill`` defaults to True here: files are not guaranteed to arrive in month
    order, and a watermark would drop an older month that arrives late."""
    p = paths(base)
    schema = T.StructType(schemas.RAW.fields + [T.StructField("periodo", T.StringType())])
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(p["raw"])

    def batch(df: DataFrame, epoch_id: int) -> None:
        periods = sorted(r[0] for r in df.select("periodo").distinct().collect())  # at most a calendar of months
        load_periods(spark, base, periods, run_ts=run_ts, backfill=backfill)

    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    return w.start()
