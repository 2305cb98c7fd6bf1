"""Months are published once all their announced parts are in.

A month's raw files may be delivered in parts. After a part's files the deliverer writes a receipt
``(periodo, part, parts)``: part ``part`` of the announced ``parts``. A Structured Streaming
aggregation over the receipts keeps, per month, the parts seen and the latest announcement in
RocksDB state under the checkpoint; the state is one row a month of the calendar. A batch loads the
months that got a receipt and are complete, whole, from the raw directory. So half a month never
reaches bronze, silver or gold; a part delivered again or announced later loads its month again; a
restart goes on from the checkpoint, and a batch replayed after a failure gives the same tables.

Defined cases: receipts without a month, part or number of parts, and parts outside ``1..parts``,
complete nothing; repeated receipts count once; if a month is announced with different numbers of
parts, the largest counts.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from monthlake.streaming.incremental import load_periods

RECEIPT = "periodo string, part int, parts int"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def receipts_path(base: str) -> str:
    return f"{base}/receipts"


def write_receipts(receipts: DataFrame, base: str) -> None:
    """Add receipts ``(periodo, part, parts)``, after the files of their parts."""
    receipts.select("periodo", F.col("part").cast("int"), F.col("parts").cast("int")).write.mode("append").parquet(
        receipts_path(base))


def month_parts(receipts: DataFrame) -> DataFrame:
    """``periodo, parts, seen, complete`` per month; the same on a table and on a stream."""
    known = receipts.where("periodo IS NOT NULL AND part IS NOT NULL AND parts IS NOT NULL")
    months = known.groupBy("periodo").agg(F.max("parts").alias("parts"), F.collect_set("part").alias("seen"))
    seen = F.size(F.filter("seen", lambda p: (p >= 1) & (p <= F.col("parts"))))
    return months.select("periodo", "parts", seen.alias("seen"), ((seen == F.col("parts")) & (seen > 0)).alias("complete"))


def start_complete_months(spark: SparkSession, base: str, checkpoint: str, available_now: bool = True,
                          max_files_per_trigger: int | None = None,
                          run_ts: _dt.datetime | None = None) -> StreamingQuery:
    """Start the stream over ``<base>/receipts``; returns the running query."""
    reader = spark.readStream.schema(RECEIPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    months = month_parts(reader.parquet(receipts_path(base)))

    def batch(changed: DataFrame, epoch_id: int) -> None:
        ready = sorted(r[0] for r in changed.where("complete").select("periodo").collect())  # months of a calendar
        load_periods(spark, base, ready, run_ts=run_ts)

    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)  # read when the query starts
    try:
        w = months.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint)
        return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")).start()
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)
