import datetime as dt

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from monthlake.plans.pipeline import FACT_TABLE, MART_TABLE, read_layer, run
from monthlake.sources.feed import raw_feed
from monthlake.sources.ingest import write_period
from monthlake.streaming import completeness as MC
from monthlake.streaming.completeness import RECEIPT, month_parts, start_complete_months, write_receipts

TS = dt.datetime(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_month_parts_cases(spark):
    got = month_parts(spark.createDataFrame([
        ("a", 1, 2), ("a", 1, 2),                 # the same part twice is one part
        ("b", 2, 2), ("b", 1, 2),
        ("c", 0, 1), ("c", 2, 1), ("c", None, 1),  # no part of 1..1
        ("d", 1, 1), ("d", 2, 3),                 # the larger announcement counts
        ("e", 1, 0), (None, 1, 1), ("f", 1, None)], RECEIPT))
    assert rows(got) == [("a", 2, 1, False), ("b", 2, 2, True), ("c", 1, 0, False), ("d", 3, 2, False), ("e", 0, 0, False)]
    assert rows(month_parts(spark.createDataFrame([], RECEIPT))) == []


@pytest.fixture()
def delivery(spark, tmp_table):
    base = tmp_table("parts")
    feed = raw_feed(spark, SF_SMALL, with_period=True)
    newest = feed.agg(F.max("periodo")).first()[0]
    half = F.xxhash64("nr_contrato", "id_terc") % 2 == 0
    parts = {1: feed.where((F.col("periodo") != newest) | half), 2: feed.where((F.col("periodo") == newest) & ~half)}

    def deliver(part, receipt=True):
        parts[part].write.mode("append").partitionBy("periodo").parquet(f"{base}/raw")
        if receipt:
            announce(part)

    def announce(part, of=None):
        months = parts[part].select("periodo").distinct()
        write_receipts(months.select("periodo", F.lit(part).alias("part"), (
            F.lit(of) if of else F.when(F.col("periodo") == newest, 2).otherwise(1)).alias("parts")), base)

    def drain():
        q = start_complete_months(spark, base, checkpoint=f"{base}/_checkpoint", run_ts=TS)
        q.awaitTermination()
        assert q.exception() is None

    return base, feed, int(newest.replace("-", "")), deliver, announce, drain


def months_of(spark, base):
    return {r.id_tempo for r in read_layer(spark, base, FACT_TABLE).select("id_tempo").distinct().collect()}


def test_half_a_month_is_held_back_and_published_after_a_restart(spark, tmp_table, delivery):
    base, feed, newest, deliver, announce, drain = delivery
    deliver(1)
    drain()
    before = months_of(spark, base)
    assert before and newest not in before

    deliver(2, receipt=False)  # files without their receipt publish nothing
    drain()
    assert months_of(spark, base) == before

    announce(2)
    drain()  # a new query on the same checkpoint: the first part is remembered
    whole = tmp_table("whole")
    write_period(feed, f"{whole}/raw")
    run(spark, whole, "*", run_ts=TS)
    for table in (MART_TABLE, FACT_TABLE, "dim_terceirizados"):
        assert rows(read_layer(spark, base, table)) == rows(read_layer(spark, whole, table)), table


def test_a_part_delivered_again_loads_its_month_again(spark, delivery, monkeypatch):
    base, _, newest, deliver, announce, drain = delivery
    loads, real = [], MC.load_periods
    monkeypatch.setattr(MC, "load_periods", lambda spark, base, periods, run_ts=None: (
        loads.append(list(periods)), real(spark, base, periods, run_ts=run_ts)))
    deliver(1)
    deliver(2)
    drain()
    count = lambda: read_layer(spark, base, FACT_TABLE).where(F.col("id_tempo") == newest).count()
    n = count()
    name = f"{newest // 100}-{newest % 100:02d}"
    assert name in loads[-1] and len(loads[-1]) > 1
    announce(2)
    drain()
    assert loads[-1] == [name] and count() == n
    drain()  # nothing new
    assert loads[-1] == [name] and count() == n
