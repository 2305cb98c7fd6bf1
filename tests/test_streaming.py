import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from monthlake.plans.pipeline import FACT_TABLE, MART_TABLE, read_layer, run
from monthlake.sources.feed import raw_feed
from monthlake.sources.ingest import write_period
from monthlake.streaming.incremental import start_incremental

TS = dt.datetime(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _drain(spark, base, ckpt):
    q = start_incremental(spark, base, checkpoint=ckpt, run_ts=TS)
    q.awaitTermination()
    assert q.exception() is None


def test_stream_in_two_drops_equals_one_run(spark, tmp_table):
    feed = raw_feed(spark, SF_SMALL, with_period=True)
    periods = sorted(r[0] for r in feed.select("periodo").distinct().collect())
    cut = periods[len(periods) // 2]
    streamed, batch = tmp_table("stream"), tmp_table("batch")
    ckpt = f"{streamed}/_checkpoint"

    write_period(feed.where(F.col("periodo") < cut), f"{streamed}/raw")
    _drain(spark, streamed, ckpt)
    first = rows(read_layer(spark, streamed, MART_TABLE))
    _drain(spark, streamed, ckpt)  # nothing new: same tables
    assert rows(read_layer(spark, streamed, MART_TABLE)) == first

    write_period(feed.where(F.col("periodo") >= cut), f"{streamed}/raw")
    _drain(spark, streamed, ckpt)

    write_period(feed, f"{batch}/raw")
    run(spark, batch, "*", run_ts=TS)
    for table in (MART_TABLE, "dim_terceirizados", "dim_orgaos"):
        assert rows(read_layer(spark, streamed, table)) == rows(read_layer(spark, batch, table)), table
    cols = ["id_fato", "id_tempo", "salario_mensal_valor", "custo_mensal_valor"]
    assert rows(read_layer(spark, streamed, FACT_TABLE).select(*cols)) == \
        rows(read_layer(spark, batch, FACT_TABLE).select(*cols))


def test_run_rejects_unknown_step(spark, tmp_table):
    with pytest.raises(ValueError):
        run(spark, tmp_table("x"), "*", only="no_such_model")
