"""Registered queries go red when their operator does nothing."""

import sys

import duckdb
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

sys.path.insert(0, "tools")
from check_oracle import TABLES, digest  # noqa: E402

from monthlake import queries as Q  # noqa: E402


def matches(spark, name) -> bool:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = Q.QUERIES[name](spark, SF_SMALL)
    res = con.execute(Q.ORACLE[name])
    return digest(df.columns, [tuple(r) for r in df.collect()]) == digest([d[0] for d in res.description], res.fetchall())


BROKEN = {
    "month_completeness": (Q.MC, "month_parts", lambda receipts: receipts.groupBy("periodo").agg(
        F.max("parts").alias("parts")).withColumn("complete", F.lit(True))),
    "write_if_absent": (Q.I, "write_if_absent", lambda df, path: df.write.mode("overwrite").parquet(path)),
    "latest_period_filter": (Q, "latest_period", lambda fact, newest=None: fact),
    "table_descriptions": (Q.S, "describe", lambda df: df),
    "dq_not_null_written": (Q.Q, "observed_not_null", lambda spark, seen, cols: spark.createDataFrame(
        [(c, 0) for c in cols], "column_name string, failures bigint")),
    "upsert_scd1": (Q, "upsert_bucketed", lambda spark, path, src, key, columns, rank: src.select(*columns)),
    "page_envelope": (Q.SV, "serving_envelope", lambda spark, path, b, n: Q.SV.envelope(spark.range(3), b, n)),
    "fact_incremental": (Q, "incremental_slice", lambda src, newest, backfill=False: src),
    "null_tokens": (Q.I, "null_tokens", lambda df, *a, **k: df),
    "raw_ingest_text": (Q.I, "null_tokens", lambda df, *a, **k: df),
    "dq_relationships": (Q.Q, "check_relationship", lambda child, *a, **k: child.limit(0)),
    "dq_not_null": (Q.Q, "check_not_null", lambda df, cols: df.select(
        F.explode(F.array(*[F.lit(c) for c in cols])).alias("column_name"), F.lit(0).alias("failures")).distinct()),
    "catalog_candidates": (Q.CAT, "candidates", lambda links, *a, **k: links.select("href").distinct()),
    "skip_existing_periods": (Q.I, "skip_existing", lambda incoming, *a, **k: incoming),
    "manifest_scan": (Q.MAN, "select_layers", lambda m, *a, **k: m.withColumn("layer", F.lit("raw"))),
}


@pytest.mark.parametrize("name", sorted(BROKEN))
def test_entry_goes_red(spark, monkeypatch, name):
    module, function, nothing = BROKEN[name]
    monkeypatch.setattr(module, function, nothing)
    assert not matches(spark, name)
