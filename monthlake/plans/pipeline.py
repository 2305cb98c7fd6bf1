"""One warehouse run: raw period files -> bronze -> silver dims + fact -> gold mart.

Layout under ``base``: ``raw/periodo=YYYY-MM/`` (all-text), ``bronze/``, ``silver/<table>/``,
``gold/app_terceirizados/``. Every layer is written before the next one reads it, through the
one commit mechanism of ``operators.upsert``. The fact is partitioned by ``id_tempo``; its
watermark and the mart's month come from its commit log. Gold is written in page order.

One rule decides between loads: of a dimension's row the newest month wins, and a month that is
loaded again replaces what it gave before. A load always holds whole months, so the tables do
not depend on the order in which months arrive.
"""

from __future__ import annotations

import datetime as _dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake import schemas
from monthlake.functions.periods import current_period, normalize_period
from monthlake.operators.bucketed import upsert_bucketed
from monthlake.operators.serve import write_serving
from monthlake.operators.upsert import current, read_commit, read_current, upsert_table, write_version
from monthlake.plans.dims import COLUMNS as DIM_COLUMNS
from monthlake.plans.dims import MONTH_COL, dim_period, dim_source
from monthlake.plans.fact import FACT_KEY, fact_to_write, incremental_slice, newest_month
from monthlake.plans.mart import build_mart
from monthlake.plans.staging import run_timestamp, stage
from monthlake.sources.ingest import read_periods

FACT_TABLE = "fact_contratos_terceirizados"
MART_TABLE = "app_terceirizados"
STEPS = ("bronze", *sorted(DIM_COLUMNS), "dim_periodo", FACT_TABLE, MART_TABLE)


def paths(base: str, raw: str | None = None) -> dict[str, str]:
    p = {"raw": raw or f"{base}/raw", "bronze": f"{base}/bronze/brutos_terceirizados"}
    for t in (*DIM_COLUMNS, "dim_periodo", FACT_TABLE):
        p[t] = f"{base}/silver/{t}"
    p[MART_TABLE] = f"{base}/gold/{MART_TABLE}"
    return p


def load_silver_gold(spark: SparkSession, base: str, bronze: DataFrame, only: str | None = None,
                     backfill: bool = False) -> None:
    """Dimensions (SCD-1 upsert), calendar, fact (watermarked upsert) and mart from a bronze batch."""
    p = paths(base)

    def upsert_dim(name: str) -> None:
        src, key, _ = dim_source(bronze, name)
        upsert_bucketed(spark, p[name], schemas.describe(src), key, [*DIM_COLUMNS[name], MONTH_COL], rank=MONTH_COL)

    def load_fact() -> None:
        newest = newest_month(current(spark, p[FACT_TABLE]))
        src = schemas.describe(incremental_slice(fact_to_write(bronze), newest, backfill=backfill))
        upsert_table(spark, p[FACT_TABLE], src, list(FACT_KEY), None, columns=schemas.FACT, partition="id_tempo", clustered=True)

    # Dimensions, calendar and fact all read only bronze: they are independent jobs and
    # are submitted side by side; the mart waits for all of them.
    steps = [(lambda n=n: upsert_dim(n)) for n in sorted(DIM_COLUMNS) if only in (None, n)]
    if only in (None, "dim_periodo"):
        steps.append(lambda: write_version(schemas.describe(dim_period(spark)), p["dim_periodo"]))
    if only in (None, FACT_TABLE):
        steps.append(load_fact)
    with ThreadPoolExecutor(max_workers=max(1, len(steps))) as pool:
        for f in [pool.submit(step) for step in steps]:
            f.result()
    if only in (None, MART_TABLE):
        commit = current(spark, p[FACT_TABLE])
        newest = newest_month(commit)
        if newest is None:
            raise ValueError("the fact holds no month yet")
        mart = build_mart(read_commit(spark, p[FACT_TABLE], commit, [str(newest)]), read_layer(spark, base, "dim_terceirizados"),
                          read_layer(spark, base, "dim_orgaos_superiores"), newest)
        write_serving(schemas.describe(mart), p[MART_TABLE], "id_terceirizado")


def run(spark: SparkSession, base: str, period: str | None = None, only: str | None = None,
        run_ts: _dt.datetime | None = None, backfill: bool = False, raw: str | None = None) -> DataFrame:
    """Run every layer for one period (``'YYYY-MM'``; default: the current month) or all
    (``'*'``); ``only`` runs one step (``STEPS``) from the layers already written; ``raw``
    overrides where the raw period files live (default ``<base>/raw``). A period that has not
    landed is an error. Returns the gold mart."""
    if only is not None and only not in STEPS:
        raise ValueError(f"unknown step {only!r}; one of {STEPS}")
    p = paths(base, raw)
    if only in (None, "bronze"):
        wanted = "*" if period == "*" else one_period(spark, period)
        raw = read_periods(spark, p["raw"], schema=schemas.RAW, period=wanted)
        write_version(schemas.describe(stage(raw, run_ts or run_timestamp())), p["bronze"])
    if only != "bronze":
        load_silver_gold(spark, base, read_current(spark, p["bronze"]), only=only, backfill=backfill)
    return read_current(spark, p[MART_TABLE])


def one_period(spark: SparkSession, period: str | None) -> str:
    """A period as ``YYYY-MM`` (an error for anything else); None is the current month."""
    value = current_period() if period is None else normalize_period(F.lit(period))
    out = spark.range(1).select(value).first()[0]
    if out is None:
        raise ValueError(f"not a period: {period!r}")
    return out


def read_layer(spark: SparkSession, base: str, table: str) -> DataFrame | None:
    """A silver or gold table with its contract columns."""
    df = read_current(spark, paths(base)[table])
    return df.drop(MONTH_COL) if df is not None and table in DIM_COLUMNS else df
