"""Silver fact: one row per worker x contract x agency x month (``id_fato``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.functions.keys import period_key, surrogate_key
from monthlake.functions.packed import pack, unpack
from monthlake.operators.dedup import latest_per_key
from monthlake.operators.upsert import Commit

FACT_KEY = ("id_tempo", "id_fato")  # the month is part of the hashed key and spares a merge the other months
# Several bronze rows can share a grain; keep the highest salary, then cost, then the
# smallest parent-agency key — together these decide every remaining column.
def fact_order() -> list:
    return [F.col("salario_mensal_valor").desc_nulls_last(),
            F.col("custo_mensal_valor").desc_nulls_last(),
            F.col("id_orgao_superior").asc_nulls_last()]


# The columns behind ``id_fato``: both its md5 parts and the key itself are injective in them.
GRAIN = ("id_tempo", "id_terceirizado", "numero_contrato", "orgao_nome", "orgao_sigla")
PARENT = ("unidade_gestora_nome", "unidade_gestora_codigo")


def grain_rows(bronze: DataFrame) -> DataFrame:
    """Bronze -> the fact's natural columns, one row per bronze row, nothing hashed yet."""
    cols = ["id_terceirizado", period_key("ano", "mes_numero").alias("id_tempo"),
            "salario_mensal_valor", "custo_mensal_valor"]
    if "data_processamento" in bronze.columns:
        cols.append("data_processamento")
    return bronze.select(*cols, "numero_contrato", "orgao_nome", "orgao_sigla", "unidade_gestora_nome",
                         "unidade_gestora_codigo")


def grain_order() -> list:
    """``fact_order`` before hashing: the parent agency's key is needed for its ties."""
    return [F.col("salario_mensal_valor").desc_nulls_last(), F.col("custo_mensal_valor").desc_nulls_last(),
            surrogate_key(*PARENT).asc_nulls_last()]


def with_keys(grain: DataFrame) -> DataFrame:
    """Replace the natural columns by their surrogate keys (the parent agency's may be there already)."""
    if "id_orgao_superior" not in grain.columns:
        grain = grain.withColumn("id_orgao_superior", surrogate_key(*PARENT))
    out = grain.select(
        *[c for c in grain.columns if c in ("id_terceirizado", "id_tempo", "salario_mensal_valor",
                                            "custo_mensal_valor", "data_processamento")],
        surrogate_key("numero_contrato").alias("id_contrato"),
        surrogate_key("orgao_nome", "orgao_sigla").alias("id_orgao"),
        "id_orgao_superior")
    return out.withColumn("id_fato", surrogate_key("id_terceirizado", "id_contrato", "id_orgao", "id_tempo"))


def fact_rows(bronze: DataFrame) -> DataFrame:
    """Bronze -> fact columns with surrogate keys (not yet one row per grain)."""
    return with_keys(grain_rows(bronze))


def _as_text(rows: DataFrame, names: Sequence[str], text: str) -> DataFrame:
    """The columns ``names`` as one text, which is what a shuffle moves in the fewest bytes."""
    return rows.withColumn(text, pack(*[F.col(c).cast("string") for c in names])).drop(*names)


def _as_columns(rows: DataFrame, names: Sequence[str], text: str, like: DataFrame) -> DataFrame:
    types = dict(like.dtypes)
    return rows.withColumns({c: t.cast(types[c]) for c, t in zip(names, unpack(text, len(names)), strict=True)}).drop(text)


# Agencies come first in the grain's text, so a file in its order holds each agency's key in a run.
GRAIN_TEXT = GRAIN[3:] + GRAIN[1:3]


def build_fact(bronze: DataFrame) -> DataFrame:
    """Full build: one row per grain, then the keys of the survivors only. The parent agency's key
    decides ties, so it is made before and its texts stay behind."""
    natural = grain_rows(bronze)
    rows = natural.withColumn("id_orgao_superior", surrogate_key(*PARENT)).drop(*PARENT)
    one = latest_per_key(_as_text(rows, GRAIN_TEXT, "grain"), ("id_tempo", "grain"), fact_order())
    return with_keys(_as_columns(one, GRAIN_TEXT, "grain", natural).select(*rows.columns))


def fact_to_write(bronze: DataFrame) -> DataFrame:
    """``build_fact`` in ranges of months, for a table with one directory per month.

    The ranges are cut by the grain, so one shuffle of the natural columns both brings the rows of
    a grain together and lays the table out; the keys, three times as wide, are made after it. The
    rows of one grain meet in one task, where they stream past its first row."""
    natural = grain_rows(bronze)
    rows = _as_text(_as_text(natural, GRAIN_TEXT, "grain"), PARENT, "parent").repartitionByRange("id_tempo", "grain")
    rows = _as_columns(rows, PARENT, "parent", natural)
    one = latest_per_key(rows, ("id_tempo", "grain"), grain_order())
    return with_keys(_as_columns(one, GRAIN_TEXT, "grain", natural).select(*natural.columns))


def incremental_slice(fact_src: DataFrame, newest: int | None, backfill: bool = False) -> DataFrame:
    """High-watermark filter: keep source months ``>=`` the newest month already loaded
    (``newest``, from the target's commit log: no data file is opened for it).

    Months older than the watermark are dropped unless ``backfill``. A target without a
    month has no watermark and loads everything."""
    if newest is None or backfill:
        return fact_src
    return fact_src.where(F.col("id_tempo") >= F.lit(newest))


def newest_month(commit: Commit | None) -> int | None:
    """The newest month of a committed fact, or None."""
    months = [int(v) for v in commit.values if v.lstrip("-").isdigit()] if commit else []
    return max(months, default=None)
