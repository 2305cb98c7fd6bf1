"""Gold mart: workers of the newest month, one row each, with parent-agency acronym."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.operators.dedup import latest_per_key


def latest_period(fact: DataFrame, newest: int | None = None) -> DataFrame:
    """Fact rows of the newest ``id_tempo``. A table knows its months from its commit log:
    given the newest one, only that partition is opened. Without it a scalar subquery finds it."""
    if newest is None:
        return fact.where(F.col("id_tempo") == fact.select(F.max("id_tempo")).scalar())
    return fact.where(F.col("id_tempo") == F.lit(newest))


def build_mart(fact: DataFrame, dim_worker: DataFrame, dim_parent_agency: DataFrame,
               newest: int | None = None) -> DataFrame:
    """Newest-month workers with cnpj, cpf and parent agency; one row per worker.

    Ties (a worker under several parent agencies in the month) go to the smallest
    acronym, then smallest ``id_fato``. The per-worker top-1 runs on the fact side
    *before* the worker join (the worker dimension is one row per id, so cnpj/cpf are
    constant per worker): a worker holding a large share of the month is reduced
    map-side instead of landing in one task. The planner picks both joins by size.
    """
    f = latest_period(fact, newest).select("id_terceirizado", "id_tempo", "id_orgao_superior", "id_fato")
    parent = dim_parent_agency.select("id_orgao_superior", "orgao_superior_sigla")
    ranked = latest_per_key(
        f.join(parent, "id_orgao_superior"),
        ["id_terceirizado"],
        [F.col("id_tempo").desc_nulls_last(), "orgao_superior_sigla", "id_fato"],
    )
    worker = dim_worker.select("id_terceirizado", "cnpj", "cpf")
    return ranked.join(worker, "id_terceirizado").select(
        "id_terceirizado", "cnpj", "cpf", "orgao_superior_sigla")
