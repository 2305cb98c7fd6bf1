"""Silver dimensions built from bronze.

Bronze may hold several rows per dimension key (one per month and more); each build
keeps one row per key: the latest month wins, remaining ties go to the smallest
attribute values (NULLs last), so results never depend on row order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake import schemas
from monthlake.functions.keys import period_key, surrogate_key
from monthlake.operators.dedup import latest_per_key

MONTH_COL = "ref_tempo"  # stored beside a dimension's columns: the month that decided the row


def latest_first() -> list:
    """Newest month first."""
    return [F.col(MONTH_COL).desc_nulls_last()]


AGENCY = ("orgao_nome", "orgao_sigla")
PARENT = ("unidade_gestora_nome", "unidade_gestora_codigo")


@dataclass(frozen=True)
class Dimension:
    """How a dimension is cut from bronze: its natural key, the other columns in tie-break order,
    and the surrogate keys that are added once one row per key is left."""

    key: tuple[str, ...]
    attributes: tuple[str, ...] = ()
    hashed: tuple[tuple[str, tuple[str, ...]], ...] = ()

    @property
    def table_key(self) -> str:
        return self.hashed[0][0] if self.hashed else self.key[0]


# A surrogate key is injective in its columns, so dedup on these and hash the survivors.
DIMENSIONS = {
    "dim_categoria_profissional": Dimension(("id_categoria_profissional",), ("categoria_profissional_nome",)),
    "dim_contratos": Dimension(("numero_contrato",), (), (("id_contrato", ("numero_contrato",)),)),
    "dim_orgaos": Dimension(AGENCY, ("orgao_codigo_siafi", "orgao_codigo_siape", *PARENT),
                            (("id_orgao", AGENCY), ("id_orgao_superior", PARENT))),
    "dim_orgaos_superiores": Dimension(PARENT, ("orgao_superior_sigla",), (("id_orgao_superior", PARENT),)),
    "dim_terceirizados": Dimension(("id_terceirizado",), ("cpf", "cnpj", "terceirizado_nome", "razao_social",
                                                          "id_categoria_profissional", "escolaridade")),
}


def dim_source(bronze: DataFrame, name: str) -> tuple[DataFrame, str, list]:
    """(one row per key with its deciding month, key, order) for an upsert."""
    d = DIMENSIONS[name]
    rows = bronze.select(*d.key, *d.attributes, period_key("ano", "mes_numero").alias(MONTH_COL))
    ties: list = [c for c in d.attributes if c not in PARENT]
    if name == "dim_orgaos":  # its last tie-break is the parent agency's key
        ties.append(surrogate_key(*PARENT).asc_nulls_last())
    one = latest_per_key(rows, d.key, [*latest_first(), *ties])
    for column, parts in d.hashed:
        one = one.withColumn(column, surrogate_key(*parts))
    return one, d.table_key, [*latest_first(), *[c for c in one.columns if c not in (d.table_key, MONTH_COL)]]


def build_dim(bronze: DataFrame, name: str) -> DataFrame:
    """One row per key: the newest month wins, ties go to the smallest attributes."""
    return dim_source(bronze, name)[0].select(*COLUMNS[name])


COLUMNS = {
    "dim_categoria_profissional": schemas.DIM_CATEGORY,
    "dim_contratos": schemas.DIM_CONTRACT,
    "dim_orgaos": schemas.DIM_AGENCY,
    "dim_orgaos_superiores": schemas.DIM_PARENT_AGENCY,
    "dim_terceirizados": schemas.DIM_WORKER,
}


def dim_period(spark: SparkSession, start: str = "2020-01-01", end: str = "2030-12-01") -> DataFrame:
    """Monthly calendar, both ends inclusive (default 2020-01 .. 2030-12 = 132 rows)."""
    cal = spark.range(1).select(F.explode(F.sequence(
        F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("INTERVAL 1 MONTH"))).alias("d"))
    return calendar_columns(cal, "d")


def calendar_columns(cal: DataFrame, date_col: str) -> DataFrame:
    d = F.col(date_col)
    return cal.select(
        period_key(F.year(d), F.month(d)).alias("id_tempo"),
        F.month(d).cast("bigint").alias("mes_numero"),
        F.date_format(d, "MMMM").alias("mes_nome"),
        F.year(d).cast("bigint").alias("ano"),
    )


def dim_period_span(spark: SparkSession, months: DataFrame, col: str = "id_tempo") -> DataFrame:
    """Calendar spanning the months found in ``months`` (first to last, gaps filled).

    Only the two bounds leave the scan (one aggregate row); the calendar is then
    generated by ``sequence``."""
    b = months.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    def first_day(k: str):
        return F.make_date((F.col(k) / 100).cast("int"), F.col(k) % 100, F.lit(1))

    cal = b.select(F.explode(F.sequence(first_day("lo"), first_day("hi"), F.expr("INTERVAL 1 MONTH"))).alias("d"))
    return calendar_columns(cal, "d")
