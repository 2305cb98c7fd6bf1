"""Bronze: rename and type the 23 raw text columns into the 25-column bronze table."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.functions.casts import split_code_name, to_int, to_money


def run_timestamp() -> _dt.datetime:
    """One processing time per run, taken once on the driver (a literal in every plan)."""
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)


def stage(raw: DataFrame, run_ts: _dt.datetime | None = None, with_timestamp: bool = True,
          decimal_comma: bool = False) -> DataFrame:
    """Typed bronze rows from raw text. Column names are resolved case-insensitively.

    Integers use the tolerant cast (``'123.0'`` ok, garbage fails the job under ANSI),
    money is decimal(18,2); ``nm_categoria_profissional`` is split into code and name.
    """
    c = F.col
    code, name = split_code_name(c("nm_categoria_profissional"))
    cols = [
        to_int(c("id_terc")).alias("id_terceirizado"),
        c("sg_orgao_sup_tabela_ug").alias("orgao_superior_sigla"),
        to_int(c("cd_ug_gestora")).alias("unidade_gestora_codigo"),
        c("nm_ug_tabela_ug").alias("unidade_gestora_nome"),
        c("sg_ug_gestora").alias("unidade_gestora_sigla"),
        c("nr_contrato").alias("numero_contrato"),
        c("nr_cnpj").cast("string").alias("cnpj"),
        c("nm_razao_social").alias("razao_social"),
        c("nr_cpf").cast("string").alias("cpf"),
        c("nm_terceirizado").alias("terceirizado_nome"),
        code.alias("id_categoria_profissional"),
        c("nm_escolaridade").alias("escolaridade"),
        c("nr_jornada").cast("string").alias("jornada_horas"),
        c("nm_unidade_prestacao").alias("unidade_prestacao"),
        to_money(c("vl_mensal_salario"), decimal_comma).alias("salario_mensal_valor"),
        to_money(c("vl_mensal_custo"), decimal_comma).alias("custo_mensal_valor"),
        to_int(c("num_mes_carga")).alias("mes_numero"),
        c("mes_carga").alias("mes_nome"),
        to_int(c("ano_carga")).alias("ano"),
        c("sg_orgao").alias("orgao_sigla"),
        c("nm_orgao").alias("orgao_nome"),
        to_int(c("cd_orgao_siafi")).alias("orgao_codigo_siafi"),
        to_int(c("cd_orgao_siape")).alias("orgao_codigo_siape"),
        name.alias("categoria_profissional_nome"),
    ]
    if with_timestamp:
        ts = run_ts or run_timestamp()
        cols.append(F.lit(ts).cast("timestamp").alias("data_processamento"))
    return raw.select(*cols)
