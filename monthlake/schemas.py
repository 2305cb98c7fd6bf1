"""Table contracts of every layer. Column comments carry the documentation."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw feed headers, the data contract of the published monthly files.
RAW_COLUMNS = (
    "id_terc", "sg_orgao_sup_tabela_ug", "cd_ug_gestora", "nm_ug_tabela_ug", "sg_ug_gestora",
    "nr_contrato", "nr_cnpj", "nm_razao_social", "nr_cpf", "nm_terceirizado",
    "nm_categoria_profissional", "nm_escolaridade", "nr_jornada", "nm_unidade_prestacao",
    "vl_mensal_salario", "vl_mensal_custo", "num_mes_carga", "mes_carga", "ano_carga",
    "sg_orgao", "nm_orgao", "cd_orgao_siafi", "cd_orgao_siape",
)

RAW = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])


def _f(name, dtype, comment):
    return T.StructField(name, dtype, True, {"comment": comment})


_S, _I, _M = T.StringType(), T.IntegerType(), T.DecimalType(18, 2)

BRONZE = T.StructType([
    _f("id_terceirizado", _I, "worker id"),
    _f("orgao_superior_sigla", _S, "parent agency acronym"),
    _f("unidade_gestora_codigo", _I, "managing unit code"),
    _f("unidade_gestora_nome", _S, "managing unit name"),
    _f("unidade_gestora_sigla", _S, "managing unit acronym"),
    _f("numero_contrato", _S, "contract number"),
    _f("cnpj", _S, "company tax id (text, leading zeros kept)"),
    _f("razao_social", _S, "company legal name"),
    _f("cpf", _S, "worker tax id, pre-masked"),
    _f("terceirizado_nome", _S, "worker name"),
    _f("id_categoria_profissional", _I, "job category code"),
    _f("escolaridade", _S, "schooling level"),
    _f("jornada_horas", _S, "weekly hours"),
    _f("unidade_prestacao", _S, "unit where the service is provided"),
    _f("salario_mensal_valor", _M, "monthly salary"),
    _f("custo_mensal_valor", _M, "monthly cost"),
    _f("mes_numero", _I, "month number"),
    _f("mes_nome", _S, "month name"),
    _f("ano", _I, "year"),
    _f("orgao_sigla", _S, "agency acronym"),
    _f("orgao_nome", _S, "agency name"),
    _f("orgao_codigo_siafi", _I, "agency code (SIAFI)"),
    _f("orgao_codigo_siape", _I, "agency code (SIAPE)"),
    _f("categoria_profissional_nome", _S, "job category name"),
    _f("data_processamento", T.TimestampType(), "processing time, one value per run"),
])

# Column lists of the silver/gold tables (types follow from the plans).
DIM_CATEGORY = ("id_categoria_profissional", "categoria_profissional_nome")
DIM_CONTRACT = ("numero_contrato", "id_contrato")
DIM_AGENCY = ("orgao_nome", "orgao_sigla", "orgao_codigo_siafi", "orgao_codigo_siape",
              "id_orgao", "id_orgao_superior")
DIM_PARENT_AGENCY = ("orgao_superior_sigla", "unidade_gestora_codigo", "unidade_gestora_nome",
                     "id_orgao_superior")
DIM_PERIOD = ("id_tempo", "mes_numero", "mes_nome", "ano")
DIM_WORKER = ("id_terceirizado", "cpf", "cnpj", "terceirizado_nome", "razao_social",
              "id_categoria_profissional", "escolaridade")
FACT = ("id_terceirizado", "id_tempo", "salario_mensal_valor", "custo_mensal_valor",
        "data_processamento", "id_contrato", "id_orgao", "id_orgao_superior", "id_fato")
MART = ("id_terceirizado", "cnpj", "cpf", "orgao_superior_sigla")


# Column descriptions of the silver and gold tables (carried as column metadata).
COMMENTS = {
    "id_categoria_profissional": "job category code",
    "categoria_profissional_nome": "job category name",
    "numero_contrato": "contract number",
    "id_contrato": "contract key (md5 of the contract number)",
    "orgao_nome": "agency name",
    "orgao_sigla": "agency acronym",
    "orgao_codigo_siafi": "agency code (SIAFI)",
    "orgao_codigo_siape": "agency code (SIAPE)",
    "id_orgao": "agency key (md5 of name, acronym)",
    "id_orgao_superior": "parent agency key (md5 of managing unit name, code)",
    "orgao_superior_sigla": "parent agency acronym",
    "unidade_gestora_codigo": "managing unit code",
    "unidade_gestora_nome": "managing unit name",
    "id_tempo": "period key yyyymm",
    "mes_numero": "month number",
    "mes_nome": "month name",
    "ano": "year",
    "id_terceirizado": "worker id",
    "cpf": "worker tax id, pre-masked",
    "cnpj": "company tax id",
    "terceirizado_nome": "worker name",
    "razao_social": "company legal name",
    "escolaridade": "schooling level",
    "salario_mensal_valor": "monthly salary",
    "custo_mensal_valor": "monthly cost",
    "data_processamento": "processing time, one value per run",
    "id_fato": "fact key (md5 of worker, contract, agency, period)",
}


COMMENTS = {f.name: f.metadata["comment"] for f in BRONZE.fields} | COMMENTS | {"ref_tempo": "month that decided the row"}

# Table descriptions, set when a table is registered.
TABLE_COMMENTS = {
    "brutos_terceirizados": "typed raw rows, one per published line",
    "dim_categoria_profissional": "job categories",
    "dim_contratos": "contracts",
    "dim_orgaos": "agencies with their parent agency",
    "dim_orgaos_superiores": "parent agencies and managing units",
    "dim_periodo": "calendar of months",
    "dim_terceirizados": "workers, newest known attributes",
    "fact_contratos_terceirizados": "one row per worker, contract, agency and month",
    "app_terceirizados": "workers of the newest month, one row each",
}


def describe(df):
    """Attach the column descriptions as metadata (kept in the written Parquet schema)."""
    from pyspark.sql import functions as F
    return df.select([F.col(c).alias(c, metadata={"comment": COMMENTS[c]}) if c in COMMENTS else F.col(c)
                      for c in df.columns])
