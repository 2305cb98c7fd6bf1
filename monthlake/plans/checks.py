"""The warehouse's 41 declared checks (tables named as in the model layer)."""

from __future__ import annotations

from monthlake.operators.quality import Check

BRONZE = "brutos_terceirizados"
FACT = "fact_contratos_terceirizados"
MART = "app_terceirizados"


def _nn(table, *cols):
    return [Check(table, "not_null", (c,)) for c in cols]


WAREHOUSE_CHECKS: list[Check] = [
    Check(BRONZE, "unique_combination", ("id_terceirizado", "mes_numero", "ano")),
    *_nn(BRONZE, "id_terceirizado", "unidade_gestora_codigo", "cnpj", "cpf",
         "id_categoria_profissional", "mes_numero", "ano"),
    *_nn("dim_categoria_profissional", "id_categoria_profissional", "categoria_profissional_nome"),
    Check("dim_categoria_profissional", "unique", ("id_categoria_profissional",)),
    Check("dim_contratos", "unique", ("id_contrato",)),
    *_nn("dim_contratos", "id_contrato", "numero_contrato"),
    Check("dim_orgaos", "unique", ("id_orgao",)),
    *_nn("dim_orgaos", "id_orgao", "id_orgao_superior", "orgao_nome"),
    Check("dim_orgaos", "relationships", ("id_orgao_superior",), "dim_orgaos_superiores", "id_orgao_superior"),
    Check("dim_orgaos_superiores", "unique", ("id_orgao_superior",)),
    *_nn("dim_orgaos_superiores", "id_orgao_superior", "unidade_gestora_codigo", "unidade_gestora_nome"),
    Check("dim_periodo", "unique_combination", ("mes_numero", "ano")),
    *_nn("dim_periodo", "id_tempo", "mes_numero", "ano"),
    Check("dim_periodo", "unique", ("id_tempo",)),
    *_nn("dim_terceirizados", "id_terceirizado", "cpf", "cnpj", "id_categoria_profissional"),
    Check("dim_terceirizados", "unique", ("id_terceirizado",)),
    Check(FACT, "unique_combination", ("id_terceirizado", "id_contrato", "id_orgao", "id_tempo")),
    *_nn(FACT, "id_fato", "id_terceirizado", "id_tempo"),
    Check(FACT, "unique", ("id_fato",)),
    *_nn(MART, "id_terceirizado", "cnpj", "cpf"),
]

assert len(WAREHOUSE_CHECKS) == 41, len(WAREHOUSE_CHECKS)
