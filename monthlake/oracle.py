"""DuckDB SQL for every registered query (the correctness oracle).

The SQL is written independently of the Spark plans, over the same driver tables.
Surrogate keys use the same md5-of-length-prefixed-parts rule as ``surrogate_key``.
"""

from __future__ import annotations


def k(expr: str) -> str:
    v = f"CAST({expr} AS VARCHAR)"
    return f"coalesce(CAST(length({v}) AS VARCHAR) || ':' || {v}, 'N')"


def key(*exprs: str) -> str:
    return "md5(" + " || ".join(k(e) for e in exprs) + ")"


FEED = """feed AS (
  SELECT
    CAST(c.c_custkey AS VARCHAR) AS id_terc,
    r.r_name AS sg_orgao_sup_tabela_ug,
    CAST(n.n_nationkey AS VARCHAR) AS cd_ug_gestora,
    n.n_name AS nm_ug_tabela_ug,
    'UG' || CAST(n.n_nationkey AS VARCHAR) AS sg_ug_gestora,
    'CT' || CAST(o.o_orderkey AS VARCHAR) AS nr_contrato,
    lpad(CAST(l.l_suppkey AS VARCHAR), 14, '0') AS nr_cnpj,
    s.s_name AS nm_razao_social,
    '***.' || lpad(CAST(c.c_custkey % 1000 AS VARCHAR), 3, '0') || '.***-**' AS nr_cpf,
    c.c_name AS nm_terceirizado,
    CAST(p.p_size AS VARCHAR) || ' - ' || p.p_type AS nm_categoria_profissional,
    c.c_mktsegment AS nm_escolaridade,
    CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) AS nr_jornada,
    o.o_orderpriority AS nm_unidade_prestacao,
    CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS vl_mensal_salario,
    CAST(CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) + CAST(l.l_quantity AS DECIMAL(18,2))
         AS DECIMAL(18,2)) AS VARCHAR) AS vl_mensal_custo,
    CAST(month(l.l_shipdate) AS VARCHAR) AS num_mes_carga,
    lower(strftime(l.l_shipdate, '%B')) AS mes_carga,
    CAST(year(l.l_shipdate) AS VARCHAR) AS ano_carga,
    'S' || CAST(s.s_suppkey AS VARCHAR) AS sg_orgao,
    s.s_name AS nm_orgao,
    CAST(s.s_suppkey AS VARCHAR) AS cd_orgao_siafi,
    CAST(s.s_suppkey + 100000 AS VARCHAR) AS cd_orgao_siape,
    strftime(l.l_shipdate, '%Y-%m') AS periodo
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

BRONZE_COLS = """
    CAST(id_terc AS INTEGER) AS id_terceirizado,
    sg_orgao_sup_tabela_ug AS orgao_superior_sigla,
    CAST(cd_ug_gestora AS INTEGER) AS unidade_gestora_codigo,
    nm_ug_tabela_ug AS unidade_gestora_nome,
    sg_ug_gestora AS unidade_gestora_sigla,
    nr_contrato AS numero_contrato,
    CAST(nr_cnpj AS VARCHAR) AS cnpj,
    nm_razao_social AS razao_social,
    CAST(nr_cpf AS VARCHAR) AS cpf,
    nm_terceirizado AS terceirizado_nome,
    CAST(split_part(nm_categoria_profissional, ' - ', 1) AS INTEGER) AS id_categoria_profissional,
    nm_escolaridade AS escolaridade,
    CAST(nr_jornada AS VARCHAR) AS jornada_horas,
    nm_unidade_prestacao AS unidade_prestacao,
    CAST(vl_mensal_salario AS DECIMAL(18,2)) AS salario_mensal_valor,
    CAST(vl_mensal_custo AS DECIMAL(18,2)) AS custo_mensal_valor,
    CAST(num_mes_carga AS INTEGER) AS mes_numero,
    mes_carga AS mes_nome,
    CAST(ano_carga AS INTEGER) AS ano,
    sg_orgao AS orgao_sigla,
    nm_orgao AS orgao_nome,
    CAST(cd_orgao_siafi AS INTEGER) AS orgao_codigo_siafi,
    CAST(cd_orgao_siape AS INTEGER) AS orgao_codigo_siape,
    trim(split_part(nm_categoria_profissional, ' - ', 2)) AS categoria_profissional_nome"""

BRONZE = f"bronze AS (SELECT {BRONZE_COLS} FROM feed)"

FACT = f"""fact_src AS (
  SELECT id_terceirizado, CAST(ano * 100 + mes_numero AS INTEGER) AS id_tempo,
         salario_mensal_valor, custo_mensal_valor,
         {key('numero_contrato')} AS id_contrato,
         {key('orgao_nome', 'orgao_sigla')} AS id_orgao,
         {key('unidade_gestora_nome', 'unidade_gestora_codigo')} AS id_orgao_superior
  FROM bronze
), fact_keyed AS (
  SELECT *, {key('id_terceirizado', 'id_contrato', 'id_orgao', 'id_tempo')} AS id_fato FROM fact_src
), fact AS (
  SELECT id_terceirizado, id_tempo, salario_mensal_valor, custo_mensal_valor,
         id_contrato, id_orgao, id_orgao_superior, id_fato
  FROM (SELECT *, row_number() OVER (PARTITION BY id_fato ORDER BY salario_mensal_valor DESC NULLS LAST,
               custo_mensal_valor DESC NULLS LAST, id_orgao_superior ASC NULLS LAST) AS rn
        FROM fact_keyed) WHERE rn = 1
)"""


def _dim(name: str, exprs: list[str], cols: list[str], key_col: str, attrs: list[str],
         source: str = "bronze") -> str:
    order = ", ".join(["ano DESC NULLS LAST", "mes_numero DESC NULLS LAST"]
                      + [f"{a} ASC NULLS LAST" for a in attrs])
    return f"""{name} AS (
  SELECT {', '.join(cols)} FROM (
    SELECT *, row_number() OVER (PARTITION BY {key_col} ORDER BY {order}) AS rn
    FROM (SELECT {', '.join(exprs)}, ano, mes_numero FROM {source})) WHERE rn = 1
)"""


_ID_CONTRATO = f"{key('numero_contrato')} AS id_contrato"
_ID_ORGAO = f"{key('orgao_nome', 'orgao_sigla')} AS id_orgao"
_ID_ORGAO_SUP = f"{key('unidade_gestora_nome', 'unidade_gestora_codigo')} AS id_orgao_superior"
_WORKER = ["id_terceirizado", "cpf", "cnpj", "terceirizado_nome", "razao_social",
           "id_categoria_profissional", "escolaridade"]

DIMS = {
    "dim_categoria_profissional": _dim(
        "dim_categoria_profissional",
        ["id_categoria_profissional", "categoria_profissional_nome"],
        ["id_categoria_profissional", "categoria_profissional_nome"],
        "id_categoria_profissional", ["categoria_profissional_nome"]),
    "dim_contratos": _dim(
        "dim_contratos", ["numero_contrato", _ID_CONTRATO], ["numero_contrato", "id_contrato"],
        "id_contrato", ["numero_contrato"]),
    "dim_orgaos": _dim(
        "dim_orgaos",
        ["orgao_nome", "orgao_sigla", "orgao_codigo_siafi", "orgao_codigo_siape", _ID_ORGAO, _ID_ORGAO_SUP],
        ["orgao_nome", "orgao_sigla", "orgao_codigo_siafi", "orgao_codigo_siape", "id_orgao",
         "id_orgao_superior"],
        "id_orgao", ["orgao_nome", "orgao_sigla", "orgao_codigo_siafi", "orgao_codigo_siape",
                     "id_orgao_superior"]),
    "dim_orgaos_superiores": _dim(
        "dim_orgaos_superiores",
        ["orgao_superior_sigla", "unidade_gestora_codigo", "unidade_gestora_nome", _ID_ORGAO_SUP],
        ["orgao_superior_sigla", "unidade_gestora_codigo", "unidade_gestora_nome", "id_orgao_superior"],
        "id_orgao_superior", ["orgao_superior_sigla", "unidade_gestora_codigo", "unidade_gestora_nome"]),
    "dim_terceirizados": _dim(
        "dim_terceirizados", _WORKER, _WORKER, "id_terceirizado", _WORKER[1:]),
}


def worker_dim(name: str, source: str) -> str:
    return _dim(name, _WORKER, _WORKER, "id_terceirizado", _WORKER[1:], source)

MART = """mart AS (
  SELECT id_terceirizado, cnpj, cpf, orgao_superior_sigla FROM (
    SELECT f.id_terceirizado, w.cnpj, w.cpf, p.orgao_superior_sigla,
           row_number() OVER (PARTITION BY f.id_terceirizado
                              ORDER BY f.id_tempo DESC, p.orgao_superior_sigla ASC NULLS LAST,
                                       w.cnpj ASC NULLS LAST, w.cpf ASC NULLS LAST, f.id_fato ASC) AS rn
    FROM fact f
    JOIN (SELECT max(id_tempo) AS m FROM fact) t ON f.id_tempo = t.m
    JOIN dim_terceirizados w ON f.id_terceirizado = w.id_terceirizado
    JOIN dim_orgaos_superiores p ON f.id_orgao_superior = p.id_orgao_superior
  ) WHERE rn = 1
)"""


def with_(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


WAREHOUSE = (FEED, BRONZE, FACT, DIMS["dim_terceirizados"], DIMS["dim_orgaos_superiores"], MART)


DIM_PERIOD_SPAN = """dim_periodo AS (
  SELECT CAST(year(d) * 100 + month(d) AS INTEGER) AS id_tempo, month(d) AS mes_numero,
         strftime(d, '%B') AS mes_nome, year(d) AS ano
  FROM (SELECT unnest(generate_series(make_date(lo // 100, lo % 100, 1), make_date(hi // 100, hi % 100, 1),
                                       INTERVAL 1 MONTH)) AS d
        FROM (SELECT min(ano * 100 + mes_numero) AS lo, max(ano * 100 + mes_numero) AS hi FROM bronze))
)"""

# The declared checks, written out once more: table, kind, columns, parent table, parent column.
SUITE = """
bronze|brutos_terceirizados|unique_combination|id_terceirizado,mes_numero,ano
bronze|brutos_terceirizados|not_null|id_terceirizado
bronze|brutos_terceirizados|not_null|unidade_gestora_codigo
bronze|brutos_terceirizados|not_null|cnpj
bronze|brutos_terceirizados|not_null|cpf
bronze|brutos_terceirizados|not_null|id_categoria_profissional
bronze|brutos_terceirizados|not_null|mes_numero
bronze|brutos_terceirizados|not_null|ano
dim_categoria_profissional|dim_categoria_profissional|not_null|id_categoria_profissional
dim_categoria_profissional|dim_categoria_profissional|not_null|categoria_profissional_nome
dim_categoria_profissional|dim_categoria_profissional|unique|id_categoria_profissional
dim_contratos|dim_contratos|unique|id_contrato
dim_contratos|dim_contratos|not_null|id_contrato
dim_contratos|dim_contratos|not_null|numero_contrato
dim_orgaos|dim_orgaos|unique|id_orgao
dim_orgaos|dim_orgaos|not_null|id_orgao
dim_orgaos|dim_orgaos|not_null|id_orgao_superior
dim_orgaos|dim_orgaos|not_null|orgao_nome
dim_orgaos|dim_orgaos|relationships|id_orgao_superior|dim_orgaos_superiores|id_orgao_superior
dim_orgaos_superiores|dim_orgaos_superiores|unique|id_orgao_superior
dim_orgaos_superiores|dim_orgaos_superiores|not_null|id_orgao_superior
dim_orgaos_superiores|dim_orgaos_superiores|not_null|unidade_gestora_codigo
dim_orgaos_superiores|dim_orgaos_superiores|not_null|unidade_gestora_nome
dim_periodo|dim_periodo|unique_combination|mes_numero,ano
dim_periodo|dim_periodo|not_null|id_tempo
dim_periodo|dim_periodo|not_null|mes_numero
dim_periodo|dim_periodo|not_null|ano
dim_periodo|dim_periodo|unique|id_tempo
dim_terceirizados|dim_terceirizados|not_null|id_terceirizado
dim_terceirizados|dim_terceirizados|not_null|cpf
dim_terceirizados|dim_terceirizados|not_null|cnpj
dim_terceirizados|dim_terceirizados|not_null|id_categoria_profissional
dim_terceirizados|dim_terceirizados|unique|id_terceirizado
fact|fact_contratos_terceirizados|unique_combination|id_terceirizado,id_contrato,id_orgao,id_tempo
fact|fact_contratos_terceirizados|not_null|id_fato
fact|fact_contratos_terceirizados|not_null|id_terceirizado
fact|fact_contratos_terceirizados|not_null|id_tempo
fact|fact_contratos_terceirizados|unique|id_fato
mart|app_terceirizados|not_null|id_terceirizado
mart|app_terceirizados|not_null|cnpj
mart|app_terceirizados|not_null|cpf
"""


def suite_sql() -> str:
    """One SELECT per declared check, UNION ALL (what a test runner compiles them to)."""
    parts = []
    for line in SUITE.split():
        t, name, kind, cols, *parent = line.split("|")
        head = f"SELECT '{name}' AS table_name, '{kind}' AS check_name, '{cols}' AS columns, "
        if kind == "not_null":
            parts.append(head + f"count(*) FILTER (WHERE {cols} IS NULL) AS failures FROM {t}")
        elif kind == "unique":
            parts.append(head + f"count(*) AS failures FROM (SELECT {cols} FROM {t} WHERE {cols} IS NOT NULL "
                                f"GROUP BY {cols} HAVING count(*) > 1)")
        elif kind == "unique_combination":
            parts.append(head + f"count(*) AS failures FROM (SELECT {cols} FROM {t} GROUP BY {cols} HAVING count(*) > 1)")
        else:
            parts.append(head + f"count(*) AS failures FROM {t} c WHERE c.{cols} IS NOT NULL AND NOT EXISTS "
                                f"(SELECT 1 FROM {parent[0]} p WHERE p.{parent[1]} = c.{cols})")
    return "\nUNION ALL\n".join(parts)


# The descriptions of the registered tables' columns.
_DESCRIBED = """
app_terceirizados|cnpj|company tax id
app_terceirizados|cpf|worker tax id, pre-masked
app_terceirizados|id_terceirizado|worker id
app_terceirizados|orgao_superior_sigla|parent agency acronym
brutos_terceirizados|ano|year
brutos_terceirizados|categoria_profissional_nome|job category name
brutos_terceirizados|cnpj|company tax id
brutos_terceirizados|cpf|worker tax id, pre-masked
brutos_terceirizados|custo_mensal_valor|monthly cost
brutos_terceirizados|data_processamento|processing time, one value per run
brutos_terceirizados|escolaridade|schooling level
brutos_terceirizados|id_categoria_profissional|job category code
brutos_terceirizados|id_terceirizado|worker id
brutos_terceirizados|jornada_horas|weekly hours
brutos_terceirizados|mes_nome|month name
brutos_terceirizados|mes_numero|month number
brutos_terceirizados|numero_contrato|contract number
brutos_terceirizados|orgao_codigo_siafi|agency code (SIAFI)
brutos_terceirizados|orgao_codigo_siape|agency code (SIAPE)
brutos_terceirizados|orgao_nome|agency name
brutos_terceirizados|orgao_sigla|agency acronym
brutos_terceirizados|orgao_superior_sigla|parent agency acronym
brutos_terceirizados|razao_social|company legal name
brutos_terceirizados|salario_mensal_valor|monthly salary
brutos_terceirizados|terceirizado_nome|worker name
brutos_terceirizados|unidade_gestora_codigo|managing unit code
brutos_terceirizados|unidade_gestora_nome|managing unit name
brutos_terceirizados|unidade_gestora_sigla|managing unit acronym
brutos_terceirizados|unidade_prestacao|unit where the service is provided
dim_categoria_profissional|categoria_profissional_nome|job category name
dim_categoria_profissional|id_categoria_profissional|job category code
dim_categoria_profissional|ref_tempo|month that decided the row
dim_contratos|id_contrato|contract key (md5 of the contract number)
dim_contratos|numero_contrato|contract number
dim_contratos|ref_tempo|month that decided the row
dim_orgaos|id_orgao|agency key (md5 of name, acronym)
dim_orgaos|id_orgao_superior|parent agency key (md5 of managing unit name, code)
dim_orgaos|orgao_codigo_siafi|agency code (SIAFI)
dim_orgaos|orgao_codigo_siape|agency code (SIAPE)
dim_orgaos|orgao_nome|agency name
dim_orgaos|orgao_sigla|agency acronym
dim_orgaos|ref_tempo|month that decided the row
dim_orgaos_superiores|id_orgao_superior|parent agency key (md5 of managing unit name, code)
dim_orgaos_superiores|orgao_superior_sigla|parent agency acronym
dim_orgaos_superiores|ref_tempo|month that decided the row
dim_orgaos_superiores|unidade_gestora_codigo|managing unit code
dim_orgaos_superiores|unidade_gestora_nome|managing unit name
dim_periodo|ano|year
dim_periodo|id_tempo|period key yyyymm
dim_periodo|mes_nome|month name
dim_periodo|mes_numero|month number
dim_terceirizados|cnpj|company tax id
dim_terceirizados|cpf|worker tax id, pre-masked
dim_terceirizados|escolaridade|schooling level
dim_terceirizados|id_categoria_profissional|job category code
dim_terceirizados|id_terceirizado|worker id
dim_terceirizados|razao_social|company legal name
dim_terceirizados|ref_tempo|month that decided the row
dim_terceirizados|terceirizado_nome|worker name
fact_contratos_terceirizados|custo_mensal_valor|monthly cost
fact_contratos_terceirizados|data_processamento|processing time, one value per run
fact_contratos_terceirizados|id_contrato|contract key (md5 of the contract number)
fact_contratos_terceirizados|id_fato|fact key (md5 of worker, contract, agency, period)
fact_contratos_terceirizados|id_orgao|agency key (md5 of name, acronym)
fact_contratos_terceirizados|id_orgao_superior|parent agency key (md5 of managing unit name, code)
fact_contratos_terceirizados|id_tempo|period key yyyymm
fact_contratos_terceirizados|id_terceirizado|worker id
fact_contratos_terceirizados|salario_mensal_valor|monthly salary
"""
DESCRIPTIONS = "SELECT * FROM (VALUES " + ", ".join(
    "('" + "', '".join(line.split("|")) + "')" for line in _DESCRIBED.strip().split("\n")) + ") t(table_name, col_name, comment)"
