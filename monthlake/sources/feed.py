"""A raw monthly feed derived from the TPC-H-style driver tables.

One raw row per ``lineitem``; worker = customer, contract = order, company and agency
= supplier, managing unit = supplier's nation, parent agency = its region, category =
part size + type, month = ship month. All 23 raw columns are text, like the
published files. The mapping is the shared test contract (see FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake.functions.packed import join_packs, pack, unpack

NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # Spark's own directory name for a NULL partition value


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


TEXTS = ("o_orderpriority", "c_name", "c_mktsegment", "p_type", "s_name")


def feed_rows(spark: SparkSession, sf_dir: str, packed: bool = False) -> DataFrame:
    """The feed's rows as typed columns, nothing of it text yet: what a shuffle has to move.
    ``packed``: with their texts (``TEXTS``) as one, ``texts``."""
    s = F.col
    # Money and months are narrower than the doubles and timestamps they come from.
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", s("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.trunc("l_shipdate", "month").alias("month"))
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    cust = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    part = load(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type")
    supp = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")

    # Orders meet customers before lineitem: that join shuffles orders (a quarter of
    # lineitem's rows) on the customer key instead of the lineitem-sized join result.
    order_cust = orders.join(cust, s("o_custkey") == s("c_custkey")).drop("o_custkey")
    if packed:
        order_cust = order_cust.select("o_orderkey", "c_custkey", pack(*TEXTS[:3]).alias("order_texts"))
    # Parts come before orders: theirs are the fewest bytes that lineitem carries to its next shuffle.
    rows = (li.join(part, s("l_partkey") == s("p_partkey")).drop("l_partkey", "p_partkey")
            .join(order_cust, s("l_orderkey") == s("o_orderkey")).drop("l_orderkey")
            .join(supp, s("l_suppkey") == s("s_suppkey")).drop("l_suppkey"))
    if packed:
        rows = rows.withColumn("texts", join_packs("order_texts", pack(*TEXTS[3:]))).drop("order_texts", *TEXTS[3:])
    return rows


def raw_feed(spark: SparkSession, sf_dir: str, with_period: bool = False, clustered: bool = False) -> DataFrame:
    """``clustered``: in ranges of months, for a write of one directory per month. The rows are
    dealt out as ``feed_rows`` and become text afterwards: the texts repeat each other and take
    more than twice the bytes. Equal months are spread over several tasks by the rows' other columns.
    They are sorted by month as typed rows too, so that the write sorts no texts and files lie in
    the order of worker and contract. Spark's writer takes that order only from a column without
    NULLs: rows without a month get the name of the directory where it puts NULLs anyway."""
    s = F.col
    rows = feed_rows(spark, sf_dir, packed=clustered)
    if clustered:
        rows = rows.repartitionByRange("month", "c_custkey", "o_orderkey", "s_suppkey", "price", "l_quantity", "texts")
    # Nations and regions are a few rows each and met last.
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = rows.join(nation.join(region, s("n_regionkey") == s("r_regionkey")), s("s_nationkey") == s("n_nationkey"))
    if clustered:
        j = (j.withColumn("periodo", F.coalesce(F.date_format("month", "yyyy-MM"), F.lit(NO_MONTH)))
             .sortWithinPartitions("periodo", "c_custkey", "o_orderkey"))
        j = j.withColumns(dict(zip(TEXTS, unpack("texts", len(TEXTS)), strict=True)))

    txt = lambda c: c.cast("string")
    cols = [
        txt(s("c_custkey")).alias("id_terc"),
        s("r_name").alias("sg_orgao_sup_tabela_ug"),
        txt(s("n_nationkey")).alias("cd_ug_gestora"),
        s("n_name").alias("nm_ug_tabela_ug"),
        F.concat(F.lit("UG"), txt(s("n_nationkey"))).alias("sg_ug_gestora"),
        F.concat(F.lit("CT"), txt(s("o_orderkey"))).alias("nr_contrato"),
        F.lpad(txt(s("s_suppkey")), 14, "0").alias("nr_cnpj"),
        s("s_name").alias("nm_razao_social"),
        F.concat(F.lit("***."), F.lpad(txt(s("c_custkey") % 1000), 3, "0"), F.lit(".***-**")).alias("nr_cpf"),
        s("c_name").alias("nm_terceirizado"),
        F.concat(txt(s("p_size")), F.lit(" - "), s("p_type")).alias("nm_categoria_profissional"),
        s("c_mktsegment").alias("nm_escolaridade"),
        txt(s("l_quantity").cast("int")).alias("nr_jornada"),
        s("o_orderpriority").alias("nm_unidade_prestacao"),
        txt(s("price")).alias("vl_mensal_salario"),
        txt((s("price") + s("l_quantity").cast("decimal(18,2)")).cast("decimal(18,2)")).alias("vl_mensal_custo"),
        txt(F.month("month")).alias("num_mes_carga"),
        F.lower(F.date_format("month", "MMMM")).alias("mes_carga"),
        txt(F.year("month")).alias("ano_carga"),
        F.concat(F.lit("S"), txt(s("s_suppkey"))).alias("sg_orgao"),
        s("s_name").alias("nm_orgao"),
        txt(s("s_suppkey")).alias("cd_orgao_siafi"),
        txt(s("s_suppkey") + 100000).alias("cd_orgao_siape"),
    ]
    if clustered:
        cols.append(s("periodo"))
    elif with_period:
        cols.append(F.date_format("month", "yyyy-MM").alias("periodo"))
    return j.select(*cols)
