"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their DuckDB oracle SQL.

Every query reads the driver tables (or layers Spark derives from them and writes to
the shared folder), over whole tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake import oracle as O
from monthlake.plans import warehouse as W
from monthlake.plans.dims import build_dim
from monthlake.plans.fact import build_fact
from monthlake.plans.mart import build_mart, latest_period
from monthlake.plans.staging import stage
from monthlake.sources.feed import raw_feed
from monthlake.sources import ingest as I
from monthlake.session import scratch_path, shared_root
from monthlake.functions import casts as C
from monthlake.functions import keys as K
from monthlake.functions import periods as P
from monthlake.sources import catalog as CAT
from monthlake.sources import manifest as MAN
from monthlake import schemas as S
from monthlake.functions.keys import period_key as _pk
from monthlake.operators.bucketed import upsert_bucketed
from monthlake.operators.upsert import CODEC, current, upsert_table, write_version
from monthlake.plans.dims import MONTH_COL, dim_period_span, dim_source
from monthlake.plans.fact import FACT_KEY, fact_to_write, incremental_slice, newest_month
from monthlake.plans.pipeline import FACT_TABLE, MART_TABLE, read_layer, run
from monthlake.plans.pipeline import paths as pipeline_paths
from monthlake.streaming import completeness as MC
from monthlake.streaming.incremental import start_incremental
from monthlake.operators import serve as SV
from monthlake.operators import quality as Q
from monthlake.plans.checks import WAREHOUSE_CHECKS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
BRONZE_TABLE = "brutos_terceirizados"


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


FACT_COLS = ("id_terceirizado", "id_tempo", "salario_mensal_valor", "custo_mensal_valor",
             "id_contrato", "id_orgao", "id_orgao_superior", "id_fato")

# --- bronze, silver, gold ---------------------------------------------------------


@register("staging_typed", O.with_(O.FEED, O.BRONZE, body="SELECT * FROM bronze"))
def staging_typed(spark, sf_dir):
    return stage(raw_feed(spark, sf_dir), with_timestamp=False)


@register("fact_build", O.with_(O.FEED, O.BRONZE, O.FACT, body="SELECT * FROM fact"))
def fact_build(spark, sf_dir):
    return build_fact(W.bronze(spark, sf_dir)).select(*FACT_COLS)


_DIM_QUERIES = {
    "dim_category": "dim_categoria_profissional",
    "dim_contract": "dim_contratos",
    "dim_agency": "dim_orgaos",
    "dim_parent_agency": "dim_orgaos_superiores",
    "dim_worker": "dim_terceirizados",
}


def _dim_query(table: str) -> Query:
    return lambda spark, sf_dir: build_dim(W.bronze(spark, sf_dir), table)


for _q, _t in _DIM_QUERIES.items():
    register(_q, O.with_(O.FEED, O.BRONZE, O.DIMS[_t], body=f"SELECT * FROM {_t}"))(_dim_query(_t))


@register("mart_latest", O.with_(*O.WAREHOUSE, body="SELECT * FROM mart"))
def mart_latest(spark, sf_dir):
    return build_mart(W.fact(spark, sf_dir), W.dim(spark, sf_dir, "dim_terceirizados"),
                      W.dim(spark, sf_dir, "dim_orgaos_superiores"), W.newest(spark, sf_dir))


# --- ingest: text, tokens, formats, period layout ---------------------------------


def _t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _varchar_select(cols):
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in cols)


CUSTOMER_COLS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
SUPPLIER_COLS = ("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
ORDERS_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@register("all_string", f"SELECT {_varchar_select(CUSTOMER_COLS)} FROM customer")
def all_string(spark, sf_dir):
    return I.all_string(_t(spark, sf_dir, "customer"))


# Missing-value tokens and texts that only look like one, dealt over the customers by key.
TOKEN_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
               "NA", "NULL", "NaN", "None", "n/a", "nan", "null", "na", "NAN", " ", "NA ", "0", "none", "Null")
_TOKEN_LIST = ", ".join(f"'{t}'" for t in TOKEN_TEXTS)
_TOKEN_TEXT = f"list_extract([{_TOKEN_LIST}], CAST(c_custkey % {len(TOKEN_TEXTS)} AS INTEGER) + 1)"


@register("null_tokens", f"""
SELECT c_custkey, CASE WHEN t IN ('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN',
  '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null') THEN NULL ELSE t END AS t, c_name
FROM (SELECT c_custkey, {_TOKEN_TEXT} AS t, c_name FROM customer)""")
def null_tokens(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    t = F.element_at(F.array(*[F.lit(x) for x in TOKEN_TEXTS]), (F.col("c_custkey") % len(TOKEN_TEXTS) + 1).cast("int"))
    return I.null_tokens(c.select("c_custkey", t.alias("t"), "c_name"))


ODD_SQL = r"""SELECT CAST(s_suppkey AS VARCHAR) AS k, CASE CAST(s_suppkey % 7 AS INTEGER)
  WHEN 0 THEN 'EMPRESA "' || s_name || '" LTDA' WHEN 1 THEN 'C:\dir\' || s_name || '\' WHEN 2 THEN s_name || chr(10) || 'linha; dois'
  WHEN 3 THEN ' ' || s_name || '  ' WHEN 4 THEN '' WHEN 5 THEN NULL ELSE 'ção é ' || s_name END AS v, s_name AS n FROM supplier"""


def _odd_texts(spark, sf_dir):
    """Supplier names with quotes, backslashes, line breaks, outer blanks, accents, '' and NULL."""
    name = F.col("s_name")
    kind = F.col("s_suppkey") % 7
    v = (F.when(kind == 0, F.concat(F.lit('EMPRESA "'), name, F.lit('" LTDA')))
         .when(kind == 1, F.concat(F.lit("C:\\dir\\"), name, F.lit("\\")))
         .when(kind == 2, F.concat(name, F.lit("\nlinha; dois"))).when(kind == 3, F.concat(F.lit(" "), name, F.lit("  ")))
         .when(kind == 4, F.lit("")).when(kind == 5, F.lit(None).cast("string")).otherwise(F.concat(F.lit("ção é "), name)))
    return _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("k"), v.alias("v"), name.alias("n"))


@register("csv_roundtrip", ODD_SQL)
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv-supplier")
    I.write_csv(_odd_texts(spark, sf_dir), path)
    return I.read_raw(spark, path, fmt="csv", tokens=None)


_RAW_TEXT = r"""feed2 AS (SELECT * REPLACE (
  CASE WHEN CAST(id_terc AS INTEGER) % 4 = 0 THEN 'EMPRESA "' || nm_razao_social || '" LTDA' ELSE nm_razao_social || '\' END AS nm_razao_social,
  CASE WHEN CAST(id_terc AS INTEGER) % 3 = 0 THEN nm_terceirizado || chr(10) || 'ção; é' ELSE nm_terceirizado END AS nm_terceirizado,
  CASE WHEN CAST(id_terc AS INTEGER) % 5 = 0 THEN NULL ELSE nm_escolaridade END AS nm_escolaridade) FROM feed)"""


@register("raw_ingest_text", O.with_(O.FEED, _RAW_TEXT, O.BRONZE.replace("FROM feed)", "FROM feed2)"), body="SELECT * FROM bronze"))
def raw_ingest_text(spark, sf_dir):
    """Text files to bronze: the feed as compressed delimited files (one drop per year, columns of every
    second one in reverse), each ingested once and once more, then typed."""
    key = F.col("id_terc").cast("int")
    feed = W.raw(spark, sf_dir).withColumns({
        "nm_razao_social": F.when(key % 4 == 0, F.concat(F.lit('EMPRESA "'), "nm_razao_social", F.lit('" LTDA')))
                            .otherwise(F.concat("nm_razao_social", F.lit("\\"))),
        "nm_terceirizado": F.when(key % 3 == 0, F.concat("nm_terceirizado", F.lit("\nção; é"))).otherwise(F.col("nm_terceirizado")),
        "nm_escolaridade": F.when(key % 5 == 0, F.lit("NA")).otherwise(F.col("nm_escolaridade"))})
    drop, path = scratch_path(spark, "raw-text"), scratch_path(spark, "raw-landed")
    years = sorted(r[0] for r in feed.select(F.substring("periodo", 1, 4)).distinct().collect())
    for n, year in enumerate(years):
        columns = S.RAW_COLUMNS[::-1] if n % 2 else S.RAW_COLUMNS
        I.write_csv(feed.where(F.col("periodo").startswith(year)).select(*columns), f"{drop}/{year}.csv",
                    compression="gzip", rows_per_file=1 << 19)
        assert I.ingest_period(spark, f"{drop}/{year}.csv", path, f"{year}-01")
        assert not I.ingest_period(spark, f"{drop}/{year}.csv", path, f"{year}-01")  # landed: left alone
    return stage(I.read_periods(spark, path, schema=S.RAW), with_timestamp=False)


@register("parquet_roundtrip", "SELECT * FROM supplier")
def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "parquet-supplier")
    I.write_parquet(_t(spark, sf_dir, "supplier"), path)
    return spark.read.parquet(path)


def _orders_by_period(spark, sf_dir):
    return _t(spark, sf_dir, "orders").withColumn("periodo", F.date_format("o_orderdate", "yyyy-MM"))


ORDERS_PERIOD = "SELECT *, strftime(o_orderdate, '%Y-%m') AS periodo FROM orders"
SCAN_PERIOD = "1996-03"


@register("period_partition_scan",
          f"SELECT * FROM ({ORDERS_PERIOD}) WHERE periodo = '{SCAN_PERIOD}'")
def period_partition_scan(spark, sf_dir):
    path = scratch_path(spark, "orders-by-period")
    I.write_period(_orders_by_period(spark, sf_dir), path)
    return I.read_periods(spark, path, period=SCAN_PERIOD)


@register("multi_period_union",
          "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
          "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS o_orderpriority, periodo "
          f"FROM ({ORDERS_PERIOD})")
def multi_period_union(spark, sf_dir):
    # Two drops of period files with different columns (one lacks o_orderpriority).
    o = _orders_by_period(spark, sf_dir)
    a, b = scratch_path(spark, "drop-a"), scratch_path(spark, "drop-b")
    I.write_period(o.where(F.col("o_orderstatus") == "F").drop("o_orderpriority"), a)
    I.write_period(o.where(F.col("o_orderstatus") != "F"), b)
    return I.union_files([I.read_periods(spark, a), I.read_periods(spark, b)]).select(*ORDERS_COLS, "periodo")


@register("skip_existing_periods", O.with_(O.FEED, body=(
    "SELECT * FROM feed f WHERE NOT EXISTS (SELECT 1 FROM orders o "
    "WHERE strftime(o.o_orderdate, '%Y-%m') = f.periodo)")))
def skip_existing_periods(spark, sf_dir):
    # Incoming raw rows by ship month; months already present in orders count as loaded.
    return I.skip_existing(raw_feed(spark, sf_dir, with_period=True), _orders_by_period(spark, sf_dir))


@register("ctas_mart", O.with_(*O.WAREHOUSE, body="SELECT * FROM mart"))
def ctas_mart(spark, sf_dir):
    """Gold of a run registered as a table, which then follows the next run's version."""
    base = scratch_path(spark, "warehouse-registered")
    raw = W.raw(spark, sf_dir) and W.layer_path(spark, sf_dir, "raw")
    months = sorted(f.rsplit("/periodo=", 1)[1].split("/", 1)[0] for f in W.raw(spark, sf_dir).inputFiles())
    name = "app_terceirizados_" + hashlib.md5(base.encode()).hexdigest()[:8]
    gold = f"{shared_root(spark)}/monthlake/gold.db"
    run(spark, base, months[0], run_ts=W.FIXED_RUN_TS, raw=raw)
    path = pipeline_paths(base)[MART_TABLE]
    I.register_table(spark, path, name, "gold", db_location=gold, comment=S.TABLE_COMMENTS[MART_TABLE])
    run(spark, base, "*", run_ts=W.FIXED_RUN_TS, raw=raw)
    return I.register_table(spark, path, name, "gold", db_location=gold)


@register("fact_registered", O.with_(O.FEED, O.BRONZE, O.FACT, body=f"SELECT {', '.join(FACT_COLS)} FROM fact"))
def fact_registered(spark, sf_dir):
    """The month-partitioned fact registered after its first month, then once more after a load of all."""
    base = scratch_path(spark, "warehouse-fact")
    raw = W.raw(spark, sf_dir) and W.layer_path(spark, sf_dir, "raw")
    months = sorted(f.rsplit("/periodo=", 1)[1].split("/", 1)[0] for f in W.raw(spark, sf_dir).inputFiles())
    name = "fact_" + hashlib.md5(base.encode()).hexdigest()[:8]
    for period in (months[0], "*"):
        for step in ("bronze", FACT_TABLE):
            run(spark, base, period, only=step, run_ts=W.FIXED_RUN_TS, raw=raw)
        fact = I.register_table(spark, pipeline_paths(base)[FACT_TABLE], name, "gold", db_location=f"{shared_root(spark)}/monthlake/gold.db",
                                comment=S.TABLE_COMMENTS[FACT_TABLE])
    return fact.select(*FACT_COLS)


@register("write_if_absent", "SELECT * FROM customer WHERE c_custkey % 2 = 0")
def write_if_absent(spark, sf_dir):
    """A cache written from every second customer, then offered all: what is there stays."""
    path, customers = scratch_path(spark, "cache"), _t(spark, sf_dir, "customer")
    I.write_if_absent(customers.where("c_custkey % 2 = 0"), path)
    I.write_if_absent(customers, path)
    return spark.read.parquet(path)


@register("table_descriptions", O.DESCRIPTIONS)
def table_descriptions(spark, sf_dir):
    """What ``DESCRIBE TABLE`` says of the registered silver and gold tables' columns."""
    base = scratch_path(spark, "warehouse-described")
    raw = W.raw(spark, sf_dir) and W.layer_path(spark, sf_dir, "raw")
    run(spark, base, "*", run_ts=W.FIXED_RUN_TS, raw=raw)
    tag, out = hashlib.md5(base.encode()).hexdigest()[:8], None
    for table in S.TABLE_COMMENTS:
        I.register_table(spark, pipeline_paths(base)["bronze" if table == BRONZE_TABLE else table], f"{table}_{tag}", "gold",
                         db_location=f"{shared_root(spark)}/monthlake/gold.db", comment=S.TABLE_COMMENTS[table])
        rows = spark.sql(f"DESCRIBE TABLE gold.{table}_{tag}").where("comment IS NOT NULL AND comment <> ''").select(
            F.lit(table).alias("table_name"), "col_name", "comment")
        out = rows if out is None else out.unionByName(rows)
    return out.distinct()


# --- scalar functions ---------------------------------------------------------------


@register("int_cast_tolerant",
          "SELECT p_partkey, CAST(CAST(p_retailprice AS VARCHAR) AS INTEGER) AS retail_int, "
          "CAST(' ' || CAST(p_size AS VARCHAR) || '.0 ' AS INTEGER) AS size_int FROM part")
def int_cast_tolerant(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return p.select("p_partkey", C.to_int(F.col("p_retailprice").cast("string")).alias("retail_int"),
                    C.to_int(F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(".0 "))).alias("size_int"))


@register("category_split",
          "SELECT p_partkey, CAST(split_part(cat, ' - ', 1) AS INTEGER) AS category_code, "
          "trim(split_part(cat, ' - ', 2)) AS category_name FROM "
          "(SELECT p_partkey, CAST(p_size AS VARCHAR) || ' - ' || p_type || ' - ' || p_brand AS cat FROM part)")
def category_split(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    code, name = C.split_code_name(F.concat_ws(" - ", F.col("p_size").cast("string"), "p_type", "p_brand"))
    return p.select("p_partkey", code.alias("category_code"), name.alias("category_name"))


@register("surrogate_keys",
          "SELECT s_suppkey, "
          f"{O.key('s_name')} AS k_name, "
          f"{O.key('s_name', 'nullif(s_nationkey, 0)')} AS k_name_nation, "
          f"{O.key('nullif(s_nationkey, 0)', 's_name')} AS k_nation_name, "
          f"{O.key('s_suppkey', 's_name', 'nullif(s_nationkey, 0)', 'n_name')} AS k_four "
          "FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def surrogate_keys(spark, sf_dir):
    s = _t(spark, sf_dir, "supplier").join(_t(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    nk = F.nullif(F.col("s_nationkey"), F.lit(0))
    return s.select("s_suppkey",
                    K.surrogate_key("s_name").alias("k_name"),
                    K.surrogate_key("s_name", nk).alias("k_name_nation"),
                    K.surrogate_key(nk, "s_name").alias("k_nation_name"),
                    K.surrogate_key("s_suppkey", "s_name", nk, "n_name").alias("k_four"))


@register("period_key",
          "SELECT o_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS id_tempo, "
          "strftime(o_orderdate, '%Y-%m') AS periodo FROM orders")
def period_key(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.select("o_orderkey", K.period_key(F.year("o_orderdate"), F.month("o_orderdate")).alias("id_tempo"),
                    P.normalize_period(F.date_format("o_orderdate", "yyyy-MM")).alias("periodo"))


_MONTHS_PT = [("01", "janeiro"), ("02", "fevereiro"), ("03", "marco"), ("04", "abril"), ("05", "maio"), ("06", "junho"),
              ("07", "julho"), ("08", "agosto"), ("09", "setembro"), ("10", "outubro"), ("11", "novembro"), ("12", "dezembro")]
_NAME_CASE = "CASE " + " ".join(
    f"WHEN contains(lower(t), '{n}') OR contains(lower(t), '{n[:3]}') THEN '{m}'" for m, n in _MONTHS_PT) + " END"
_PT_CASE = "CASE m " + " ".join(f"WHEN '{m}' THEN '{n}'" for m, n in _MONTHS_PT) + " END"
PERIOD_TEXTS = """texts AS (
  SELECT o_orderkey, CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR) AS t FROM orders
  UNION ALL
  SELECT o_orderkey, lower(strftime(o_orderdate, '%B')) || ' ' || CAST(year(o_orderdate) AS VARCHAR) AS t FROM orders
)"""


@register("period_parse", (
    f"WITH {PERIOD_TEXTS}, y AS (SELECT o_orderkey, t, nullif(regexp_extract(t, '(\\d{{4}})', 1), '') AS year FROM texts), "
    "m AS (SELECT *, coalesce(lpad(nullif(regexp_extract(CASE WHEN year IS NULL THEN t ELSE replace(t, year, '') END, "
    f"'(\\d{{1,2}})', 1), ''), 2, '0'), {_NAME_CASE}) AS m FROM y) "
    f"SELECT o_orderkey, t AS period_text, year, m AS month_num, {_PT_CASE} AS month_name, "
    "CASE WHEN year IS NOT NULL AND m IS NOT NULL THEN year || '-' || m END AS periodo FROM m"))
def period_parse(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    texts = o.select("o_orderkey", F.concat(F.month("o_orderdate").cast("string"), F.lit("/"),
                                            F.year("o_orderdate").cast("string")).alias("period_text")).unionByName(
        o.select("o_orderkey", F.concat(F.lower(F.date_format("o_orderdate", "MMMM")), F.lit(" "),
                                        F.year("o_orderdate").cast("string")).alias("period_text")))
    parsed = texts.select("o_orderkey", "period_text", P.parse_period(F.col("period_text")).alias("p"))
    return parsed.select("o_orderkey", "period_text", "p.year", "p.month_num", "p.month_name",
                         P.period_from_parts("p.year", "p.month_num").alias("periodo"))


@register("http_date_parse",
          "SELECT event_id, strftime(ts, '%a, %d %b %Y %H:%M:%S GMT') AS http_date, "
          "strptime(strftime(ts, '%a, %d %b %Y %H:%M:%S GMT'), '%a, %d %b %Y %H:%M:%S GMT') AS modified FROM events")
def http_date_parse(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_id", P.format_http_date("ts").alias("http_date"))
    return e.select("event_id", "http_date", P.parse_http_date("http_date").alias("modified"))


@register("url_rewrite",
          "SELECT page_id, link, replace(link, '/view', '/@@download/file') AS download_url, "
          "split(replace(link, '/view', ''), '/')[-1] AS file_name, lower(split(link, '.')[-1]) AS extension "
          "FROM (SELECT page_id, url || '/view' AS link FROM pages)")
def url_rewrite(spark, sf_dir):
    p = _t(spark, sf_dir, "pages").select("page_id", F.concat("url", F.lit("/view")).alias("link"))
    return p.select("page_id", "link", P.download_url("link").alias("download_url"),
                    P.file_name("link").alias("file_name"), P.extension("link").alias("extension"))


# --- catalog, manifests --------------------------------------------------------------


# Listing pages made of the urls: a menu link, an entry with two links, one in other quotes and
# case with an escaped ampersand, and one without a link.
LISTING_SQL = """
SELECT page_id, 0 AS pos, url || '/arq/Terceirizados_2024' || lpad(CAST(page_id % 12 + 1 AS VARCHAR), 2, '0') || '.csv/view' AS href FROM pages
UNION ALL
SELECT page_id, 1 AS pos, url || '/terceirizados-marco-2024.XLSX?a=1&b=' || CAST(page_id AS VARCHAR) AS href FROM pages
UNION ALL
SELECT page_id, 3 AS pos, url || '/leiame-202403.pdf' AS href FROM pages"""


def _listings(spark, sf_dir):
    url, n = F.col("url"), F.col("page_id")
    month = F.lpad((n % 12 + 1).cast("string"), 2, "0")
    page = F.concat(
        F.lit('<html><nav><a href="/menu_202403.csv">menu</a></nav><article class="entry"><h2>x</h2>\n<a class="u" href="'), url,
        F.lit("/arq/Terceirizados_2024"), month, F.lit('.csv/view">a</a> <a href="/other_202403.csv">b</a></article>'),
        F.lit("<ARTICLE id='k' CLASS='tile entry'><A HREF='"), url, F.lit("/terceirizados-marco-2024.XLSX?a=1&amp;b="),
        n.cast("string"), F.lit("'>c</A></ARTICLE><article class=\"entry\">no link</article><article class='entry'>"),
        F.lit('<a href="'), url, F.lit('/leiame-202403.pdf">d</a></article></html>'))
    return _t(spark, sf_dir, "pages").select("page_id", page.alias("html"))


@register("catalog_links", LISTING_SQL)
def catalog_links(spark, sf_dir):
    return CAT.extract_links(_listings(spark, sf_dir))


@register("catalog_candidates", """
SELECT DISTINCT url || '/arq/Terceirizados_202403.csv/view' AS href FROM pages WHERE page_id % 12 = 2
UNION
SELECT url || '/terceirizados-marco-2024.XLSX?a=1&b=' || CAST(page_id AS VARCHAR) AS href FROM pages""")
def catalog_candidates(spark, sf_dir):
    return CAT.candidates(CAT.extract_links(_listings(spark, sf_dir)), "2024", "03", "marco")


VERSIONS_SQL = ("SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS modified FROM events")


@register("latest_version",
          f"SELECT user_id, event_id, modified FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
          f"ORDER BY modified DESC NULLS LAST, event_id) AS rn FROM ({VERSIONS_SQL})) WHERE rn = 1")
def latest_version(spark, sf_dir):
    # Period = user, link = event, Last-Modified = ts; error events are undated.
    e = _t(spark, sf_dir, "events").select(
        "user_id", "event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("modified"))
    return CAT.latest_version(e, "user_id", "modified", "event_id")


REMOTE_SQL = "SELECT event_type || '/' || CAST(event_id AS VARCHAR) || '.parquet' AS path, ts AS updated FROM events"
LOCAL_SQL = ("SELECT event_type || '/' || CAST(event_id AS VARCHAR) || '.parquet' AS path, "
             "ts + to_minutes(CAST(floor(value) AS BIGINT) - 50) AS modified FROM events WHERE value >= 20")
DIFF_SQL = (f"SELECT r.path, r.updated, l.modified AS local_modified, "
            f"CASE WHEN l.modified IS NULL OR r.updated > l.modified THEN 'download' ELSE 'skip' END AS action, "
            f"split_part(r.path, '/', 1) AS layer "
            f"FROM ({REMOTE_SQL}) r LEFT JOIN ({LOCAL_SQL}) l ON r.path = l.path")


def _manifests(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    path = F.concat("event_type", F.lit("/"), F.col("event_id").cast("string"), F.lit(".parquet"))
    remote = e.select(path.alias("path"), F.col("ts").alias("updated"))
    local = e.where(F.col("value") >= 20).select(
        path.alias("path"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.floor("value").cast("int") - 50)).alias("modified"))
    layers = {t: f"{t}/" for t in ("click", "error", "purchase", "signup", "view")}
    return MAN.select_layers(remote, "all", layers), local


@register("manifest_diff", DIFF_SQL)
def manifest_diff(spark, sf_dir):
    remote, local = _manifests(spark, sf_dir)
    return MAN.diff_manifest(remote, local).select("path", "updated", "local_modified", "action", "layer")


@register("manifest_summary",
          f"SELECT layer, count(*) FILTER (WHERE action = 'download') AS downloaded, "
          f"count(*) FILTER (WHERE action = 'skip') AS skipped FROM ({DIFF_SQL}) GROUP BY layer")
def manifest_summary(spark, sf_dir):
    remote, local = _manifests(spark, sf_dir)
    return MAN.summarize(MAN.diff_manifest(remote, local))


@register("manifest_scan", """
SELECT 'bronze' AS layer, 'bronze/orders/periodo=' || strftime(o_orderdate, '%Y-%m') AS folder, 'download' AS action FROM orders GROUP BY ALL
UNION ALL SELECT 'ouro', 'gold/nation', 'skip'
UNION ALL SELECT 'prata', 'silver/part', 'download'""")
def manifest_scan(spark, sf_dir):
    """Layers written from the tables, scanned, and the sync plan against a second copy that
    holds the gold layer (written later) alone."""
    remote, local = scratch_path(spark, "store"), scratch_path(spark, "copy")
    I.write_period(_orders_by_period(spark, sf_dir), f"{remote}/bronze/orders")
    _t(spark, sf_dir, "part").write.parquet(f"{remote}/silver/part")
    _t(spark, sf_dir, "nation").coalesce(1).write.parquet(f"{remote}/gold/nation")
    _t(spark, sf_dir, "nation").coalesce(1).write.parquet(f"{remote}/other/nation")
    _t(spark, sf_dir, "nation").coalesce(1).write.parquet(f"{local}/gold/nation")
    folder = F.regexp_replace("path", "/[^/]*$", "")
    files = MAN.scan_manifest(spark, remote, glob="*.parquet", time_col="updated")
    have = MAN.scan_manifest(spark, local, glob="*.parquet")
    plan = MAN.diff_manifest(MAN.select_layers(files, "all").withColumn("path", folder).distinct(),
                             have.withColumn("path", folder).distinct())
    return plan.select("layer", F.col("path").alias("folder"), "action").distinct()


# --- upsert, watermark, whole run, stream -------------------------------------------


_B2 = "b2 AS (SELECT *, CAST(ano * 100 + mes_numero AS INTEGER) AS pk FROM bronze)"
_OLD = "b_old AS (SELECT * FROM b2 WHERE pk < (SELECT max(pk) FROM b2))"
_NEW = "b_new AS (SELECT * FROM b2 WHERE pk = (SELECT max(pk) FROM b2))"


@register("upsert_scd1", O.with_(
    O.FEED, O.BRONZE, _B2, _OLD, _NEW, O.worker_dim("tgt", "b_old"), O.worker_dim("src", "b_new"),
    body="SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.id_terceirizado IS NOT DISTINCT FROM "
         "t.id_terceirizado) UNION ALL SELECT * FROM src"))
def upsert_scd1(spark, sf_dir):
    """Worker dimension loaded from every month but the newest, then the newest month
    upserted on top (SCD-1, written as table versions)."""
    b = W.bronze(spark, sf_dir)
    pk = _pk("ano", "mes_numero")
    newest = b.select(F.max(pk)).scalar()
    path = scratch_path(spark, "dim-worker-upsert")
    for part in (b.where(pk < newest), b.where(pk == newest)):
        src, key, _ = dim_source(part, "dim_terceirizados")
        out = upsert_bucketed(spark, path, src, key, [*S.DIM_WORKER, MONTH_COL], rank=MONTH_COL)
    return out.drop(MONTH_COL)


@register("fact_incremental", O.with_(
    O.FEED, O.BRONZE, O.FACT,
    "m AS (SELECT id_tempo, row_number() OVER (ORDER BY id_tempo DESC) AS rn FROM (SELECT DISTINCT id_tempo FROM fact))",
    body="SELECT * FROM fact WHERE id_tempo NOT IN (SELECT id_tempo FROM m WHERE rn = 4)"))
def fact_incremental(spark, sf_dir):
    """A fact without its newest and its fourth newest month, and with no amounts in the second
    newest; then the whole source is offered. The watermark keeps months from the newest loaded
    one on: that month's rows are replaced, the newest comes in, the older gap stays."""
    b = W.bronze(spark, sf_dir)
    src = fact_to_write(b)
    months = sorted(r[0] for r in b.select(_pk("ano", "mes_numero")).distinct().collect())[::-1]  # a calendar of months
    path = scratch_path(spark, "fact-incremental")
    first = src.where((F.col("id_tempo") <= months[1]) & (F.col("id_tempo") != months[3]))
    for c in ("salario_mensal_valor", "custo_mensal_valor"):
        first = first.withColumn(c, F.when(F.col("id_tempo") != months[1], F.col(c)))
    upsert_table(spark, path, first, list(FACT_KEY), None, columns=S.FACT, partition="id_tempo", clustered=True)
    newest = newest_month(current(spark, path))
    out = upsert_table(spark, path, incremental_slice(src, newest), list(FACT_KEY), None, columns=S.FACT, partition="id_tempo",
                       clustered=True)
    return out.select(*FACT_COLS)


@register("latest_period_filter",
          "SELECT * FROM orders WHERE CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) = "
          "(SELECT max(CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER)) FROM orders)")
def latest_period_filter(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumn("id_tempo", _pk(F.year("o_orderdate"), F.month("o_orderdate")))
    return latest_period(o).drop("id_tempo")


@register("latest_per_key",
          "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey "
          "ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def latest_per_key_q(spark, sf_dir):
    from monthlake.operators.dedup import latest_per_key
    return latest_per_key(_t(spark, sf_dir, "orders"), ["o_custkey"],
                          [F.col("o_orderdate").desc_nulls_last(), "o_orderkey"])


def _land_raw(spark, sf_dir) -> str:
    base = scratch_path(spark, "warehouse")
    I.write_period(raw_feed(spark, sf_dir, with_period=True, clustered=True), f"{base}/raw")
    return base


@register("pipeline_end_to_end", O.with_(*O.WAREHOUSE, body="SELECT * FROM mart"))
def pipeline_end_to_end(spark, sf_dir):
    base = _land_raw(spark, sf_dir)
    return run(spark, base, "*", run_ts=W.FIXED_RUN_TS)


def _deliver(drop, base: str) -> None:
    """Add rows of the landed feed to a raw directory: they lie by month already, so a scan's task
    writes the months of its own files and nothing is shuffled."""
    drop.write.mode("append").option("compression", CODEC).partitionBy("periodo").parquet(f"{base}/raw")


@register("incremental_stream", O.with_(*O.WAREHOUSE, body="SELECT * FROM mart"))
def incremental_stream(spark, sf_dir):
    """Three drops, newest months first; one month comes half in the first, half in the last."""
    feed, base = W.raw(spark, sf_dir), scratch_path(spark, "warehouse-stream")
    months = sorted((f.rsplit("/periodo=", 1)[1].split("/", 1)[0] for f in feed.inputFiles()), reverse=True)
    months = list(dict.fromkeys(months))
    split, cut = months[0], months[len(months) // 2]
    half = F.xxhash64("nr_contrato", "id_terc") % 2 == 0
    is_split = F.col("periodo") == split
    for drop in (feed.where((F.col("periodo") >= cut) & (~is_split | half)), feed.where(F.col("periodo") < cut),
                 feed.where(is_split & ~half)):
        _deliver(drop, base)
        q = start_incremental(spark, base, checkpoint=f"{base}/_stream_checkpoint", run_ts=W.FIXED_RUN_TS)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return read_layer(spark, base, MART_TABLE)


@register("month_completeness", O.with_(O.FEED, O.BRONZE, O.FACT, body="""
SELECT 1 AS drain, id_tempo, count(*) AS n_rows FROM fact WHERE id_tempo < (SELECT max(id_tempo) FROM fact) GROUP BY id_tempo
UNION ALL SELECT 2 AS drain, id_tempo, count(*) AS n_rows FROM fact GROUP BY id_tempo"""))
def month_completeness(spark, sf_dir):
    """The fact's rows per month after each of two deliveries: the first holds every month, but only
    one of two announced parts of the newest; the second the other part."""
    feed, base = W.raw(spark, sf_dir), scratch_path(spark, "warehouse-parts")
    newest = F.col("periodo") == max(f.rsplit("/periodo=", 1)[1].split("/", 1)[0] for f in feed.inputFiles())
    half = F.xxhash64("nr_contrato", "id_terc") % 2 == 0
    seen = []
    for part, drop in ((1, feed.where(~newest | half)), (2, feed.where(newest & ~half))):
        _deliver(drop, base)
        MC.write_receipts(drop.select("periodo").distinct().select(
            "periodo", F.lit(part).alias("part"), F.when(newest, 2).otherwise(1).alias("parts")), base)
        q = MC.start_complete_months(spark, base, checkpoint=f"{base}/_parts_checkpoint", run_ts=W.FIXED_RUN_TS)
        q.awaitTermination()
        seen.append(read_layer(spark, base, FACT_TABLE).groupBy("id_tempo").agg(F.count("*").alias("n_rows"))
                    .select(F.lit(part).alias("drain"), "id_tempo", "n_rows"))
    return seen[0].unionByName(seen[1])


@register("dim_period", O.with_(O.FEED, O.BRONZE, O.DIM_PERIOD_SPAN, body="SELECT * FROM dim_periodo"))
def dim_period_q(spark, sf_dir):
    """Calendar spanning the months present in the fact (the fixed 2020-2030 calendar of
    ``dim_period()`` is the library default; see tests)."""
    return dim_period_span(spark, W.fact(spark, sf_dir).select("id_tempo"))


# --- serving --------------------------------------------------------------------------


LOOKUP_ID = 1
BRONZE_NO_TS = [f.name for f in S.BRONZE.fields if f.name != "data_processamento"]


def _bronze_rows(spark, sf_dir):
    return W.bronze(spark, sf_dir).select(*BRONZE_NO_TS)


def _mart_pages(spark, sf_dir) -> str:
    return W.serving(spark, sf_dir, "mart", "id_terceirizado", lambda: W.mart(spark, sf_dir))


def _bronze_pages(spark, sf_dir) -> str:
    return W.serving(spark, sf_dir, "bronze", "id_terceirizado", lambda: _bronze_rows(spark, sf_dir))


@register("page_list", O.with_(*O.WAREHOUSE, body=(
    "SELECT * FROM mart ORDER BY id_terceirizado, cnpj, cpf, orgao_superior_sigla LIMIT 20 OFFSET 0")))
def page_list(spark, sf_dir):
    return SV.page(spark, _mart_pages(spark, sf_dir), "id_terceirizado", 0, 20)


@register("page_deep", "SELECT * FROM customer ORDER BY " + ", ".join(CUSTOMER_COLS) + " LIMIT 200 OFFSET 1000")
def page_deep(spark, sf_dir):
    path = W.serving(spark, sf_dir, "customer", "c_custkey", lambda: _t(spark, sf_dir, "customer"))
    return SV.page(spark, path, "c_custkey", 1000, 500)


@register("page_envelope", "SELECT 1000 AS b_start, 200 AS \"limit\", count(*) AS total, "
                           "CASE WHEN 1200 < count(*) THEN 1200 END AS next FROM customer")
def page_envelope(spark, sf_dir):
    """A serving table loaded twice, the second time with all customers; its envelope opens no data file."""
    path, customers = scratch_path(spark, "serving-envelope"), _t(spark, sf_dir, "customer")
    for rows in (customers.where("c_custkey % 2 = 0"), customers):
        SV.write_serving(rows, path, "c_custkey")
    return SV.serving_envelope(spark, path, 1000, 500)


@register("page_by_id", O.with_(O.FEED, O.BRONZE, body=(
    f"SELECT * FROM bronze WHERE id_terceirizado = {LOOKUP_ID} ORDER BY " + ", ".join(BRONZE_NO_TS)
    + " LIMIT 50 OFFSET 10")))
def page_by_id(spark, sf_dir):
    rows, _ = SV.lookup(spark, _bronze_pages(spark, sf_dir), "id_terceirizado", LOOKUP_ID, 10, 50)
    return rows


@register("page_by_id_envelope", O.with_(O.FEED, O.BRONZE, body=(
    f"SELECT {LOOKUP_ID} AS id_terceirizado, 10 AS b_start, 50 AS \"limit\", count(*) AS total, "
    f"CASE WHEN 60 < count(*) THEN 60 END AS next FROM bronze WHERE id_terceirizado = {LOOKUP_ID}")))
def page_by_id_envelope(spark, sf_dir):
    _, env = SV.lookup(spark, _bronze_pages(spark, sf_dir), "id_terceirizado", LOOKUP_ID, 10, 50)
    return env


@register("row_json", O.with_(*O.WAREHOUSE, body=(
    "SELECT CAST(to_json({'id_terceirizado': id_terceirizado, 'cnpj': cnpj, 'cpf': cpf, "
    "'orgao_superior_sigla': orgao_superior_sigla}) AS VARCHAR) AS json FROM mart")))
def row_json(spark, sf_dir):
    return SV.row_json(W.mart(spark, sf_dir))


# --- data quality -----------------------------------------------------------------------


LINEITEM_COLS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


@register("dq_not_null", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM "
    "(SELECT * REPLACE (nullif(l_linenumber, 1) AS l_linenumber, nullif(l_returnflag, 'R') AS l_returnflag) FROM lineitem)"
    for c in LINEITEM_COLS))
def dq_not_null(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").withColumns({
        "l_linenumber": F.nullif(F.col("l_linenumber"), F.lit(1)), "l_returnflag": F.nullif(F.col("l_returnflag"), F.lit("R"))})
    return Q.check_not_null(li, LINEITEM_COLS)


@register("dq_not_null_written", ORACLE["dq_not_null"])
def dq_not_null_written(spark, sf_dir):
    """The same NULL counts, taken by the job that writes the table."""
    li = _t(spark, sf_dir, "lineitem").withColumns({
        "l_linenumber": F.nullif(F.col("l_linenumber"), F.lit(1)), "l_returnflag": F.nullif(F.col("l_returnflag"), F.lit("R"))})
    watched, seen = Q.observe_not_null(li, LINEITEM_COLS)
    write_version(watched, scratch_path(spark, "lineitem-checked"))
    return Q.observed_not_null(spark, seen, LINEITEM_COLS)


@register("dq_unique", "SELECT l_orderkey, count(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL "
                       "GROUP BY l_orderkey HAVING count(*) > 1")
def dq_unique(spark, sf_dir):
    return Q.check_unique(_t(spark, sf_dir, "lineitem"), "l_orderkey")


@register("dq_unique_combination", "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem "
                                   "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def dq_unique_combination(spark, sf_dir):
    return Q.check_unique_combination(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("dq_relationships",
          "SELECT * FROM (SELECT o_orderkey, nullif(o_custkey, 5) AS o_custkey FROM orders) o WHERE o_custkey IS NOT NULL "
          "AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_custkey % 7 <> 0)")
def dq_relationships(spark, sf_dir):
    """Orders without a parent among the customers whose key is no multiple of 7."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.nullif(F.col("o_custkey"), F.lit(5)).alias("o_custkey"))
    return Q.check_relationship(o, _t(spark, sf_dir, "customer").where("c_custkey % 7 <> 0"), "o_custkey", "c_custkey")


def warehouse_tables(spark, sf_dir) -> dict:
    t = {name: W.dim(spark, sf_dir, name) for name in
         ("dim_categoria_profissional", "dim_contratos", "dim_orgaos", "dim_orgaos_superiores", "dim_terceirizados")}
    t["brutos_terceirizados"] = W.bronze(spark, sf_dir)
    t["fact_contratos_terceirizados"] = W.fact(spark, sf_dir)
    t["app_terceirizados"] = W.mart(spark, sf_dir)
    t["dim_periodo"] = dim_period_span(spark, t["fact_contratos_terceirizados"].select("id_tempo"))
    return t


@register("dq_suite", O.with_(
    O.FEED, O.BRONZE, O.FACT, *O.DIMS.values(), O.MART, O.DIM_PERIOD_SPAN,
    body=O.suite_sql()))
def dq_suite(spark, sf_dir):
    return Q.run_suite(warehouse_tables(spark, sf_dir), WAREHOUSE_CHECKS)
