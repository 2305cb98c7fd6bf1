"""What the layers' writes shuffle: narrow typed rows once, and the texts and keys made of them never."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text
from monthlake.functions.packed import join_packs, pack, unpack
from monthlake.operators.upsert import current, read_current, upsert_table
from monthlake.plans import warehouse as W
from monthlake.operators.dedup import latest_per_key
from monthlake.plans.fact import GRAIN, build_fact, fact_to_write, grain_order, grain_rows, with_keys
from monthlake.plans.staging import stage
from monthlake.sources.feed import raw_feed


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def exchanges(df) -> list[str]:
    """The columns of every shuffle in the plan, as printed."""
    return re.findall(r"Exchange\nInput \[\d+\]: (.*)\nArguments: (?:range|hash)partitioning", plan_text(df))


def test_landed_feed_is_dealt_before_it_becomes_text(spark):
    plain, dealt = raw_feed(spark, SF_SMALL, with_period=True), raw_feed(spark, SF_SMALL, with_period=True, clustered=True)
    assert dealt.columns == plain.columns and rows(dealt) == rows(plain)
    ranges = re.findall(r"Exchange\nInput \[(\d+)\]: (.*)\nArguments: rangepartitioning\(month",
                        plan_text(raw_feed(spark, SF_SMALL, with_period=True, clustered=True)))
    assert len(ranges) == 1 and int(ranges[0][0]) <= 13 and "nm_" not in ranges[0][1]
    assert all("l_shipdate" not in x and "l_extendedprice" not in x for x in exchanges(dealt))


def test_fact_is_shuffled_once_and_without_its_keys(spark):
    bronze = W.bronze(spark, SF_SMALL)
    twice = bronze.unionByName(bronze).unionByName(bronze.limit(3).withColumns({"numero_contrato": F.lit(None), "salario_mensal_valor": F.lit(None)}))
    fact = fact_to_write(twice)
    assert rows(fact) == rows(build_fact(twice))
    moved = exchanges(fact_to_write(bronze))
    assert len(moved) == 1 and "id_fato" not in moved[0] and "id_contrato" not in moved[0]


def test_landed_files_lie_in_order_of_worker_and_contract(spark, tmp_table):
    path = tmp_table("landed")
    feed = raw_feed(spark, SF_SMALL, clustered=True)
    feed.write.partitionBy("periodo").parquet(path)
    files = spark.read.parquet(path).inputFiles()
    landed = [[(int(r.id_terc), int(r.nr_contrato[2:])) for r in spark.read.parquet(f).collect()] for f in files[:20]]
    assert all(f == sorted(f) for f in landed) and max(map(len, landed)) > 1


def test_rows_without_a_month_land_in_the_directory_of_nulls(spark, tmp_table):
    src, path = tmp_table("tables"), tmp_table("landed")
    for name in ("orders", "customer", "part", "supplier", "nation", "region"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{src}/{name}.parquet")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(40)
    li.withColumn("l_shipdate", F.when(F.col("l_orderkey") % 2 == 0, F.col("l_shipdate"))).write.parquet(f"{src}/lineitem.parquet")
    raw_feed(spark, src, clustered=True).write.partitionBy("periodo").parquet(path)
    plain = raw_feed(spark, src, with_period=True)
    assert rows(spark.read.parquet(path).select(*plain.columns)) == rows(plain)
    assert plain.where("periodo IS NULL").count() > 0


def test_merge_with_the_month_in_its_key_reads_held_months_only(spark, tmp_table):
    path = tmp_table("held")
    load = lambda r: upsert_table(spark, path, spark.createDataFrame(r, "id string, id_tempo int, v int"), ["id_tempo", "id"],
                                  None, columns=["id", "id_tempo", "v"], partition="id_tempo")
    load([("a", 202401, 1), ("b", 202401, 2), (None, None, 3)])
    out = load([("a", 202401, 10), ("a", 202402, 5), (None, None, 30), ("b", 202403, 6)])
    want = [("a", 202401, 10), ("a", 202402, 5), ("b", 202401, 2), ("b", 202403, 6), (None, None, 30)]
    assert rows(out.select("id", "id_tempo", "v")) == sorted(want, key=repr)
    assert rows(read_current(spark, path).select("id", "id_tempo", "v")) == sorted(want, key=repr)
    assert current(spark, path).values.count("202401") == 1


def test_packed_texts_come_back(spark):
    texts = [None, "", "a", "\x01", "\x02", "\x02n", "\x02e", "\x02m\x01", "\x01\x01", "é;\n", "n", "\x02\x02"]
    pairs = [(a, b) for a in texts for b in texts]
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("p", pack("a", "b"))
    df = df.withColumn("q", join_packs("p", pack(F.lit(None).cast("string"))))
    assert df.select("p").distinct().count() == len(pairs) and df.where("p IS NULL").count() == 0
    back = df.select("a", "b", *unpack("p", 2), *unpack("q", 3)).collect()
    assert all(tuple(r) == (r[0], r[1], r[0], r[1], r[0], r[1], None) for r in back)


def test_landed_feed_moves_its_texts_as_one(spark):
    dealt = plan_text(raw_feed(spark, SF_SMALL, with_period=True, clustered=True))
    moved = re.search(r"Input \[(\d+)\]: (.*)\nArguments: rangepartitioning\(month", dealt)
    assert int(moved[1]) == 9 and not re.search("c_name|s_name|p_type|o_orderpriority|c_mktsegment", moved[2])


def test_landed_feed_keeps_odd_texts(spark, tmp_table):
    src = tmp_table("tables")
    for name in ("lineitem", "orders", "customer", "part", "supplier", "nation", "region"):
        df = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        for c in {"c_name", "s_name", "p_type", "o_orderpriority", "c_mktsegment"} & set(df.columns):
            k = F.col(df.columns[0]) % 4
            df = df.withColumn(c, F.when(k == 0, None).when(k == 1, F.lit("\x01\x02")).when(k == 2, F.lit("")).otherwise(F.col(c)))
        df.write.parquet(f"{src}/{name}.parquet")
    plain, dealt = raw_feed(spark, src, with_period=True), raw_feed(spark, src, with_period=True, clustered=True)
    assert rows(dealt) == rows(plain) and plain.where("nm_terceirizado IS NULL").count() > 0
    bronze = stage(plain, with_timestamp=False)
    assert rows(fact_to_write(bronze)) == rows(build_fact(bronze))


def test_written_layers_leave_no_shuffle_files(spark, tmp_table):
    import os
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    moved = lambda: {f for x in folders for d, _, fs in os.walk(x) for f in fs if f.startswith("shuffle_") and f.endswith(".data")}
    had = moved()
    raw_feed(spark, SF_SMALL, clustered=True).write.partitionBy("periodo").parquet(tmp_table("landed"))
    fact_to_write(W.bronze(spark, SF_SMALL)).write.partitionBy("id_tempo").parquet(tmp_table("fact"))
    assert not moved() - had


def test_fact_build_moves_the_grain_as_one_text(spark):
    bronze = W.bronze(spark, SF_SMALL)
    moved = exchanges(build_fact(bronze))
    assert len(moved) == 1 and not re.search("unidade_gestora|orgao_nome|numero_contrato", moved[0])
    odd = bronze.limit(6).withColumns({"orgao_nome": F.lit("\x01\x02n"), "orgao_sigla": F.lit(None).cast("string"),
                                       "unidade_gestora_codigo": F.lit(None).cast("int")})
    both = bronze.unionByName(odd.withColumn("numero_contrato", F.lit(""))).unionByName(odd)
    assert rows(build_fact(both)) == rows(fact_to_write(both)) and "WindowGroupLimit" in plan_text(build_fact(both))
    key = latest_per_key(grain_rows(both), GRAIN, grain_order())
    assert rows(build_fact(both)) == rows(with_keys(key))
