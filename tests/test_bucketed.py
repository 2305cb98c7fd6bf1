import itertools

from conftest import plan_text
from pyspark.sql import functions as F

from monthlake.operators.bucketed import bucket_table, buckets_of, merged_keys, upsert_bucketed
from monthlake.operators.upsert import current, read_current, upsert_table

COLUMNS = ["k", "v", "m"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, m int")


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_target_is_not_shuffled(spark, tmp_table):
    path = tmp_table("dim")
    many = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.lit("a").alias("v"), F.lit(1).alias("m"))
    upsert_bucketed(spark, path, many, "k", COLUMNS, "m", buckets=5)
    folder = current(spark, path).parts[0][1]
    assert buckets_of(folder) == 5
    with bucket_table(many, f"{path}/data/{folder}", "k", 5) as target:
        source = frame(spark, [("7", "b", 2), ("new", "c", 2)])
        plan = plan_text(merged_keys(target, source, "k", "m"))
        top = plan.split("\n\n")[0]
        assert top.count("Exchange") == 1 and "Bucketed: true" in plan
        target_side = top.split("SortMergeJoin", 1)[1].split("Exchange", 1)[0]
        assert "Scan parquet" in target_side  # the target's scan comes before the only exchange, the source's
    got = upsert_bucketed(spark, path, source, "k", COLUMNS, "m", buckets=99)
    assert got.count() == 5001 and rows(got.where("m = 2")) == [("7", "b", 2), ("new", "c", 2)]
    assert buckets_of(current(spark, path).parts[0][1]) == 5  # fixed by the first load
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_any_order_of_loads_and_null_keys(spark, tmp_table):
    loads = [[("a", "new", 3), ("b", "b", 3), (None, "n3", 3)], [("a", "old", 1), ("c", "c", 1), (None, "n1", 1)],
             [("d", "no month", None), ("e", "e", 2)], [("a", "newer", 3), ("d", "d", 2)]]
    want = None
    for order in itertools.permutations(range(3)):
        path = tmp_table("dim")
        for i in (*order, 3):
            out = upsert_bucketed(spark, path, frame(spark, loads[i]), "k", COLUMNS, "m", buckets=3)
        want = want or rows(out)
        assert rows(out) == want
    assert want == sorted([("a", "newer", 3), ("b", "b", 3), ("c", "c", 1), ("d", "d", 2), ("e", "e", 2), (None, "n3", 3)], key=repr)


def test_table_without_buckets_becomes_one(spark, tmp_table):
    path = tmp_table("dim")
    upsert_table(spark, path, frame(spark, [("a", "x", 1), (None, "n", 1)]), ["k"], None)
    upsert_bucketed(spark, path, frame(spark, [("b", "y", 1)]), "k", COLUMNS, None, buckets=2)
    upsert_bucketed(spark, path, frame(spark, [("a", "z", 0)]), "k", COLUMNS, None)
    assert rows(read_current(spark, path)) == sorted([("a", "z", 0), ("b", "y", 1), (None, "n", 1)], key=repr)


def test_empty_loads(spark, tmp_table):
    path = tmp_table("dim")
    assert rows(upsert_bucketed(spark, path, frame(spark, [("a", "x", 1)]).limit(0), "k", COLUMNS, "m", buckets=2)) == []
    assert rows(upsert_bucketed(spark, path, frame(spark, [("a", "x", 1)]), "k", COLUMNS, "m")) == [("a", "x", 1)]
    assert rows(upsert_bucketed(spark, path, frame(spark, [("a", "x", 1)]).limit(0), "k", COLUMNS, "m")) == [("a", "x", 1)]
