"""A key holding a third of all rows: results stay whole and exact, and the per-key
top-1 is cut map-side before the shuffle."""

from pyspark.sql import functions as F

from conftest import plan_text
from monthlake.operators.dedup import latest_per_key
from monthlake.operators.quality import check_unique


def hot_frame(spark, n=30_000):
    # key 0 holds a third of the rows, the rest are spread over 1000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        F.col("id").alias("v"))


def test_latest_per_key_hot_key(spark):
    df = hot_frame(spark)
    top = latest_per_key(df, ["k"], [F.col("v").desc()])
    got = {r.k: r.v for r in top.collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg(F.max("v").alias("m")).collect()}
    assert got == want
    plan = plan_text(top)
    partial = plan.index("WindowGroupLimit")
    # the first WindowGroupLimit in the printed tree is the final one; a partial one must
    # also appear, below the exchange
    assert "Partial" in plan[partial:] and "Exchange" in plan


def test_unique_check_hot_key(spark):
    df = hot_frame(spark)
    bad = {r.k: r.n_records for r in check_unique(df, "k").collect()}
    assert bad[0] == 10_000 and len(bad) == 1001
    assert "partial_count" in plan_text(check_unique(df, "k"))


def test_unique_check_of_texts_compares_rows_of_repeated_hashes_only(spark, monkeypatch):
    from pyspark.sql import Row
    from monthlake.operators import quality as Q
    one = [("a", "x", 1)] * 3 + [("b", None, 1), (None, "b", 1), (None, None, None), (None, None, None), ("c", "x", 2), ("c", "x", 3)]
    df = spark.createDataFrame(one, "k string, l string, n int")
    want = [Row(k="a", n_records=3), Row(k="c", n_records=2)]
    pairs = {("a", "x", 1): 3, (None, None, None): 2}
    for most, same_hash in ((1_000_000, False), (1_000_000, True), (0, False)):
        monkeypatch.setattr(Q, "MOST_HASHES", most)
        if same_hash:  # all keys collide
            monkeypatch.setattr(Q.F, "xxhash64", lambda *cols: F.lit(7).cast("bigint"))
        single, both = check_unique(df, "k"), Q.check_unique_combination(df, ["k", "l", "n"])
        assert sorted(single.collect()) == want and single.columns == ["k", "n_records"]
        assert {(r.k, r.l, r.n): r.n_records for r in both.collect()} == pairs
        assert ("LeftSemi" in plan_text(single)) == ("LeftSemi" in plan_text(both)) == (most > 0)
        monkeypatch.undo()
    assert check_unique(spark.range(5).select(F.col("id").cast("string").alias("k")), "k").count() == 0


def test_relationship_check_hot_key(spark):
    from monthlake.operators.quality import check_relationship
    child = hot_frame(spark)
    parent = spark.range(1, 1001).withColumnRenamed("id", "p")  # key 0 is missing
    assert check_relationship(child, parent, "k", "p").count() == 10_000
