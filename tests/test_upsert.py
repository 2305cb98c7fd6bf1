import pytest
from pyspark.sql import functions as F

from monthlake.operators.upsert import Commit, current, merge_frames, read_current, try_read, upsert_table
from monthlake.plans.fact import incremental_slice, newest_month


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


def test_merge_dedups_source_keeps_unmatched_target(spark):
    target = spark.createDataFrame([(1, "old"), (2, "keep"), (None, "nullkey")], "k int, v string")
    source = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (3, "new", 1), (None, "nk2", 1)],
                                   "k int, v string, m int")
    out = merge_frames(target, source, ["k"], [F.col("m").desc()], columns=["k", "v"])
    assert rows(out) == sorted([(1, "b"), (2, "keep"), (3, "new"), (None, "nk2")], key=repr)


def test_upsert_table_idempotent_and_versioned(spark, tmp_table):
    path = tmp_table("dim")
    src = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    upsert_table(spark, path, src, ["k"], ["v"])
    once = rows(read_current(spark, path))
    upsert_table(spark, path, src, ["k"], ["v"])
    assert rows(read_current(spark, path)) == once
    upsert_table(spark, path, spark.createDataFrame([(2, "z")], "k int, v string"), ["k"], ["v"])
    assert rows(read_current(spark, path)) == [(1, "a"), (2, "z")]


def test_partitioned_upsert_rewrites_only_touched_partitions(spark, tmp_table):
    path = tmp_table("fact")
    first = spark.createDataFrame([("a", 202401, 1), ("b", 202402, 2)], "id string, id_tempo int, v int")
    upsert_table(spark, path, first, ["id"], ["v"], partition="id_tempo")
    nxt = spark.createDataFrame([("b", 202402, 20), ("c", 202403, 3)], "id string, id_tempo int, v int")
    out = upsert_table(spark, path, nxt, ["id"], ["v"], columns=["id", "id_tempo", "v"], partition="id_tempo")
    assert rows(out, "id", "id_tempo", "v") == [("a", 202401, 1), ("b", 202402, 20), ("c", 202403, 3)]


def test_watermark(spark):
    src = spark.createDataFrame([(202401,), (202402,), (202403,)], "id_tempo int")
    assert rows(incremental_slice(src, 202402)) == [(202402,), (202403,)]
    assert rows(incremental_slice(src, 202402, backfill=True)) == [(202401,), (202402,), (202403,)]
    assert rows(incremental_slice(src, None)) == [(202401,), (202402,), (202403,)]
    assert newest_month(None) is None
    assert newest_month(Commit(1, (("202401", "a"), ("202312", "b"), ("__HIVE_DEFAULT_PARTITION__", "c")))) == 202401


def test_uncommitted_version_is_not_read(spark, tmp_table):
    path = tmp_table("dimv")
    # the first load died after its data was in place
    spark.createDataFrame([(8, "yy")], "k int, v string").write.parquet(f"{path}/data/version=1")
    assert read_current(spark, path) is None
    upsert_table(spark, path, spark.createDataFrame([(1, "a")], "k int, v string"), ["k"], ["v"])
    assert rows(read_current(spark, path)) == [(1, "a")]
    # and so did a later one
    spark.createDataFrame([(9, "zz")], "k int, v string").write.parquet(f"{path}/data/version=99999999999999999")
    upsert_table(spark, path, spark.createDataFrame([(2, "b")], "k int, v string"), ["k"], ["v"])
    assert rows(read_current(spark, path)) == [(1, "a"), (2, "b")]


FACT_ROWS = "id string, id_tempo int, v int"


def test_torn_first_fact_load_loses_no_month(spark, tmp_table):
    path = tmp_table("facttorn")
    # one month of the first load is in place, its commit entry is not
    spark.createDataFrame([("c", 202403, 3)], FACT_ROWS).write.partitionBy("id_tempo").parquet(f"{path}/data/version=1-new")
    assert newest_month(current(spark, path)) is None  # no watermark: everything is loaded
    src = spark.createDataFrame([("a", 202401, 1), ("b", 202402, 2), ("c", 202403, 3)], FACT_ROWS)
    out = upsert_table(spark, path, incremental_slice(src, newest_month(current(spark, path))), ["id"], ["v"],
                       columns=["id", "id_tempo", "v"], partition="id_tempo")
    assert rows(out, "id", "id_tempo", "v") == [("a", 202401, 1), ("b", 202402, 2), ("c", 202403, 3)]


def test_load_that_died_between_data_and_commit(spark, tmp_table):
    path = tmp_table("factdied")
    first = spark.createDataFrame([("a", 202401, 1), ("b", 202402, 2)], FACT_ROWS)
    upsert_table(spark, path, first, ["id"], ["v"], partition="id_tempo")
    before = current(spark, path)
    for kind, r in (("new", ("b", 202402, 20)), ("kept", ("x", 202402, 9))):
        spark.createDataFrame([r], FACT_ROWS).write.partitionBy("id_tempo").parquet(f"{path}/data/version=77-{kind}")
    assert current(spark, path) == before
    # the next load: watermark first, then the merge, as the pipeline does
    newest = newest_month(current(spark, path))
    assert newest == 202402
    src = spark.createDataFrame([("z", 202401, 0), ("c", 202402, 3), ("d", 202403, 4)], FACT_ROWS)
    out = upsert_table(spark, path, incremental_slice(src, newest), ["id"], ["v"],
                       columns=["id", "id_tempo", "v"], partition="id_tempo")
    assert rows(out, "id", "id_tempo", "v") == [("a", 202401, 1), ("b", 202402, 2), ("c", 202402, 3), ("d", 202403, 4)]


def test_other_read_errors_are_not_an_absent_table(spark, tmp_path):
    (tmp_path / "t").mkdir()
    assert try_read(spark, str(tmp_path / "t")) is None and try_read(spark, str(tmp_path / "none")) is None
    (tmp_path / "t" / "part-0.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception):  # noqa: B017, PT011
        try_read(spark, str(tmp_path / "t")).collect()


def test_ranked_upsert_is_order_free(spark, tmp_table):
    loads = [[(1, "new", 202403), (2, "b", 202403)], [(1, "old", 202401), (3, "c", 202401)], [(1, "newer", 202403)]]
    found = []
    for order in ((0, 1, 2), (1, 0, 2), (0, 2, 1)):
        path = tmp_table("dimrank")
        for i in order:
            out = upsert_table(spark, path, spark.createDataFrame(loads[i], "k int, v string, m int"), ["k"], None,
                               columns=["k", "v", "m"], rank=[F.col("m").desc_nulls_last()])
        found.append(rows(out))
    assert found == [[(1, "newer", 202403), (2, "b", 202403), (3, "c", 202401)]] * 3
