from conftest import plan_text

from monthlake.operators.upsert import current, upsert_table
from monthlake.session import shared_root
from monthlake.sources.ingest import register_table


def test_partitioned_table_is_registered_and_follows_loads(spark, tmp_table):
    path, name = tmp_table("fact"), "fact_registered_test"
    where = f"{shared_root(spark)}/monthlake/gold.db"
    load = lambda rows: upsert_table(spark, path, spark.createDataFrame(rows, "id string, id_tempo int, v int"),
                                     ["id"], None, columns=["id", "id_tempo", "v"], partition="id_tempo")
    load([("a", 202401, 1), ("b", 202402, 2), ("x", 202402, 9)])
    got = register_table(spark, path, name, "gold", db_location=where, comment="it's the fact")
    assert sorted(map(tuple, got.select("id", "id_tempo", "v").collect())) == [("a", 202401, 1), ("b", 202402, 2), ("x", 202402, 9)]
    # a month now lies in two directories: new rows and kept ones
    load([("b", 202402, 20), ("c", 202403, 3)])
    assert len([p for p, _ in current(spark, path).parts if p == "202402"]) == 2
    got = register_table(spark, path, name, "gold", db_location=where)
    want = [("a", 202401, 1), ("b", 202402, 20), ("c", 202403, 3), ("x", 202402, 9)]
    assert sorted(map(tuple, got.select("id", "id_tempo", "v").collect())) == want
    assert sorted(map(tuple, spark.sql(f"SELECT id, id_tempo, v FROM gold.{name}").collect())) == want
    month = spark.sql(f"SELECT * FROM gold.{name} WHERE id_tempo = 202403")
    assert [r.id for r in month.collect()] == ["c"]
    plan = plan_text(month)
    assert "PartitionFilters: [isnotnull(id_tempo" in plan and "(id_tempo#" in plan
    assert "CatalogFileIndex" in plan or "InMemoryFileIndex" in plan
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN gold LIKE '{name}__v*'").collect()] == [f"{name}__v{current(spark, path).version}"]
    assert "load_dir" not in got.columns
    again = register_table(spark, path, name, "gold", db_location=where)  # no new commit: nothing changes
    assert again.count() == 4
    # the tables that went were external: older versions' files are still there
    assert spark.read.parquet(f"{path}/data").count() > 4
