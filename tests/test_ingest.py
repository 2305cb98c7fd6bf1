import datetime as dt

import pytest
from pyspark.sql import types as T

from monthlake.sources.ingest import ingest_period, read_periods, read_raw, skip_existing, union_files, write_period
from monthlake.sources.manifest import diff_manifest, scan_manifest, select_layers, summarize


def test_csv_latin1_semicolon_and_tokens(spark, tmp_path):
    p = tmp_path / "terceirizados_2024-03.csv"
    p.write_bytes("id_terc;nm_orgao;nr_cnpj\n1;MINISTÉRIO DA EDUCAÇÃO;00123\n2;NA;\n".encode("latin-1"))
    df = read_raw(spark, str(p))
    assert df.dtypes == [("id_terc", "string"), ("nm_orgao", "string"), ("nr_cnpj", "string")]
    assert sorted(tuple(r) for r in df.collect()) == [("1", "MINISTÉRIO DA EDUCAÇÃO", "00123"), ("2", None, None)]
    with pytest.raises(ValueError):
        read_raw(spark, "x/terceirizados_2024-03.xlsx")
    with pytest.raises(ValueError):
        read_raw(spark, "x/terceirizados_2024-03.json")


def test_period_layout(spark, tmp_table):
    path = tmp_table("raw")
    a = spark.createDataFrame([("1", "2024-01"), ("2", "2024-02")], "id string, periodo string")
    write_period(a, path)
    write_period(spark.createDataFrame([("3", "2024-02")], "id string, periodo string"), path)
    # rewriting one period leaves the others
    assert sorted(tuple(r) for r in read_periods(spark, path).collect()) == [("1", "2024-01"), ("3", "2024-02")]
    one = read_periods(spark, path, period="2024-01")
    assert [r.id for r in one.collect()] == ["1"]
    assert all("periodo=2024-01/" in f for f in one.inputFiles())  # only its directory is opened
    with pytest.raises(FileNotFoundError):
        read_periods(spark, path, period="2099-01")
    with pytest.raises(ValueError, match="nome"):
        read_periods(spark, path, schema=T.StructType([T.StructField("id", T.StringType()), T.StructField("nome", T.StringType())]))
    incoming = spark.createDataFrame([("9", "2024-02"), ("8", "2024-03")], "id string, periodo string")
    assert [r.id for r in skip_existing(incoming, read_periods(spark, path)).collect()] == ["8"]
    u = union_files([spark.createDataFrame([("1",)], "a string"), spark.createDataFrame([("2", "x")], "a string, b string")])
    assert sorted(tuple(r) for r in u.collect()) == [("1", None), ("2", "x")]


def test_manifest_scan_and_diff(spark, tmp_path):
    for name in ("bronze/a.parquet", "gold/b.parquet"):
        f = tmp_path / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(b"x" * 10)
    m = scan_manifest(spark, str(tmp_path))
    assert {(r.path, r.length) for r in m.collect()} == {("bronze/a.parquet", 10), ("gold/b.parquet", 10)}
    # a scan feeds the sync plan as it is
    seen = scan_manifest(spark, str(tmp_path), time_col="updated")
    plan = diff_manifest(select_layers(seen, "all"), m.where("path like 'gold/%'"))
    assert {r.path: r.action for r in plan.collect()} == {"bronze/a.parquet": "download", "gold/b.parquet": "skip"}
    t = dt.datetime
    remote = spark.createDataFrame([("bronze/a", t(2024, 1, 2)), ("bronze/b", t(2024, 1, 1)), ("gold/c", t(2024, 1, 1))],
                                   "path string, updated timestamp")
    local = spark.createDataFrame([("bronze/a", t(2024, 1, 1)), ("gold/c", t(2024, 1, 1))], "path string, modified timestamp")
    d = diff_manifest(select_layers(remote, "all"), local)
    assert {r.path: r.action for r in d.collect()} == {"bronze/a": "download", "bronze/b": "download", "gold/c": "skip"}
    assert {r.path for r in diff_manifest(remote, local, "full").where("action = 'download'").collect()} == \
        {"bronze/a", "bronze/b", "gold/c"}
    s = {r.layer: (r.downloaded, r.skipped) for r in summarize(d).collect()}
    assert s == {"bronze": (2, 0), "ouro": (0, 1)}
    with pytest.raises(ValueError):
        select_layers(remote, "silver-ish")


def test_write_if_absent(spark, tmp_table):
    from monthlake.sources.ingest import write_if_absent
    path = tmp_table("cache")
    write_if_absent(spark.createDataFrame([(1,)], "a int"), path)
    write_if_absent(spark.createDataFrame([(2,)], "a int"), path)
    assert [r.a for r in spark.read.parquet(path).collect()] == [1]


def test_csv_like_the_published_files(spark, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_bytes('id;nome;cnpj\n1;"EMPRESA ""X"" LTDA";00\n2;"C:\\dir\\";" x "\n3;"duas\nlinhas; aqui";""\n'.encode("latin-1"))
    b.write_bytes("cnpj;id;nome\n77;4;JOSÉ\n".encode("latin-1"))
    got = {r.id: (r.nome, r.cnpj) for r in read_raw(spark, [str(a), str(b)]).collect()}
    assert got == {"1": ('EMPRESA "X" LTDA', "00"), "2": ("C:\\dir\\", " x "), "3": ("duas\nlinhas; aqui", None), "4": ("JOSÉ", "77")}


def test_ingest_period(spark, tmp_path, tmp_table):
    f, path = tmp_path / "t_2024-03.csv", tmp_table("landed")
    f.write_bytes("ID;nome\n1;NA\n2;é\n".encode("latin-1"))
    with pytest.raises(ValueError, match="cpf"):
        ingest_period(spark, str(f), path, "2024-03", required=["id", "cpf"])
    assert ingest_period(spark, str(f), path, "2024-03", required=["id", "nome"])
    f.write_bytes(b"ID;nome\n9;x\n")
    assert not ingest_period(spark, str(f), path, "2024-03", required=["id", "nome"])  # landed before: not read again
    assert sorted(tuple(r) for r in read_periods(spark, path, period="2024-03").collect()) == [
        ("1", None, "2024-03"), ("2", "é", "2024-03")]


def test_run_needs_a_landed_period(spark, tmp_table):
    from monthlake.plans import warehouse as W
    from monthlake.plans.pipeline import one_period, run
    W.raw(spark, "/root/testdata/sf0.001")
    raw = W.layer_path(spark, "/root/testdata/sf0.001", "raw")
    with pytest.raises(FileNotFoundError):
        run(spark, tmp_table("absent"), "2099-01", raw=raw)
    with pytest.raises(FileNotFoundError):
        run(spark, tmp_table("absent"), raw=raw)  # the default: the current month
    assert one_period(spark, "2024-3") == "2024-03"
    assert one_period(spark, None) == spark.sql("select date_format(current_date(), 'yyyy-MM')").first()[0]
    with pytest.raises(Exception):  # noqa: B017, PT011
        one_period(spark, "2024-13")


def test_layer_columns_carry_descriptions(spark, tmp_table):
    from monthlake.plans.pipeline import MART_TABLE, read_layer, run
    from monthlake.plans import warehouse as W
    base = tmp_table("described")
    W.raw(spark, "/root/testdata/sf0.001")
    run(spark, base, "*", raw=W.layer_path(spark, "/root/testdata/sf0.001", "raw"))
    mart = read_layer(spark, base, MART_TABLE)
    assert mart.schema["cpf"].metadata.get("comment") == "worker tax id, pre-masked"
    bronze = read_layer(spark, base, "bronze")
    assert bronze.schema["cpf"].metadata.get("comment") == "worker tax id, pre-masked"
    assert all(f.metadata.get("comment") for f in read_layer(spark, base, "dim_orgaos").schema.fields)


def test_compressed_text_lands_whole_and_leaves_no_records(spark, tmp_table):
    import os

    from monthlake.session import shared_root
    from monthlake.sources.ingest import write_csv
    rows = [(str(k), [None, "", 'q"q', "two\nlines; x", " é "][k % 5]) for k in range(1000)]
    drop, path = tmp_table("drop"), tmp_table("landed")
    write_csv(spark.createDataFrame(rows, "a string, b string").coalesce(1), drop, compression="gzip", rows_per_file=300)
    files = [f for f in os.listdir(drop) if f.startswith("part-")]
    assert len(files) == 4 and all(f.endswith(".csv.gz") for f in files)
    root = f"{shared_root(spark)}/monthlake"
    texts = lambda: {x for x in os.listdir(root) if x.startswith("text-")}
    had = texts()
    assert ingest_period(spark, drop, path, "2024-03", required=["a", "b"], fmt="csv", tokens=None)
    assert sorted(tuple(r) for r in read_periods(spark, path).select("a", "b").collect()) == sorted(rows, key=lambda r: r[0])
    with pytest.raises(ValueError):
        ingest_period(spark, drop, path, "2024-04", required=["c"], fmt="csv")
    assert texts() == had
