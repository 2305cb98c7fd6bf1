import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from monthlake.operators.serve import envelope, lookup, page, total_rows, write_serving
from monthlake.sources.catalog import candidates, extract_links, latest_version


@pytest.fixture()
def people(spark):
    return spark.createDataFrame([(i, f"n{i}") for i in range(1, 26)] + [(None, "nokey")], "id int, name string")


@pytest.fixture()
def people_path(people, tmp_table):
    path = tmp_table("people")
    write_serving(people, path, "id")
    return path


def test_page_and_envelope(spark, people, people_path):
    turn = lambda *a: page(spark, people_path, "id", *a)
    assert [r.id for r in turn(0, 3).collect()] == [1, 2, 3]
    assert [r.id for r in turn(24, 20).collect()] == [25, None]  # NULL key sorts last
    assert len(turn(0, 500).collect()) == 26  # clamp to 200
    assert turn(0, 0).collect() == [] == turn(99, 5).collect()
    e = envelope(people, 0, 0).first()
    assert (e.total, e.next) == (26, 0) and total_rows(spark, people_path) == 26
    assert envelope(people, 20, 20).first().next is None
    assert envelope(people, 0, 500).first().limit == 200
    for b, n in ((-1, 20), (0, -1), ("x", 1)):
        with pytest.raises(ValueError):
            turn(b, n)


def test_lookup(spark, people_path):
    rows, env = lookup(spark, people_path, "id", 3, 0, 5)
    assert [r.name for r in rows.collect()] == ["n3"]
    assert tuple(env.first()) == (3, 0, 5, 1, None)
    with pytest.raises(LookupError):
        lookup(spark, people_path, "id", 999)
    with pytest.raises(ValueError):
        lookup(spark, people_path, "id", 3, 0, 0)


def test_pages_of_one_hot_id_over_many_files(spark, tmp_table):
    df = spark.range(9000).select((F.col("id") % 3 * (F.col("id") % 7)).alias("k"), F.col("id").alias("v"))
    path = tmp_table("hot")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_serving(df, path, "k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    everything = [tuple(r) for r in df.orderBy("k", "v").collect()]
    assert len(spark.read.parquet(path + "/data").inputFiles()) > 1
    for b, n in ((0, 20), (3990, 200), (8990, 20)):
        assert [tuple(r) for r in page(spark, path, "k", b, n).collect()] == everything[b:b + n]
    zeros = [r for r in everything if r[0] == 0]
    for b in (0, 100, len(zeros) - 5):
        rows, env = lookup(spark, path, "k", 0, b, 50)
        assert [tuple(r) for r in rows.collect()] == zeros[b:b + 50]
        assert env.first().total == len(zeros)


def test_every_depth_has_one_plan(spark, people_path):
    shape = lambda b: re.sub(r"\d+", "N", plan_text(page(spark, people_path, "id", b, 5)).split("\n\n")[0])
    assert shape(0) == shape(12) and "Exchange" not in shape(0)


def test_lookup_opens_only_files_that_can_hold_the_id(spark, tmp_table):
    from monthlake.operators.serve import key_files
    df = spark.range(9000).select((F.col("id") % 3000 * 2).cast("int").alias("k"), F.col("id").alias("v"))
    hot = spark.range(5000).select(F.lit(3000).alias("k"), (F.col("id") + 10_000).alias("v"))
    path = tmp_table("files")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_serving(df.unionByName(hot), path, "k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    index = spark.read.parquet(f"{path}/_index").orderBy("start").collect()
    data = f"{path}/data/version={spark.read.parquet(f'{path}/_index').first().version}"
    assert len(index) >= 6
    ends, inner, start = key_files(spark, path, 3000)
    assert len(ends) <= 3 and inner > 0 and start is not None  # files of the hot id alone are counted by the index
    ends, inner, start = key_files(spark, path, 10)
    assert [f.file for f in ends] == [index[0].file] and (inner, start) == (0, None)
    # every other file is unreadable: the lookup does not notice
    import os
    for f in index[1:]:
        with open(f"{data}/{f.file}".removeprefix("file:"), "wb") as out:
            out.write(b"gone")
        crc = f"{data}/.{f.file}.crc"
        if os.path.exists(crc):
            os.remove(crc)
    rows, env = lookup(spark, path, "k", 10, 0, 20)
    assert [r.v for r in rows.collect()] == [5, 3005, 6005] and env.first().total == 3
    with pytest.raises(LookupError):
        lookup(spark, path, "k", 11)  # within the first file's keys, but not there
    with pytest.raises(LookupError):
        lookup(spark, path, "k", 10**6)  # beyond all files: none is opened


def test_serving_envelope_opens_no_data_file(spark, people, people_path):
    from monthlake.operators.serve import serving_envelope
    got = serving_envelope(spark, people_path, 20, 4)
    assert tuple(got.first()) == (20, 4, 26, 24) and tuple(envelope(people, 20, 4).first()) == (20, 4, 26, 24)
    assert got.dtypes == envelope(people, 20, 4).dtypes
    assert all("/_totals/" in f for f in got.inputFiles()) and "/data/" not in plan_text(got)
    write_serving(people.limit(7), people_path, "id")
    assert serving_envelope(spark, people_path, 0, 5).first().total == 7
    write_serving(people.limit(0), people_path, "id")
    assert tuple(serving_envelope(spark, people_path, 0, 5).first()) == (0, 5, 0, None)


def test_bloom_filter_of_the_key_is_written(spark, people_path):
    jvm = spark._jvm
    file = next(f for f in page(spark, people_path, "id", 0, 5).inputFiles())
    path = jvm.org.apache.hadoop.fs.Path(file)
    conf = spark._jsc.hadoopConfiguration()
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf))
    columns = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in reader.getFooter().getBlocks().get(0).getColumns()}
    reader.close()
    assert columns["id"] > 0 and columns["name"] <= 0


LISTING = """<html><body>
<article class="entry"><a href="https://x.gov/arq/Terceirizados_202403.csv/view">mar</a></article>
<article class="entry"><a href="https://x.gov/arq/terceirizados-marco-2024.XLSX/view">mar</a></article>
<article class="entry"><a href="https://x.gov/arq/terceirizados_202402.csv/view">fev</a></article>
<article class="entry"><a href="https://x.gov/arq/leiame-202403.pdf">doc</a></article>
<article class="entry"><a href="https://x.gov/arq/Terceirizados_202403.csv/view">dup</a></article>
</body></html>"""


def test_candidates(spark):
    extra = ('<nav><a href="/menu_202403.csv">m</a></nav><ARTICLE class="tile entry"><p><A id=1 HREF=\'/b_202403.csv?a=1&amp;b=2\'>'
             '</A><a href="/second_202403.csv">s</a></ARTICLE><article class="entry">none</article><article class="entryway">'
             '<a href="/not_202403.csv">n</a></article>')
    pages = spark.createDataFrame([(1, "u", LISTING), (2, "u", extra), (3, "u", None)], "page_id long, url string, html string")
    links = extract_links(pages)
    assert links.where("page_id = 1").count() == 5
    assert [tuple(r) for r in links.where("page_id = 2").collect()] == [(2, 0, "/b_202403.csv?a=1&b=2")]
    got = sorted(r.href for r in candidates(links, "2024", "03", "marco").collect())
    assert got == ["/b_202403.csv?a=1&b=2", "https://x.gov/arq/Terceirizados_202403.csv/view",
                   "https://x.gov/arq/terceirizados-marco-2024.XLSX/view"]


def test_latest_version(spark):
    t = dt.datetime
    df = spark.createDataFrame([
        ("p1", "a", None), ("p1", "b", t(2024, 3, 1)), ("p1", "c", t(2024, 3, 5)),   # newest dated wins
        ("p2", "b", None), ("p2", "a", None),                                        # all undated: first link
        ("p3", "b", t(2024, 1, 1)), ("p3", "a", t(2024, 1, 1)),                      # equal dates: first link
    ], "period string, link string, modified timestamp_ntz")
    got = {r.period: r.link for r in latest_version(df, "period", "modified", "link").collect()}
    assert got == {"p1": "c", "p2": "a", "p3": "a"}


def test_row_json_keeps_nulls(spark):
    from monthlake.operators.serve import row_json
    df = spark.createDataFrame([(1, None)], "id int, cnpj string")
    assert row_json(df).first()[0] == '{"id":1,"cnpj":null}'


def test_serving_rows_move_their_texts_as_one_and_come_in_page_order(spark, tmp_table):
    import re

    from monthlake.operators import serve
    texts = [None, "", "\x01", "\x02n", "b", "a\x02", "é"]
    rows = [(k % 3, a, 1.5 * k, b) for k, (a, b) in enumerate((a, b) for a in texts for b in texts)] * 2
    df = spark.createDataFrame(rows, "k int, a string, d double, b string")
    moved = re.findall(r"Exchange\nInput \[\d+\]: (.*)\nArguments: rangepartitioning", plan_text(serve._in_ranges(df, "k")))
    assert len(moved) == 1 and moved[0].count("#") == 3
    path = tmp_table("odd-pages")
    serve.write_serving(df, path, "k")
    assert [tuple(r) for r in serve.page(spark, path, "k", 0, 200).collect()] == [
        tuple(r) for r in df.orderBy(*serve.page_order(df.columns, "k")).collect()]
    assert serve.page(spark, path, "k", 30, 20).collect() == df.orderBy(*serve.page_order(df.columns, "k")).collect()[30:50]
