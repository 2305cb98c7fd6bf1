"""Delimited text read in ranges equals Spark's own reader of whole files."""

import random
import re
from collections import Counter

import pytest
from conftest import plan_text

from monthlake.sources import quoted
from monthlake.sources.ingest import NO_TEXT, read_raw, union_files

FIELDS = ["a", "", '""', '"x; y"', '"two\nlines"', '"q ""z"" q"', ' pad ', '"\n\n"', '"é\n;""\n"', "é", '"long ' + "w\n" * 40 + '"', '"r\r\nn"', "NA"]


def whole_files(spark, paths, encoding="ISO-8859-1"):
    """Spark's multiLine reader, one file at a time."""
    return [spark.read.options(header=True, sep=";", encoding=encoding, quote='"', escape='"', multiLine=True, inferSchema=False,
                               mode="FAILFAST", nullValue=NO_TEXT).csv(p) for p in paths]


@pytest.mark.parametrize(("seed", "range_bytes", "end"), [(1, 16, "\n"), (2, 64, "\n"), (3, 257, "\r\n"), (4, 1 << 20, "\n")])
def test_ranges_equal_the_whole_file_reader(spark, tmp_path, seed, range_bytes, end):
    rng = random.Random(seed)
    paths = []
    for n, head in enumerate(("id;v;w", "id;v;w", "w;id;v", '"id";"v";"x"')):
        rows = [f"{n * 1000 + k};{rng.choice(FIELDS)};{rng.choice(FIELDS)}" if n != 2 else f"{rng.choice(FIELDS)};{n * 1000 + k};b" for k in range(60)]
        p = tmp_path / f"f{n}.csv"
        p.write_bytes((end.join([head, *rows]) + (end if n else "")).encode("latin-1"))
        paths.append(str(p))
    got = quoted.read_quoted(spark, paths, ";", "ISO-8859-1", True, NO_TEXT, range_bytes)
    assert [f.columns for f in got] == [["id", "v", "w"], ["w", "id", "v"], ["id", "v", "x"]]
    columns = ["id", "v", "w", "x"]
    # In a file of \r\n lines Spark's reader turns those inside quotes into \n; here they stay.
    def plain(frames):
        return Counter(tuple(v and v.replace("\r\n", "\n") if end == "\r\n" else v for v in r) for r in union_files(frames).select(columns).collect())

    assert plain(got) == plain(whole_files(spark, paths))
    assert end == "\n" or any("\r\n" in (r.v or "") for f in got for r in f.collect())


def test_a_file_with_line_breaks_is_read_by_many_tasks(spark, tmp_path):
    p = tmp_path / "big.csv"
    p.write_bytes(("id;v\n" + "".join(f'{k};"line\nbreak; {k}"\n' for k in range(20_000))).encode())
    lines = quoted._lines(spark, [str(p)], 1 << 16)
    assert lines.rdd.getNumPartitions() > 4
    [got] = quoted.read_quoted(spark, [str(p)], ";", "UTF-8", True, NO_TEXT, 1 << 16)
    assert got.count() == 20_000 and got.where("v = concat('line\\nbreak; ', id)").count() == 20_000
    records = next(f for f in got.inputFiles()).rsplit("/group=", 1)[0]
    kinds = Counter(r.kind for r in spark.read.parquet(records).collect())
    assert kinds[quoted.WHOLE] > 19_900 and kinds[quoted.TAIL] > 0  # only pieces at the ranges' ends are joined


def test_files_of_one_header_are_one_scan(spark, tmp_path):
    for n in range(300):
        head, row = (("a;b", f"{n};x"), ("b;a", f"y;{n}"), ("a;c", f"{n};z"))[n % 3]
        (tmp_path / f"f{n:03}.csv").write_bytes(f"{head}\n{row}\n".encode())
    df = read_raw(spark, [str(tmp_path / f"f{n:03}.csv") for n in range(300)])
    assert sorted(df.columns) == ["a", "b", "c"] and df.count() == 300
    assert Counter((r.b, r.c) for r in df.collect()) == Counter({("x", None): 100, ("y", None): 100, (None, "z"): 100})
    scans = set(re.findall(r"\(group#\d+ = (\d)\)", plan_text(df)))
    assert scans == {"0", "1", "2"}
    tables = []
    for n, schema in enumerate(("a int, b string", "a int, b string", "a string, c int")):
        spark.createDataFrame([(n, "x") if n < 2 else ("2", 3)], schema).write.parquet(str(tmp_path / f"t{n}.parquet"))
        tables.append(str(tmp_path / f"t{n}.parquet"))
    both = read_raw(spark, tables)
    assert plan_text(both).split("\n\n")[0].count("Scan parquet") == 2
    assert sorted(map(tuple, both.select("a", "b", "c").collect()), key=str) == [("0", "x", None), ("1", "x", None), ("2", None, "3")]


def test_odd_files(spark, tmp_path):
    def read(text, header=True, encoding="UTF-8"):
        p = tmp_path / f"o{random.random()}.csv"
        p.write_bytes(text.encode(encoding))
        return quoted.read_quoted(spark, [str(p)], ";", encoding, header, NO_TEXT)

    assert read("") == [] == read("\n\n\r\n")
    [head] = read("a;b\n")
    assert head.columns == ["a", "b"] and head.collect() == []
    [bom] = read('﻿"a\nx";b\n\n1;2\n\n')
    assert bom.columns == ["a\nx", "b"] and [tuple(r) for r in bom.collect()] == [("1", "2")]
    [late] = read('\n\na;b\n"1\n1";2\n')
    assert [tuple(r) for r in late.collect()] == [("1\n1", "2")]
    [none] = read("1;2\n3;4\n", header=False)
    assert none.columns == ["_c0", "_c1"] and len(none.collect()) == 2
    with pytest.raises(ValueError, match="not closed"):
        read('a;b\n1;"2\n3;4\n')
    with pytest.raises(ValueError, match="twice"):
        read("a;a\n1;2\n")
    with pytest.raises(ValueError, match="ranges"):
        read("a;b\n1;2\n", encoding="UTF-16")
    with pytest.raises(Exception, match="quote in a field"):
        read('a;b\n1;5" pipe\n2;6" pipe\n')[0].collect()
    with pytest.raises(Exception):  # noqa: B017, PT011 - fewer fields than the header
        read("a;b\n1\n")[0].collect()
