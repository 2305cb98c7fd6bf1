import datetime as dt

import pytest
from pyspark.sql import functions as F

from monthlake.functions import (
    download_url, extension, file_name, format_http_date, nullify_tokens, parse_http_date,
    parse_period, split_code_name, surrogate_key, to_int, to_money,
)


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {dtype}")


def test_tolerant_int(spark):
    df = one_col(spark, ["123", " 123 ", "123.0", "123.5", "-2.5", None])
    assert [r[0] for r in df.select(to_int("v")).collect()] == [123, 123, 123, 124, -3, None]


@pytest.mark.parametrize("bad", ["", "x"])
def test_tolerant_int_rejects_garbage(spark, bad):
    with pytest.raises(Exception):
        one_col(spark, [bad]).select(to_int("v")).collect()


def test_money(spark):
    df = one_col(spark, ["1234.565"])
    assert str(df.select(to_money("v")).first()[0]) == "1234.57"
    assert str(one_col(spark, ["1.234,56"]).select(to_money("v", decimal_comma=True)).first()[0]) == "1234.56"
    with pytest.raises(Exception):
        one_col(spark, ["1.234,56"]).select(to_money("v")).collect()


def test_category_split(spark):
    code, name = split_code_name(F.col("v"))
    rows = one_col(spark, ["519940 - LEITURISTA - X", None]).select(code, name).collect()
    assert [tuple(r) for r in rows] == [(519940, "LEITURISTA"), (None, None)]
    # no separator: empty name, and the code text is not a number -> error
    assert one_col(spark, ["SEM"]).select(name).first()[0] == ""
    with pytest.raises(Exception):
        one_col(spark, ["SEM"]).select(code).collect()


def test_surrogate_key_null_and_position_aware(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("ab", "c"), ("a", "bc")], "x string, y string")
    keys = [r[0] for r in df.select(surrogate_key("x", "y")).collect()]
    assert len(set(keys)) == 4 and all(k is not None for k in keys)
    # int and long inputs give the same key (text form), unlike xxhash64
    a = spark.range(1).select(surrogate_key(F.lit(1)), surrogate_key(F.lit(1).cast("bigint"))).first()
    assert a[0] == a[1]


def test_null_tokens(spark):
    df = one_col(spark, ["NA", "null", "", "NAO"])
    assert [r[0] for r in df.select(nullify_tokens("v")).collect()] == [None, None, None, "NAO"]


@pytest.mark.parametrize("text, expect", [
    ("2024-09", ("2024", "09", "setembro")),
    ("03/2024", ("2024", "03", "marco")),
    ("março 2024", ("2024", "03", "marco")),
    ("set 2024", ("2024", "09", "setembro")),
    ("13/2024", ("2024", "13", None)),
    ("092024", ("0920", "24", None)),
    ("fevereiro", (None, "02", "fevereiro")),
    ("nada", (None, None, None)),
])
def test_parse_period(spark, text, expect):
    r = one_col(spark, [text]).select(parse_period("v").alias("p")).select("p.*").first()
    assert tuple(r) == expect


def test_http_dates(spark):
    df = one_col(spark, ["Wed, 21 Oct 2015 07:28:00 GMT", "garbage", None])
    got = [r[0] for r in df.select(parse_http_date("v")).collect()]
    assert got == [dt.datetime(2015, 10, 21, 7, 28), None, None]
    ts = spark.createDataFrame([(dt.datetime(2015, 10, 21, 7, 28),)], "t timestamp_ntz")
    assert ts.select(format_http_date("t")).first()[0] == "Wed, 21 Oct 2015 07:28:00 GMT"


def test_links(spark):
    link = "https://x.gov/arquivos/terceirizados_2024-03.CSV/view"
    r = one_col(spark, [link]).select(download_url("v"), file_name("v"), extension(file_name("v"))).first()
    assert tuple(r) == ("https://x.gov/arquivos/terceirizados_2024-03.CSV/@@download/file",
                        "terceirizados_2024-03.CSV", "csv")


def test_to_period(spark):
    from monthlake.functions import to_period
    df = one_col(spark, ["março 2024", "03/2024", "2024-9", "nada"])
    assert [r[0] for r in df.select(to_period("v")).collect()] == ["2024-03", "2024-03", "2024-09", None]
    with pytest.raises(Exception):
        one_col(spark, ["13/2024"]).select(to_period("v")).collect()


def test_to_int_raises_whatever_the_ansi_setting(spark):
    from monthlake.functions.casts import to_int
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            good = spark.createDataFrame([("12",), (" 7.0 ",), (None,), ("-2147483648",)], "c string")
            assert [r[0] for r in good.select(to_int("c")).collect()] == [12, 7, None, -2147483648]
            for bad in ("abc", "", "3000000000"):
                with pytest.raises(Exception):  # noqa: B017, PT011
                    spark.createDataFrame([(bad,)], "c string").select(to_int("c")).collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_typing_stays_small_enough_to_be_compiled(spark):
    import contextlib
    import io
    import re
    from conftest import SF_SMALL
    from monthlake.plans.staging import stage
    from monthlake.sources.feed import raw_feed
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            stage(raw_feed(spark, SF_SMALL), with_timestamp=False).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", buf.getvalue())]
    assert sizes and max(sizes) <= 8000  # the JVM leaves larger methods interpreted
