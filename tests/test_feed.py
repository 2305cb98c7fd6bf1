from pyspark.sql import functions as F

from conftest import SF_SMALL
from monthlake.schemas import RAW_COLUMNS
from monthlake.sources.feed import raw_feed


def test_feed_contract(spark):
    feed = raw_feed(spark, SF_SMALL, with_period=True)
    assert feed.columns == [*RAW_COLUMNS, "periodo"]
    assert all(t == "string" for _, t in feed.dtypes)
    lineitems = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert feed.count() == lineitems  # one raw row per line item, no join losses
    r = feed.where(F.col("nr_cnpj").startswith("0")).first()
    assert len(r.nr_cnpj) == 14  # leading zeros kept as text
    assert r.nr_cpf.startswith("***.") and r.nr_cpf.endswith(".***-**")
