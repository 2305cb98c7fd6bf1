"""Exact deduplication with keyed streaming state on disk.

1. Content table: every document's digest, length and content locator (file and row number of
   the text), without the text.
2. A Structured Streaming aggregation consumes it. Its RocksDB state is keyed by digest and
   never expires; it holds the copies' number and the kept row (largest id) with its locator.
   Each micro-batch aggregates partially before the shuffle, so a group of copies sends one row
   per task however large it is.
3. Hits (digests seen more than once) are compared by their full bytes: distinct texts per digest,
   aggregated in every task before the shuffle, so a group of copies sends one text per task. Only
   texts that may be hits take part: a bit filter of fixed size drops the others at the scan.
4. Should two different texts share a digest, their rows are grouped by the text itself.
5. Rows of groups that hold a ``HOT``-th of the table or more (at most ``HOT`` groups, hence
   broadcast) get their decision where they are scanned; the others by a join on the digest.

All of it is DataFrame operations. Defined cases: null text counts as empty; null ids sort
below all others; rows repeated in full form one group, of which one row stays; an empty table
gives no rows; extra columns are ignored (``dedup_rows`` keeps them).
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake.llm.common import bit_filter, plain_scan, whole_row, with_maybe, write_shared
from monthlake.session import scratch_path

Digest = Callable[[Column], Column]
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # many small stores
}
LOCATOR = ("file", "row")
HOT = 1000


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def located(docs: DataFrame, *keep: Column) -> DataFrame:
    """``keep`` and the place of every row, ``__file, __row``; a frame that is no plain file scan
    is written first."""
    return plain_scan(docs).select(*keep, F.col("_metadata.file_path").alias("__file"),
                                   F.col("_metadata.row_index").alias("__row"))


@contextlib.contextmanager
def _conf(spark: SparkSession, conf: dict[str, str]):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def keyed_state(spark: SparkSession, content_path: str, schema, base: str, files_per_batch: int = 1000) -> DataFrame:
    """Run the stateful stream over the content table; returns ``(digest, n_bytes, n, kept)``.

    State and offsets live under ``base`` in the shared folder, so a rerun with the same
    folders goes on after the last finished batch and later content only adds to the state."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(content_path)
    state = stream.groupBy("digest", "n_bytes").agg(
        F.count("*").alias("n"), F.max(F.struct("doc_id", *LOCATOR)).alias("kept"))

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/state/batch={batch_id}")

    with _conf(spark, STATE_CONF):
        q = (state.writeStream.outputMode("update").foreachBatch(put).trigger(availableNow=True)
                  .option("checkpointLocation", f"{base}/checkpoint").start())
        q.awaitTermination()
    changed = spark.read.schema(state.schema).option("basePath", f"{base}/state").parquet(f"{base}/state/batch=*")
    # A digest's count only rises from batch to batch: the row with the largest is the newest.
    return changed.groupBy("digest", "n_bytes").agg(F.max(F.struct("n", "kept")).alias("s")).select(
        "digest", "n_bytes", "s.n", "s.kept")


def decisions(docs: DataFrame, digest: Digest = sha256_hex) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, digest, file, row``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    source = located(docs, F.col("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.col("__file").alias("file"), F.col("__row").alias("row"))
    keyed = source.withColumn("digest", digest(F.col("text"))).withColumn("n_bytes", F.octet_length("text"))
    base = scratch_path(spark, "llm-dedup")
    content = keyed.select("digest", "n_bytes", "doc_id", *LOCATOR)
    content.write.parquet(f"{base}/content")
    content = spark.read.schema(content.schema).parquet(f"{base}/content")
    if content.isEmpty():
        return content.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"),
                              F.lit(True).alias("kept"), "digest", *LOCATOR)
    groups = keyed_state(spark, f"{base}/content", content.schema, base).where("n > 1")
    groups = write_shared(groups, "dedup-groups")

    # Full bytes: a group whose hits hold more than one distinct text.
    group = ["digest", "n_bytes"]
    key = F.concat_ws(":", *group)
    hits = with_maybe(keyed, bit_filter(groups, key), key, "maybe").where("maybe").drop("maybe")
    differ = hits.select(*group, "text").distinct().groupBy(*group).agg(F.count("*").alias("texts"))
    differ = write_shared(differ.where("texts > 1").select(*group), "dedup-differ")

    clashes = not differ.isEmpty()
    if clashes:
        content, groups = (d.join(differ, group, "left_anti") for d in (content, groups))
    hot = groups.where(F.col("n") * HOT >= content.count())
    marked = content.join(F.broadcast(hot), group, "left")
    cold = marked.where(F.col("n").isNull()).drop("n", "kept").join(groups.join(F.broadcast(hot), group, "left_anti"),
                                                                    group, "left")
    joined = marked.where(F.col("n").isNotNull()).unionByName(cold)
    kept = F.coalesce(F.col("kept"), F.struct("doc_id", *LOCATOR))
    out = joined.select("doc_id", kept["doc_id"].alias("keep_id"), F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
                        ((F.col("file") == kept["file"]) & (F.col("row") == kept["row"])).alias("kept"),
                        "digest", *LOCATOR)
    if not clashes:
        return out
    # Different texts under one digest: group by the bytes themselves.
    clash = hits.join(differ, group, "left_semi")
    by_text = clash.groupBy("text").agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", *LOCATOR)).alias("k"))
    return out.unionByName(clash.join(by_text, "text").select(
        "doc_id", F.col("k.doc_id").alias("keep_id"), "group_size",
        ((F.col("file") == F.col("k.file")) & (F.col("row") == F.col("k.row"))).alias("kept"), "digest", *LOCATOR))


def dedup_report(docs: DataFrame) -> DataFrame:
    """One row per document, dropped ones too: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    return decisions(docs).select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def drop_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of ``docs`` (a plain file scan) whose locator is not in ``dropped``.

    Rows that the bit filter clears never leave their task; only the others are joined."""
    columns = docs.columns
    at = F.concat_ws(":", F.col("__file"), F.col("__row"))
    d = located(docs, whole_row(docs).alias("__doc"))
    d = with_maybe(d, bit_filter(dropped, F.concat_ws(":", "file", "row")), at, "__maybe")
    x = dropped.select(F.col("file").alias("__x_file"), F.col("row").alias("__x_row"))
    stay = d.where("__maybe").join(x, (F.col("__file") == F.col("__x_file")) & (F.col("__row") == F.col("__x_row")),
                                   "left_anti")
    return d.where(~F.col("__maybe")).unionByName(stay).select(
        *[F.col("__doc").getField(c).alias(c) for c in columns])


def dedup_rows(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    docs = plain_scan(docs)
    dropped = write_shared(decisions(docs).where(~F.col("kept")).select(*LOCATOR), "dedup-dropped")
    return drop_rows(docs, dropped)
