"""Importance resampling towards a target distribution.

Every word and pair of neighbouring words of a text is a feature, hashed into ``BUCKETS`` buckets.
Bucket counts over all documents and over all target texts give each bucket a gain, the log of the
ratio of its smoothed shares; the gains are one array, and a document's weight is the floored mean
of its features' entries. A Gumbel number drawn from the document's id is added to the weight, so
taking the highest scores samples without replacement in proportion to the exponential weights.

The draw is a distributed quickselect over composite keys (score, id, text, place in the table),
which no two rows share. Every round takes random pivot keys out of the part that is still open,
counts the keys before, at and after each in one aggregation, and keeps the part between two
pivots that holds the k-th key; it ends when a pivot is that key. Only rows up to that key are
sorted, by ranges, and a row's rank is its place in its range plus the rows of the ranges before.
Brought to the driver: ``BUCKETS`` counts a side, ``PIVOTS`` keys and twice as many counts a round.

A feature's hash is the CRC-32 of its UTF-8 bytes; a pair's goes on from its first word's. Texts
are hashed in pieces that end between words, so a very long one needs no memory of its own.

Defined cases: null and empty texts have no features and weigh 0; a null id is drawn under the
empty string and comes after all others at equal scores; rows equal in id and score are ordered by
text hash, then place; an empty target or document table leaves the smoothed shares; an empty
table gives no rows; extra columns are ignored by ``resample`` and kept by ``resample_rows``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthlake.llm.common import plain_scan, ship_code, whole_row, write_shared
from monthlake.llm.exact_dedup import LOCATOR, located

BUCKETS = 10_000
SHARE = 25  # percent
MIN_WORDS = 20
SEED = 7
PIVOTS = 31
PIECE = 1 << 20  # bytes
# A word is a run of digits, a-z and characters past U+007F, all of whose bytes are past 0x7F.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


def feature_hashes(raw: bytes | None) -> Iterator[np.ndarray]:
    """CRC-32 of every word and word pair of a text in UTF-8, in arrays of about a piece's features."""
    raw = (raw or b"").lower()  # of bytes: A-Z only
    at, last = 0, None
    while at < len(raw):
        gap = GAP.search(raw, at + PIECE)
        end = gap.start() if gap else len(raw)
        words = WORD.findall(raw, at, end)
        if words:
            one = list(map(crc32, words))
            after = [b" " + w for w in words]
            pairs = list(map(crc32, after[1:], one))
            if last is not None:
                pairs.append(crc32(after[0], last))
            last = one[-1]
            yield np.array(one + pairs, np.uint32)
        at = end


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over every whole text of ``texts(text)``."""
    ship_code(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        held: list[np.ndarray] = []
        size = 0
        for b in batches:
            for text in b.column(0):
                for h in feature_hashes(text.as_py()):
                    held.append(h)
                    size += len(h)
                    if size >= PIECE:
                        total += np.bincount(np.concatenate(held) % buckets, minlength=buckets)
                        held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held) % buckets, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    parts = texts.select(F.col("text").cast("binary")).mapInArrow(count, "bucket int, n bigint")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket ``floor(1000 ln(target share / raw share))`` of the counts, each plus one."""
    n = len(raw)
    s, t = raw.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, n_features, weight, mark, file, row`` per row of ``docs`` (a plain file scan);
    ``mark`` is a hash of the text."""
    ship_code(docs.sparkSession)
    d = located(docs, F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"),
                F.col("text").cast("binary").alias("text"))
    d = d.select("doc_id", "mark", F.col("__file").alias("file"), F.col("__row").alias("row"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = len(gain)
        for b in batches:
            n, weight = [], []
            for text in b.column(4):
                features = total = 0
                for h in feature_hashes(text.as_py()):
                    features += len(h)
                    total += int(gain[h % buckets].sum())
                n.append(features)
                weight.append(total // features if features else 0)  # rounds down
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(n, pa.int64()), pa.array(weight, pa.int64())],
                                             ["doc_id", "mark", "file", "row", "n_features", "weight"])

    return d.mapInArrow(run, "doc_id bigint, mark bigint, file string, row bigint, n_features bigint, weight bigint")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """``floor(-1000 ln(-ln u))`` with ``u`` in (0, 1) from a digest of the id: reruns agree."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


# --- quickselect --------------------------------------------------------------------------


def order_key() -> Column:
    """One struct per row whose ascending order is that of the draw; no two rows share it."""
    return F.struct((-F.col("score")).alias("s"), F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("d"),
                    F.col("mark").alias("m"), F.xxhash64("file").alias("f"), F.col("row").alias("r"))


def literal(key: Row, kind: T.StructType) -> Column:
    return F.struct(*[F.lit(key[f.name]).cast(f.dataType).alias(f.name) for f in kind.fields])


def kth_key(keyed: DataFrame, k: int, pivots: int = PIVOTS) -> Row | None:
    """The ``k``-th smallest of the distinct keys in ``keyed(key)``, from 1; None beyond them."""
    kind = keyed.schema["key"].dataType
    key, part, turn = F.col("key"), keyed, 0
    while True:
        draw = part.orderBy(F.xxhash64(F.lit(turn), *[F.col(f"key.{f.name}") for f in kind.fields]), key).limit(pivots)
        drawn = sorted((r.key for r in draw.collect()), key=lambda p: [0 if v is None else v for v in p])
        if not drawn:
            return None
        at = [literal(p, kind) for p in drawn]
        # 2i: between the pivots i - 1 and i; 2i + 1: pivot i itself
        place = sum((2 * (key > p).cast("int") + (key == p).cast("int") for p in at), F.lit(0))
        counts = {r.place: r["count"] for r in part.groupBy(place.alias("place")).count().collect()}
        for cell in range(2 * len(drawn) + 1):
            n = counts.get(cell, 0)
            if k <= n:
                break
            k -= n
        else:
            return None
        if cell % 2:
            return drawn[cell // 2]
        if cell > 0:
            part = part.where(key > at[cell // 2 - 1])
        if cell < 2 * len(drawn):
            part = part.where(key < at[cell // 2])
        turn += 1


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` with ``rank`` 1, 2, 3... by ``key``: sorted within ranges of keys; the written
    rows carry their range and place, and the rows of the ranges before (one sum a range) are added."""
    w = winners.repartitionByRange("key").sortWithinPartitions("key")
    w = write_shared(w.withColumn("at", F.monotonically_increasing_id()), "importance-ranked")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = {r.part: r["count"] for r in w.groupBy(part.alias("part")).count().collect()}  # one row a task
    before, total = [], 0
    for p in sorted(sizes):
        before.append((p, total))
        total += sizes[p]
    before = w.sparkSession.createDataFrame(before, "part long, before long")
    return w.join(before, part == F.col("part")).withColumn("rank", F.col("before") + place + 1).drop("part", "before", "at")


def decisions(docs: DataFrame, target: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS,
              buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``doc_id, n_features, weight, score, rank, file, row`` per document; undrawn ranks are null."""
    docs = plain_scan(docs)
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    d = weigh(docs, gain).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    d = write_shared(d, "importance-scores").withColumn("key", order_key())
    enough = F.col("n_features") >= 2 * min_words - 1  # n words have n - 1 pairs
    open_ = d.where(enough)
    k = share * open_.count() // 100
    kth = kth_key(open_.select("key"), k) if k else None
    columns = ["doc_id", "n_features", "weight", "score", "rank", *LOCATOR]
    if kth is None:
        return d.withColumn("rank", F.lit(None).cast("long")).select(columns)
    won = F.col("key") <= literal(kth, d.schema["key"].dataType)
    rest = d.where(~(enough & won)).withColumn("rank", F.lit(None).cast("long"))
    return rest.select(columns).unionByName(ranked(open_.where(won)).select(columns))


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE) -> DataFrame:
    """One row per document: ``doc_id, n_features, weight, score, rank``."""
    return decisions(docs, target, share).drop(*LOCATOR)


def resample_rows(docs: DataFrame, target: DataFrame, share: int = SHARE) -> DataFrame:
    """The drawn documents with all their columns."""
    docs = plain_scan(docs)
    drawn = write_shared(decisions(docs, target, share).where("rank IS NOT NULL").select(
        F.col("file").alias("__x_file"), F.col("row").alias("__x_row")), "importance-drawn")
    d = located(docs, whole_row(docs).alias("__doc"))
    d = d.join(drawn, (F.col("__file") == F.col("__x_file")) & (F.col("__row") == F.col("__x_row")), "left_semi")
    return d.select(*[F.col("__doc").getField(c).alias(c) for c in docs.columns])
