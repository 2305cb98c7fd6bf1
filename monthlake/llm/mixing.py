"""Mixing sources to target weights by weighted sampling without replacement.

Every document draws an exponential key divided by its quality weight (Efraimidis-Spirakis:
sorting by ``-ln(u) / weight`` is a weighted sample without replacement). Each source has a
word budget; whole epochs of the source come first, and the rest of the budget is filled by
the documents with the smallest keys, by a prefix sum of their sizes. A document belongs to
the fractional part when the middle of its span in the prefix sum lies inside the rest, so a
source misses its target by half a document at most.

The prefix sum never sorts a source in one task: keys are binned by their logarithm into
``KEY_BINS`` bins of ``KEY_BINS`` bins each. Bin sums (partially aggregated before the shuffle)
locate the bin of a source that crosses its budget, then the one inside it, and only that one
is sorted. A logarithm of an exponential key is nowhere denser than 1/e a unit, whatever the
weight, so a bin holds about 1 in 65,000 documents of a source at most. The outcome per source is a cutoff (bin, key); taking a document is then a
row-local comparison.

Defined cases: a null or blank text has size 0 and takes nothing; a null source is a source of
its own, ordered last; null ids are allowed; rows equal in id and text share one key and are
taken together; an empty table gives no rows; extra columns are ignored by ``mix_sizes`` and
kept by ``mix_rows``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthlake.llm.common import whole_row, word_count, write_shared

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
KEY_BINS = 1024  # on each of two levels
# Logarithms of all keys: ``u`` lies between 2^-53 and 1 - 2^-53, a weight between 0.1 and 1.
LOG_KEYS = (-37.0, 6.0)


def quality_weight(text: Column, size: Column) -> Column:
    """Quality weight in [0.1, 1]: falls with the share of markup-like symbols per word."""
    symbols = F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]", ""))
    share = F.least(F.lit(1.0), F.coalesce(symbols, F.lit(0)) / F.greatest(size, F.lit(1)))
    return F.lit(1.0) - F.lit(0.9) * share


def sample_key(doc_id: Column, text: Column, weight: Column) -> Column:
    """``-ln(u) / weight`` with ``u`` in (0, 1) from a digest of id and text: reruns agree."""
    seed = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))
    u = (F.conv(F.substring(F.md5(seed), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / weight


def _sized(docs: DataFrame, *keep: Column) -> DataFrame:
    d = docs.select(*keep, F.col("doc_id").alias("__id"), F.col("source").alias("__source"),
                    F.col("text").alias("__text"), word_count(F.col("text")).alias("__size"))
    key = sample_key(F.col("__id"), F.col("__text"), quality_weight(F.col("__text"), F.col("__size")))
    d = d.withColumn("__key", key).drop("__text")
    return d.withColumn("__bin", key_bin(F.col("__key")))


def key_bin(key: Column) -> Column:
    """The fine bin of a key; grows with the key."""
    low, high = LOG_KEYS
    bin_ = F.floor((F.log(key) - low) * (KEY_BINS**2 / (high - low)))
    return F.greatest(F.lit(0), F.least(bin_, F.lit(KEY_BINS**2 - 1))).cast("int")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row per source.

    Weights repeat over the sources in code point order, null last. A target above
    ``max_epochs`` times its source is cut there and the excess shared again by weight: in
    order of cap per weight, the first source that stays under its cap fixes the level."""
    pos = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), ((pos - 1) % len(weights) + 1).cast("int"))
    s = sizes.select("source", "source_size", pos.alias("pos"), w.cast("long").alias("w"),
                     (F.col("source_size") * max_epochs).alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("w"), "pos")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left_w = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    s = s.select("*", F.row_number().over(order).alias("rank"),
                 ((F.sum("source_size").over(everything) - before) / left_w).alias("level"))
    fits = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct("rank", "level"))
    s = s.withColumn("first", F.min(fits).over(everything))
    target = F.when(F.col("first").isNull() | (F.col("rank") < F.col("first.rank")), F.col("cap").cast("double")) \
              .otherwise(F.col("first.level") * F.col("w"))
    return s.select("source", "source_size", target.alias("target"))


def source_plan(sized: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source: size, target, whole epochs and the cutoff (bin, key) of the fractional part.

    ``sized`` has ``(source, size, key, bin)`` per document. Everything after the first
    aggregation is one row per source, or at most ``KEY_BINS`` rows per source."""
    bins = sized.groupBy("source", _coarse("bin").alias("bin")).agg(F.sum("size").alias("size"))
    plan = source_targets(bins.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = plan.withColumn("epochs", epochs.cast("long"))
    plan = write_shared(plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-targets")

    zero = F.lit(0).cast("long")
    coarse = _crossing(bins, plan.select("source", "rest", zero.alias("start")), "mix-coarse")
    inner = _with_source(sized, coarse).where(_coarse("bin") == F.col("cut_bin"))
    inner = inner.groupBy("source", "bin").agg(F.sum("size").alias("size"))
    crossing = _crossing(inner, coarse.select("source", "rest", F.col("before").alias("start")), "mix-fine")

    edge = _with_source(sized, crossing).where(F.col("bin") == F.col("cut_bin"))
    edge = edge.groupBy("source", "before", "rest", "key").agg(F.sum("size").alias("size"))
    cum = F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("key"))
    edge = edge.select("source", "key", (2 * cum - F.col("size") <= 2 * F.col("rest")).alias("inside"))
    keys = edge.where("inside").groupBy("source").agg(F.max("key").alias("cut_key"))
    cuts = _with_source(crossing.select("source", "cut_bin"), keys, "left")
    return _with_source(plan, cuts, "left").select("source", "source_size", "target", "epochs", "cut_bin", "cut_key")


def _coarse(bin_: str) -> Column:
    return F.floor(F.col(bin_) / KEY_BINS).cast("int")


def _crossing(bins: DataFrame, budgets: DataFrame, name: str) -> DataFrame:
    """Per source the bin whose prefix sum from ``start`` on reaches ``rest``, and the sum before it."""
    upto = F.col("start") + F.sum("size").over(Window.partitionBy("source").orderBy("bin"))
    cum = _with_source(bins, budgets).select("source", "bin", "size", "rest", upto.alias("upto"))
    cum = cum.where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("size") < F.col("rest")))
    return write_shared(cum.select("source", F.col("bin").alias("cut_bin"),
                                   (F.col("upto") - F.col("size")).alias("before"), "rest"), name)


def _with_source(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join two frames on ``source``, null sources included."""
    b = b.withColumnRenamed("source", "__b_source")
    return a.join(b, F.col("source").eqNullSafe(F.col("__b_source")), how).drop("__b_source")


def _repeats(d: DataFrame, plan: DataFrame) -> DataFrame:
    """Join the per-source plan and add ``__repeats``: how often the mix takes a document."""
    p = plan.select(*[F.col(c).alias(f"__p_{c}") for c in plan.columns])
    inside = (F.col("__bin") < F.col("__p_cut_bin")) | (
        (F.col("__bin") == F.col("__p_cut_bin")) & (F.col("__key") <= F.col("__p_cut_key")))
    repeats = F.col("__p_epochs") + F.coalesce(inside, F.lit(False)).cast("long")
    return d.join(p, F.col("__source").eqNullSafe(F.col("__p_source"))).withColumn("__repeats", repeats)


def _narrow(docs: DataFrame) -> DataFrame:
    d = _sized(docs).select(F.col("__id"), F.col("__source"), F.col("__size"), F.col("__key"), F.col("__bin"))
    return write_shared(d, "mix-sizes")


def _plan_of(narrow: DataFrame, weights, max_epochs) -> DataFrame:
    sized = narrow.select(*[F.col(f"__{c}").alias(c) for c in ("source", "size", "key", "bin")])
    return write_shared(source_plan(sized, weights, max_epochs), "mix-plan")


def mix_sizes(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken`` (words taken)."""
    narrow = _narrow(docs)
    d = _repeats(narrow, _plan_of(narrow, weights, max_epochs))
    return d.select(F.col("__id").alias("doc_id"), F.col("__size").alias("size"),
                    F.col("__p_source_size").alias("source_size"), F.col("__p_target").alias("target"),
                    (F.col("__repeats") * F.col("__size")).alias("taken"))


def mix_rows(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns only.

    The texts are never shuffled for it: sizes and keys are computed again beside them and
    compared with their source's cutoff (one small row per source)."""
    narrow = _narrow(docs)
    d = _repeats(_sized(docs, whole_row(docs).alias("__row")), _plan_of(narrow, weights, max_epochs))
    d = d.where(F.col("__repeats") > 0)
    return d.select("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__repeats"))).alias("__n")).select(
        *[F.col("__row").getField(c).alias(c) for c in docs.columns])
