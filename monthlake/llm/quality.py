"""Quality rules: base counts and a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed into ``N_BUCKETS`` buckets. Two multinomials over the buckets
are estimated: a trusted target (documents labelled as good) and the raw corpus (every
document). A document scores the mean over its n-grams of ``ln(target / raw)``; it is kept
when that mean is at least ``MIN_RATIO``. Counting aggregates partially in each task, so a
shuffle carries at most tasks x buckets rows; scoring is row-local (the table of N_BUCKETS
numbers is a literal), so texts are never shuffled. DataFrame functions only.

Both sides count every row: a bit filter of fixed size over the trusted ids marks the documents
that may be trusted at the scan, and only those are joined to the ids (the planner broadcasts
them while they are small); the others go to the counts directly.

Defined cases: null and blank texts have no words (all counts 0, ratio 0, base_failed); null
ids are never trusted; repeated rows are judged alike; without any trusted row every ratio is
0 and the base rules decide alone; an empty table gives no rows; extra columns are ignored by
``judge`` and kept by ``quality_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthlake.llm.common import SPACES, bit_filter, let, with_maybe, words, write_shared

N_BUCKETS = 1 << 14
MIN_RATIO = -0.1
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SMOOTHING = 1.0
END = "\n"  # no word holds it: stands after the last word


def buckets(w: Column, n_buckets: int = N_BUCKETS) -> Column:
    """Hash buckets of all words and word pairs of a word array (the last word pairs with END)."""
    n = F.lit(n_buckets)
    uni = F.transform(w, lambda x: F.pmod(F.xxhash64(x), n).cast("int"))
    bi = F.transform(w, lambda x, i: F.pmod(F.xxhash64(x, F.coalesce(F.get(w, i + 1), F.lit(END))), n).cast("int"))
    return F.concat(uni, bi)


def log_ratios(docs: DataFrame, trusted: DataFrame, n_buckets: int = N_BUCKETS) -> list[float]:
    """``ln(target / raw)`` per bucket, add-one smoothed. Every text is cut into words once."""
    ids = trusted.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("__id")).distinct()
    ids = write_shared(ids, "trusted-ids")  # the planner then knows their size
    bits = bit_filter(ids, F.col("__id").cast("string"))  # as strings, 5 of any integer type hashes alike
    d = with_maybe(docs.select("doc_id", "text"), bits, F.col("doc_id").cast("string"), "__maybe")
    some = d.where("__maybe").join(ids.withColumn("t", F.lit(1)), F.col("doc_id") == F.col("__id"), "left")
    d = d.where("NOT __maybe").select("text", F.lit(0).alias("t")).unionAll(
        some.select("text", F.coalesce("t", F.lit(0)).alias("t")))
    grams = d.select("t", F.explode(let(words(F.col("text")), lambda w: buckets(w, n_buckets))).alias("b"))
    rows = grams.groupBy("b").agg(F.count("*").alias("raw"), F.sum("t").alias("target")).collect()  # <= n_buckets rows
    raw, target = [0] * n_buckets, [0] * n_buckets
    for r in rows:
        raw[r.b], target[r.b] = r.raw, r.target
    import math

    n_raw, n_target = sum(raw), sum(target)
    if not n_target:
        return [0.0] * n_buckets
    of = lambda c, n: (c + SMOOTHING) / (n + SMOOTHING * n_buckets)
    return [round(math.log(of(t, n_target) / of(r, n_raw)), 6) for t, r in zip(target, raw, strict=True)]


def mean_ratio(w: Column, ratios: list[float]) -> Column:
    """Mean log-ratio over the n-grams of a word array; 0 for no words."""
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")  # folded to one literal
    total = F.aggregate(buckets(w, len(ratios)), F.lit(0.0), lambda acc, b: acc + F.get(table, b))
    return F.when(F.size(w) > 0, total / (2 * F.size(w))).otherwise(F.lit(0.0))


def _repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in the text, first ones included."""
    grams = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    grams = F.when(F.size(w) >= 3, grams).otherwise(F.array().cast("array<bigint>"))

    def covered(g: Column) -> Column:
        # Windows sorted by (hash, position): a window repeats when a neighbour has its hash.
        by_hash = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            again = F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))
            return F.transform(again, lambda x: x["i"])

        at = let(by_hash, positions)
        return F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))

    # Most texts repeat no window: one hash set decides that before any sorting.
    return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(covered(g)))


def _measure(text: Column, ratios: list[float], min_ratio: float) -> Column:
    """All counts and verdicts of one text as a struct. Every intermediate is bound by ``let``: a
    filter on the verdict is then never unfolded into expressions that split the text again."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "")
    symbols = F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]", ""))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.concat_ws("", w)).cast("long").alias("word_chars"),
            symbols.cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
            mean_ratio(w, ratios).alias("log_ratio"))

    def with_verdict(m: Column) -> Column:
        failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "log_ratio")
        return F.struct(*[m[c].alias(c) for c in names], failed.alias("base_failed"),
                        (~failed & (m["log_ratio"] >= min_ratio)).alias("kept"))

    return let(let(words(text), of_words), with_verdict)


def trusted_of(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1 AND toxic = 0").select("doc_id")


def judge(docs: DataFrame, trusted: DataFrame, min_ratio: float = MIN_RATIO) -> DataFrame:
    """One row per document: its counts, log-ratio, ``base_failed`` and ``kept``."""
    m = _measure(F.col("text"), log_ratios(docs, trusted), min_ratio).alias("m")
    return docs.select("doc_id", m).select(
        "doc_id", *[f"m.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                       "base_failed", "kept", "log_ratio")])


def quality_rows(docs: DataFrame, trusted: DataFrame, min_ratio: float = MIN_RATIO) -> DataFrame:
    """The documents that are kept, with their own columns."""
    return docs.where(_measure(F.col("text"), log_ratios(docs, trusted), min_ratio)["kept"])
