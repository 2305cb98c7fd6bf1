"""Repeated paragraphs: MinHash banding, exact Jaccard, connected components.

A paragraph is a line of at least ``MIN_WORDS`` words. Equal ones (equal word sequences) are one
class, collapsed by partial aggregation before anything else, so a passage that a third of all
documents share is one row. Classes get a MinHash signature of their five-word shingles, cut
into ``BANDS`` bands of ``ROWS`` values: at a Jaccard similarity of 0.8 two classes meet in some
band with probability 1 - (1 - 0.8^ROWS)^BANDS (0.993). Classes that meet are verified by their
exact Jaccard similarity, and components of verified links are the clusters; of each cluster the
first paragraph (smallest document, then position) stays and the others are removed.

In a band's bucket only connectivity counts: a search drops every member that it reaches, so a
bucket full of near copies gives fewer links than members and never all pairs. A bucket of more
than ``BUCKET`` classes is dealt in blocks, each pair of blocks a group of its own, so no group
holds more than two blocks and no pair is left out. Texts are read again where they are needed
and never shuffled; only the shingles of classes that meet another one are.

A passage may also stand inside longer lines, or run over several short ones. For these every
run of ``PASSAGE`` words is taken as a paragraph too: its MinHash, the smallest hash of its
``GRAM``-word shingles, is one value, and runs over neighbouring words mostly share it, so a
document has about one value per ``(PASSAGE - GRAM) / 2`` words. Two documents that share
``PASSAGE`` words in a row share such a value for certain, but a shared value may stand in less;
so it only names candidates: every run whose value is shared is compared as a whole, by two 64-bit
hashes of the words' hashes (edit distance 0). The runs that select one shingle travel as one row, and
rows equal in all their words are one before their runs are compared. A run that stands twice, in
two documents or in one, is kept at its first place. Neighbouring runs with one first holder are a
span, so a span has at least ``PASSAGE`` words and reaches as far as the documents agree. What
stands in repeated paragraphs only is theirs: a run whose shingle lies in them alone is no candidate.

Defined cases: null texts and short lines have no paragraphs; repeated rows are copies like any
other; a null id sorts last, so its paragraph is removed first; texts are read whole at any
length; an empty table gives no rows; extra columns are ignored (``cleaned_rows`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthlake.llm import common
from monthlake.llm.common import FILTER_BITS, bit_filter, drop_shared, plain_scan, ship_code, whole_row, with_maybe
from monthlake.llm.components import connected_components
from monthlake.llm.exact_dedup import LOCATOR, located

SHINGLE = 5
SIMILARITY = 0.8
MIN_WORDS = 20
BANDS, ROWS = 7, 3
PASSAGE, GRAM = 50, 20
BUCKET = 4096
SEED = 7
AT_ONCE = 4096  # shingles hashed together
BYTES_AT_ONCE = 1 << 20  # texts that are hashed together; a longer one stands alone
KEY = ("h1", "h2")
write_shared = partial(common.write_shared, codec="zstd")  # tables that are written once and read once or twice


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(SEED)
    odd = r.integers(0, 1 << 63, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, r.integers(0, 1 << 63, size=BANDS * ROWS, dtype=np.uint64)


def paragraphs(text: str | None) -> Iterator[tuple[int, int, int, list[bytes]]]:
    """``(number of the line, start, length, words)`` of every paragraph; start and length in characters."""
    start = 0
    for n, line in enumerate((text or "").split("\n")):
        w = line.encode("utf-8").split()
        if len(w) >= MIN_WORDS:
            yield n, start, len(line), w
        start += len(line) + 1


def shingles(w: list[bytes]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles."""
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter((digest(x) for x in w), dtype=np.uint64, count=len(w))
    n = max(1, len(h) - SHINGLE + 1)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(min(SHINGLE, len(h))):
        out = (out ^ h[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Words:
    """Where a text's words stand (in bytes) and a hash of each, computed for all at once."""

    def __init__(self, raw: bytes):
        self.bytes = b = np.frombuffer(raw, dtype=np.uint8)
        gap = np.ones(len(b) + 2, dtype=np.int8)
        gap[1:-1] = (b == 32) | ((b >= 9) & (b <= 13))
        step = np.diff(gap)
        self.start, self.end = np.flatnonzero(step == -1), np.flatnonzero(step == 1)
        self.hash = np.zeros(len(self.start), dtype=np.uint64)
        i = 0
        while i < len(self.start):  # in pieces of about a megabyte
            j = max(i + 1, int(np.searchsorted(self.start, self.start[i] + (1 << 20))))
            self.hash[i:j] = self._hashes(self.start[i:j], self.end[i:j])
            i = j

    def _hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A polynomial of each word's bytes, from prefix sums over the piece."""
        low, n = int(start[0]), int(end[-1] - start[0])
        up, down = _powers(BASES[0], n), _powers(pow(BASES[0], -1, 1 << 64), n)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((self.bytes[low:low + n].astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        return _mix((total[end - low] - total[start - low]) * down[start - low])

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """First word of every line, and the line starts in bytes."""
        at = np.concatenate([[0], np.flatnonzero(self.bytes == 10) + 1])
        return np.concatenate([np.searchsorted(self.start, at), [len(self.start)]]), at

    def grams(self, n: int, base: int) -> np.ndarray:
        """A hash of every run of ``n`` words."""
        first = np.arange(max(0, len(self.hash) - n + 1))
        return self.ranges(first, first + n, base)

    def ranges(self, first: np.ndarray, last: np.ndarray, base: int) -> np.ndarray:
        """A hash of the words ``[first, last)`` each, from prefix sums of a polynomial."""
        up, down = _powers(base, len(self.hash)), _powers(pow(base, -1, 1 << 64), len(self.hash))
        total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(self.hash * up[:len(self.hash)])])
        return _mix((total[last] - total[first]) * down[first])


class Texts(Words):
    """Several texts, each from a line of its own, so that their words are hashed together."""

    def __init__(self, raws: list[bytes]):
        self.raw = b"\n".join(raws)
        super().__init__(self.raw)
        self.text_at = np.cumsum([0, *(len(r) + 1 for r in raws)])[:-1]  # first byte of every text
        self.first_word = np.searchsorted(self.start, self.text_at)
        self.text_of = np.searchsorted(self.first_word, np.arange(len(self.start)), "right") - 1
        self.chars = np.concatenate([[0], np.cumsum((self.bytes & 0xC0) != 0x80)])  # characters before a byte
        self.breaks = np.flatnonzero(self.bytes == 10)
        self.first_line = np.searchsorted(self.breaks, self.text_at)

    def within(self, at: np.ndarray, text: np.ndarray) -> np.ndarray:
        """The character of its text that stands at a byte."""
        return self.chars[at] - self.chars[self.text_at[text]]

    def paragraphs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The lines of at least ``MIN_WORDS`` words: text; number, start, length, words and key (as rows);
        first word and the word behind the last (as rows)."""
        first, at = self.lines()
        line = np.flatnonzero(np.diff(first) >= MIN_WORDS)
        end = np.append(at[1:] - 1, len(self.bytes))[line]
        text = np.searchsorted(self.text_at, at[line], "right") - 1
        digest = xxhash.xxh3_128_digest
        key = b"".join(digest(b" ".join(self.raw[i:j].split())) for i, j in zip(at[line].tolist(), end.tolist(), strict=True))
        columns = [line - self.first_line[text], self.within(at[line], text), self.chars[end] - self.chars[at[line]],
                   np.diff(first)[line], *np.frombuffer(key, dtype="<i8").reshape(-1, 2).T]
        return text, np.stack(columns), np.stack([first[line], first[line + 1]])

    def selected(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The hashes of all shingles; the first word of every run of ``PASSAGE`` words of one text, and the
        position of the shingle that it selects."""
        f = self.grams(GRAM, BASES[0])
        at = selected(f)
        run = np.flatnonzero(self.text_of[:len(at)] == self.text_of[PASSAGE - 1:])
        return f, run, at[run]


def together(texts: pa.Array) -> Iterator[tuple[int, Texts]]:
    """The texts of a column in turn, as many at once as make ``BYTES_AT_ONCE``, with the number of the first."""
    raws, size, at = [], 0, 0
    for i, t in enumerate(texts):
        raw = t.as_buffer().to_pybytes() if t.is_valid else b""
        if raws and size + len(raw) > BYTES_AT_ONCE:
            yield at, Texts(raws)
            raws, size, at = [], 0, i
        raws.append(raw)
        size += len(raw)
    if raws:
        yield at, Texts(raws)


# Fixed odd numbers: bases of the polynomial hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(1024, 1 << (n - 1).bit_length()), base, dtype=np.uint64)
        have[0] = 1
        have = _POWERS[base] = np.cumprod(have, dtype=np.uint64)
    return have


def signatures(words: Words, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """One row of band values per word range ``[first, last)``, from its shingles' MinHash."""
    a, b = (x[:, None] for x in _MULTIPLIERS)
    g = words.grams(SHINGLE, BASES[0])
    last = np.maximum(last - SHINGLE + 1, first + 1)
    low = np.full((len(a), len(first)), ~np.uint64(0))
    k = 0
    while k < len(first):  # ranges of about AT_ONCE shingles together; a longer range by itself in pieces
        to = max(k + 1, int(np.searchsorted(last, first[k] + AT_ONCE, "right")))
        for at in range(int(first[k]), int(last[to - 1]), AT_ONCE):
            stop = min(at + AT_ONCE, int(last[to - 1]))
            h = g[at:stop] * a + b
            h ^= h >> np.uint64(29)
            if to > k + 1:
                ends = np.minimum(np.stack([first[k:to], last[k:to]], axis=1).reshape(-1) - at, h.shape[1])
                h = np.minimum.reduceat(h, ends[:-1], axis=1)[:, ::2]
                low[:, k:to] = h
            else:
                low[:, k] = np.minimum(low[:, k], h.min(axis=1))
        k = to
    out = np.zeros((len(first), BANDS), dtype=np.uint64)
    for r in range(ROWS):
        out = _mix((out ^ low[r::ROWS].T) * np.uint64(0x9E3779B97F4A7C15))
    return out


def passages(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """``(position, hash)`` of the shingle with the smallest hash in every run of ``PASSAGE`` words."""
    f = words.grams(GRAM, BASES[0])
    at = np.unique(selected(f))
    return at, f[at]


def selected(f: np.ndarray) -> np.ndarray:
    """For every run of ``PASSAGE`` words the position of its shingle with the smallest hash (the first of equals)."""
    width = PASSAGE - GRAM + 1
    best, at, have = f, np.arange(len(f)), 1
    while have < width:  # the best of twice as many shingles, the last step overlapping
        step = min(have, width - have)
        n = max(0, len(best) - step)
        left = best[:n] <= best[step:]
        best, at = np.where(left, best[:n], best[step:]), np.where(left, at[:n], at[step:])
        have += step
    return at


_MULTIPLIERS = _multipliers()


NAMES = ["doc_id", "file", "row", "passage", "at", "start", "n_chars", "n_words", *KEY, *(f"b{i}" for i in range(BANDS))]


def _units(docs: DataFrame) -> DataFrame:
    """One row per paragraph (``at`` is its line) and per selected shingle of a run of words
    (``passage``; ``at`` is its first word, ``b0`` and ``b1`` its first and last line, ``h1`` its hash); the
    texts are read once for both."""
    kind = dict(docs.dtypes)["doc_id"]

    def rows(b: pa.RecordBatch, owner: np.ndarray, columns: np.ndarray, bands: np.ndarray | None):
        ids = b.select(["doc_id", "file", "row"]).take(pa.array(owner))
        of = [pa.array(c) for c in columns]
        of += [pa.array(c) for c in bands.view(np.int64).T.copy()] if bands is not None else []
        named = dict(zip(("at", "b0", "b1", "h1") if bands is None else NAMES[4:], of, strict=True))
        return pa.RecordBatch.from_arrays(
            [*ids.columns, pa.array(np.full(len(owner), bands is None)),
             *(named.get(c, pa.nulls(len(owner), pa.int64())) for c in NAMES[4:])], NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, texts in together(b.column("text")):
                text, lines, (first, last) = texts.paragraphs()
                if len(text):
                    yield rows(b, text + i, lines, signatures(texts, first, last))
                f, _, at = texts.selected()
                at = at[np.diff(at, prepend=-1) != 0]
                if len(at):
                    text = texts.text_of[at]
                    b0, b1 = (np.searchsorted(texts.breaks, texts.start[x]) - texts.first_line[text] for x in (at, at + GRAM - 1))
                    yield rows(b, text + i, np.stack([at - texts.first_word[text], b0, b1, f[at].view(np.int64)]), None)

    return docs.mapInArrow(run, f"doc_id {kind}, file string, row bigint, passage boolean, "
                                + ", ".join(f"{n} bigint" for n in NAMES[4:]))


def _bits_of(shared: DataFrame) -> np.ndarray:
    """A bitmap of ``FILTER_BITS`` bits (4 MB) of the first hashes in ``shared``, at the driver."""
    b = shared.select((F.pmod("h1", F.lit(FILTER_BITS)) + 1).alias("b"))  # from 1: buckets then begin at 1
    rows = b.groupBy(F.bitmap_bucket_number("b").alias("k")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("v")).collect()
    out = np.zeros((FILTER_BITS // 32768, 4096), dtype=np.uint8)
    for r in rows:
        out[r.k - 1, :len(r.v)] = np.frombuffer(r.v, dtype=np.uint8)
    return out.reshape(-1)


def _groups(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """One row per selected shingle that may be shared: the runs of ``PASSAGE`` words that select it follow
    one another from ``word`` on. ``u1, u2`` hash all their words; ``w1, w2`` each run, ``starts`` and
    ``stops`` are the runs' characters."""
    kind = dict(docs.dtypes)["doc_id"]
    names = ["doc_id", "file", "row", "word", "runs", "u1", "u2", "w1", "w2", "starts", "stops"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, texts in together(b.column("text")):
                f, word, of = texts.selected()
                v = (f & np.uint64(FILTER_BITS - 1)).astype(np.int64)
                hit = (bits[v >> 3] >> (v & 7).astype(np.uint8) & 1).astype(bool)[of]
                word, of = word[hit], of[hit]
                if not len(word):
                    continue
                at = np.flatnonzero(np.diff(of, prepend=-1) != 0)  # a shingle's runs follow one another
                n = np.diff(np.append(at, len(word)))
                text = texts.text_of[word]
                u = [texts.ranges(word[at], word[at] + n - 1 + PASSAGE, x).view(np.int64) for x in BASES]
                runs = [*(texts.ranges(word, word + PASSAGE, x).view(np.int64) for x in BASES),
                        texts.within(texts.start[word], text), texts.within(texts.end[word + PASSAGE - 1], text)]
                ids = b.select(["doc_id", "file", "row"]).take(pa.array(text[at] + i))
                columns = [word[at] - texts.first_word[text[at]], n, *u]
                offsets = pa.array(np.append(at, len(word)), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(c, pa.int64())) for c in runs]
                yield pa.RecordBatch.from_arrays([*ids.columns, *(pa.array(c, pa.int64()) for c in columns), *lists], names)

    return docs.mapInArrow(run, f"doc_id {kind}, file string, row bigint, word bigint, runs bigint, u1 bigint, u2 bigint, "
                                + ", ".join(f"{n} array<bigint>" for n in names[7:]))


def _outside(hits: DataFrame, lines: DataFrame) -> DataFrame:
    """The hashes of ``hits`` that stand somewhere not wholly inside the repeated ``lines(file, row, line)``."""
    at = [F.xxhash64("file").alias("file"), "row"]  # a number stands for a file's name
    each = hits.select(*at, "h1", F.explode(F.sequence("b0", "b1")).alias("line"))  # a shingle's few lines
    known = lines.select(*at, "line").distinct().withColumn("known", F.lit(1))
    return each.join(known, ["file", "row", "line"], "left").where("known IS NULL").select("h1").distinct()


def shared_passages(source: DataFrame, units: DataFrame, lines: DataFrame) -> DataFrame:
    """Spans of at least ``PASSAGE`` words that stand elsewhere too, in another document or in the same
    one: ``doc_id, file, row, start, n_chars, n_words, cluster_doc, cluster_size, removed``;
    ``cluster_doc`` is the first holder of every run in the span, which keeps it at its first place.

    ``lines`` are the repeated paragraphs: what stands only in these is theirs, and their words
    do not count for a passage. ``units`` are used up."""
    p = units.where("passage").select(*LOCATOR, "h1", "b0", "b1")
    seeds = write_shared(p.groupBy("h1").agg(F.count("*").alias("n")).where("n > 1").select("h1"), "para-seeds")
    key, place = F.col("h1"), F.struct(*LOCATOR)
    # A shingle that a filter lets through by chance is one more candidate: runs are compared in the end.
    hits = write_shared(with_maybe(p, bit_filter(seeds, key), key, "maybe").where("maybe").drop("maybe"), "para-hits")
    drop_shared(units, seeds)
    seeds = write_shared(_outside(hits, lines), "para-outside")
    hit = with_maybe(hits, bit_filter(seeds, key), key, "maybe").where("maybe")
    docs = with_maybe(source, bit_filter(hit, place), place, "maybe").where("maybe").drop("maybe")
    groups = write_shared(_groups(docs, _bits_of(seeds)), "para-groups")
    drop_shared(hits, seeds)
    first_run = _first_runs(groups)
    out = groups.select("doc_id", *LOCATOR, *GROUP, "word", "starts", "stops").join(first_run, list(GROUP))
    # The runs of a group from number k to l have their first place in one row.
    who = F.xxhash64(*LOCATOR)
    out = out.select("doc_id", *LOCATOR, (F.col("word") + F.col("k")).alias("word"), (F.col("word") + F.col("l")).alias("last"),
                     F.get("starts", F.col("k")).alias("start"), F.get("stops", F.col("l")).alias("stop"),
                     "first_doc", "first_who", "n",
                     ((who == F.col("first_who")) & (F.col("word") + F.col("k") == F.col("first_word"))).alias("kept"))
    # A document's runs in order: a new span begins after a gap, where the first holder changes, and
    # between a run's first place and a later one.
    w = Window.partitionBy(*LOCATOR).orderBy("word")
    same = (F.col("word") - F.lag("last").over(w) == 1) & (F.col("first_who") == F.lag("first_who").over(w)) & (
        F.col("kept") == F.lag("kept").over(w))
    out = out.withColumn("span", F.when(same, 0).otherwise(1)).withColumn("span", F.sum("span").over(w))
    spans = out.groupBy(*LOCATOR, "span").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("stop").alias("stop"),
        (F.max("last") - F.min("word") + PASSAGE).alias("n_words"), F.first("first_doc").alias("cluster_doc"),
        F.max("n").alias("cluster_size"), F.first("kept").alias("kept"))
    return spans.select("doc_id", *LOCATOR, "start", (F.col("stop") - F.col("start")).alias("n_chars"), "n_words",
                        "cluster_doc", "cluster_size", (~F.col("kept")).alias("removed"))


GROUP = ("u1", "u2", "runs")


def _first_runs(groups: DataFrame) -> DataFrame:
    """Per distinct group (equal in all its words) the stretches ``k`` to ``l`` of its runs that stand more
    than once, with the first place of the run ``k`` and the largest number of copies ``n``.

    Equal groups are one row before their runs are compared with those of other groups, so a passage
    with many copies costs one row a group, not one a copy and run."""
    # First as paragraphs are: by document, then place; a null id comes last.
    at = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64(*LOCATOR).alias("who"), "word")
    distinct = write_shared(groups.groupBy(*GROUP).agg(
        F.min(at).alias("at"), F.count("*").alias("n"), F.first("w1").alias("w1"), F.first("w2").alias("w2")), "para-distinct")
    each = distinct.select(*GROUP, "at", "n", F.posexplode(F.arrays_zip("w1", "w2")).alias("k", "w")).select(
        *GROUP, "n", "k", "w.w1", "w.w2",
        F.struct("at.no_id", "at.doc_id", "at.who", (F.col("at.word") + F.col("k")).alias("word")).alias("at"))
    shared = each.groupBy("w1", "w2").agg(F.min("at").alias("first"), F.sum("n").alias("copies")).where("copies > 1")
    shared = write_shared(shared, "para-shared")
    each = each.drop("at", "n").join(shared, ["w1", "w2"])
    w = Window.partitionBy(*GROUP).orderBy("k")
    same = (F.col("k") - F.lag("k").over(w) == 1) & (F.col("first.who") == F.lag("first.who").over(w)) & (
        F.col("first.word") - F.lag("first.word").over(w) == 1)
    each = each.withColumn("part", F.when(same, 0).otherwise(1)).withColumn("part", F.sum("part").over(w))
    out = each.groupBy(*GROUP, "part").agg(F.min("k").alias("k"), F.max("k").alias("l"), F.min("first").alias("first"),
                                           F.max("copies").alias("n"))
    out = write_shared(out.select(*GROUP, "k", "l", F.col("first.doc_id").alias("first_doc"), F.col("first.who").alias("first_who"),
                                  F.col("first.word").alias("first_word"), "n"), "para-first-runs")
    drop_shared(distinct, shared)
    return out


def _meetings(classes: DataFrame) -> DataFrame:
    """``band, cell, h1, h2, size`` of the classes that share a bucket with another class."""
    each = F.explode(F.arrays_zip(F.array(*[F.lit(i) for i in range(BANDS)]).alias("band"),
                                  F.array(*[F.col(f"b{i}") for i in range(BANDS)]).alias("cell"))).alias("x")
    m = classes.select(*KEY, each).select(F.col("x.band").alias("band"), F.col("x.cell").alias("cell"), *KEY)
    crowded = m.groupBy("band", "cell").agg(F.count("*").alias("size")).where("size > 1")
    crowded, cell = write_shared(crowded, "para-buckets"), F.col("cell")
    # Few classes meet another one: a filter leaves most rows out before the join moves them.
    m = with_maybe(m, bit_filter(crowded, cell), cell, "maybe").where("maybe").drop("maybe")
    meetings = write_shared(m.join(crowded, ["band", "cell"]), "para-meetings")
    drop_shared(crowded)
    return meetings


def _shingles_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``h1, h2, shingles`` of the wanted classes, from a second reading of the texts."""
    bits = _bits_of(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = {}
            for _, texts in together(b.column(0)):
                _, lines, (first, last) = texts.paragraphs()
                v = lines[4] & FILTER_BITS - 1
                for i in np.flatnonzero(bits[v >> 3] >> (v & 7).astype(np.uint8) & 1).tolist():
                    raw = texts.raw[texts.start[first[i]]:texts.end[last[i] - 1]]
                    found.setdefault((int(lines[4, i]), int(lines[5, i])), raw.split())
            rows = list(found.items())
            for i in range(0, len(rows), 2048):
                part = rows[i:i + 2048]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k, _ in part], pa.int64()), pa.array([k[1] for k, _ in part], pa.int64()),
                     pa.array([b" ".join(w) for _, w in part], pa.binary())], ["h1", "h2", "words"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [shingles(w.as_py().split()).view(np.int64) for w in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s, pa.list_(pa.int64()))],
                                             ["h1", "h2", "shingles"])

    p = docs.select("text").mapInArrow(run, "h1 bigint, h2 bigint, words binary")
    p = p.join(wanted, list(KEY), "left_semi").groupBy(*KEY).agg(F.min("words").alias("words"))
    return write_shared(p.mapInArrow(cut, "h1 bigint, h2 bigint, shingles array<bigint>"), "para-shingles")


def links_in_group(sets: list[np.ndarray], similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """Positions (i, j) of verified links that connect whatever is connected among ``sets``."""
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]  # shingle to its members
    out, left = [], np.ones(len(sets), dtype=bool)
    for seed in range(len(sets)):
        if not left[seed]:
            continue
        left[seed], front = False, [seed]
        while front:
            i = front.pop()
            lo, hi = np.searchsorted(flat, sets[i], "left"), np.searchsorted(flat, sets[i], "right")
            shared = np.bincount(owner[_ranges(lo, hi)], minlength=len(sets))
            hit = np.flatnonzero(left & (shared >= similarity * (size[i] + size - shared) - 1e-9))
            out += [(i, int(j)) for j in hit]
            left[hit] = False
            front += hit.tolist()
    return out


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All positions of the ranges [lo, hi), one after the other."""
    n = hi - lo
    return np.repeat(hi - np.cumsum(n), n) + np.arange(n.sum())


def class_links(meetings: DataFrame, sets: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Verified links ``(a, b)`` between classes (as text keys)."""
    blocks = F.ceil(F.col("size") / bucket).cast("int")
    own = F.pmod(F.xxhash64(*KEY), blocks).cast("int")
    m = meetings.withColumn("blocks", blocks).withColumn("own", own)
    # The group of blocks (i, j) holds both: a member goes to every group that its block is in.
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    m = m.select("band", "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *KEY)
    m = m.join(sets, list(KEY))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, sets_ = None, [], []

        def links() -> pa.RecordBatch | None:
            if len(names) < 2:
                return None
            found = links_in_group(sets_)
            return pa.RecordBatch.from_arrays([pa.array([names[i] for i, _ in found], pa.string()),
                                               pa.array([names[j] for _, j in found], pa.string())], ["a", "b"])

        for b in batches:
            of = list(zip(*(b.column(n).to_pylist() for n in ("band", "cell", "i", "j")), strict=True))
            for k, h1, h2, s in zip(of, b.column("h1").to_pylist(), b.column("h2").to_pylist(), b.column("shingles"),
                                    strict=True):
                if k != key:
                    if (out := links()) is not None:
                        yield out
                    key, names, sets_ = k, [], []
                names.append(f"{h1:x}:{h2:x}")
                sets_.append(s.values.to_numpy())
        if (out := links()) is not None:
            yield out

    group = ["band", "cell", "i", "j"]
    m = m.repartition(*group).sortWithinPartitions(*group)
    return write_shared(m.mapInArrow(run, "a string, b string").distinct(), "para-links")


def _source(docs: DataFrame) -> DataFrame:
    ship_code(docs.sparkSession)
    return located(docs, F.col("doc_id"), F.col("text")).select(
        "doc_id", "text", F.col("__file").alias("file"), F.col("__row").alias("row"))


def repeated_paragraphs(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Every paragraph that has a copy or near copy: ``doc_id, line, start, n_chars, n_words,
    cluster_doc, cluster_line, cluster_size, removed`` and its document's ``file, row``."""
    source = _source(docs)
    return _repeated(source, write_shared(_units(source), "para-units"), bucket)[0]


def _repeated(source: DataFrame, units: DataFrame, bucket: int) -> tuple[DataFrame, list[DataFrame]]:
    """The rows, and the written tables that they are read from besides ``units``."""
    p = units.where("NOT passage").withColumnRenamed("at", "line")
    classes = p.groupBy(*KEY).agg(F.count("*").alias("n"), *[F.min(f"b{i}").alias(f"b{i}") for i in range(BANDS)])
    classes = write_shared(classes, "para-classes")
    meetings = _meetings(classes)
    wanted = write_shared(meetings.select(*KEY).distinct(), "para-wanted")
    sets = _shingles_of(source, wanted)
    links = class_links(meetings, sets, bucket)
    drop_shared(meetings, wanted, sets)
    roots = connected_components(links)

    name = F.format_string("%s:%s", _hex("h1"), _hex("h2"))
    named = classes.select(*KEY, "n", name.alias("name")).join(roots.withColumnRenamed("node", "name"), "name", "left")
    again = named.where("n > 1 OR root IS NOT NULL").select(*KEY, F.coalesce("root", "name").alias("cluster"))
    again = write_shared(again, "para-again")
    drop_shared(classes, links)
    at = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "line", *LOCATOR)
    found = p.select("doc_id", *LOCATOR, "line", "start", "n_chars", "n_words", *KEY).join(again, list(KEY))
    found = write_shared(found.drop(*KEY).withColumn("at", at), "para-found")
    drop_shared(again)
    first = write_shared(found.groupBy("cluster").agg(F.min("at").alias("first"), F.count("*").alias("cluster_size")),
                         "para-first")
    out = found.join(first, "cluster")
    return out.select("doc_id", *LOCATOR, "line", "start", "n_chars", "n_words",
                      F.col("first.doc_id").alias("cluster_doc"), F.col("first.line").alias("cluster_line"),
                      "cluster_size", (F.col("at") != F.col("first")).alias("removed")), [found, first]


def _repeated_and_shared(source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repeated paragraphs, written, and the shared passages. A table is dropped once the last
    step that reads it has written its own."""
    units = write_shared(_units(source), "para-units")
    rows, read = _repeated(source, units, BUCKET)
    p = write_shared(rows, "para-repeated")
    drop_shared(*read)
    return p, shared_passages(source, units, p)


def repeated_text(docs: DataFrame) -> DataFrame:
    """Repeated paragraphs and shared passages together: ``kind`` tells which; start and length
    are in characters of the text."""
    p, s = _repeated_and_shared(_source(docs))
    out = p.withColumn("kind", F.lit("paragraph")).unionByName(s.withColumn("kind", F.lit("passage")), allowMissingColumns=True)
    return out.select("doc_id", "kind", "line", "start", "n_chars", "n_words", "cluster_doc", "cluster_line",
                      "cluster_size", "removed")


def _hex(column: str):
    """As Python's ``format(x, "x")`` writes a signed number."""
    c = F.col(column)
    return F.concat(F.when(c < 0, F.lit("-")).otherwise(F.lit("")), F.lower(F.hex(F.abs(c))))


def cut_text(text: str | None, gone: list[int] | None, spans: list | None) -> str | None:
    """``text`` without the lines ``gone`` and the removed spans ``(start, n_chars, removed)``; what
    a span that stays covers is not cut from it, so the first copy of a passage stays whole."""
    if text is None or not (gone or spans):
        return text
    cut = np.zeros(len(text), dtype=bool)
    for keep in (False, True):
        for start, n, removed in spans or ():
            if removed != keep:
                cut[start:start + n] = not keep
    out, at, gone = [], 0, set(gone or ())
    for i, line in enumerate(text.split("\n")):
        c = cut[at:at + len(line)]
        at += len(line) + 1
        if i in gone:
            continue
        if c.any():
            line = "".join(x for x, y in zip(line, c.tolist(), strict=True) if not y)
            if not line.strip():
                continue
        out.append(line)
    return "\n".join(out)


def cleaned_rows(docs: DataFrame) -> DataFrame:
    """The documents without their removed paragraphs and passages, with all their columns."""
    columns, docs = docs.columns, plain_scan(docs)
    p, s = _repeated_and_shared(_source(docs))
    p = p.where("removed").select(*LOCATOR, "line", F.lit(None).alias("span"))
    s = s.select(*LOCATOR, F.lit(None).cast("bigint").alias("line"),
                                              F.struct("start", "n_chars", "removed").alias("span"))
    gone = p.unionByName(s).groupBy(F.col("file").alias("__f"), F.col("row").alias("__r")).agg(
        F.collect_set("line").alias("__gone"), F.collect_list("span").alias("__spans"))
    d = located(docs, whole_row(docs).alias("__doc"))
    j = d.join(gone, (F.col("__file") == F.col("__f")) & (F.col("__row") == F.col("__r")), "left")
    text = F.udf(cut_text, "string")(F.col("__doc.text"), "__gone", "__spans")
    return j.select(*[text.alias(c) if c == "text" else F.col("__doc").getField(c).alias(c) for c in columns])
