"""SimHash near-deduplication by segment popcounts and a grid join.

A 64-bit fingerprint is cut into 32 segments of 2 bits; their popcounts (0, 1 or 2) are its
embedding. The Manhattan distance of two embeddings never exceeds the Hamming distance of the
fingerprints, so it is a lower bound to filter by. Popcounts are held in unary (00, 01, 11), so
an embedding is again 64 bits and the Manhattan distance is the popcount of an exclusive or.

Grid: the 32 coordinates form 6 groups. Two embeddings within 3 differ in at most 3 groups, so
they agree on at least 3 of the 6: every fingerprint goes to the 20 cells named by 3 groups and
its coordinates there, and linked ones meet in at least one cell. In a cell, candidates are
filtered by the Manhattan distance and verified by the Hamming distance.

Only connectivity is needed, so a cell links its members by a search that drops each member as
soon as it is reached: it emits fewer links than members, and a cell full of near copies costs
one pass per member reached, not all pairs. Cells of more than ``CELL_CAP`` fingerprints are
not held in a task: their members go through ``midpoint_links``, which is exact as well.

Copies are collapsed to distinct fingerprints first (partial aggregation), so a large group of
equal texts is one row in everything that follows.

Defined cases: null and blank texts have the fingerprint zero and are linked like any other;
fewer words than a shingle form one shingle; a null id never names a component unless all its
ids are null; repeated rows share fingerprint and component; an empty table gives no rows;
extra columns are ignored (``near_dedup_rows`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.llm.common import plain_scan, ship_code, write_shared
from monthlake.llm.components import connected_components
from monthlake.llm.exact_dedup import LOCATOR, drop_rows, located

SHINGLE = 3
MAX_BITS = 3
SEED = 42
CELL_CAP = 50_000
GROUPS = (6, 6, 5, 5, 5, 5)  # segments of each group
LOW = np.uint64(0x5555555555555555)
ROWS_AT_ONCE = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text's word shingles (repeats included) as an unsigned 64-bit number."""
    w = (text or "").encode("utf-8").lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[i:] for i in range(shingle)), strict=False)) if len(w) > shingle else [b" ".join(w)]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(g, SEED) for g in grams), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), ROWS_AT_ONCE):
        part = h[i:i + ROWS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, file, row, fp`` (fp signed) per document, the texts read once."""
    ship_code(docs.sparkSession)
    d = located(docs, F.col("doc_id"), F.col("text")).select(
        "doc_id", "text", F.col("__file").alias("file"), F.col("__row").alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("file"), b.column("row"), pa.array(fp.view(np.int64))],
                ["doc_id", "file", "row", "fp"])

    kind = dict(d.dtypes)
    return d.mapInArrow(run, f"doc_id {kind['doc_id']}, file string, row bigint, fp bigint")


def embedding(fp: np.ndarray) -> np.ndarray:
    """Popcounts of the 2-bit segments in unary: 00, 01 or 11."""
    one = np.uint64(1)
    return ((fp | (fp >> one)) & LOW) | ((fp & (fp >> one) & LOW) << one)


def cell_masks() -> np.ndarray:
    """One mask per choice of 3 of the 6 groups."""
    masks, at = [], 0
    for n in GROUPS:
        masks.append(((1 << 2 * n) - 1) << 2 * at)
        at += n
    return np.array([sum(c) for c in combinations(masks, 3)], dtype=np.uint64)


def links_in_cell(x: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Positions (i, j) of verified links that connect whatever is connected in ``x``."""
    t, left, out = embedding(x), np.arange(len(x)), []
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            i = front.pop()
            near = np.bitwise_count(t[left] ^ t[i]) <= max_bits  # Manhattan distance, the lower bound
            at = np.flatnonzero(near)
            at = at[np.bitwise_count(x[left[at]] ^ x[i]) <= max_bits]
            if len(at):
                hit = left[at]
                out += [(i, j) for j in hit]
                front += list(hit)
                left = np.delete(left, at)
    return out


def grid_links(fps: DataFrame, max_bits: int = MAX_BITS, cell_cap: int = CELL_CAP) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints that connect all within ``max_bits``."""
    if max_bits > 3:
        raise ValueError("six groups of coordinates find links of at most 3 bits")
    masks = cell_masks()

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            t = embedding(fp)
            for k, m in enumerate(masks):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp), k, dtype=np.int32)), pa.array((t & m).view(np.int64)),
                     pa.array(fp.view(np.int64))], ["part", "cell", "fp"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(run: np.ndarray) -> list[tuple[int, int]]:
            return [(run[i], run[j]) for i, j in links_in_cell(run, max_bits)]

        def rows(pairs, over: bool) -> pa.RecordBatch:
            p = np.array(pairs, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(p[:, 0]), pa.array(p[:, 1]), pa.array(np.full(len(p), over))], ["a", "b", "over"])

        key, held, flooded = None, [], False  # the cell that goes on: its members, or that it is past the cap
        for b in batches:
            part, cell = b.column(0).to_numpy(), b.column(1).to_numpy()
            fp = b.column(2).to_numpy().view(np.uint64)
            if not len(fp):
                continue
            starts = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (cell[1:] != cell[:-1])])
            ends, out = np.r_[starts[1:], len(fp)], []
            long = np.flatnonzero((ends - starts > 1) | (starts == 0) | (ends == len(fp)))
            for s, e in zip(starts[long], ends[long], strict=True):
                if key == (part[s], cell[s]):
                    held.append(fp[s:e])
                else:
                    if held and not flooded:
                        out += links(np.concatenate(held))
                    key, held, flooded = (part[s], cell[s]), [fp[s:e]], False
                if flooded or sum(map(len, held)) > cell_cap:
                    flooded = True
                    yield rows([(x, x) for x in np.concatenate(held)], True)
                    held = []
                elif e < len(fp):
                    out += links(np.concatenate(held))
                    held = []
            if out:
                yield rows(out, False)
        if held and not flooded:
            yield rows(links(np.concatenate(held)), False)

    spread = fps.select("fp").mapInArrow(cells, "part int, cell bigint, fp bigint")
    sorted_cells = spread.repartition("part", "cell").sortWithinPartitions("part", "cell")
    found = write_shared(sorted_cells.mapInArrow(join, "a bigint, b bigint, over boolean"), "simhash-links")
    links = found.where("NOT over").select("a", "b")
    crowded = found.where("over").select(F.col("a").alias("fp")).distinct()
    return links if crowded.isEmpty() else links.unionByName(midpoint_links(crowded, max_bits))


def midpoint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links for crowded cells without a cell: two fingerprints within 3 bits have a point within
    1 of one and within 2 of the other. All members of a point are linked to one that is within
    ``max_bits - 2`` of it, which is a true link for each; a point has at most 2081 members."""
    one = [1 << i for i in range(64)]
    two = [a | b for a, b in combinations(one, 2)]
    near = np.array([0, *one] if max_bits >= 3 else [0], dtype=np.uint64)
    far = np.array([] if max_bits < 1 else two if max_bits >= 3 else [*one, *two] if max_bits == 2 else one, dtype=np.uint64)

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column(0).to_numpy().view(np.uint64):
                at = np.concatenate([near, far]) ^ x
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at.view(np.int64)), pa.array(np.full(len(at), x).view(np.int64)),
                     pa.array(np.arange(len(at)) < len(near))], ["point", "fp", "near"])

    p = fps.mapInArrow(points, "point bigint, fp bigint, near boolean")
    hubs = p.where("near").groupBy("point").agg(F.min("fp").alias("hub"))
    return p.join(hubs, "point").where("fp != hub").select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct()


def decisions(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, cell_cap: int = CELL_CAP) -> DataFrame:
    """``doc_id, file, row, fp, component_id, kept``; the smallest id of a component is kept."""
    d = write_shared(fingerprints(docs, shingle), "simhash-fp")
    # One row per distinct fingerprint with its first document; null ids come last.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *LOCATOR)).alias("first")
    fps = write_shared(d.groupBy("fp").agg(first, F.count("*").alias("n")), "simhash-distinct")
    roots = connected_components(grid_links(fps, max_bits, cell_cap))
    r = roots.select(F.col("node").alias("fp"), "root")
    linked = write_shared(r.join(fps, "fp").select("fp", "root", "first"), "simhash-linked")
    best = linked.groupBy("root").agg(F.min("first").alias("best"))
    of_linked = linked.join(best, "root").select("fp", "best")
    copies = fps.where("n > 1").join(r.select("fp"), "fp", "left_anti").select("fp", F.col("first").alias("best"))
    best = write_shared(of_linked.unionByName(copies), "simhash-best")
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *LOCATOR)
    out = d.join(best, "fp", "left").withColumn("best", F.coalesce("best", own))
    kept = (F.col("best.file") == F.col("file")) & (F.col("best.row") == F.col("row"))
    return out.select("doc_id", *LOCATOR, "fp", F.col("best.doc_id").alias("component_id"), kept.alias("kept"))


def near_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per document."""
    return decisions(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
                                  "kept")


def near_dedup_rows(docs: DataFrame) -> DataFrame:
    """One document of each component, with all its columns."""
    docs = plain_scan(docs)
    dropped = write_shared(decisions(docs).where("NOT kept").select(*LOCATOR), "simhash-dropped")
    return drop_rows(docs, dropped)
