"""Conversation structure repair by a cheapest path through the edit lattice.

A row's fault is the first that holds: blank (no word), duplicate (role and text stand in an earlier
row, compared by SHA-256), truncated (its last character is no ``.!?``). A repaired conversation's
role initials read ``(s?(ua)+)?``. Edits, with their letters in the audit: Keep (K, 0), Rerole to
user or assistant (R, 1), Delete (D, 2, the only edit of blank and duplicate rows), Insert an empty
user or assistant text anywhere (I, 5); a truncated row that stays adds 5.

A lattice node is (rows edited, state), the state being the last role given: none, system, user or
assistant. Two searches with a heap each, one from the start and one from the end, settle nodes by
cost; they go on until their next costs together exceed the best crossing, so every cheapest path
has crossed, and the least audit among the crossings is taken. Equal costs are settled in row
order (free edits lead to the next row only), so a node's least audit is known when it is settled;
two audits of one cost to one node are never a prefix of each other, so least parts make a least whole.

Rows are ordered, compared and counted by windows; a row is one letter from there on. A conversation
is cut in blocks of ``BLOCK`` rows, each searched on its own from every state it can start in to every
state it can end in, and the blocks' results (at most 16 audits) are put together: a conversation
of any length is spread over many tasks and the search never sees more than a block. Equal blocks
are searched once per task. Texts come in at the end only: sorted by conversation and row they
stream past their audit, so a task holds one audit and one text; a conversation's digest is
sequential by its nature.

Defined cases: a null role or text counts as one space, an empty role as no role that can stay; null
conversation ids are one conversation; null turns come first and count for no gap; rows of equal
turn are ordered by a digest of role and text; equal rows are all there, the later ones
duplicates; a conversation without rows has zeros, an empty audit and the empty string's digest;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthlake.llm.common import SPACES, ship_code, write_shared

BLOCK = 1024
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NONE, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (NONE, ASSISTANT)
NEXT = (USER, USER, ASSISTANT, USER)  # the role that may be inserted or given after a state
BEFORE = ((), (), (NONE, SYSTEM, ASSISTANT), (USER,))  # the states before such a role
INITIAL = {"s": (SYSTEM, (NONE,)), "u": (USER, (NONE, SYSTEM, ASSISTANT)), "a": (ASSISTANT, (USER,))}
NAME = {USER: "user", ASSISTANT: "assistant"}


# --- the search ---------------------------------------------------------------------------
# A row's letter: x for one that must go; else its role initial (o for any other), upper case if truncated.


def edits_from(letters: str, i: int, q: int) -> Iterator[tuple[int, int, int, str]]:
    """Edges out of node (i, q): ``(i, q, cost, letter)``."""
    yield i, NEXT[q], INSERT, "I"
    if i == len(letters):
        return
    yield i + 1, q, DELETE, "D"
    row = letters[i]
    if row == "x":
        return
    more = TRUNCATED if row.isupper() else 0
    to, after = INITIAL.get(row.lower(), (None, ()))
    if q in after:
        yield i + 1, to, KEEP + more, "K"
    if NEXT[q] != to:
        yield i + 1, NEXT[q], REROLE + more, "R"


def edits_into(letters: str, j: int, r: int) -> Iterator[tuple[int, int, int, str]]:
    """Edges into node (j, r), from ``(i, q, cost, letter)``."""
    for q in BEFORE[r]:
        yield j, q, INSERT, "I"
    if j == 0:
        return
    yield j - 1, r, DELETE, "D"
    row = letters[j - 1]
    if row == "x":
        return
    more = TRUNCATED if row.isupper() else 0
    to, after = INITIAL.get(row.lower(), (None, ()))
    if to == r:
        for q in after:
            yield j - 1, q, KEEP + more, "K"
    else:
        for q in BEFORE[r]:
            yield j - 1, q, REROLE + more, "R"


@lru_cache(maxsize=1 << 15)
def cheapest(letters: str, start: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """Cost and least audit of the cheapest way from state ``start`` before the first row to one
    of ``ends`` after the last; None if there is none."""
    n = len(letters)
    labels = ({(0, start): (0, "")}, {(n, q): (0, "") for q in ends})  # node to cost and audit, of either side
    heaps = [[(0, 0, 0, start)], [(0, 0, n, q) for q in ends]]
    settled: tuple[set, set] = (set(), set())
    edges = (edits_from, edits_into)
    best: tuple[int, str] | None = None
    while heaps[0] and heaps[1]:
        if best and heaps[0][0][0] + heaps[1][0][0] > best[0]:
            break
        side = int(heaps[1][0][0] < heaps[0][0][0])
        cost, _, i, q = heapq.heappop(heaps[side])
        node, own, other = (i, q), labels[side], labels[1 - side]
        if node in settled[side] or cost > own[node][0]:
            continue
        settled[side].add(node)
        audit = own[node][1]
        if node in settled[1 - side]:
            best = _less(best, cost + other[node][0], audit + other[node][1] if side == 0 else other[node][1] + audit)
        for to, r, step, letter in edges[side](letters, i, q):
            found = (cost + step, audit + letter if side == 0 else letter + audit)
            if (to, r) not in own or found < own[to, r]:
                own[to, r] = found
                # Of equal costs, the rows nearer to this side's end are settled first.
                heapq.heappush(heaps[side], (found[0], to if side == 0 else n - to, to, r))
            if (to, r) in settled[1 - side]:
                rest = other[to, r]
                best = _less(best, found[0] + rest[0], found[1] + rest[1] if side == 0 else rest[1] + found[1])
    return best


def _less(best: tuple[int, str] | None, cost: int, audit: str) -> tuple[int, str]:
    return (cost, audit) if best is None or (cost, audit) < best else best


def block_edits(letters: str, first: bool, last: bool) -> list[dict]:
    """The cheapest edits of one block from every state it can start in to every one it can end in."""
    out = []
    for start in (NONE,) if first else range(4):
        for ends in (ENDS,) if last else ((NONE,), (SYSTEM,), (USER,), (ASSISTANT,)):
            found = cheapest(letters, start, ends)
            if found:
                out.append({"start": start, "end": ends[0], "cost": found[0], "audit": found[1]})
    return out


def join_blocks(blocks: list[list[dict]]) -> tuple[int, str]:
    """Cost and least audit over a conversation's blocks in order."""
    at = {NONE: (0, "")}
    for block in blocks:
        to: dict[int, tuple[int, str]] = {}
        for e in block:
            if e["start"] in at:
                cost, audit = at[e["start"]]
                to[e["end"]] = _less(to.get(e["end"]), cost + e["cost"], audit + e["audit"])
        at = to
    return min(at.values(), default=(0, ""))


# --- the tables ---------------------------------------------------------------------------


def _spaced(c: Column) -> Column:
    return F.coalesce(c, F.lit(" "))


def _plain(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, digest`` of a table of turns; a null role or text is one space."""
    d = rows.select("conv_id", "turn", _spaced(F.col("role")).alias("role"), _spaced(F.col("text")).alias("text"))
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return d.withColumn("digest", F.unhex(F.sha2(whole, 256)))


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after seeded damage: of twenty digests of ``conv_id:turn``, one drops
    a row, one empties its text, one takes out its ``.!?``, one repeats it, one makes its role user."""
    key = F.concat(_spaced(F.col("conv_id").cast("string")), F.lit(":"), _spaced(F.col("turn").cast("string")))
    d = conversations.select("conv_id", "turn", _spaced(F.col("role")).alias("role"), _spaced(F.col("text")).alias("text"),
                             (F.crc32(key.cast("binary")) % 20).alias("how")).where("how != 0")
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("how") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("how") == 3, 2).otherwise(1)))
    return d.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def blocks_of(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per conversation and block of rows: the rows' letters and their counts of faults."""
    words = F.trim("text", F.lit(SPACES))
    d = _plain(rows).select("conv_id", "turn", "digest", F.substring("role", 1, 1).alias("initial"),
                            (words == "").alias("empty"), (~F.substring(words, -1, 1).isin(".", "!", "?")).alias("cut"))
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    by_turn = Window.partitionBy("conv_id").orderBy(*order)
    again = Window.partitionBy("conv_id", "digest").orderBy(*order)
    one = F.lit(1)
    d = d.select("*", F.row_number().over(by_turn).alias("pos"), F.lag("initial").over(by_turn).alias("before"),
                 F.lag("turn").over(by_turn).alias("turn_before"), F.lead(one).over(by_turn).isNull().alias("last"))
    d = d.withColumn("copy", F.row_number().over(again) > 1)
    blank, duplicate = F.col("empty"), ~F.col("empty") & F.col("copy")
    truncated = ~F.col("empty") & ~F.col("copy") & F.col("cut")
    initial = F.when(F.col("initial").isin(*INITIAL), F.col("initial")).otherwise("o")
    letter = F.when(blank | duplicate, "x").when(truncated, F.upper(initial)).otherwise(initial)
    illegal = F.col("before").isNotNull() & ~F.concat("before", "initial").isin("su", "ua", "au")
    new_turn = F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("turn_before"))
    d = d.select("conv_id", F.floor((F.col("pos") - 1) / block).alias("block"), F.struct("pos", letter.alias("letter")).alias("row"),
                 "turn", "last", *[c.cast("long").alias(n) for n, c in (
                     ("blank", blank), ("duplicate", duplicate), ("truncated", truncated), ("illegal", illegal), ("turns", new_turn))])
    return d.groupBy("conv_id", "block").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("row")), lambda r: r["letter"]), "").alias("letters"),
        F.bool_or("last").alias("last"), F.min("turn").alias("low"), F.max("turn").alias("high"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "turns")])


def plans(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per conversation with rows: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``."""
    ship_code(rows.sparkSession)
    found = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    blocks = blocks_of(rows, block)
    kind = dict(rows.dtypes)
    sums = ("blank", "duplicate", "truncated", "illegal", "turns")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = dict(zip(b.schema.names, b.columns, strict=True))
            edits = [block_edits(letters, at == 0, last) for letters, at, last in zip(
                *[columns.pop(c).to_pylist() for c in ("letters", "block", "last")], strict=True)]
            at = b.column("block")
            yield pa.RecordBatch.from_arrays([*columns.values(), at, pa.array(edits, found)], [*columns, "block", "edits"])

    counts = ", ".join(f"{c} bigint" for c in sums)
    edit = "array<struct<start: int, end: int, cost: bigint, audit: string>>"
    searched = blocks.mapInArrow(search, f"conv_id {kind['conv_id']}, low {kind['turn']}, high {kind['turn']}, {counts}, "
                                         f"block bigint, edits {edit}")
    whole = searched.groupBy("conv_id").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), *[F.sum(c).alias(c) for c in sums],
        F.array_sort(F.collect_list(F.struct("block", "edits"))).alias("blocks"))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long")
    whole = whole.select("conv_id", gaps.alias("gaps"), *sums[:4], "blocks")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends = [join_blocks([x["edits"] for x in blocks.as_py()]) for blocks in b.column("blocks")]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([c for c, _ in ends], pa.int64()),
                                              pa.array([a for _, a in ends], pa.string())],
                                             [*b.schema.names[:-1], "cost", "audit"])

    counts = ", ".join(f"{c} bigint" for c in ("gaps", *sums[:4], "cost"))
    return whole.mapInArrow(join, f"conv_id {kind['conv_id']}, {counts}, audit string")


def repaired(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """``role, text, letter`` of the rows that an audit leaves or inserts, one row at a time."""
    state = NONE
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            yield NAME[state], "", letter
            continue
        role, text = next(rows)
        if letter == "R":
            state = NEXT[state]
            yield NAME[state], text, letter
        elif letter == "K":
            state = INITIAL[role[0]][0]
            yield role, text, letter


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _beside_audits(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """Every conversation's report, then its rows in order, conversations never cut by a task."""
    text = _plain(rows).select("conv_id", F.lit(True).alias("is_row"), "turn", "digest", "role", "text")
    out = reports.select("conv_id", F.lit(False).alias("is_row"), *REPORT, "audit").unionByName(text, allowMissingColumns=True)
    return out.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id"), "is_row", F.col("turn").asc_nulls_first(), "digest").select(
        "conv_id", "is_row", *REPORT, "audit", "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, Iterator[tuple[str, str]]]]:
    """Report and rows of one conversation after the other, from the stream of ``_beside_audits``."""
    def lines():
        for b in batches:
            for i in range(0, b.num_rows, 256):
                yield from zip(*[c.to_pylist() for c in b.slice(i, 256).columns], strict=True)

    stream = lines()
    ahead = next(stream, None)

    def rows():
        nonlocal ahead
        while (ahead := next(stream, None)) is not None and ahead[1]:
            yield ahead[-2:]

    while ahead is not None:
        report = [ahead[0], *ahead[2:-2]]
        it = rows()
        yield report, it
        for _ in it:  # rows that were not asked for
            pass


def repair_rows(conversations: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, position, role, text, edit`` (the edit's letter)."""
    ship_code(conversations.sparkSession)
    reports = write_shared(plans(conversations), "dialogue-plans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for (conv_id, *_, audit), rows in _conversations(batches):
            for k, (role, text, letter) in enumerate(repaired(audit, rows)):
                out.append({"conv_id": conv_id, "position": k, "role": role, "text": text, "edit": letter})
                if len(out) == 1024:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
        yield pa.RecordBatch.from_pylist(out, schema)

    beside = _beside_audits(conversations, reports)
    kind = dict(conversations.dtypes)["conv_id"]
    schema = pa.schema([("conv_id", pa.string() if kind == "string" else pa.int64()), ("position", pa.int64()),
                        ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
    return beside.mapInArrow(run, f"conv_id {kind}, position bigint, role string, text string, edit string")


def repair_report(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``conversations``, also where ``rows`` has none: ``conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256``."""
    spark = rows.sparkSession
    ship_code(spark)
    found = plans(rows)
    found = found.select(F.col("conv_id").alias("of"), *REPORT, "audit")
    reports = conversations.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in REPORT], F.coalesce("audit", F.lit("")).alias("audit"))
    reports = write_shared(reports, "dialogue-plans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = []
        for report, rows in _conversations(batches):
            digest = hashlib.sha256()
            for k, (role, text, _) in enumerate(repaired(report[-1], rows)):
                digest.update(f"{chr(10) if k else ''}{role}:{text}".encode())
            out.append([*report, digest.hexdigest()])
            if len(out) == 1024:
                yield batch(out)
                out = []
        yield batch(out)

    def batch(out: list[list]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[]] * len(names)
        kinds = [ids, *[pa.int64()] * len(REPORT), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    kind = dict(rows.dtypes)["conv_id"]
    ids = pa.string() if kind == "string" else pa.int64()
    names = ["conv_id", *REPORT, "audit", "repaired_sha256"]
    counts = ", ".join(f"{c} bigint" for c in REPORT)
    return _beside_audits(rows, reports).mapInArrow(run, f"conv_id {kind}, {counts}, audit string, repaired_sha256 string")
