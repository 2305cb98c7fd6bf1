"""Token ids in files of directly addressable codes.

An id is cut into chunks of 8 bits, the low one first. Level 0 of a file holds the first chunk of
every id, level 1 the second chunk of those ids that have one, and so on; a bitmap beside each
level tells which ids go on, and a rank directory (ones before every 512 bits) gives a position's
place in the next level. Any id is read by one look-up a level, and a run of ids is a run of every
level, so nothing is decoded block by block.

Texts are range-partitioned by id before they are encoded and sorted within their range, so a task
writes consecutive documents into files of about ``FILE_IDS`` ids; ids are never shuffled. A
file's name is its attempt's own, and only files in the written manifest count, so a repeated
task leaves no trace. The ids before a file are a prefix sum over the manifest (one narrow row a
file). Files are read by Spark, every header, section and length checked.

Texts are encoded by the tokenizers library. Its byte-level vocabularies never join what a single
space or line break parts, so texts are cut there and each distinct piece of a batch is encoded
once; finished pieces are remembered in a bounded table of two generations. Pieces of one word go to
the library's model, others and texts with any other run of white space or with a special token to
the whole tokenizer.

Defined cases: null and empty texts have the end id only; ids ascend, null ones last; rows of one id
are ordered by text hash, then by place in the table; equal rows are all written; texts are
encoded whole at any length; an empty table has no files and no rows; extra columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthlake.llm.common import open_store, plain_scan, ship_code, ship_file, write_shared
from monthlake.llm.exact_dedup import located
from monthlake.session import scratch_path

FILE_IDS = 1 << 24
END_ID = 0
SLICE_BYTES = 4 << 20  # of text, encoded at once
MEMO = 400_000
MAGIC = b"DACIDS01"
HEADER = struct.Struct("<8sQQQ")  # magic, documents, ids, levels; then the length of every level
BLOCK_BITS = 512
# The white space of byte-level vocabularies; a text with any of it but single
# spaces and line breaks (or pairs of them before a word) is encoded whole.
WIDE = "\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
UNUSUAL = f"[\\t-\\r {WIDE}]{{3}}|[\\t-\\r {WIDE}]{{2}}\\z|[\\x00\\t\\x0b-\\r{WIDE}]"


class TokenFileError(ValueError):
    """A token file that is cut short or does not hold what its header says."""


# --- the file -----------------------------------------------------------------------------
# Header; length of every level (uint64); documents: ids (int64), has-id (uint8), starts (uint64,
# one more than documents). Then per level its chunks (uint8), bitmap (uint64 words) and ranks
# (uint64, one per 512 bits). Every section starts at a multiple of 8 bytes. Little-endian.


def _padded(n: int) -> int:
    return -(-n // 8) * 8


def build(doc_ids: list[int | None], starts: np.ndarray, ids: np.ndarray) -> list[bytes]:
    """The sections of a token file, in order. ``starts`` has one entry more than documents."""
    levels, sections = [], []
    rest = ids.astype(np.uint32, copy=False)
    while True:
        levels.append(len(rest))
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        words = np.zeros(-(-len(rest) // 64), np.uint64)
        words.view(np.uint8)[:len(bits)] = bits
        ones = np.add.reduceat(np.bitwise_count(words), np.arange(0, len(words), BLOCK_BITS // 64), dtype=np.int64) if len(words) else []
        ranks = np.zeros(len(ones), np.uint64)
        ranks[1:] = np.cumsum(ones)[:-1]
        sections += [(rest & 255).astype(np.uint8).tobytes(), words.tobytes(), ranks.tobytes()]
        rest = rest[more] >> 8
        if not len(rest):
            break
    known = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], np.int64)
    out = [HEADER.pack(MAGIC, len(doc_ids), len(ids), len(levels)), struct.pack(f"<{len(levels)}Q", *levels),
           numbers.tobytes(), known.tobytes(), starts.astype(np.uint64).tobytes(), *sections]
    return [s + bytes(_padded(len(s)) - len(s)) for s in out]


class TokenFile:
    """Random access to the ids of one file, from any buffer (bytes or a memory map)."""

    def __init__(self, content):
        buf = memoryview(content)
        if len(buf) < HEADER.size:
            raise TokenFileError("no header")
        magic, docs, self.n_ids, depth = HEADER.unpack_from(buf)
        if magic != MAGIC or not 1 <= depth <= 4:
            raise TokenFileError("not a token file")
        at = HEADER.size

        def section(n: int, kind: type) -> np.ndarray:
            nonlocal at
            size = n * np.dtype(kind).itemsize
            if at + size > len(buf):
                raise TokenFileError(f"cut short: {len(buf)} bytes, {at + size} wanted")
            out = np.frombuffer(buf, kind, n, at)
            at += _padded(size)
            return out

        lengths = section(depth, np.uint64).tolist()
        self.doc_ids, self.known, self.starts = section(docs, np.int64), section(docs, np.uint8), section(docs + 1, np.uint64)
        self.levels = [(section(n, np.uint8), section(-(-n // 64), np.uint64), section(-(-n // BLOCK_BITS), np.uint64)) for n in lengths]
        if at != len(buf):
            raise TokenFileError(f"{len(buf)} bytes, {at} wanted")
        ends = [*lengths[1:], 0]
        if lengths[0] != self.n_ids or int(self.starts[-1]) != self.n_ids or any(
                self.rank(k, n) != e for k, (n, e) in enumerate(zip(lengths, ends, strict=True))):
            raise TokenFileError("lengths do not agree")

    def rank(self, level: int, i: int) -> int:
        """How many of the level's first ``i`` ids go on."""
        if i == 0:
            return 0
        _, words, ranks = self.levels[level]
        block = (i - 1) // BLOCK_BITS
        word = i // 64
        n = int(ranks[block]) + int(np.bitwise_count(words[block * (BLOCK_BITS // 64):word]).sum())
        return n + ((int(words[word]) & ((1 << i % 64) - 1)).bit_count() if i % 64 else 0)

    def get(self, i: int) -> int:
        """The id at position ``i``: one look-up a level."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = 0
        for level, (chunks, words, _) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * level)
            if not int(words[i // 64]) >> (i % 64) & 1:
                break
            i = self.rank(level, i)
        return value

    def slice(self, i: int, j: int, level: int = 0) -> np.ndarray:
        """The ids at positions ``i`` to ``j`` (not included): a run of every level."""
        chunks, words, _ = self.levels[level]
        out = chunks[i:j].astype(np.uint32)
        a, b = self.rank(level, i), self.rank(level, j)
        if b > a:
            bits = np.unpackbits(words[i // 64:-(-j // 64)].view(np.uint8), bitorder="little")[i % 64:i % 64 + j - i]
            out[bits.view(bool)] |= self.slice(a, b, level + 1) << np.uint32(8)
        return out

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """``doc_id, start, end`` of every document in the file."""
        starts = self.starts.tolist()
        for k, (d, known) in enumerate(zip(self.doc_ids.tolist(), self.known.tolist(), strict=True)):
            yield (d if known else None), starts[k], starts[k + 1]


# --- encoding -----------------------------------------------------------------------------


class Encoder:
    """Texts of a batch to ids, each distinct piece between spaces and line breaks encoded once."""

    def __init__(self, path: str):
        import tokenizers

        self.whole = tokenizers.Tokenizer.from_file(path)
        self.whole.no_padding()
        self.whole.no_truncation()
        self.model = self.whole.model
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        rest = iter(range(256, 512))
        self.symbol = {b: chr(b) if b in own else chr(next(rest)) for b in range(256)}
        special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.unusual = "|".join([UNUSUAL, *map(_quoted, special)])
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def piece(self, piece: str) -> bytes:
        """Ids of one piece as little-endian unsigned 32-bit numbers."""
        out = self.known.get(piece)
        if out is None:
            out = self.older.get(piece)
            if out is None:
                out = self.fresh(piece)
            if len(self.known) >= MEMO:
                self.older, self.known = self.known, {}
            if len(piece) <= 64:
                self.known[piece] = out
        return out

    def fresh(self, piece: str) -> bytes:
        word = piece[1:] if piece[:1] == " " else piece
        if word and word.isalpha() and max(word) < "ɐ":  # letters in every version of Unicode
            ids = [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.symbol))]
        elif len(word) > 1 and word[-1] in ".,!?;:" and word[:-1].isalpha() and max(word) < "ɐ":
            return self.piece(piece[:-1]) + self.piece(piece[-1])
        else:
            ids = self.whole.encode(piece, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text, null ones empty."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, self.unusual)
        plain = pc.if_else(odd, "", texts)
        cut = pc.replace_substring(pc.replace_substring(plain, " ", "\0 "), "\n", "\0\n\0")
        lists = pc.split_pattern(cut, "\0")
        pieces = lists.flatten().dictionary_encode()
        known = [self.piece(p) for p in pieces.dictionary.to_pylist()]
        flat = np.frombuffer(b"".join(known), np.uint32)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        first = np.cumsum(sizes) - sizes
        at = pieces.indices.to_numpy()
        n = sizes[at]
        end = np.cumsum(n)
        where = np.repeat(first[at] - (end - n), n)
        where += np.arange(len(where))
        ids = flat[where]
        ends = np.concatenate([[0], end])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        for k, whole in enumerate(odd.to_pylist()):
            if whole:
                yield np.array(self.whole.encode(texts[k].as_py(), add_special_tokens=False).ids, np.uint32)
            else:
                yield ids[ends[k]:ends[k + 1]]


def _quoted(literal: str) -> str:
    return "".join(c if c.isalnum() or ord(c) > 127 else "\\" + c for c in literal)


_OPEN: dict[str, Encoder] = {}


def _encoder(name: str) -> Encoder:
    if name not in _OPEN:
        _OPEN.clear()
        _OPEN[name] = Encoder(SparkFiles.get(name))
    return _OPEN[name]


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of ``SLICE_BYTES`` or one longer text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    at = held = 0
    for k, n in enumerate(sizes):
        if held and held + n > SLICE_BYTES:
            yield texts.slice(at, k - at)
            at, held = k, 0
        held += n
    if at < len(sizes):
        yield texts.slice(at)


# --- writing and reading ------------------------------------------------------------------


def write_tokens(docs: DataFrame, folder: str, vocab_path: str, end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode ``docs`` and write token files in ascending id order; returns the manifest:
    ``file, documents, ids, base`` (ids in the files before)."""
    spark = docs.sparkSession
    ship_code(spark)
    vocab = ship_file(spark, vocab_path)
    d = located(plain_scan(docs), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.xxhash64("__file"), F.col("__row")]
    d = d.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, (store, root), task = _encoder(vocab), open_store(folder), TaskContext.get().partitionId()
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        starts, n = [0], 0
        end = np.array([end_id], np.uint32)

        def close() -> pa.RecordBatch:
            nonlocal n, number
            name = f"{uuid.uuid4().hex}.tokens"
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                for section in build(doc_ids, np.array(starts, np.uint64), np.concatenate(parts)):
                    out.write(section)
            row = [[name], [task], [number], [len(doc_ids)], [n], [doc_ids[0]], [doc_ids[-1]]]
            number, n = number + 1, 0
            doc_ids.clear(), parts.clear()
            starts[:] = [0]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, kinds, strict=True)], names)

        number = 0
        kinds = [pa.string(), *[pa.int64()] * 6]
        for b in batches:
            ids = b.column(0).to_pylist()
            k = 0
            for texts in _slices(b.column(1)):
                for one in encoder.encode(texts):
                    parts += [one, end]
                    n += len(one) + 1
                    starts.append(n)
                    doc_ids.append(ids[k])
                    k += 1
                    if n >= file_ids:
                        yield close()
                parts[:] = [np.concatenate(parts)] if parts else []  # a slice's arrays go with it
        if doc_ids:
            yield close()

    names = ["file", "task", "number", "documents", "ids", "first_id", "last_id"]
    store, root = open_store(folder)
    store.create_dir(root, recursive=True)
    files = d.mapInArrow(run, "file string, task bigint, number bigint, documents bigint, ids bigint, first_id bigint, last_id bigint")
    files = write_shared(files, "tokens-files")
    # One narrow row a file, so one task orders them all.
    order = Window.orderBy("task", "number")
    before = F.coalesce(F.sum("ids").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    late = (F.lag("last_id").over(order) > F.col("first_id")) | (
        F.lag("last_id").over(order).isNull() & (F.row_number().over(order) > 1) & F.col("first_id").isNotNull())
    checked = F.when(F.coalesce(late, F.lit(False)), F.raise_error(F.lit("token files out of order"))).otherwise(before)
    return write_shared(files.select("file", "documents", "ids", checked.cast("long").alias("base")), "tokens-manifest")


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per document of the manifest's files: ``doc_id, start, n_tokens, ids_crc32``."""
    ship_code(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tokens").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(*b.columns, strict=True):
                try:
                    file = TokenFile(content.as_buffer())
                except TokenFileError as e:
                    raise TokenFileError(f"{name.as_py()}: {e}") from e
                rows = [(d, i, j - i, zlib.crc32(file.slice(i, j).tobytes())) for d, i, j in file.documents()]
                for at in range(0, len(rows), 8192):
                    columns = zip(*rows[at:at + 8192], strict=True)
                    arrays = [pa.array(c, pa.int64()) for c in columns]
                    yield pa.RecordBatch.from_arrays([pa.array([name.as_py()] * len(arrays[0])), *arrays],
                                                     ["name", "doc_id", "local", "n_tokens", "ids_crc32"])

    rows = files.mapInArrow(run, "name string, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(manifest.select(F.col("file").alias("name"), "base"), "name").select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, vocab_path: str) -> DataFrame:
    """Write all documents to token files in the shared folder and read them back."""
    folder = scratch_path(docs.sparkSession, "llm-tokens")
    return read_tokens(docs.sparkSession, folder, write_tokens(docs, folder, vocab_path))
