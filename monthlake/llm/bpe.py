"""BPE encoding and decoding with a lexicon of frequent words.

Word counts cover all documents. The most frequent words, at most ``LEXICON_WORDS`` of at most
``WORD_CHARS`` characters, are found by radix selection on the counts, merged once on the driver
and compiled into a minimal acyclic automaton: words share prefixes and suffixes, and the number of words passed on the way through
it is a word's index into a table of id sequences (its output). The automaton is one flat file in
the shared folder; Spark ships it to every executor (also to one that joins later), where it is
memory-mapped.
Any other word is merged exactly. Finished pieces of text and words are remembered in bounded
tables of two generations: a full one becomes the older, what is used again moves back.

The vocabulary file is a parameter: BPE with a word-end suffix over byte symbols, normalised by
NFC, white space runs to one space and lower case; special tokens are found in the raw text.
Words never hold white space, so a text is encoded piece by piece between white space.

Defined cases: null and empty texts have no ids and decode to the empty text; null ids and
repeated rows are kept as they are; texts are encoded whole at any length (long words merge in
O(n log n)); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import mmap
import os
import struct
import unicodedata
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake.llm.common import open_store, ship_code, write_shared
from monthlake.session import scratch_path

LEXICON_WORDS = 100_000
WORD_CHARS = 64
DIGIT = 16  # bits of the key that one round of the selection decides
MEMO_PIECES, MEMO_WORDS = 300_000, 100_000
ROWS_AT_ONCE = 64
NO_MERGE = 1 << 62
ID = (1 << 32) - 1
ONE = [bytes([b]) for b in range(256)]
# The white space of the vocabulary's patterns, and its word pattern.
WHITE = regex.compile("[\t-\r \x85\xa0  -     　]+")
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
NOT_SPLIT = regex.compile("[\x1c-\x1f]")  # str.split() takes these for white space, the patterns do not


def byte_symbols() -> list[str]:
    """The printable symbol of every byte: printable bytes stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Merges:
    """A vocabulary file's model: exact merging of one word, and ids to texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.text = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + end] for s in symbols]
        # A pair of ids and its merge (rank, new id) are one number each, so ranks compare as numbers.
        self.pairs: dict[int, int] = {}
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.pairs[vocab[a] << 32 | vocab[b]] = rank << 32 | vocab[a + b]

    def merge(self, word: str) -> list[int]:
        """Ids of one normalised word: of all pairs the lowest rank merges first, leftmost first."""
        raw = word.encode("utf-8")
        ids = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        if len(ids) > 64:
            return self._merge_long(ids)
        get = self.pairs.get
        ranks = [get(a << 32 | b, NO_MERGE) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) != NO_MERGE:
            i = ranks.index(best)
            ids[i] = new = best & ID
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(new << 32 | ids[i + 1], NO_MERGE)
            if i:
                ranks[i - 1] = get(ids[i - 1] << 32 | new, NO_MERGE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        get, n = self.pairs.get, len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(p >> 32, i, ids[i], ids[i + 1], p & ID) for i in range(n - 1) if (p := get(ids[i] << 32 | ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if j < 0 or ids[i] != a or ids[j] != b:
                continue  # one side has merged meanwhile
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if p := get(new << 32 | ids[k]):
                    heapq.heappush(heap, (p >> 32, i, new, ids[k], p & ID))
            if (h := before[i]) >= 0 and (p := get(ids[h] << 32 | new)):
                heapq.heappush(heap, (p >> 32, h, ids[h], new, p & ID))
        return [x for x in ids if x >= 0]

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join(map(self.text.__getitem__, ids))


# --- the automaton ------------------------------------------------------------------------
# File: counts (states, edges, words, ids) as 4 uint32; per state: first edge, is-final; per edge:
# target, words passed before it; per word: first id; ids. All uint32, little-endian; then one
# byte per edge.


def compile_lexicon(words: dict[str, list[int]]) -> bytes:
    """The minimal acyclic automaton of ``words`` (built from sorted words, equal suffix states
    shared) with each word's ids as its output."""
    coded = sorted((w.encode("utf-8"), ids) for w, ids in words.items() if w)
    register: dict[tuple, int] = {}
    states: list[tuple] = []  # (final, ((byte, target), ...)), shared

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    path: list[list] = [[False, []]]  # open states of the word before: [final, edges, byte that leads here]
    last = b""
    for word, _ in coded:
        same = len(os.path.commonprefix([last, word]))
        while len(path) > same + 1:
            node = path.pop()
            path[-1][1].append((node[2], freeze(node)))
        for b in word[same:]:
            path.append([False, [], b])
        path[-1][0] = True
        last = word
    while len(path) > 1:
        node = path.pop()
        path[-1][1].append((node[2], freeze(node)))
    root = freeze(path[0])

    total: list[int] = []  # words below a state; a state's targets come before it
    for final, edges in states:
        total.append(int(final) + sum(total[t] for _, t in edges))
    order = [root, *(s for s in range(len(states)) if s != root)]
    number = {s: n for n, s in enumerate(order)}
    first, is_final, byte, target, passed = [], [], [], [], []
    for s in order:
        final, edges = states[s]
        first.append(len(byte))
        is_final.append(int(final))
        skip = int(final)
        for b, t in edges:
            byte.append(b)
            target.append(number[t])
            passed.append(skip)
            skip += total[t]
    first.append(len(byte))
    at, ids = [0], []
    for _, seq in coded:
        ids += seq
        at.append(len(ids))
    flat = [len(order), len(byte), len(coded), len(ids), *first, *is_final, *target, *passed, *at, *ids]
    return struct.pack(f"<{len(flat)}I", *flat) + bytes(byte)


class Lexicon:
    """A compiled lexicon, memory-mapped: word to ids, or None for a word it does not hold."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        u = memoryview(self.map)
        n, e, w, i = u[:16].cast("I")
        u = u[:4 * (4 + 2 * n + 1 + 2 * e + w + 1 + i)].cast("I")
        cuts, at = [], 4
        for size in (n + 1, n, e, e, w + 1, i):
            cuts.append(u[at:at + size])
            at += size
        self.first, self.final, self.target, self.passed, self.at, _ = cuts
        self.ids_at = 4 * (at - i)
        self.bytes_at = 4 * at  # the edges' bytes come last, so that a state's are searched in place

    def get(self, word: bytes) -> bytes | None:
        """The word's ids as they stand in the file."""
        find, base, first, target, passed = self.map.find, self.bytes_at, self.first, self.target, self.passed
        state = index = 0
        for b in word:
            e = find(ONE[b], base + first[state], base + first[state + 1]) - base
            if e < 0:
                return None
            index += passed[e]
            state = target[e]
        return self.map[self.ids_at + 4 * self.at[index]:self.ids_at + 4 * self.at[index + 1]] if self.final[state] else None


class Encoder(dict):
    """Piece of text (no white space) to its ids as little-endian bytes; ``dict`` holds the known."""

    def __init__(self, merges: Merges, lexicon: Lexicon):
        self.merges, self.lexicon = merges, lexicon
        self.older: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        out = self.older_words.get(word) or self.lexicon.get(word.encode("utf-8"))
        if out is None:
            ids = self.merges.merge(word)
            out = struct.pack(f"<{len(ids)}I", *ids)
        if len(self.words) >= MEMO_WORDS:
            self.older_words, self.words = self.words, {}
        if len(word) <= 64:
            self.words[word] = out
        return out

    def __missing__(self, piece: str) -> bytes:
        out = self.older.get(piece)
        if out is None:
            if piece.isascii() and piece.isalpha():  # most pieces are one plain word
                word = piece.lower()
                out = self.words.get(word) or self.word(word)
            else:
                out = self.parts(piece)
        if len(self) >= MEMO_PIECES:
            self.older = dict(self)
            self.clear()
        if len(piece) <= 64:
            self[piece] = out
        return out

    def parts(self, piece: str) -> bytes:
        special, out = self.merges.special, b""
        parts = self.merges.special_at.split(piece) if special and any(s in piece for s in special) else (piece,)
        for part in parts:
            if part in special:
                out += struct.pack("<I", special[part])
                continue
            if not part.isascii():
                # Letter by letter, as the vocabulary's normaliser does: no final form of sigma.
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            for word in WORD.findall(part.lower()):
                out += self.words.get(word) or self.word(word)
        return out

    def encode(self, text: str) -> bytes:
        pieces = WHITE.split(text) if NOT_SPLIT.search(text) else text.split()
        return b"".join(map(self.__getitem__, pieces))


_OPEN: dict[tuple[str, str], Encoder] = {}


def _encoder(vocab_file: str, lexicon_file: str) -> Encoder:
    """The worker's encoder over the files that Spark has shipped to this executor."""
    key = (vocab_file, lexicon_file)
    if key not in _OPEN:
        _OPEN.clear()
        _OPEN[key] = Encoder(Merges(SparkFiles.get(vocab_file)), Lexicon(SparkFiles.get(lexicon_file)))
    return _OPEN[key]


def frequent_words(docs: DataFrame, most: int = LEXICON_WORDS) -> list[str]:
    """At most ``most`` of the words (runs of letters, lower case) that all documents hold more than
    once: those above a count, or, should the highest count alone be shared by more, as many of
    its words as fit, by their hash.

    A word's key is its count, downwards, before 32 bits of its hash. Each round counts the keys
    under every value of their next ``DIGIT`` bits, takes the values that fit whole and goes on
    inside the first that does not, so the driver sees at most 2**DIGIT counts a round."""
    w = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("\\p{L}+"), F.lit(0))).alias("word"))
    counts = w.where(F.length("word") <= WORD_CHARS).groupBy("word").agg(F.count("*").alias("n")).where("n > 1")
    top = (1 << 31) - 1
    key = F.shiftleft(F.lit(top) - F.least("n", F.lit(top)), 32) + F.pmod(F.xxhash64("word"), F.lit(1 << 32))
    keys = write_shared(counts.select("word", key.alias("key")), "bpe-words")
    bound, held = 0, 0  # the keys below the bound are taken
    for shift in range(64 - DIGIT, -1, -DIGIT):
        rest = keys.where(F.col("key") >= bound)
        if shift + DIGIT < 64:
            rest = rest.where(F.shiftright("key", shift + DIGIT) == bound >> (shift + DIGIT))
        for digit, n in rest.groupBy(F.shiftright("key", shift).alias("digit")).count().orderBy("digit").collect():
            if held + n > most:
                bound = digit << shift
                break
            held += n
        else:
            # Every value fits: only in the first round, where no key lies past them.
            return [r.word for r in keys.select("word").collect()]
        if shift == 32 and held:  # the counts are decided
            break
    return [r.word for r in keys.where(F.col("key") < bound).select("word").collect()]


def _ship(spark: SparkSession, content: bytes, kind: str) -> str:
    """Write ``content`` in the shared folder and have Spark hand it to every executor; returns its
    name for ``SparkFiles.get``."""
    name = f"{kind}-{uuid.uuid4().hex[:12]}"
    folder = scratch_path(spark, f"llm-{kind}")
    store, path = open_store(folder)
    store.create_dir(path)
    with store.open_output_stream(f"{path}/{name}") as f:
        f.write(content)
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


def encode(docs: DataFrame, vocab_path: str, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """``doc_id, ids, decoded`` per document: ids as little-endian unsigned 32-bit numbers, and
    the text that they decode to."""
    spark = docs.sparkSession
    ship_code(spark)
    docs = docs.select("doc_id", "text")
    merges = Merges(vocab_path)
    lexicon = compile_lexicon({w: merges.merge(w) for w in frequent_words(docs, lexicon_words)})
    with open(vocab_path, "rb") as f:
        files = _ship(spark, f.read(), "vocabulary"), _ship(spark, lexicon, "lexicon")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(*files)
        for b in batches:
            for i in range(0, b.num_rows, ROWS_AT_ONCE):  # small batches back: decoded texts are long
                part = b.slice(i, ROWS_AT_ONCE)
                ids = [enc.encode(t.as_py() or "") for t in part.column(1)]
                decoded = [enc.merges.decode(memoryview(x).cast("I")) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                    ["doc_id", "ids", "decoded"])

    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, ids binary, decoded string")


def encode_digests(docs: DataFrame, vocab_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per document."""
    return encode(docs, vocab_path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
