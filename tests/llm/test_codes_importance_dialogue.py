"""Token files, importance resampling and conversation repair against brute force."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import tokenizers
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from monthlake.llm import dialogue, importance, queries, token_codes
from monthlake.llm.common import open_store
from monthlake.session import scratch_path

LONG = " ".join(f"word{i % 5000}" for i in range(120_000))


# --- 11 token files ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(queries.byte_vocab_path())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 700), max_size=3000), st.data())
def test_codes_give_any_id_and_any_run(ids, data):
    x = np.array(ids, np.uint32)
    f = token_codes.TokenFile(b"".join(token_codes.build([5, None], np.array([0, len(ids) // 2, len(ids)], np.uint64), x)))
    for i in data.draw(st.lists(st.integers(0, len(ids) - 1), max_size=20)) if ids else []:
        assert f.get(i) == ids[i]
    i, j = sorted(data.draw(st.tuples(st.integers(0, len(ids)), st.integers(0, len(ids)))))
    assert f.slice(i, j).tolist() == ids[i:j]
    assert list(f.documents()) == [(5, 0, len(ids) // 2), (None, len(ids) // 2, len(ids))]


def test_damaged_token_files_are_refused():
    good = b"".join(token_codes.build([1], np.array([0, 3], np.uint64), np.array([1, 70000, 300], np.uint32)))
    assert token_codes.TokenFile(good).slice(0, 3).tolist() == [1, 70000, 300]
    for bad in (b"", good[:-8], good + bytes(8), b"X" + good[1:], good[:8] + bytes([2]) + good[9:], good[:16] + bytes([4]) + good[17:]):
        with pytest.raises(token_codes.TokenFileError):
            token_codes.TokenFile(bad)


ALPHABET = st.sampled_from([*"abé.,'!12 \n\t\x0b\x85\xa0 　中ß", "  ", "\n\n", " a", "<|endoftext|>", "don't", "\0", "🙂", "ǅ", "\x1c"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=25).map("".join) | st.none(), min_size=1, max_size=4))
def test_encoder_equals_the_library(texts):
    encoder = _shared_encoder()
    got = [x.tolist() for x in encoder.encode(pa.array(texts, pa.string()))]
    assert got == [encoder.whole.encode(t or "", add_special_tokens=False).ids for t in texts]


_ENCODERS = []


def _shared_encoder():
    if not _ENCODERS:
        _ENCODERS.append(token_codes.Encoder(queries.byte_vocab_path()))
    return _ENCODERS[0]


def brute_tokens(rows, library):
    """Rows in the order of their ids as (doc_id, start, n_tokens, crc32)."""
    out, at = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_codes_query(spark, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = queries.op11_token_codes(spark, SF_SMALL)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == brute_tokens(rows, library)


def test_token_files_on_disk(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    folder = "file:" + scratch_path(spark, "test-tokens")
    manifest = token_codes.write_tokens(docs, folder, queries.byte_vocab_path(), file_ids=20_000)
    files = {r.file: r for r in manifest.collect()}
    assert len(files) > 5 and sum(r.documents for r in files.values()) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    store, root = open_store(folder)
    seen = []
    for r in sorted(files.values(), key=lambda r: r.base):
        with store.open_input_file(f"{root}/{r.file}") as f:
            t = token_codes.TokenFile(f.read())
        for d, i, j in t.documents():
            seen.append(d)
            assert t.slice(i, j).tolist() == [*library.encode(texts[d], add_special_tokens=False).ids, 0]
            assert t.get(j - 1) == 0 and (j - i < 2 or t.get(i) == library.encode(texts[d], add_special_tokens=False).ids[0])
    assert seen == sorted(texts)
    # a file that no manifest names (of a repeated task) is not read
    stray = f"{root}/{'0' * 32}.tokens"
    with store.open_output_stream(stray) as out:
        out.write(b"".join(token_codes.build([99_999_999], np.array([0, 1], np.uint64), np.array([7], np.uint32))))
    got = token_codes.read_tokens(spark, folder, manifest).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)


def test_token_edges(spark, library):
    rows = [(3, LONG), (None, "null id"), (1, None), (2, ""), (3, "same id"), (4, "twice"), (4, "twice"), (None, None), (7, "x" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(7) for c in ("file", "row", "start", "name", "__row")})
    folder = scratch_path(spark, "test-tokens")
    got = token_codes.read_tokens(spark, folder, token_codes.write_tokens(docs, folder, queries.byte_vocab_path())).collect()
    want = brute_tokens(rows, library)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, n, c) for d, _, n, c in want)
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in in_order] == [d for d, *_ in want]
    assert [r.start for r in in_order] == list(itertools.accumulate([0, *(r.n_tokens for r in in_order)]))[:-1]
    assert token_codes.round_trip(docs.limit(0), queries.byte_vocab_path()).collect() == []


# --- 12 importance resampling --------------------------------------------------------------


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(w), [zlib.crc32(x.encode()) % 10000 for x in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))]]


def brute_importance(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for d, text in rows:
        words, f = features(text)
        total = sum(math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in f)
        weight = total // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    enough = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(enough[:25 * len(enough) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


def test_importance_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = queries.op12_importance(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == Counter(brute_importance(rows, target))


@pytest.mark.parametrize("pivots", [1, 3, 31])
def test_quickselect(spark, pivots):
    d = spark.range(500).select(F.struct((F.col("id") * 7 % 11).alias("s"), (F.col("id") == 3).alias("z"),
                                         F.when(F.col("id") != 3, F.col("id")).alias("d")).alias("key"))
    want = sorted(((r.key.s, r.key.z, r.key.d or 0) for r in d.collect()))
    for k in (1, 2, 250, 499, 500):
        key = importance.kth_key(d, k, pivots)
        assert (key.s, key.z, key.d or 0) == want[k - 1]
    assert importance.kth_key(d, 501, pivots) is None and importance.kth_key(d.limit(0), 1, pivots) is None


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = "Énd of one, two three—four" * 50 + " x" * 10 + "y" * 300
    whole = Counter(np.concatenate(list(importance.feature_hashes(text.encode()))).tolist())
    monkeypatch.setattr(importance, "PIECE", 7)
    assert Counter(np.concatenate(list(importance.feature_hashes(text.encode()))).tolist()) == whole
    assert Counter(h % 10000 for h in whole.elements()) == Counter(features(text)[1])


def test_importance_edges(spark):
    prose = " ".join(f"term{i}" for i in range(60))
    rows = [(1, ""), (2, None), (3, " \n\t "), (4, LONG), (5, prose), (5, prose), (5, prose), (None, prose), (None, None), (6, prose + " more"),
            (7, "x" * 100_000), (8, "ONE Two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(7) for c in ("file", "row", "score", "rank", "key", "mark", "weight", "at", "__file", "__doc", "a.b")})
    target = spark.createDataFrame([("term1 term2 term3",), (None,)], "text string")
    got = importance.resample(docs, target).collect()
    want = brute_importance(rows, ["term1 term2 term3", None])
    assert Counter(map(tuple, got)) == Counter(want)
    half = importance.resample_rows(docs, target, share=50)
    assert half.columns == docs.columns
    n = sum(1 for _, t in rows if features(t)[0] >= 20)
    assert half.count() == n // 2
    ranks = sorted(r.rank for r in importance.resample(docs, target, share=100).collect() if r.rank)
    assert ranks == list(range(1, n + 1))
    assert importance.resample(docs.limit(0), target).collect() == [] == importance.resample_rows(docs.limit(0), target).collect()
    assert len(importance.resample(docs, target.limit(0)).collect()) == len(rows)


# --- 13 conversation repair ----------------------------------------------------------------


def words(t):
    return re.search(r"[^\x20\x09-\x0D]", t)


def brute_damage(rows):
    out = []
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        how = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if how:
            text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
            out += [(c, turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    return out


def order(row):
    _, turn, role, text = row
    return turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute_repair(rows):
    """Report of one conversation's rows after damage, by trying every way through the lattice."""
    rows = sorted(rows, key=order)
    seen, letters, n = set(), "", Counter()
    for _, _, role, text in rows:
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if not words(text):
            n["blank"] += 1
            letters += "x"
        elif (role, text) in seen:
            n["duplicate"] += 1
            letters += "x"
        elif text.strip(" \t\n\x0b\x0c\r")[-1] not in ".!?":
            n["truncated"] += 1
            letters += initial.upper()
        else:
            letters += initial
        seen.add((role, text))
    n["illegal"] = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit = brute_cheapest(letters)
    lines, at, state = [], 0, ""
    for e in audit:
        if e == "I":
            state = "a" if state == "u" else "u"
            lines.append({"u": "user", "a": "assistant"}[state] + ":")
            continue
        _, _, role, text = rows[at]
        at += 1
        if e == "R":
            state = "a" if state == "u" else "u"
            role = {"u": "user", "a": "assistant"}[state]
        if e != "D":
            state = role[0]
            lines.append(f"{role}:{text}")
    return (gaps, n["blank"], n["duplicate"], n["truncated"], n["illegal"], cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute_cheapest(letters):
    """Least (cost, audit) of whole strings of edits, kept per position and roles given so far."""
    legal = re.compile("(s?(ua)*u?)?")
    best = {"": (0, "")}  # last role given ("" none) to cost and audit
    for k in range(len(letters) + 1):
        grown = dict(best)
        for _ in range(3):  # insertions here
            for last, (cost, audit) in list(grown.items()):
                to = "a" if last == "u" else "u"
                grown[to] = min(grown.get(to, (math.inf, "")), (cost + 5, audit + "I"))
        if k == len(letters):
            return min(v for last, v in grown.items() if last in ("", "a"))
        row, best = letters[k], {}

        def step(last, cost, audit):
            best[last] = min(best.get(last, (math.inf, "")), (cost, audit))  # noqa: B023

        for last, (cost, audit) in grown.items():
            step(last, cost + 2, audit + "D")
            if row == "x":
                continue
            more = 5 if row.isupper() else 0
            for role in "ua":
                if legal.fullmatch({"": "", "s": "s", "u": "u", "a": "ua"}[last] + role):
                    step(role, cost + 1 + more, audit + "R")
            if row.lower() in "sua" and legal.fullmatch({"": "", "s": "s", "u": "u", "a": "ua"}[last] + row.lower()):
                step(row.lower(), cost + more, audit + "K")
    return None


def exhaustive(letters):
    """Every string of edits with at most two insertions a gap."""
    legal, found = re.compile("(s?(ua)+)?"), []  # as the contract has it
    for inserts in itertools.product(range(3), repeat=len(letters) + 1):
        for edits in itertools.product("DKR", repeat=len(letters)):
            cost, audit, roles = 0, "", ""
            possible = all(e == "D" or row != "x" for e, row in zip(edits, letters, strict=True))
            for k, (e, row) in enumerate([*zip(edits, letters, strict=True), ("", "")]):
                for _ in range(inserts[k]):
                    roles += "a" if roles[-1:] == "u" else "u"
                    cost, audit = cost + 5, audit + "I"
                if not e:
                    break
                audit += e
                cost += {"D": 2, "R": 1, "K": 0}[e] + (5 if e != "D" and row.isupper() else 0)
                if e == "R":
                    roles += "a" if roles[-1:] == "u" else "u"
                elif e == "K":
                    roles += row.lower()
            if possible and legal.fullmatch(roles):
                found.append((cost, audit))
    return min(found)


LETTERS = st.text("suaoSUAOx", max_size=14)


@settings(max_examples=400, deadline=None)
@given(LETTERS)
def test_search_equals_brute_force(letters):
    assert dialogue.cheapest(letters, dialogue.NONE, dialogue.ENDS) == brute_cheapest(letters)


@settings(max_examples=40, deadline=None)
@given(st.text("suaoUx", max_size=4))
def test_brute_force_equals_trying_all(letters):
    assert brute_cheapest(letters) == exhaustive(letters)


@settings(max_examples=200, deadline=None)
@given(LETTERS, st.integers(1, 5))
def test_blocks_join_to_the_whole(letters, size):
    cuts = [letters[i:i + size] for i in range(0, len(letters), size)] or [""]
    blocks = [dialogue.block_edits(c, k == 0, k == len(cuts) - 1) for k, c in enumerate(cuts)]
    assert dialogue.join_blocks(blocks) == brute_cheapest(letters)


def report(rows, ids):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    return {(c, *brute_repair(by[c])) for c in ids}


def test_dialogue_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op13_dialogue(spark, SF_SMALL)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    want = report(brute_damage(rows), {r[0] for r in rows})
    assert len(got.collect()) == len(want) and set(map(tuple, got.collect())) == want


EDGE = [(1, 0, "user", "Hi."), (1, 0, "assistant", "Tie."), (1, None, "user", "No turn!"), (1, 9, None, None), (1, 9, "tool", "Called."),
        (2, 0, "user", None), (2, 1, "user", ""), (2, 2, "assistant", " \n"), (None, 0, "user", "Null id?"), (None, 1, "assistant", "Yes."),
        (3, 0, "assistant", "x" * 200_000 + "."), (3, 0, "assistant", "x" * 200_000 + "."), (4, None, None, None), (5, 4, "", "Empty role."),
        (6, 1, "system", "S."), (6, 2, "user", "Cut"), (6, 3, "assistant", "A. "), (7, 3, "usher", "U role.")]


def test_dialogue_edges(spark):
    clash = {c: F.lit(7) for c in ("pos", "block", "letters", "digest", "audit", "cost", "initial", "last", "of", "is_row", "how", "copy")}
    d = spark.createDataFrame(EDGE, "conv_id long, turn long, role string, text string").withColumns(clash)
    plain = [(c, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in EDGE]
    got = dialogue.repair_report(d, d).collect()
    assert {tuple(r) for r in got} == report(plain, {r[0] for r in EDGE}) and len(got) == 8
    got = dialogue.repair_report(dialogue.damage(d), d).collect()
    assert {tuple(r) for r in got} == report(brute_damage(EDGE), {r[0] for r in EDGE}) and len(got) == 8
    nothing = dialogue.repair_report(d.limit(0), d).collect()
    assert {tuple(r)[1:] for r in nothing} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert dialogue.repair_report(d.limit(0), d.limit(0)).collect() == []
    assert dialogue.repair_rows(d.limit(0)).collect() == []


def test_repaired_rows_are_legal(spark):
    d = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    damaged = dialogue.damage(d)
    rows = dialogue.repair_rows(damaged).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.conv_id].append(r)
    digests = {r.conv_id: r.repaired_sha256 for r in dialogue.repair_report(damaged, damaged).collect()}
    for c, part in by.items():
        part.sort(key=lambda r: r.position)
        assert re.fullmatch("s?(ua)+", "".join(r.role[0] for r in part))
        assert digests[c] == hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in part).encode()).hexdigest()


def test_long_conversation_in_blocks(spark):
    rows = [(1, k, ("user", "assistant", "user", "system")[k * k % 4], f"text {k % 97}{'.' if k % 5 else ''}") for k in range(3000)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert {tuple(r) for r in dialogue.repair_report(d, d).collect()} == {(1, *brute_repair(rows))}


@pytest.mark.parametrize(("uri", "name", "root"), [("/a/b", "local", "/a/b"), ("file:/a/b", "local", "/a/b"), ("file:///a/b", "local", "/a/b"),
                                                   ("s3a://bucket/x/y?region=us-east-1", "s3", "bucket/x/y")])
def test_stores_by_their_hadoop_names(uri, name, root, monkeypatch):
    monkeypatch.setenv("AWS_EC2_METADATA_DISABLED", "true")
    monkeypatch.setenv("AWS_REGION", "us-east-1")
    store, path = open_store(uri)
    assert (store.type_name, path) == (name, root)
