"""Byte-level BPE, periodic runs and importance resampling against brute force and the libraries."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from pricelens.llm import byte_bpe, periodic, queries, resampling
from pricelens.llm.shipping import prepare

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SF001 = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = "doc_id long, text string, ids string, runs string, n_words string, weight string, rank string"
TEXTS = {
    1: "The quick brown fox don't  jump\n\nover 123 lazy dogs' <|endoftext|> ", 2: "", 3: None, 4: " \n\t ",
    5: "naïve café İstanbul 東京 😀   é x", 6: "a b c " * 9 + "tail", 7: "la " * 40, 8: "x" * 20_000,
    9: "one two three four five six seven eight nine ten eleven twelve " * 400, 10: "Same line\nsame line\n\nSAME line\rother",
    11: " ".join(f"w{i % 7}" for i in range(60)) + "\n" + " ".join(f"w{i % 7}" for i in range(60)), 12: "one\ntwo\n\nthree\nfour" * 8,
    13: "\x1cfile\x85sep\xa0" * 6, 14: "lone", 15: "a a b a a b a a b a a b b b b b b b b",
}


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    rows = [(i, t, "a", "b", "c", "d", "e") for i, t in TEXTS.items()]
    rows += [(1, TEXTS[1], None, None, None, None, None), (None, TEXTS[9], None, None, None, None, None), (None,) * 7]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def test_encode_and_decode_rows(docs, empty, library):
    encoded = byte_bpe.encode_texts(docs, RANKS, public_tokenizers.PATTERN)
    got = byte_bpe.decode_ids(encoded, RANKS, out_col="text").collect()
    assert len(got) == len(TEXTS) + 3
    for r in got:
        if r.doc_id is not None:
            text = TEXTS[r.doc_id] or ""
            assert (list(r.ids), r.text) == (library.encode_ordinary(text), text)
    assert byte_bpe.encode_texts(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_decode_ids_keeps_nulls(spark):
    prepare(spark)
    rows = spark.createDataFrame([(1, None), (2, []), (3, [64, None, 65])], "id long, ids array<int>")
    token = {rank: t for t, rank in byte_bpe.read_ranks(RANKS).items()}
    got = {r.id: r.decoded for r in byte_bpe.decode_ids(rows, RANKS).collect()}
    assert got == {1: None, 2: "", 3: (token[64] + token[65]).decode()}


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_transducer_equals_the_library_on_random_text(name):
    ranks = byte_bpe.read_ranks(public_tokenizers.path(name))
    machine = byte_bpe.Transducer(ranks, public_tokenizers.PATTERN)
    machine.MAX_STATES, machine.WINDOW = 4000, 64             # tables are dropped and rebuilt on the way
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    pools = ["abcdefghijklmnopqrstuvwxyz", "ab", "aé東ßİ̳😀", "0123456789", "!?.,'\"-_ \t\n", "etaoin shrdlu'"]
    for _ in range(60):
        texts = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(60))) for _ in range(50)]
        ids, sizes = machine.encode(texts)
        for text, own in zip(texts, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
            assert own.tolist() == other.encode_ordinary(text), text
    for text in ("a" * 30_000, "ab" * 10_000, "thethe" * 5000, "東" * 9000, " " * 20_000 + "x"):
        assert machine.encode([text])[0].tolist() == other.encode_ordinary(text)
    assert machine.encode([])[0].tolist() == [] and machine.encode(["", ""])[1].tolist() == [0, 0]


def test_a_piece_that_no_merge_makes_is_its_token():
    ranks = {bytes((b,)): b for b in range(256)} | {b"ab": 256, b"abcd": 257}       # "cd" is no token
    machine = byte_bpe.Transducer(ranks, public_tokenizers.PATTERN)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("abcd", "abcd abcd", "abcde", "xabcd\nabcd", "abab"):
        assert machine.encode([text])[0].tolist() == other.encode_ordinary(text)


def test_ranks_without_a_byte_raise():
    with pytest.raises(ValueError):
        byte_bpe.MergeTable({b"a": 0, b"b": 1, b"ab": 2})


def test_stream_decoder_equals_a_text_decoder():
    machine, rng = byte_bpe.StreamDecoder({}), random.Random(3)
    some = [0xE6, 0x9D, 0xB1, 0xF0, 0x9F, 0x98, 0x80, 65, 0xED, 0xA0, 0xC3, 0xA9, 0xF4, 0x90]
    for _ in range(4000):
        raw = bytes(rng.choice([rng.randrange(256), *some]) for _ in range(rng.randrange(14)))
        text, held, at = "", b"", 0
        while at < len(raw):
            size = rng.randrange(1, 4)
            out, held = machine.feed(held, raw[at:at + size])
            assert len(held) < 4
            text, at = text + out, at + size
        assert text + "�" * bool(held) == raw.decode("utf-8", "replace")


def plain_runs(w, min_length=6, exponent=4):
    """Every maximal run by comparing all words at each distance."""
    out = []
    for p in range(1, len(w) // exponent + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            n = i - s + p
            smaller = any(p % q == 0 and w[s + q:s + n] == w[s:s + n - q] for q in range(1, p))
            if n >= max(min_length, exponent * p) and not smaller:
                out.append((s, n, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force_on_random_words():
    rng = random.Random(1)
    for _ in range(600):
        texts = []
        for _ in range(rng.randrange(1, 5)):
            n, k = rng.randrange(60), rng.choice([1, 2, 3, 20])
            w = [rng.randrange(1, k + 1) for _ in range(n)]
            if n > 10 and rng.random() < 0.5:
                a, p = rng.randrange(n), rng.randrange(1, 8)
                w = [w[i] if i < a else w[min(a + (i - a) % p, n - 1)] for i in range(n)]
            texts.append(w)
        least, exponent = rng.choice([(6, 4), (2, 2), (5, 3), (3, 2)])
        ids = np.array([x for w in texts for x in w], np.int64)
        doc = np.repeat(np.arange(len(texts)), [len(w) for w in texts])
        want, at = [], 0
        for w in texts:
            want += [(s + at, n, p) for s, n, p in plain_runs(w, least, exponent)]
            at += len(w)
        assert sorted(periodic.runs_of(ids, doc, least, exponent), key=lambda r: (r[0], r[2])) == want


def test_ordered_positions_split_their_blocks():
    rng = random.Random(2)
    items = rng.sample(range(100_000), 9000)
    held = periodic.OrderedPositions([items[0]])
    for x in items[1:]:
        held.add(x)
    assert list(held) == sorted(items) and len(held.blocks) > 4
    assert held.around(-5) == (-1, min(items)) and held.around(10 ** 6) == (max(items), -1)


def test_periodic_runs_rows(docs, empty):
    got = periodic.periodic_runs(docs).collect()
    assert len(got) == len(TEXTS) + 3
    for r in got:
        if r.doc_id is None:
            continue
        w = re.findall(r"[^\x20\x09-\x0d]+", TEXTS[r.doc_id] or "")
        want = plain_runs(w)
        gone = {i for s, n, p in want for i in range(s + p, s + n)}
        assert (r.n_words, [tuple(x) for x in r.runs]) == (len(w), want)
        assert r.collapsed == " ".join(x for i, x in enumerate(w) if i not in gone)
    assert periodic.periodic_runs(empty).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, exponent=1)


def test_op12_query_on_whole_tables(spark):
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, SF001).collect()}
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", text or "")
        n, h = len(w), zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs, r = plain_runs(w), got[i]
        gone = {k for s, m, p in runs for k in range(s + p, s + m)}
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (
            len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()


def plain_features(text, n=2, buckets=10_000):
    w = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOW))
    return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_line_counts_equal_whole_text_counts(docs, empty, n):
    want = collections.Counter()
    for t in [*TEXTS.values(), TEXTS[1], TEXTS[9]]:
        want.update(plain_features(t, n, 97)[1])
    assert resampling.feature_counts(docs, n=n, buckets=97).tolist() == [want[b] for b in range(97)]
    assert resampling.feature_counts(empty, n=n, buckets=97).tolist() == [0] * 97


def plain_draw(texts, target, least=20, percent=25):
    """Weight, score and rank of every (id, text)."""
    raw, aim = collections.Counter(), collections.Counter()
    own = [plain_features(t) for _, t in texts]
    for _, f in own:
        raw.update(f)
    for t in target:
        aim.update(plain_features(t)[1])
    s, t = sum(raw.values()), sum(aim.values())
    gain = [math.floor(1000 * math.log((aim[b] + 1) * (s + 10_000) / ((raw[b] + 1) * (t + 10_000)))) for b in range(10_000)]
    rows = []
    for (i, _), (n, f) in zip(texts, own, strict=True):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))))
    drawn = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    k = len(drawn) * percent // 100
    out = [(i, n, w, s, j + 1 if j < k else None) for j, (i, _, n, w, s) in enumerate(drawn)]
    return out + [(i, n, w, s, None) for i, words, n, w, s in rows if words < least]


def key(row):
    return tuple((x is None, x or 0) for x in row)


def test_importance_resample_rows(spark, docs, empty):
    target = spark.createDataFrame([("one two three four five",), (None,), ("w1 w2",)], "text string")
    texts = [*TEXTS.items(), (1, TEXTS[1]), (None, TEXTS[9]), (None, None)]
    for percent in (25, 60):
        got = [tuple(r) for r in resampling.importance_resample(docs, target, percent=percent).collect()]
        assert sorted(got, key=key) == sorted(plain_draw(texts, [t.text for t in target.collect()], 20, percent), key=key)
    assert resampling.importance_resample(empty, target).count() == 0
    none = target.filter(F.lit(False))
    assert sorted((tuple(r) for r in resampling.importance_resample(docs, none).collect()), key=key) == sorted(plain_draw(texts, []), key=key)


def test_op11_and_op13_queries_on_whole_tables(spark, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    bench = [r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    got = [tuple(r) for r in queries.op13_resampling(spark, SF001).collect()]
    assert sorted(got, key=key) == sorted(plain_draw(rows, bench), key=key)
    coded = {r.doc_id: r for r in queries.op11_byte_bpe(spark, SF001).collect()}
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        assert (coded[i].n_tokens, coded[i].ids_sha256, coded[i].decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
