"""Word hashes, library ids and BM25 statistics on inputs made to break them."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest

from pricelens.llm import (
    arrays, components, decontaminate, pitman_yor, range_coder, scratch, shingle_join, textbatch, token_store, transducer,
    unicode_classes)
from pricelens.llm.shipping import prepare

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SWAP = str.maketrans("ab", "ba")


def thue_morse(n: int) -> str:
    word = "a"
    while len(word) < n:
        word += word.translate(SWAP)
    return word


def test_word_hashes_tell_words_apart():
    rng = random.Random(1)
    words = [w for n in (8, 16, 64, 256, 512, 1024, 2048, 4096) for w in (thue_morse(n), thue_morse(n).translate(SWAP))]
    words += ["".join(rng.choice("abABé") for _ in range(rng.randrange(1, 30))) for _ in range(10_000)]
    words += ["a" * k for k in range(1, 700)] + ["x" * 8 + "y" * 8, "y" * 8 + "x" * 8, "x" * 300 + "y", "x" * 301]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    hashes, first = textbatch.text_words(data, np.array([0, len(data)]))
    assert first.tolist() == [0, len(words)]
    seen: dict[str, set[int]] = {}
    for word, h in zip(words, hashes.tolist(), strict=True):
        seen.setdefault(word.translate(LOW), set()).add(h)
    assert all(len(h) == 1 for h in seen.values()) and len(set.union(*seen.values())) == len(seen)


def test_different_long_words_are_not_linked(spark):
    prepare(spark)
    word = thue_morse(1024)
    rows = [(1, word), (2, word.translate(SWAP)), (3, word.upper())]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           shingle_join.shingle_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (1, 1)}


def odd_texts(n: int) -> list[str]:
    rng = random.Random(7)

    def sign() -> str:
        return chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x600), rng.randrange(0x300, 0x370), 0x130, 0x3A3, 32,
                               rng.randrange(0x600, 0xD7FF), rng.randrange(0xE000, 0xFFFF), rng.randrange(0x10000, 0x1FFFF)]))

    return ["".join(sign() for _ in range(rng.randrange(25))) for _ in range(n)]


def test_ids_equal_the_library_on_odd_texts():
    machine = token_store.TokenEncoder(TOKENIZER)
    machine.MAX_KNOWN = 3000                                   # forgets on the way
    long = thue_morse(2048)
    texts = ["ab İ̳ cd", f"{long} {long.translate(SWAP)}", "", "<|endoftext|> x", "İ̳ <|ENDOFTEXT|>", "'s''s 'll"]
    texts += odd_texts(6000)
    for i in range(0, len(texts), 500):
        own = texts[i:i + 500]
        ids, sizes = machine.encode(own, 2)
        want = [e.ids + [2] for e in machine.library.encode_batch(own, add_special_tokens=False)]
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
        assert machine.machine.count(own).tolist() == [len(w) - 1 for w in want]


def test_token_files_hold_the_library_ids(spark):
    prepare(spark)
    texts = {1: "ab İ̳ cd", 2: "plain", 3: thue_morse(2048) + " " + thue_morse(2048).translate(SWAP)}
    path = scratch.scratch_path(spark, "tokens-odd")
    token_store.write_token_files(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), path, TOKENIZER)
    library, at = token_store.TokenEncoder(TOKENIZER).library, 0
    for r in token_store.read_token_files(spark, path, with_ids=True).orderBy("start").collect():
        want = library.encode(texts[r.doc_id], add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) == (at, len(want), want)
        at += len(want)


def test_code_point_classes_are_the_library_s():
    from tokenizers import Regex, pre_tokenizers

    classes, _ = unicode_classes.code_point_classes()
    points = [c for c in range(0x80, 0x110000, 13) if not 0xD800 <= c < 0xE000]
    text = " ".join(map(chr, points))
    for pattern, kind in ((r"\p{L}", unicode_classes.LETTER), (r"\p{N}", unicode_classes.DIGIT)):
        found = pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(text)
        assert [points[a // 2] for _, (a, _) in found] == [c for c in points if classes[c] == kind]


@pytest.mark.parametrize("block_bytes", [400, 3000])
def test_scores_do_not_depend_on_item_blocks(spark, block_bytes):
    prepare(spark)
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(rng.choice(words, int(rng.integers(5, 40))))) for k in range(38)]
    rows += [(38, " ".join(rng.choice(words, 700))), (39, ""), (40, None)]
    items = spark.createDataFrame(rows, "item_id long, text string").repartition(3)
    whole, = decontaminate.item_blocks(items)
    parts = list(decontaminate.item_blocks(items, block_bytes))
    assert len(parts) > 1 and {p.stride for p in parts if p.item} == {whole.stride}

    def impacts(index):
        return {(index.item[index.owner[e]], int(t)): round(x, 12) for t, es, xs in
                zip(index.terms.tolist(), index.entry, index.impact, strict=True) for e, x in zip(es, xs, strict=True)
                if index.pieces[index.owner[e]] == 1}

    want = impacts(whole)
    got = {}
    for p in parts:
        got |= impacts(p)
    assert got == want and len(want) > 300


def test_released_passes_batches_on():
    assert list(arrays.released(lambda xs: (x + 1 for x in xs))(iter([1, 2]))) == [2, 3]


def test_spans_of_neighbours_are_those_of_the_machine():
    rng = np.random.default_rng(5)
    for n in [1, 2, 3, *rng.integers(4, 60, 2000).tolist()]:
        cls = rng.choice([0, 1, 2, 3, 3, 3, 4, 5, 6, 7, 8, 9], n).astype(np.uint8)
        cls[-1] = transducer.SPACE
        for own, want in zip(transducer.pretoken_spans(cls), transducer.pretoken_starts(cls), strict=True):
            assert np.array_equal(own, want)


def test_slices_encoded_together_have_the_library_ids():
    machine = token_store.TokenEncoder(TOKENIZER)
    machine.MAX_KNOWN = 50                                     # drops the pre-tokens met longest ago
    rng = random.Random(8)
    for _ in range(4):
        texts = [odd_texts(40), [], [""], ["<|endoftext|>", "it's we'll 're", "<|endoftext|> x"],
                 [" ".join(rng.choices(["ab", "cd", "ef", "12", "été"], k=30))]]
        coded = machine.encode_splits([machine.split(t) for t in texts], 2)
        for own, (ids, counts) in zip(texts, coded, strict=True):
            want = [machine.library.encode(t, add_special_tokens=False).ids + [2] for t in own]
            assert ids.tolist() == sum(want, []) and counts.tolist() == [len(w) for w in want]
        assert len(machine.known) == len(machine.size) == len(machine.met) <= 50 and machine.size.sum() == len(machine.pool)


def test_files_coded_side_by_side_equal_files_coded_alone():
    rng = np.random.default_rng(3)
    tokens = [rng.zipf(1.3, n).clip(0, top) for n, top in ((700, 50), (0, 5), (64, 3), (1, 9), (333, 40_000))]
    files = [(x, range_coder.ZeroOrder.of(x)) for x in tokens]
    coded = range_coder.encode_files(files, 64)
    assert coded == [range_coder.encode_blocks(x, 64, z) for x, z in files]
    for got, want in zip(range_coder.decode_files([(b, len(x), z) for b, (x, z) in zip(coded, files, strict=True)], 64), tokens, strict=True):
        assert np.array_equal(got, want)
    kept = [token_store.Tokens(np.arange(1), np.zeros(1, bool), np.array([len(x)]), x) for x in tokens]
    contents = [*token_store.pack_files(kept, 64), *token_store.pack_files(kept[:1], 128)]
    got = list(token_store.unpack_files(contents))
    assert [x.tokens.tolist() for x in got] == [x.tolist() for x in [*tokens, tokens[0]]]
    assert contents[0] == token_store.pack_file(np.arange(1), np.zeros(1, bool), np.array([700]), tokens[0], 64)


def test_word_numbers_give_the_pairs_and_pack_better():
    rng = np.random.default_rng(4)
    hashes = np.append(rng.integers(0, 1 << 63, 3000).astype(np.uint64), pitman_yor.END)
    n = rng.integers(1, 60, 2000)
    words = hashes[rng.zipf(1.2, n.sum()).clip(0, 2999)]
    words[np.cumsum(n) - 1] = pitman_yor.END
    before = np.concatenate([words[:1], words[:-1]])
    before[np.cumsum(n) - n] = pitman_yor.START
    w, _, pair = pitman_yor.distinct_pairs(words, before)
    numbers = pitman_yor.numbered_words(w, pair)
    assert np.array_equal(pitman_yor.numbered_pairs(*numbers, n), pair)
    assert len(arrays.pack(*numbers)) < len(arrays.pack(pair))


def test_flushes_send_each_bucket_a_context_once(spark):
    prepare(spark)
    text = " ".join(f"{'the' if k % 2 else 'w' + str(k % 997)}" for k in range(20_000))
    docs = spark.createDataFrame([(1, True, text + " " + " ".join(f"w{k % 997} z{k}" for k in range(20_000)))], "id long, train boolean, text string")
    blobs = [pitman_yor.unpack(r.payload) for r in pitman_yor.occurrences(docs, 2).collect() if r.part < 2]
    for own, per, before, place, count in blobs:
        assert per.sum() == len(place) == len(count) and len(np.unique(np.cumsum(before, dtype=np.uint64))) == len(before) < len(place)


def _sets(spark, sets):
    rows = [(rep, len(s), np.sort(np.array(list(s), np.uint64)).tobytes()) for rep, s in sets]
    return spark.createDataFrame(rows, "rep long, n long, shingles binary").repartition(3)


def _groups(edges):
    return {r.node: r.component for r in components.components(edges).collect()}


def _linked(a, b):
    return 100 * len(a & b) >= 75 * len(a | b)


@pytest.mark.parametrize("paired", [32, 4])
def test_a_few_common_rare_shingles_join_no_blocks(spark, monkeypatch, paired):
    monkeypatch.setattr(shingle_join, "PAIRED", paired, raising=False)
    rng = np.random.default_rng(3)
    sets, group = [], {}
    for g in range(20):                        # near copies; the last of a group and the first of the next share shingle g
        base = [int(x) for x in rng.integers(1 << 40, 1 << 62, 64)]
        for k in range(3 if g else 12):
            own = {*base[:60], *(int(x) for x in rng.integers(1 << 40, 1 << 62, 4))}
            own |= {g} if k == 2 else {g - 1} if k == 0 and g else set()
            own |= {1000 + len(sets) % 2}      # held by very many
            group[len(sets)] = g
            sets.append((len(sets), own))
    edges = shingle_join.block_edges(_sets(spark, sets), np.zeros(1 << shingle_join.SKETCH_BITS, np.uint8), 3)
    found = _groups(edges)
    first = {g: min(i for i in group if group[i] == g) for g in group.values()}
    assert found == {i: first[g] for i, g in group.items()}


@pytest.mark.parametrize("paired", [32, 2])
def test_linked_classes_share_a_block(spark, monkeypatch, paired):
    monkeypatch.setattr(shingle_join, "PAIRED", paired, raising=False)
    rng = np.random.default_rng(4)
    sets = []
    for n in (1, 2, 3, 4, 5, 7, 9, 16, 17, 33, 48, 80):
        for _ in range(3):
            base = [int(x) for x in rng.choice(400, n, replace=False)]
            for size in rng.integers(-(-3 * n // 4), n + 1, 5).tolist():
                more = rng.integers(0, n // 8 + 1)
                sets.append((int(rng.integers(0, 150)), {*base[:size], *(int(x) for x in rng.choice(400, more))}))
    sets += sets[:10]                          # rows that come twice; ids repeat as well
    rank = rng.integers(0, 3, 1 << shingle_join.SKETCH_BITS).astype(np.uint8)
    spread = [(rep, {x << 52 | x for x in s}) for rep, s in sets]
    found = _groups(shingle_join.block_edges(_sets(spark, spread), rank, 4))
    links = [(a, b) for a, s in sets for b, t in sets if a < b and _linked(s, t)]
    assert len(links) > 100 and all(found[a] == found[b] for a, b in links)


def test_large_block_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "PASS_SETS", 1, raising=False)
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(14):                        # pairs that nothing else links, in one block
        base = [int(x) for x in rng.integers(0, 1 << 62, 24)]
        sets += [(len(sets), set(base)), (len(sets) + 1, set(base[1:]))]
    edges = spark.createDataFrame([(0, k) for k in range(1, len(sets))], "a long, b long")
    found = _groups(shingle_join.block_links(_sets(spark, sets), edges, tile=6))
    assert found == {k: k - k % 2 for k in range(len(sets))}
