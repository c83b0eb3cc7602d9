"""Stages of the corpus pipeline on a small folder of tables, against brute force."""

from __future__ import annotations

import collections
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pricelens.llm.shipping import prepare

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
RNG = np.random.default_rng(11)
GOOD = ["river", "stones", "over", "the", "runs", "old", "and", "mill", "quiet", "water", "bridge", "evening", "town"]
FRENCH = ["le", "fleuve", "coule", "sous", "vieux", "pont", "et", "la", "ville", "dort", "encore", "soir", "une"]


def prose(words, n):
    return " ".join(RNG.choice(words, n))


ITEM = "which quiet mill stands beside the seven narrow bridges of harrowgate today the answer is the blue mill of old tom parker"
BASE = prose(GOOD, 60)
ROWS = [(i, prose(GOOD, 40), "en", "a", 0) for i in range(10, 60)] + [(i, prose(FRENCH, 40), "fr", "b", 0) for i in range(60, 75)]
ROWS += [(100, BASE, "en", "a", 0), (101, BASE + " end", "en", "a", 0), (102, BASE.upper(), "en", "a", 0), (102, BASE, "en", "b", 0),
         (103, prose(GOOD, 30) + " " + ITEM + " " + prose(GOOD, 30), "en", "a", 0), (104, None, None, None, None), (105, "", "en", "a", 0),
         (None, BASE, "en", "a", 0), (None, BASE, "en", "a", 0), (None, prose(GOOD, 20), None, None, None), (11, None, "en", "a", 0),
         (106, "word " * 9000, "en", "a", 0), (107, "same", "en", "a", 0), (107, "same", "en", "a", 0)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    prepare(spark)
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(ROWS, COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], int(r[0] % 7 != 0), 0) for r in ROWS if r[0] is not None] + [(None, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def sets_of(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOW))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_near_duplicates_keep_one_of_each_group(spark, docs, folder):
    got = corpus_pipeline.near_duplicates(spark, docs, folder)
    assert got.columns == docs.columns
    sets = collections.defaultdict(list)
    for i, text, *_ in ROWS:
        if i is not None:
            sets[i].append(sets_of(text))
    group = {i: i for i in sets}
    ids = sorted(sets)
    for _ in ids:                                               # smallest id along links, by plain passes
        for a in ids:
            for b in ids:
                if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    want = []
    for i in ids:
        if group[i] == i:
            want.append(min((r for r in ROWS if r[0] == i), key=lambda r: (r[1] or "", key(r))))
    want += [r for k, r in enumerate(ROWS) if r[0] is None and all(s[0] is not None or s[1] != r[1] for s in ROWS[:k])]
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


def test_decontamination_drops_the_planted_document_only(spark, docs, folder):
    got = [tuple(r) for r in corpus_pipeline.benchmark_decontamination(spark, docs, folder).collect()]
    assert sorted(got, key=key) == sorted((r for r in ROWS if r[0] != 103), key=key)


def test_quality_filter_keeps_rows_whole(spark, docs, folder):
    got = [tuple(r) for r in corpus_pipeline.quality_filter(spark, docs, folder).collect()]
    assert not collections.Counter(got) - collections.Counter(ROWS)


def test_mixing_repeats_and_drops_none(spark, docs, folder):
    got = corpus_pipeline.source_mixing(spark, docs, folder)
    assert got.columns == docs.columns
    counts = collections.Counter(tuple(r) for r in got.collect())
    assert set(counts) == set(ROWS)
    times = {lang: np.mean([counts[r] for r in set(ROWS) if r[2] == lang and r[1]]) for lang in ("en", "fr")}
    assert times["fr"] > 1.2 * times["en"]                       # tempered weights repeat the rarer language


def test_token_files_have_a_row_a_document(spark, docs, folder):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in corpus_pipeline.token_files(spark, docs, folder).collect())
    want = []
    for i, text, *_ in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((i is None, i or 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert got == sorted(want)


def test_stages_on_empty_tables(spark, docs, folder):
    none = docs.filter(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0


def test_run_applies_all_stages(spark, folder):
    got = corpus_pipeline.run(spark, folder).collect()
    ids = {r.doc_id for r in got}
    assert 103 not in ids and not {101, 102} & ids and len(got) >= 40
