"""Edge rows and brute-force comparisons of the training-data operators."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pricelens.llm import (
    components, decontaminate, exact_dedup, mixing, pitman_yor, quality, range_coder, scratch, secret_scan, shingle_join,
    token_counts, token_store, transducer, warc)
from pricelens.llm.shipping import prepare

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, score string, label string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
TEXTS = {
    1: "The quick brown fox jumps over the lazy dog near the old river bank today",
    2: "the quick brown fox jumps over the lazy dog near the old river bank today",
    3: "The quick brown fox jumps over the lazy dog near the old river bank today again",
    4: "", 5: None, 6: "one two three", 7: "One two THREE", 8: "it's the dog's 'real' <|endoftext|> x12 é ÉCOLE ΣΑΣ ö!!'s 'r",
    9: LONG, 10: LONG + " tail", 11: "   \n\t ", 12: "x" * 5000, 13: 'assign token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" here',
    14: "number 9807915762804490 here", 15: "naïve café İstanbul 東京   😀 don't we'll",
}


def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOW))


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    rows = [(i, t, "en" if i % 2 else "fr", f"src{i % 3}", 0, "a", "b", "c") for i, t in TEXTS.items()]
    rows += [(1, TEXTS[1], "en", "src0", 0, "a", "b", "c"), (None, TEXTS[2], None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def test_token_counts_equal_the_library(docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(TOKENIZER)
    for r in token_counts.token_counts(docs, TOKENIZER).collect():
        if r.doc_id is not None:
            text = TEXTS[r.doc_id] or ""
            assert r.n_tokens == len(library.encode(text, add_special_tokens=False).ids), text[:40]
            assert r.n_bytes == len(text.encode()) and r.over_limit == (r.n_tokens > 2048)
    assert token_counts.token_counts(docs, TOKENIZER).count() == len(TEXTS) + 3
    assert token_counts.token_counts(empty, TOKENIZER).count() == 0


def test_token_counter_on_random_strings():
    from tokenizers import Tokenizer

    library, machine, rng = Tokenizer.from_file(TOKENIZER), transducer.TokenCounter(TOKENIZER), np.random.default_rng(3)
    letters = list("abehlorstvmdREVL''' 019.,!-éßñ東\t\n")
    texts = ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(400)]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert machine.count(texts).tolist() == want
    # a state map composed over many chunks equals one walk
    cls = transducer.char_classes()[np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)]
    assert (transducer.scan_states(cls, 7) == transducer.scan_states(cls, 1 << 20)).all()


@pytest.mark.parametrize("key_chars", [64, 1])
def test_exact_dedup(docs, empty, key_chars):
    got = exact_dedup.exact_dedup(docs, salts=4, key_chars=key_chars).collect()
    every = [(i, (t or "").translate(LOW)) for i, t in TEXTS.items()] + [(1, TEXTS[1].lower()), (None, TEXTS[2]), (None, "")]
    groups = collections.defaultdict(list)
    for i, t in every:
        groups[hashlib.sha256(t.encode()).hexdigest()].append(i)
    assert len(got) == len(every)
    for r in got:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
    kept = collections.Counter(r.text_sha256 for r in got if r.kept)
    assert kept == {k: 1 for k in groups}
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_warc_round_trip(spark):
    prepare(spark)
    body = "<html>\r\n\r\nWARC/1.1\r\n" + "ü" * 80 + "</html>"
    rows = [(3, "http://a/ b\r\nX: y", body), (1, None, body), (2, "http://c", None), (4, "http://d", "short"),
            (5, "http://e", "short"), (None, "http://f", body), (1, "http://g", body), (7, "", "x" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload_digest", F.lit(1))
    path = scratch.scratch_path(spark, "warc-test")
    warc.write_archives(pages, path)
    got = warc.read_archives(spark, path).collect()
    assert len(got) == len(rows)
    for r in got:
        html = next(h for i, _, h in rows if i == r.page_id) or ""
        assert r.payload_bytes == len(html.encode()) and r.payload_digest == hashlib.sha256(html.encode()).hexdigest()
        assert (r.record_type, r.refers_to) == (("revisit", 1) if r.page_id == 3 else ("response", None))
    path = scratch.scratch_path(spark, "warc-empty")
    warc.write_archives(pages.limit(0), path)
    assert warc.read_archives(spark, path).count() == 0


def test_quality_learns_and_scores_every_row(spark, docs, empty):
    rng = np.random.default_rng(1)
    good = [" ".join(rng.choice(["the", "river", "runs", "over", "old", "stones"], 40)) for _ in range(120)]
    bad = [" | ".join(rng.choice(["THE!!", "RIVER%%", "RUNS##"], 30)) for _ in range(120)]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 120), 0) for i in range(240)] + [(None, 1, 0), (500, None, 0), (3, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    net = quality.fit(table, labels)
    held = quality.quality_scores(table, net).filter("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in held) and len(held) > 20
    assert np.mean([r.predicted == (r.doc_id < 120) for r in held]) > 0.95
    scores = quality.quality_scores(docs, net).collect()
    assert len(scores) == len(TEXTS) + 3 and all(0 <= r.score <= 1 for r in scores)
    assert quality.quality_scores(empty, quality.fit(empty.select("doc_id", "text"), labels)).count() == 0
    # a long text is taken in runs with the same result
    text = np.frombuffer(LONG.encode() * 3, np.uint8)
    one = net.logits(*quality.padded(text, np.array([0, len(text)])))[0]
    assert abs(quality._score_long(net, text) - one) < 1e-3


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())
    label = {i: i for i in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((label[a], label[b]))
                label = {k: x if v == y else v for k, v in label.items()}
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize("tile", [1024, 8])
def test_shingle_components(spark, docs, empty, tile):
    rng = np.random.default_rng(5)
    vocab = [f"w{i}" for i in range(300)]
    rows = []
    for base in range(6):                                     # groups of near copies around the threshold
        text = list(rng.choice(vocab, 60))
        for _ in range(14):
            edited = list(text)
            for k in rng.integers(0, 60, rng.integers(0, 4)):
                edited[k] = str(rng.choice(vocab))
            rows.append((len(rows), " ".join(edited)))
    got = shingle_join.shingle_components(spark.createDataFrame(rows, "doc_id long, text string"), tile=tile).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)
    if tile == 1024:
        got = shingle_join.shingle_components(docs).collect()
        want = brute_components(TEXTS.items())
        assert len(got) == len(TEXTS) + 3
        for r in got:
            assert r.component_id is None if r.doc_id is None else (r.n_shingles, r.component_id) == want[r.doc_id]
        assert shingle_join.shingle_components(empty).count() == 0


def test_components_in_many_runs(spark, monkeypatch):
    monkeypatch.setattr(components, "TASK_EDGES", 20)
    edges = [(i, i + 1) for i in range(100)] + [(200, k) for k in range(201, 260)] + [(300, 300), (401, 400)]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {**{i: 0 for i in range(101)}, **{k: 200 for k in range(200, 260)}, 400: 400, 401: 400}
    assert {r.node: r.component for r in got} == want


def test_decontamination(spark, docs, empty):
    question, answer = "What is the name of the long river that runs through the old town", "it is called the green river by all"
    items = spark.createDataFrame([(1, f"{question} {answer}"), (2, "zeta eta theta iota kappa lamda mu nu xi omicron pi rho"),
                                   (3, None), (4, "")], "item_id long, text string")
    filler = " ".join(f"fill{i}" for i in range(90))
    table = spark.createDataFrame([
        (1, f"{filler} {question.upper()}!! {answer}, {filler}"), (2, f"{filler} {question} {filler}"), (3, filler), (4, None),
        (5, ""), (None, f"{question} {answer}"), (6, f"{answer} {filler}")], "doc_id long, text string").withColumn("item_id", F.lit(9))
    got = decontaminate.retrieved_items(table, items).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in got if r.leaked) == [(0, 1), (1, 1)]
    flags = table.select("doc_id", decontaminate.leak_flags(table, items)(F.col("text")).alias("leak")).collect()
    assert {r.doc_id for r in flags if r.leak} == {1, None}
    assert decontaminate.retrieved_items(empty, items).count() == 0
    assert decontaminate.retrieved_items(docs, items.limit(0)).count() == 0


def test_decontamination_of_long_items(spark):
    """An item of 257 words is no leak by its last word, nor by its question alone."""
    item = [f"q{i}" for i in range(150)] + [f"a{i}" for i in range(106)] + ["common"]
    items = spark.createDataFrame([(1, " ".join(item[:150]), " ".join(item[150:]))], "item_id long, question string, answer string")
    filler = " ".join(f"fill{i}" for i in range(300))
    table = spark.createDataFrame([(1, f"{filler} common {filler}"), (2, f"{filler} {' '.join(item)} {filler}"),
                                   (3, f"{filler} {' '.join(item[:150])} common {filler}"), (4, " ".join(item[:140] + item[150:]))],
                                  "doc_id long, text string")
    got = decontaminate.retrieved_items(table, items).collect()
    assert sorted(r.doc_id for r in got if r.leaked) == [2, 4] and len({(r.doc_id, r.item_id) for r in got}) == len(got)
    flags = table.select("doc_id", decontaminate.leak_flags(table, items)(F.col("text")).alias("leak")).collect()
    assert {r.doc_id for r in flags if r.leak} == {2, 4}
    index = decontaminate.ItemIndex([(1, " ".join(item), "")])
    assert index.stride == decontaminate.MAX_ENTRY and index.pieces == [2]


def test_wand_retrieves_all_above_the_threshold():
    rng = np.random.default_rng(2)
    vocab = [f"t{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocab, 6)), " ".join(rng.choice(vocab, 6))) for i in range(150)]
    index = decontaminate.ItemIndex(items)
    for _ in range(60):
        terms = np.unique(rng.integers(0, len(index.terms), 14)).tolist()
        total = collections.Counter()
        for t in terms:
            for e, x in zip(index.entry[t], index.impact[t], strict=True):
                total[e] += x
        want = {e for e, x in total.items() if x >= 0.3}
        assert {e for e, _ in index.retrieve(terms, 0.3)} == want


def test_mixing_meets_targets(spark, docs, empty):
    rows = [(i, ("the river and the town " if i % 3 else "le fleuve et la ville ") * (1 + i % 5)) for i in range(90)]
    table = spark.createDataFrame(rows + [(None, None), (91, "")], "doc_id long, text string").withColumn("rate", F.lit("x"))
    labelled = spark.createDataFrame([(i, "en" if i % 3 else "fr") for i in range(0, 90, 2)] + [(None, "en"), (1, None)],
                                     "doc_id long, domain string")
    got = mixing.mixing_rates(table, labelled, {"en": 1.0, "fr": 1.0}).collect()
    assert len(got) == 92 and all(r.rate >= 0 for r in got)
    held = [sum(r.rate * r.n_tokens * r.posterior[k] for r in got) for k in range(2)]
    assert abs(held[0] - held[1]) < 0.01 * sum(held)
    mixed = mixing.mixed_documents(table, labelled)
    assert mixed.columns == table.columns and mixed.select("doc_id").distinct().count() == table.select("doc_id").distinct().count()
    assert mixing.mixing_rates(empty, labelled).count() == 0


@pytest.mark.parametrize("rare", [20, 2])
def test_mixing_meets_targets_of_rare_domains(spark, rare):
    """Domains of 1 % and of 0.1 % of the texts, brought to equal weights."""
    rows = [(i, "le fleuve et la ville" if i < rare else "the river and the town") for i in range(2000)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labelled = spark.createDataFrame([(i, "fr" if i < rare else "en") for i in range(0, 2000, max(1, rare // 2))], "doc_id long, domain string")
    for weights in ({"en": 1.0, "fr": 1.0}, None):
        _, rates, members = mixing.mixed(table, labelled, weights)
        got = members.select("n_tokens", "posterior", rates.rate(F.col("posterior")).alias("rate")).collect()
        held = np.array([sum(r.rate * r.n_tokens * r.posterior[k] for r in got) for k in range(2)])
        assert all(r.rate >= 0 for r in got) and held == pytest.approx(rates.targets, rel=1e-3) and rates.miss < 1e-3
        assert weights is None or held[0] == pytest.approx(held[1], rel=1e-3)


def test_mixing_gives_the_nearest_rates_where_targets_cannot_be_met(spark):
    same = spark.createDataFrame([(i, "one text for all") for i in range(40)], "doc_id long, text string")
    labelled = spark.createDataFrame([(i, "fr" if i % 4 else "en") for i in range(40)], "doc_id long, domain string")
    for weights in ({"en": 9.0, "fr": 1.0}, None):
        got = mixing.mixing_rates(same, labelled, weights).collect()
        assert len(got) == 40 and len({r.rate for r in got}) == 1 and got[0].rate > 0 and abs(got[0].domain_miss) > 0.01
        _, rates, _ = mixing.mixed(same, labelled, weights)
        assert rates.miss > 0.01
        # no other common rate brings the misses nearer
        unit = 1 / rates.totals

        def far(rate, rates=rates, unit=unit):
            return np.sum((unit * (rate * rates.totals - rates.targets)) ** 2)

        assert far(got[0].rate) <= min(far(got[0].rate * 0.999), far(got[0].rate * 1.001))


@pytest.mark.parametrize("weights", [[0.2, 0.5, 0.3], [0.0, 0.02, 0.98], [0.9, 0.1, 0.0]])
def test_mixing_rates_are_the_nearest(spark, weights):
    """The squared misses are those of many plain projected-gradient steps on all rates."""
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.6, 0.6, 0.6], 80) * 0.7 + 0.1
    n = rng.integers(0, 50, 80)
    members = spark.createDataFrame([(int(k), x.tolist()) for k, x in zip(n, p, strict=True)], "n_tokens long, posterior array<double>")
    rates = mixing.fit_rates(members, ["a", "b", "c"], dict(zip("abc", weights, strict=True)))
    own = np.array([r.r for r in members.select(rates.rate(F.col("posterior")).alias("r")).collect()])
    assert (own >= 0).all() and (n * own) @ p == pytest.approx(rates.reached)
    unit = 1 / np.sqrt((n[:, None] * p * p).sum(axis=0))
    plain, scale = np.ones(80), np.linalg.eigvalsh(unit[:, None] * (p.T @ (n[:, None] * p)) * unit)[-1]
    for _ in range(20_000):
        plain = np.maximum(0, plain - p @ (unit ** 2 * ((n * plain) @ p - rates.targets)) / scale)

    def far(r):
        return np.sum((unit * ((n * r) @ p - rates.targets)) ** 2)

    assert far(own) <= far(plain) * 1.01 + 1e-6 * np.sum((unit * rates.targets) ** 2)


def test_mixing_of_very_many_domains(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_DOMAINS", 3)
    rows = [(i, f"text of kind{i % 6} kind{i % 6}") for i in range(60)]
    labelled = spark.createDataFrame([(i, f"d{i % 6}") for i in range(40)], "doc_id long, domain string")
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert mixing.fit_classifier(table, labelled).domains == ["(rest)", "d0", "d1"]
    assert mixing.mixing_rates(table, labelled).count() == 60


def test_secret_scan(spark, docs, empty):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(60):
        key = "".join(rng.choice(list("0123456789abcdef"), 40))
        card = "".join(rng.choice(list("0123456789"), 16))
        rows.append((i, f'some words token = "{key}" then {card} and more', "a/b.py"))
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("score", F.lit(1))
    got = secret_scan.scored_findings(table).collect()
    assert len(got) == 120 and all(r.secret == (r.length == 40) for r in got)
    found = {r.doc_id for r in secret_scan.scored_findings(docs).collect() if r.doc_id is not None}
    assert {13, 14} <= found and not found & {1, 2, 3, 4, 5}
    assert secret_scan.scored_findings(empty).count() == 0


def test_secret_scan_learns_other_forms(spark):
    """Secrets in quotes, after a colon, in JSON and of known formats, among paths and digests that are none."""
    rng = np.random.default_rng(8)
    key = lambda n, signs="0123456789abcdefghijklmnopqrstuv": "".join(rng.choice(list(signs), n))
    forms = [lambda: f'api_key="{key(24)}1"', lambda: f"API_KEY={key(20)}7", lambda: f"password: {key(18)}3",
             lambda: f'{{"id":"x","token":"{key(30)}5"}}', lambda: "AKIA" + key(16, "ABCDEFGH234567")]
    plain = [lambda: f"sha1 {key(40, '0123456789abcdef')}", lambda: f"see /usr/share/doc/{key(12)}", lambda: key(16, "0123456789")]
    rows, want = [], {}
    for i in range(240):
        form = (forms + plain)[i % 8]
        rows.append((i, f"some words {form()} and more", "a/b.txt"))
        want[i] = i % 8 < 5
    got = secret_scan.scored_findings(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == 240 and all(r.secret == want[r.doc_id] for r in got)


def test_secret_scan_finds_every_run_of_a_word(spark):
    a, b, c = "0123456789abcdef01", "zyxwvutsrqponmlkjihgfedc", "QUJDREVGR0hJSktMTU5PUA=="
    docs = spark.createDataFrame([(1, f'{{"token":"{a}","secret":"{b}","n":1}}'), (2, f"pwd={a};aws_secret_access_key={c};x=1")],
                                 "doc_id long, text string")
    got = {(r.doc_id, r.word_index, r.run_index): (r.run, r.left) for r in secret_scan.candidates(docs).collect()}
    assert got == {(1, 0, 0): (a, '{"token":"'), (1, 0, 1): (b, a + '","secret":"'), (2, 0, 0): (a, "pwd="),
                   (2, 0, 1): ("aws_secret_access_key", a + ";"), (2, 0, 2): (c, "aws_secret_access_key=")}
    labels = {(r.doc_id, r.run_index): r.label for r in secret_scan.reviewed_findings(secret_scan.candidates(docs)).collect()}
    assert labels == {(1, 0): 1, (1, 1): 1, (2, 0): 1, (2, 1): 0, (2, 2): 1}


def test_pitman_yor_base_and_probability(spark, docs, empty):
    got = pitman_yor.language_model_scores(docs).collect()
    assert len(got) == len(TEXTS) + 3
    every = [(i, words(t) + [None]) for i, t in TEXTS.items()] + [(1, words(TEXTS[1]) + [None])]
    count = collections.Counter(w for i, ws in every if zlib.crc32(str(i).encode()) % 5 != 1 for w in ws)
    n, v = sum(count.values()), len(count)
    for r in got:
        ws = words(TEXTS.get(r.doc_id, TEXTS[2] if r.n_tokens > 1 else None)) + [None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(count[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(np.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), rel=1e-9)
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 1) and r.score <= 0
    assert pitman_yor.language_model_scores(empty).count() == 0


def test_pitman_yor_sums_to_one():
    """Over all known words and the unknown one, the prediction in every context is a distribution."""
    rng = np.random.default_rng(6)
    per = np.full(40, 3, np.uint32)
    ctx = np.tile(np.arange(3, dtype=np.uint16), 40)
    count = rng.integers(0, 5, 120) * rng.integers(0, 2, 120) + (ctx == 0)
    model = pitman_yor.Model(3, 40, int(count.sum()), np.bincount(ctx, weights=count, minlength=3))
    for s in range(3):
        t, c, u = list(model.states(0, per, ctx, count, s))[-1]
        model.history.append(pitman_yor.Totals(np.bincount(ctx, weights=t, minlength=3), float(c.sum()), float(u.sum())))
    p = model.predict(0, per, ctx, count)
    unknown = np.zeros(3)
    for totals in model.history[pitman_yor.BURN_IN + 1:]:
        base = model.parent(totals, np.zeros(1), np.zeros(1))[0]
        unknown += (model.strength + model.discount * totals.tables) * base / (model.strength + model.customers)
    assert np.bincount(ctx, weights=p, minlength=3) + unknown == pytest.approx(np.ones(3))


def test_pitman_yor_every_previous_word_has_its_own_restaurant(spark):
    """Texts of one shape score alike, however many previous words there are."""
    prepare(spark)
    rows = [(3 * i + k, f"left{i} right{i}") for i in range(2500) for k in range(3)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    fitted = pitman_yor.fit(table)
    scores = [r.score for r in pitman_yor.score(spark, fitted).collect()]
    assert len(scores) == 7500 and max(scores) - min(scores) < 0.5
    # the start of texts and 5,000 words, none of them merged
    own = fitted.tables.filter(F.col("part") < fitted.buckets).collect()
    assert len({x for r in own for x in np.cumsum(pitman_yor.unpack(r.contexts)[0], dtype=np.uint64).tolist()}) == 5001


def test_range_coder_and_token_files(spark, docs, empty):
    rng = np.random.default_rng(0)
    for n in (0, 1, 63, 64, 65, 1000):
        for top in (1, 2, 5000, 100_000):
            ids = rng.integers(0, top, n)
            zero = range_coder.ZeroOrder.of(ids)
            blocks = range_coder.encode_blocks(ids, 64, zero)
            assert np.array_equal(range_coder.decode_blocks(blocks, n, 64, zero), ids)
    from tokenizers import Tokenizer

    library, path = Tokenizer.from_file(TOKENIZER), scratch.scratch_path(spark, "tokens-test")
    token_store.write_token_files(docs, path, TOKENIZER, file_tokens=5000, block=256)
    got = token_store.read_token_files(spark, path, with_ids=True).orderBy("start").collect()
    assert len(got) == len(TEXTS) + 3 and [r.doc_id for r in got][2:] == sorted([*TEXTS, 1])
    at = 0
    for r in got:
        if r.doc_id is not None:
            ids = library.encode(TEXTS[r.doc_id] or "", add_special_tokens=False).ids + [2]
            raw = np.array(ids, "<u4").tobytes()
            assert (r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (at, len(ids), zlib.crc32(raw), raw)
        at += r.n_tokens
    content = bytearray(spark.read.parquet(path).first().content)
    content[-5] ^= 1
    with pytest.raises(ValueError):
        token_store.unpack_file(bytes(content))
    path = scratch.scratch_path(spark, "tokens-empty")
    token_store.write_token_files(empty, path, TOKENIZER)
    assert token_store.read_token_files(spark, path).count() == 0
