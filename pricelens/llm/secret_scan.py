"""Secret scan: a random forest over candidate findings removes false positives.

Candidates are all long runs of key characters, several in a word where it has them.  Their features are
the run's length, its character transitions, the share that dictionary words cover, the document's path,
the text beside the run inside its word and the neighbouring words.  Everything is DataFrame functions and Spark's own forest.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.scratch import written

MIN_LENGTH = 16
MAX_TRAIN = 50_000       # labelled findings that the forest learns from
DICTIONARY = 500
TREES, DEPTH = 24, 6
THRESHOLD = 0.5
NEIGHBOURS = 64          # buckets of neighbouring words

#: Names that people assign secrets to (fixed values).
NAMES = ["token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "access_key", "private_key", "auth"]
#: Key formats that are secrets whatever stands before them (fixed values).
FORMATS = ["AKIA[0-9A-Z]{16}$", "ASIA[0-9A-Z]{16}$", "gh[pousr]_[A-Za-z0-9]{20,}$", "github_pat_[A-Za-z0-9_]{20,}$",
           "glpat-[A-Za-z0-9_-]{16,}$", "xox[abprs]-[A-Za-z0-9-]{10,}$", "AIza[A-Za-z0-9_-]{35}$",
           "[sr]k_(live|test)_[A-Za-z0-9]{8,}$", "sk-[A-Za-z0-9_-]{16,}$", "npm_[A-Za-z0-9]{20,}$"]
_KEY = r"[A-Za-z0-9+/_\-]"
#: '=' belongs to a run as padding at its end, elsewhere it assigns.
_RUN = rf"{_KEY}{{{MIN_LENGTH},}}(?:={{1,2}}(?![A-Za-z0-9+/_\-=\"']))?"
#: Text that ends in a secret's name, in quotes or not, an assigning sign and an opening quote.
_ASSIGNED = (rf"({'|'.join(n.replace('_', '[_-]?') for n in NAMES)}|authorization)[\"'\])]*\s*(:=|=>|={{1,3}}|:)"
             rf"\s*[\"'(\[]*\s*((bearer|basic)\s+)?$")
_KINDS = ("v", "c", "u", "d", "o")       # vowel, consonant, upper case, digit, other


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The most frequent words of four letters or more, counted over all texts."""
    words = docs.select(F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+")).alias("w"))
    found = words.filter(F.col("w").rlike("^[a-z]{4,12}$")).groupBy("w").count().orderBy(F.desc("count"), "w").limit(size)
    return [r.w for r in found.collect()]


def candidates(docs: DataFrame, path_col: str = "source") -> DataFrame:
    """Every candidate of every whole text.

    ``doc_id, word_index, run_index, run, before2, before, left, right, after, path``: ``run_index`` counts the
    runs of a word, ``left`` and ``right`` are the text inside the word up to the next runs (``left`` with the
    run before).
    """
    path = F.col(path_col).cast("string") if path_col in docs.columns else F.lit(None).cast("string")
    words = docs.select(F.col("doc_id"), F.coalesce(path, F.lit("")).alias("path"),
                        F.split(F.coalesce("text", F.lit("")), r"\s+").alias("words"))
    hits = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("i"), w.alias("w"))),
                    lambda x: (F.length(x["w"]) >= MIN_LENGTH) & x["w"].rlike(_RUN))
    near = lambda x, k: F.coalesce(F.get("words", x["i"] + k), F.lit(""))
    # only rows with a candidate are exploded, and a word's arrays are made once
    rows = words.withColumn("hits", hits).filter(F.size("hits") > 0).withColumn("hits", F.transform("hits", lambda x: F.struct(
        x["i"].alias("i"), F.regexp_extract_all(x["w"], F.lit(_RUN), F.lit(0)).alias("runs"), F.split(x["w"], _RUN).alias("gaps"),
        near(x, -2).alias("before2"), near(x, -1).alias("before"), near(x, 1).alias("after"))))
    gap = lambda x, k: F.coalesce(F.get(x["gaps"], k), F.lit(""))
    found = F.flatten(F.transform("hits", lambda x: F.transform(x["runs"], lambda run, k: F.struct(
        x["i"].alias("word_index"), k.alias("run_index"), run.alias("run"), x["before2"].alias("before2"), x["before"].alias("before"),
        F.concat(F.coalesce(F.get(x["runs"], k - 1), F.lit("")), gap(x, k)).alias("left"), gap(x, k + 1).alias("right"),
        x["after"].alias("after")))))
    return rows.select("doc_id", "path", F.explode(found).alias("hit")).select("doc_id", "hit.*", "path")


def features(found: DataFrame, words: list[str]) -> tuple[DataFrame, list[str]]:
    """``found`` with numeric feature columns, and their names."""
    run, low = F.col("run"), F.lower("run")
    size = F.greatest(F.length(run), F.lit(1)).cast("double")
    kinds = F.translate(run, "aeiouAEIOUbcdfghjklmnpqrstvwxyzBCDFGHJKLMNPQRSTVWXYZ0123456789+/_=-",
                        "vvvvvuuuuu" + "c" * 21 + "u" * 21 + "d" * 10 + "ooooo")
    out = {"f_length": F.length(run).cast("double"),
           "f_distinct": F.size(F.array_distinct(F.split(run, ""))) / size,
           "f_hex": low.rlike("^[0-9a-f]+$").cast("double")}
    for a in _KINDS:
        out[f"f_{a}"] = F.regexp_count("__kinds", F.lit(a)) / size
        for b in _KINDS:
            out[f"f_{a}{b}"] = F.regexp_count("__kinds", F.lit(f"{a}(?={b})")) / size
    pattern = "|".join(sorted(words, key=lambda w: (-len(w), w))) or "(?!)"
    out["f_dictionary"] = 1 - F.length(F.regexp_replace(low, pattern, "")) / size
    path = F.lower("path")
    out["f_path_depth"] = F.regexp_count(path, F.lit("/")).cast("double")
    out["f_path_test"] = path.rlike("test|example|sample|mock|fixture|lock").cast("double")
    out["f_path"] = F.pmod(F.xxhash64(path), F.lit(NEIGHBOURS)).cast("double")
    for side in ("before2", "before", "after"):
        word = F.lower(side)
        out[f"f_{side}"] = F.pmod(F.xxhash64(word), F.lit(NEIGHBOURS)).cast("double")
        out[f"f_{side}_sign"] = word.rlike(r"^[^a-z0-9]+$").cast("double")
        out[f"f_{side}_name"] = named(word).cast("double")
    for side in ("left", "right"):
        out[f"f_{side}"] = F.pmod(F.xxhash64(F.regexp_extract(side, "[^A-Za-z0-9]*$" if side == "left" else "^[^A-Za-z0-9]*", 0)),
                                  F.lit(NEIGHBOURS)).cast("double")
    out["f_left_name"] = named("left").cast("double")
    out["f_assigned"] = assigned().cast("double")
    out["f_format"] = known_format().cast("double")
    out["f_digit"] = run.rlike("[0-9]").cast("double")
    return found.withColumn("__kinds", kinds).withColumns(out).drop("__kinds"), list(out)


def named(word: Column | str) -> Column:
    """Whether a word ends in a name that secrets are assigned to."""
    return F.regexp_replace(F.lower(word), r"[^a-z_]", "").rlike(f"({'|'.join(NAMES)})$")


def assigned() -> Column:
    """Whether the text before a run, in its word or the two before, assigns the run to a secret's name."""
    return F.lower(F.concat_ws(" ", "before2", "before", "left")).rlike(_ASSIGNED)


def known_format() -> Column:
    return F.col("run").rlike(f"^({'|'.join(FORMATS)})")


def reviewed_findings(found: DataFrame) -> DataFrame:
    """``doc_id, word_index, run_index, label`` as a reviewer's rule gives them, where no labelled findings exist.

    A run in a known key format is a secret, and one that is assigned to a secret's name, unless it reads
    like a name or path itself: under 32 signs, no digit, but signs between words.  Anything else is not.
    """
    run = F.col("run")
    secret = known_format() | (assigned() & (run.rlike("[0-9]") | (F.length(run) >= 32) | ~run.rlike("[_/-]")))
    return found.select("doc_id", "word_index", "run_index", secret.cast("double").alias("label"))


def fit(featured: DataFrame, names: list[str], labelled: DataFrame, max_rows: int = MAX_TRAIN
        ) -> RandomForestClassificationModel | None:
    """Forest trained on at most ``max_rows`` labelled findings; None where labels are not of both kinds."""
    key = ["doc_id", "word_index", "run_index"]
    if "run_index" not in labelled.columns:
        labelled = labelled.withColumn("run_index", F.lit(0))
    rows = (labelled.filter("doc_id is not null and label is not null").groupBy(*key).agg(F.max("label").alias("label"))
            .orderBy(F.crc32(F.concat_ws("/", F.lit("secret"), *key)), *key).limit(max_rows))
    train = featured.join(rows, key).select("label", *names)
    if train.select("label").distinct().count() < 2:
        return None
    data = VectorAssembler(inputCols=names, outputCol="features").transform(train).select("label", "features")
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=NEIGHBOURS, seed=11).fit(data)


def scored_findings(docs: DataFrame, labelled: DataFrame | None = None, path_col: str = "source",
                    audited: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Every candidate with the forest's probability: ``doc_id, word_index, run_index, length, masked, score, secret``.

    ``labelled`` has ``doc_id, word_index, label`` and ``run_index`` (default: a word's first run); without it, the findings of ``audited`` documents
    (``doc_id``; default: all) are labelled by ``reviewed_findings``.  Where the labels are all alike
    the score is that label (0 without any).  Null and empty texts have no candidates; repeated rows and
    null ids are scored each (a null id teaches nothing); other columns are not read.
    """
    found = written(candidates(docs, path_col), "findings")
    if labelled is None:
        own = found if audited is None else found.join(audited.select("doc_id").distinct(), "doc_id", "left_semi")
        labelled = reviewed_findings(own)
    featured, names = features(found, dictionary(docs))
    model = fit(featured, names, labelled)
    if model is None:
        constant = labelled.agg(F.coalesce(F.max("label"), F.lit(0.0))).first()[0]
        scored = found.withColumn("score", F.lit(float(constant)))
    else:
        vectors = VectorAssembler(inputCols=names, outputCol="features").transform(featured)
        scored = model.transform(vectors).withColumn("score", vector_to_array("probability")[1])
    masked = F.concat(F.substring("run", 1, 4), F.lit("..."))
    return scored.select("doc_id", F.col("word_index").cast("long").alias("word_index"), "run_index", F.length("run").alias("length"),
                         masked.alias("masked"), "score", (F.col("score") >= threshold).alias("secret"))
