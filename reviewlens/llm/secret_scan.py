"""Secret scans: candidates by pattern, false positives removed by a random forest over native features."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.columns import word_array
from reviewlens.session import stage

#: Characters in a row, of those that keys are made of, that make a word a candidate.
LEAST = 16
KEY_CHARS = "A-Za-z0-9/+_-"
#: Signs between a name and its value, signs that end what a name stands for, and the end of a word that assigns.
MARKS, CLOSERS = "=:\"'`", r",;&?{}()<>\[\]"
ASSIGNS = "[=:][\"'`]*\\z"
#: Labelled findings that the forest learns from at most: those with the smallest hashes.
SAMPLE_ROWS, TREES, DEPTH = 20_000, 20, 5
#: Words of the dictionary: those in most documents, of DICTIONARY_CHARS letters or more.
DICTIONARY_WORDS, DICTIONARY_CHARS = 400, 3
#: What neighbouring words and names call a credential, and what paths call an example.
CREDENTIAL = "(?i)passw|passwd|pwd|secret|token|credential|api_?key|apikey|auth|bearer|private"
EXAMPLE = "(?i)test|example|sample|demo|fixture|docs?/"
#: A format that only keys of one issuer have.
ISSUED = r"\A(AKIA|ASIA)[A-Z0-9]{16}\z"
FEATURES = (
    "length", "digits", "capitals", "vowels", "changes", "coverage", "slashes", "example_path",
    "named", "named_before", "quoted", "assigned",
)


def dictionary(docs: DataFrame, text_col: str = "text") -> list[str]:
    """The words of letters that most documents have, at most ``DICTIONARY_WORDS`` of them."""
    words = docs.select(F.explode(F.array_distinct(word_array(F.lower(text_col)))).alias("word"))
    top = (
        words.filter(F.rlike("word", F.lit(rf"\A[a-z]{{{DICTIONARY_CHARS},12}}\z")))
        .groupBy("word")
        .count()
        .orderBy(F.desc("count"), "word")
        .limit(DICTIONARY_WORDS)
    )
    return sorted(row["word"] for row in top.collect())


def candidates(docs: DataFrame, words: list[str], id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """One row per candidate: the id, ``word_no``, ``part_no``, ``value``, its ``name`` and neighbours, and ``FEATURES``.

    Signs that separate (quotes, brackets, ``=``, ``:``, ``,``, ``;``, ``&``) part a word. Candidates are all runs of
    ``LEAST`` key characters or more in every part, and the whole part, however short, where it is assigned to a
    credential's name. ``name`` is the part before, unless a comma, bracket or the like stands between.
    """
    rows = docs.select(
        F.col(id_col),
        word_array(F.col(text_col)).alias("words"),
        (F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")).alias("path"),
    )
    fits = F.lit(f"[{KEY_CHARS}]{{{LEAST},}}")

    def near(at: Column) -> Column:
        return F.when(at >= 0, F.coalesce(F.get("words", at), F.lit(""))).otherwise("")

    def value_next(before: Column, before_that: Column) -> Column:
        """Whether a credential's name and the sign of an assignment stand before a word."""
        return F.rlike(before, F.lit(ASSIGNS)) & (
            F.rlike(before, F.lit(CREDENTIAL)) | (F.rlike(before, F.lit(rf"\A[{MARKS}]+\z")) & F.rlike(before_that, F.lit(CREDENTIAL)))
        )

    def holds(w: Column, i: Column) -> Column:
        long = (F.length(w) >= LEAST) & F.rlike(w, fits)
        own = F.rlike(w, F.lit("[=:]")) & F.rlike(w, F.lit(CREDENTIAL))
        return F.when(long | own | value_next(near(i - 1), near(i - 2)), i)

    found = rows.withColumn("word_no", F.explode(F.array_compact(F.transform("words", holds))))
    at = F.col("word_no")
    words_near = found.select(
        id_col, "path", "word_no", near(at).alias("word"), near(at - 1).alias("before"), near(at - 2).alias("before_that"), near(at + 1).alias("after")
    )
    cut = F.lit(f"([^{MARKS}{CLOSERS}]*)([{MARKS}{CLOSERS}]*)")
    parted = words_near.withColumn("texts", F.regexp_extract_all("word", cut, F.lit(1))).withColumn("signs", F.regexp_extract_all("word", cut, F.lit(2)))

    def values(text: Column, i: Column) -> Column:
        sign = F.when(i > 0, F.get("signs", i - 1)).otherwise("")
        bound = ~F.rlike(sign, F.lit(f"[{CLOSERS}]"))
        name = F.when((i > 0) & bound, F.get("texts", i - 1)).otherwise("")
        first = (i == 0) | ((i == 1) & (F.get("texts", i - 1) == ""))
        assigned = (bound & F.rlike(sign, F.lit("[=:]"))) | (first & F.rlike("before", F.lit(ASSIGNS)))
        given = (bound & F.rlike(sign, F.lit("[=:]")) & F.rlike(name, F.lit(CREDENTIAL))) | (first & value_next(F.col("before"), F.col("before_that")))
        runs = F.regexp_extract_all(text, fits, F.lit(0))
        whole = F.regexp_replace(text, r"\.+\z", "")
        more = F.when(given & (whole != "") & ~F.array_contains(runs, whole), F.array(whole)).otherwise(F.array().cast("array<string>"))
        quoted = F.rlike(F.concat(sign, F.get("signs", i)), F.lit("[\"'`]"))
        return F.transform(
            F.concat(runs, more),
            lambda value: F.struct(
                i.alias("part_no"), value.alias("value"), name.alias("name"), first.alias("first"), assigned.alias("is_assigned"),
                given.alias("given"), quoted.alias("is_quoted"),
            ),
        )

    each = F.explode(F.flatten(F.transform("texts", values))).alias("candidate")
    split = parted.select(id_col, "path", "word_no", "word", "before", "before_that", "after", each).select(
        id_col, "path", "word_no", "word", "before", "before_that", "after", "candidate.*"
    )
    length = F.length("value")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[0-9]", "0"), "[A-Z]", "A"), "[aeiou]", "e"), "[b-df-hj-np-tv-z]", "c")
    changes = length - F.length(F.regexp_replace(kinds, r"(.)\1+", "$1"))
    left = F.regexp_replace(F.lower("value"), "|".join(sorted(words, key=lambda w: (-len(w), w))), "") if words else F.col("value")

    def share(pattern: str) -> Column:
        return F.regexp_count("value", F.lit(pattern)) / length

    features = {
        "length": length,
        "digits": share("[0-9]"),
        "capitals": share("[A-Z]"),
        "vowels": share("[aeiouAEIOU]"),
        "changes": 1 - changes / length,
        "coverage": 1 - F.length(left) / length,
        "slashes": share("[/_-]"),
        "example_path": F.rlike("path", F.lit(EXAMPLE)) | F.rlike("before", F.lit(EXAMPLE)),
        "named": F.rlike("name", F.lit(CREDENTIAL)),
        "named_before": (F.col("first") | (F.col("name") == "")) & F.rlike(F.concat("before_that", F.lit(" "), "before"), F.lit(CREDENTIAL)),
        "quoted": F.col("is_quoted"),
        "assigned": F.col("is_assigned"),
    }
    return split.withColumns({k: v.cast("double") for k, v in features.items()})


def _vectors(found: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)


def fit(labelled: DataFrame, seed: int = 3) -> RandomForestClassificationModel | None:
    """A forest from labelled candidates (``label`` 1: a secret, 0: not); None with fewer than two classes.

    It learns from at most ``SAMPLE_ROWS`` different findings, half of each class, those with the smallest hashes: a
    finding that is repeated without end is one, and the rarer class keeps its half.
    """
    rows = labelled.filter("label in (0, 1)").select("value", *FEATURES, F.col("label").cast("double").alias("label")).distinct()
    rows = stage(rows, "different-findings")
    first = [rows.filter(F.col("label") == c).orderBy(F.xxhash64("value", *FEATURES), "value", *FEATURES).limit(SAMPLE_ROWS // 2) for c in (0, 1)]
    sample = stage(first[0].unionByName(first[1]), "findings")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featuresCol="features", labelCol="label")
    return forest.fit(_vectors(sample.select(*FEATURES, "label")))


def scan(found: DataFrame, model: RandomForestClassificationModel | None, threshold: float = 0.5) -> DataFrame:
    """Candidates with ``score``, the forest's probability of a secret, and ``secret`` from ``threshold`` on.

    Without a model there is no verdict: both are null.
    """
    if model is None:
        return found.withColumn("score", F.lit(None).cast("double")).withColumn("secret", F.lit(None).cast("boolean"))
    scored = model.transform(_vectors(found)).withColumn("score", vector_to_array("probability")[1])
    return scored.drop("features", "rawPrediction", "probability", "prediction").withColumn("secret", F.col("score") >= threshold)


def known_findings(found: DataFrame) -> DataFrame:
    """Candidates whose nature is beyond doubt, with ``label``: what a reviewer would have marked.

    Secrets are keys of a known issuer and hexadecimal or mixed values given to a credential's name. No
    secrets are words of letters in one case and numbers, but for those given to a credential's name, of which
    only frequent words are.
    """
    mixed = F.rlike("value", F.lit("[0-9]")) & F.rlike("value", F.lit("[A-Za-z]"))
    positive = F.rlike("value", F.lit(ISSUED)) | (((F.col("named") == 1) | (F.col("named_before") == 1)) & (F.col("assigned") == 1) & mixed)
    negative = F.rlike("value", F.lit(r"\A[A-Z]?[a-z/+_-]+\z")) | F.rlike("value", F.lit(r"\A[A-Z/+_-]+\z")) | F.rlike("value", F.lit(r"\A[0-9/+_-]+\z"))
    negative = negative & (~F.col("given") | (F.col("coverage") == 1))
    return found.withColumn("label", F.when(positive, 1).when(negative, 0)).filter("label is not null")


def secret_scan(
    docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None
) -> DataFrame:
    """Findings in all whole texts: the id, ``word_no`` (from 0), ``value``, ``score`` and ``secret``.

    Candidates are all runs of key characters, and shorter values of credentials' names; a random forest on their length, shares of characters, changes between
    kinds of characters, coverage by frequent words, path, name and neighbouring words removes false positives.
    ``labelled`` holds candidates (with features) and ``label``; without it, those beyond doubt in ``docs`` are
    the labelled findings. Rows of candidates are all returned; ``secret`` tells which pass.

    Null and empty texts have no candidates; neither has an empty table. Repeated rows give their findings each,
    a null id is kept, and other columns are left out, so their names don't matter. Ties of the forest's vote
    (0.5) count as secrets. Where the labelled findings are of one class, scores and verdicts are null.
    """
    found = stage(candidates(docs, dictionary(docs, text_col), id_col, text_col, path_col), "candidates")
    model = fit(known_findings(found) if labelled is None else labelled)
    return scan(found, model).select(id_col, "word_no", "value", "score", "secret")
